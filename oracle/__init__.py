from oracle.sql import oracle_sql

__all__ = ["oracle_sql"]
