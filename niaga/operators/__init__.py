from niaga.operators.keys import (
    BUCKET_BYTES,
    BUCKET_ROWS,
    CODEC,
    MOST_BUCKETS,
    MOST_WRITERS,
    RANGE_ROWS,
    STORED,
    bucket_count,
    dense_key,
    dense_key_by_day,
    frequent_keys,
    range_count,
    staged_bounds,
    write_buckets,
)
from niaga.operators.relational import distinct_values, keep_first, lookup, top

__all__ = [
    "BUCKET_BYTES",
    "BUCKET_ROWS",
    "CODEC",
    "MOST_BUCKETS",
    "MOST_WRITERS",
    "RANGE_ROWS",
    "STORED",
    "bucket_count",
    "dense_key",
    "dense_key_by_day",
    "distinct_values",
    "frequent_keys",
    "keep_first",
    "lookup",
    "range_count",
    "staged_bounds",
    "top",
    "write_buckets",
]
