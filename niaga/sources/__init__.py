from niaga.sources.files import SourceError, SourceFrame, export_csv, read_all, read_csv
from niaga.sources.testtables import sample_sources

__all__ = ["SourceError", "SourceFrame", "export_csv", "read_all", "read_csv", "sample_sources"]
