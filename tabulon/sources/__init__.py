"""Reading and writing tables, metadata dumps, override logs and layers."""

from tabulon.sources.incremental import file_manifest, reuse_and_new, stale_only, unprocessed
from tabulon.sources.metadata import flatten_reading, metadata_fields
from tabulon.sources.readers import read_csv, read_or_empty, read_parquet, read_published_sheet
from tabulon.sources.writers import append_overrides, write_csv, write_json, write_layer, write_metrics

__all__ = [
    "append_overrides", "file_manifest", "flatten_reading", "metadata_fields", "read_csv", "read_or_empty",
    "read_parquet", "read_published_sheet", "reuse_and_new", "stale_only", "unprocessed", "write_csv",
    "write_json", "write_layer", "write_metrics",
]
