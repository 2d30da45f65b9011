"""Readers, writers and saved models."""

from sievework.sources.models import load_model, save_model
from sievework.sources.readers import (
    drop_embedded_header,
    read_csv,
    read_csv_inferred,
    read_table,
)
from sievework.sources.scratch import scratch_dir
from sievework.sources.small import small_table
from sievework.sources.writers import (
    list_tables,
    table_counts,
    write_csv,
    write_parts,
    write_table,
    write_tables,
)

__all__ = [
    "drop_embedded_header",
    "list_tables",
    "load_model",
    "read_csv",
    "read_csv_inferred",
    "read_table",
    "save_model",
    "scratch_dir",
    "small_table",
    "table_counts",
    "write_csv",
    "write_parts",
    "write_table",
    "write_tables",
]
