"""Schemas, readers, writers and staged tables."""

from opslens.sources.keyed import KeyedTable, per_key, store_keyed, with_groups
from opslens.sources.staging import release, stage, staging_root
from opslens.sources.tables import (
    append_rows,
    load_profile,
    load_tables,
    preview,
    read_csv,
    read_database,
    read_parquet,
    replace_table,
    vacuum_table,
    write_csv,
)

__all__ = [
    "KeyedTable",
    "append_rows",
    "load_profile",
    "load_tables",
    "per_key",
    "preview",
    "read_csv",
    "read_database",
    "read_parquet",
    "replace_table",
    "stage",
    "store_keyed",
    "staging_root",
    "vacuum_table",
    "with_groups",
    "write_csv",
]
