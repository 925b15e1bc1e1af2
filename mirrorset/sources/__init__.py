from mirrorset.sources.sqlite import SqliteDataSource, read_sqlite, register_sqlite, write_sqlite
from mirrorset.sources.staging import release, stage, staged_path, staging, staging_root
from mirrorset.sources.tables import (
    copy_tables,
    dictionary_values,
    empty_like,
    load_tables,
    register_tables,
    write_table,
)

__all__ = [
    "SqliteDataSource",
    "copy_tables",
    "dictionary_values",
    "empty_like",
    "load_tables",
    "read_sqlite",
    "register_sqlite",
    "register_tables",
    "release",
    "stage",
    "staged_path",
    "staging",
    "staging_root",
    "write_sqlite",
    "write_table",
]
