from tillroll.sources.csv_files import (
    SOURCE_FILE,
    SkippedFile,
    find_csv,
    read_events,
    read_inferred,
    usable_files,
    with_source_file,
)
from tillroll.sources.files import FileFacts, archive_files, list_files
from tillroll.sources.tables import (
    append_rows,
    create_table_if_missing,
    drop_table,
    replace_partitions,
    replace_table,
)

__all__ = [
    "SOURCE_FILE",
    "FileFacts",
    "SkippedFile",
    "append_rows",
    "archive_files",
    "create_table_if_missing",
    "drop_table",
    "find_csv",
    "list_files",
    "read_events",
    "read_inferred",
    "replace_partitions",
    "replace_table",
    "usable_files",
    "with_source_file",
]
