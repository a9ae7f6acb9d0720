from daybook.sources.errors import classify_error
from daybook.sources.files import (
    COMMENT_SCHEMA,
    TRIP_SCHEMA,
    Loaded,
    check_options,
    conform,
    month_paths,
    read_leaf,
    read_months,
    read_parquet,
    read_partitioned,
    stage,
)
from daybook.sources.footers import read_footers
from daybook.sources.index import Period, index_files, read_period, refreshed
from daybook.sources.listing import Directory, input_size, list_directory, list_files, probe_sources
from daybook.sources.tree import list_tree, tree_sizes

__all__ = [
    "COMMENT_SCHEMA",
    "Directory",
    "Period",
    "TRIP_SCHEMA",
    "Loaded",
    "check_options",
    "classify_error",
    "conform",
    "index_files",
    "input_size",
    "list_directory",
    "list_files",
    "list_tree",
    "month_paths",
    "probe_sources",
    "read_footers",
    "read_leaf",
    "read_months",
    "read_parquet",
    "read_partitioned",
    "read_period",
    "refreshed",
    "stage",
    "tree_sizes",
]
