from .lake import lake_load, stage_to_lake
from .loads import (
    LoadConfig,
    LoadError,
    LoadResult,
    create_view,
    load,
    load_messages,
    load_stream,
    read_state,
    resolve_mode,
)
from .tables import (
    LandingTable,
    cluster_layout,
    compact,
    expire_partitions,
    expire_staging,
    partition_column,
    partition_value,
    read_between,
    staging_name,
)

__all__ = [
    "LandingTable", "LoadConfig", "LoadError", "LoadResult", "cluster_layout", "compact", "create_view",
    "expire_partitions", "expire_staging", "lake_load", "load", "load_messages", "load_stream", "partition_column", "partition_value",
    "read_between", "read_state", "resolve_mode", "stage_to_lake", "staging_name",
]
