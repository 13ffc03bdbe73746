from .envelope import parse_records, project_denormalized, project_fixed, stamp_metadata
from .evolve import conform, evolve, evolve_frame, evolve_table, missing_fields
from .mapping import alias_streams, flatten, map_stream
from .merge import conflicts, dedupe_latest, merge_columns, upsert
from .quality import reject_reason, split_corrupt, split_valid
from .views import json_path, typed_view, view_columns

__all__ = [
    "alias_streams", "conflicts", "conform", "dedupe_latest", "evolve", "evolve_frame", "evolve_table", "flatten", "json_path",
    "map_stream", "merge_columns", "missing_fields", "parse_records", "project_denormalized",
    "project_fixed", "reject_reason", "split_corrupt", "split_valid", "stamp_metadata", "typed_view",
    "upsert", "view_columns",
]
