from .names import NameRules, key_names, rename, rename_struct, table_name, table_name_of, transform_name, unique_names
from .numbers import json_text, normalize_numbers
from .selection import is_selected, selects
from .timeformat import java_pattern
from .types import FIXED_SCHEMA, METADATA_COLUMNS, StreamSpec, resolve_schema, to_struct

__all__ = [
    "FIXED_SCHEMA", "METADATA_COLUMNS", "NameRules", "StreamSpec", "is_selected", "java_pattern",
    "json_text", "key_names", "normalize_numbers", "rename", "rename_struct", "resolve_schema", "selects",
    "table_name", "table_name_of", "to_struct", "transform_name", "unique_names",
]
