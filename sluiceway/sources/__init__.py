from .files import batch_manifest, read_batch_files, read_lake
from .messages import (
    as_messages,
    latest_state,
    read_lines,
    read_messages,
    records_of,
    stream_lines,
    stream_specs,
    unknown_streams,
    with_order,
)

__all__ = [
    "as_messages", "batch_manifest", "latest_state", "read_batch_files", "read_lake", "read_lines",
    "read_messages", "records_of", "stream_lines", "stream_specs", "unknown_streams", "with_order",
]
