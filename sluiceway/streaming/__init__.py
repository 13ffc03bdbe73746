from .loads import appended_state, read_appended, read_rejected, stream_append, stream_load

__all__ = ["appended_state", "read_appended", "read_rejected", "stream_append", "stream_load"]
