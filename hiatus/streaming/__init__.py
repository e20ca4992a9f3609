from hiatus.streaming.sessions import closed_sessions, read_event_files, write_closed_sessions

__all__ = ["closed_sessions", "read_event_files", "write_closed_sessions"]
