"""DataFrame -> DataFrame operators (no session, no sinks)."""
