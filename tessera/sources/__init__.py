"""Source relations and sinks."""
