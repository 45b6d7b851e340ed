"""File readers, table readers and sinks."""
