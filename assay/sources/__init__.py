"""Feed declarations, scans and sinks."""
