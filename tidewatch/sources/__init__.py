"""Table readers, sinks and schema contracts."""
