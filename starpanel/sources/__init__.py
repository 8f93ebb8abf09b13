"""Sources and sinks: the verified extract and the versioned store."""
