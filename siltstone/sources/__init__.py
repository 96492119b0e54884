"""Sources and sinks: files, seeds, the landing zone, versioned tables."""
