"""Sources and sinks: landing files, seeds, test-data adapter."""
