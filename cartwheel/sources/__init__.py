"""Sources and sinks: the test-data adapter, payload landing, the warehouse."""
