"""Sources and sinks: the test feed, bronze landing, lake tables, the symbol seed."""
