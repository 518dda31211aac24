"""Sources and sinks: CSV scan, staging, run folders, and the test-table fixture."""
