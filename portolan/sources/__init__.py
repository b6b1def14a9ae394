"""Sources and sinks: files, code lists, warehouse tables, test-data views."""
