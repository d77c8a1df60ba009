"""Sources and sinks: files, tables, search connectors, batch clients."""
