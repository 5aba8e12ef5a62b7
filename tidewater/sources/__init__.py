"""Sources and sinks: files, tables, message logs, write modes."""
