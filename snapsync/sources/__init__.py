"""Sources and sinks: databases, catalogue tables, file trees."""
