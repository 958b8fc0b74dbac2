"""Sources and sinks: CSV landing files, derived test views, the registry."""
