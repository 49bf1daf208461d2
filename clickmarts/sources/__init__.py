"""Sources (date-sharded raw exports, property union) and sinks."""
