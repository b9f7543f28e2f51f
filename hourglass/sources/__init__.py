"""Sources: given tables, domain adapters, raw JSON files, sinks."""
