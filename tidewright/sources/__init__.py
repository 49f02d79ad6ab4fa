"""Files and catalog tables: scans, sinks, the source registry, the load log."""
