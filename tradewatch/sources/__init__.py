"""Sources and sinks: fixtures over the given tables, landing zips, layer I/O."""
