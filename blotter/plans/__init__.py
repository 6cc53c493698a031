"""Query plans: stand-in inputs from the driver's tables and the registry
of named queries with their SQL oracles."""
