"""Sources: driver tables, partition-scoped tables, transports, dead letters."""
