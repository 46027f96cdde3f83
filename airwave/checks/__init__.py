"""The engine's queries over the host's test tables, and the same queries in ANSI SQL."""
