"""The driver's test tables seen as domain tables, and the registered queries with their SQL twins."""
