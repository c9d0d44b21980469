"""Writing tables, keyed tables and the catalog."""
