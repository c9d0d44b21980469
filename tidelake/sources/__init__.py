"""Reading tables and raw files."""
