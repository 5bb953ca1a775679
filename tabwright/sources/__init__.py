"""Reading and writing tables, reports, mappings and packages."""
