"""Writers of tables and of graph files."""
