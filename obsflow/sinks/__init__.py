"""Writers: DataFrames to files, catalog tables and databases."""
