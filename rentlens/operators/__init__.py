"""DataFrame operators. Column names are arguments with the rental schema as default."""
