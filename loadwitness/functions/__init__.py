"""Column expressions; each takes Columns and returns one Column, none is a UDF."""
