"""Column functions: no job, no shuffle, no Python on the rows."""
