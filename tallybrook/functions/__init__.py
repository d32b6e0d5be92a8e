"""Column functions: no job here ever runs by itself."""
