"""Column functions: values, paths, casts."""
