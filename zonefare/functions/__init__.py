"""Column-returning scalar functions; none of them is a Python UDF."""
