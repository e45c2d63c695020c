"""Column expressions: everything here is built from Spark's own functions and stays inside codegen."""
