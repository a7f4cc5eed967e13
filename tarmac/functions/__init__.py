"""Column functions: plain expressions, evaluated inside Spark's generated code."""
