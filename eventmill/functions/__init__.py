"""Column expressions shared by the operators. All are built-in Spark expressions."""
