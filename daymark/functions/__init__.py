"""Column expressions shared by the operators; all are built-in Spark functions."""
