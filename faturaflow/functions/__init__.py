"""Column expressions shared by the operators. No Python UDF anywhere."""
