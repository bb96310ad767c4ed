"""Column expressions shared by the sources and operators."""
