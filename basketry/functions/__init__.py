"""Column expressions shared by all layers."""
