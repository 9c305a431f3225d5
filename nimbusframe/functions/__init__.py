"""Column functions: scalar (F1-F14, F21-F25, X1-X2) and nested."""
