"""Column expressions shared by the operators: casts, keys, calendar parts, money."""
