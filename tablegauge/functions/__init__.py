"""Column expressions: scalar rules, array arithmetic, value formatting."""
