"""Column factories: they build expressions and never touch a DataFrame."""
