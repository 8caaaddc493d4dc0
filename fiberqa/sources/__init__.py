"""Reading tables, choosing datasets and writing results."""
