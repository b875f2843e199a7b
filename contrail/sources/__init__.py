"""Reading files, landing flight files, and stored tables."""
