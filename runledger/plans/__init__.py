"""Driver queries over the provided tables and their oracle SQL."""
