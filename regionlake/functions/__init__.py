"""Column expressions; no actions and no Python workers."""
