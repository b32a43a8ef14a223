"""Column expressions and aggregates that run inside Catalyst plans."""
