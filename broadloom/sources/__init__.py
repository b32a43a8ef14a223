"""File readers and writers, and deterministic row generators."""
