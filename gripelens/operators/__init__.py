"""DataFrame jobs."""
