"""Reports and jobs, and the registry of runnable queries."""
