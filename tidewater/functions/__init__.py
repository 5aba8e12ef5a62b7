"""Column functions: ids, JSON checks, time windows."""
