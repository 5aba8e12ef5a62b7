"""Multi-step plans: gold tables, the benchmark suite, the declarative pipeline."""
