"""Query plans: the named-query registry and the batch jobs."""
