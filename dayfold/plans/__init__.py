"""Star schema, the questions asked of it, and the batch jobs."""
