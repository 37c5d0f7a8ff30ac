"""Commerce analytics on Spark: staging, facts, history, revenue marts, checks and audit."""
