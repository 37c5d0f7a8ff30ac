"""The pipeline's tables, checks, reports and audit queries."""
