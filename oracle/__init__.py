"""DuckDB SQL that recomputes every query from the driver's tables, independently of Spark."""
