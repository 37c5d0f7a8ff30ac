"""Column-level rules shared by every plan."""
