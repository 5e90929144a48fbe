"""Sources (R1-R6)."""
