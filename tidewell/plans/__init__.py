"""Jobs: the operators composed over stored tables."""
