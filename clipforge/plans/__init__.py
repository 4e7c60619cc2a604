"""Query plans: the operators composed over the given tables, one function per query."""
