"""Plan-time helpers shared by the operators: skew, ordering, scratch space."""
