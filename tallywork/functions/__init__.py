"""Column-level helpers: text rules, network addresses, clock values, user functions."""
