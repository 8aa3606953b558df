"""Column functions: text clean-up and predicates."""
