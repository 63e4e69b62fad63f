"""Column functions: parsing, predicates, time, sets."""
