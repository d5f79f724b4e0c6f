"""Column helpers: semi-structured access, scalars, bands and predicates."""
