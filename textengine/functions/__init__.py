"""Column -> Column rewrites and predicates, and the profiles that parametrise them."""
