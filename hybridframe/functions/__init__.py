"""Column expressions: predicates, distances, tokens and record codecs."""
