"""Distributed building blocks: ordered prefixes, rank selection, exact quantiles."""
