"""Operators: each is a function from DataFrame to DataFrame; fitted state is a small table."""
