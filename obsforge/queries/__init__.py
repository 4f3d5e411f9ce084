"""Registered queries: one Spark callable per operator, with the equivalent SQL where there is one."""

from obsforge.queries import encoding, evaluation, feeding, modelling, profiling, relational, runs
from obsforge.queries.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "encoding", "evaluation", "feeding", "modelling", "profiling", "relational", "runs"]
