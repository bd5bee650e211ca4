"""The operators applied to the test tables, each with the SQL that checks it."""

from tuneframe.queries import evaluation, ordering, outputs, preparation, profile, training  # noqa: F401
from tuneframe.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
