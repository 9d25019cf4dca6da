"""Queries over the driver's tables, one or more per operator, with checking SQL."""

from tabwright.queries import modelling, preparation, profiles, sources, statistics
from tabwright.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "modelling", "preparation", "profiles", "sources", "statistics"]
