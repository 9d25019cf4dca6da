"""tabwright: profile, clean, sample and model wide tables as Spark DataFrame plans."""

from tabwright.functions import draw, geo, labels, numeric, predicates
from tabwright.operators import (
    caps,
    features,
    impute,
    outliers,
    profile,
    rank,
    sample,
    stats,
)
from tabwright.sources import files, staging

__all__ = [
    "caps", "draw", "features", "files", "geo", "impute", "labels", "numeric",
    "outliers", "predicates", "profile", "rank", "sample", "staging", "stats",
]
