"""Column functions over relevance scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sigmoid(score: Column) -> Column:
    """Score on 0..1; a row without a score stays without one."""
    return 1 / (1 + F.exp(-0.1 * score))


def score_or_zero(score: Column) -> Column:
    return F.coalesce(score.try_cast("double"), F.lit(0.0))


def reciprocal_rank(rank: Column, offset: int = 60) -> Column:
    return 1.0 / (offset + rank)
