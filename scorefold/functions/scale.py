"""Grading scales."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scorefold import labels
from scorefold.functions.casts import quoted


def scale4_sql(score: str, steps=labels.SCALE4_STEPS, top: float = labels.SCALE4_TOP) -> str:
    """The ladder as SQL text over a SQL operand.

    Tables with a column per subject need dozens of ladders; as text each is
    one call into the JVM instead of one per branch.
    """
    branches = " ".join(f"WHEN {score} >= {float(floor)}D THEN {float(value)}D" for floor, value in steps)
    return f"CASE WHEN {score} > {float(top)}D THEN 0.0D {branches} ELSE 0.0D END"


def reaches_sql(score: str, bound: float, steps=labels.SCALE4_STEPS, top: float = labels.SCALE4_TOP) -> str:
    """`scaled value >= bound` as a range of the raw score; steps rise with their floors."""
    if bound <= 0:
        return "true"
    floors = [floor for floor, value in steps if value >= bound]
    return f"{score} >= {float(min(floors))}D AND {score} <= {float(top)}D" if floors else "false"


def scale4(score: Column | str, steps=labels.SCALE4_STEPS, top: float = labels.SCALE4_TOP) -> Column:
    """10-point score -> 4-point value; null, below the lowest step or above the top -> 0."""
    if isinstance(score, str):
        return F.expr(scale4_sql(quoted(score), steps, top))
    ladder = F.when(score > top, 0.0)
    for floor, value in steps:
        ladder = ladder.when(score >= floor, value)
    return ladder.otherwise(0.0)
