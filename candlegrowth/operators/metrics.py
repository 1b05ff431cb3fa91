"""Numbers of a load, taken while its rows are written; no second scan."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from candlegrowth.operators import audit, clean

#: What `reject_reason` names, one by one.
REASONS = [text.removesuffix("_text") for text, _ in clean.CELLS.values()] + ["cells"]
NAMES = ["rows", "rejected", *[f"bad_{reason}" for reason in REASONS], "sum_low", "sum_high"]


def observed(staged, row_hash="row_hash"):
    """(rows, observation): the same rows, and the numbers of NAMES when they have been written once.

    The rows need reject_reason and a hash. A row with two bad cells counts under both reasons.
    """
    seen = Observation()
    reasons = F.split("reject_reason", ",")
    low, high = audit.hash_sums(row_hash)
    numbers = [
        F.count(F.lit(1)), F.count_if(F.col("reject_reason") != ""),
        *[F.count_if(F.array_contains(reasons, reason)) for reason in REASONS], low, high,
    ]
    return staged.observe(seen, *[x.alias(name) for x, name in zip(numbers, NAMES)]), seen


def numbers(observation):
    """The observed numbers; waits until the rows are written."""
    return {name: int(observation.get[name]) for name in NAMES}
