"""Vector expressions for ARRAY<DOUBLE> columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MIN_NORM = 1e-12  # fixed value: shorter vectors are divided by this instead
SIM_DIGITS = 10  # similarities are compared after rounding to this many places


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x * x))


def l2_normalize(vector: Column) -> Column:
    """v / max(|v|, 1e-12). The norm is taken once per row, not once per element."""
    scaled = F.transform(
        F.array(F.struct(vector.alias("v"), F.greatest(norm(vector), F.lit(MIN_NORM)).alias("n"))),
        lambda s: F.transform(s["v"], lambda x: x / s["n"]),
    )
    return scaled[0]
