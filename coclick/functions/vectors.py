"""Dense-vector expressions over ``array<float|double>`` columns (SC12, SC13)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a, b) -> Column:
    prods = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(_col(a), F.lit(0.0).cast("double"),
                              lambda acc, x: acc + x.cast("double") * x.cast("double")))


def l2_normalize(a) -> Column:
    # the norm is the element of an outer array: once per vector, not once per number
    scaled = F.transform(F.array(norm(a)), lambda n: F.transform(_col(a), lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0))))
    return F.get(scaled, F.lit(0))
