"""Array / list rendering as text (SC5, SC7, SC10, SNK5, SNK6)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def array_text(arr) -> Column:
    """``[1,2,3]``; an empty array gives ``[]``."""
    return F.concat(F.lit("["), F.array_join(F.transform(_col(arr), lambda x: x.cast("string")), ","), F.lit("]"))


def nested_array_text(arr) -> Column:
    """``[[1],[2,3]]``; inner empty lists give ``[]``, an empty outer list ``[]``."""
    inner = F.transform(_col(arr), lambda a: array_text(a))
    return F.concat(F.lit("["), F.array_join(inner, ","), F.lit("]"))


def score_pairs_text(items, sep: str = ";", fmt: str = "%d:%f") -> Column:
    """Render an ``array<struct<item, score>>`` as ``id:score;id:score``.

    ``fmt='%d:%f'`` gives six decimals like the list files; pass ``None`` to
    print the raw double the way a string cast does.
    """
    if fmt is None:
        parts = F.transform(_col(items), lambda s: F.concat(s["item"].cast("string"), F.lit(":"),
                                                           s["score"].cast("string")))
    else:
        parts = F.transform(_col(items), lambda s: F.format_string(fmt, s["item"], s["score"]))
    return F.array_join(parts, sep)
