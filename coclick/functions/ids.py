"""Item ids out of a JSON payload column (SRC3, SRC4, SC1, SC2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def item_id_strict(payload, path: str = "$.itemid") -> Column:
    """Strict-digit parse: a value made only of digits becomes a bigint,
    anything else (missing key, sign, decimal point, text) becomes 0.

    ``{"itemid":12}`` and ``{"itemid":"12"}`` -> 12; ``"1.0"``, ``{}``, ``-5`` -> 0.
    Callers then drop id 0 as invalid.
    """
    v = F.get_json_object(_col(payload), path)
    return F.when(v.rlike("^[0-9]+$"), F.coalesce(v.try_cast("bigint"), F.lit(0).cast("bigint"))) \
        .otherwise(F.lit(0).cast("bigint"))


def item_id_cast(payload, path: str = "$.itemid") -> Column:
    """Lenient cast of the JSON value to bigint; unparsable -> null.

    ``try_cast`` rather than ``cast``: with ANSI mode (Spark 4 default) a plain
    cast of a bad string raises instead of returning null.
    """
    return F.get_json_object(_col(payload), path).try_cast("bigint")


def parsed_payload(payload) -> Column:
    """The JSON payload parsed once (VARIANT), for any number of typed paths; broken JSON -> null."""
    return F.try_parse_json(_col(payload))


def variant_id_strict(parsed, path: str = "$.itemid") -> Column:
    """:func:`item_id_strict` on a parsed payload."""
    v = F.try_variant_get(_col(parsed), path, "string")
    return F.when(v.rlike("^[0-9]+$"), F.coalesce(v.try_cast("bigint"), F.lit(0).cast("bigint"))) \
        .otherwise(F.lit(0).cast("bigint"))


def variant_id_cast(parsed, path: str = "$.itemid") -> Column:
    """:func:`item_id_cast` on a parsed payload."""
    return F.try_variant_get(_col(parsed), path, "string").try_cast("bigint")
