"""Click-log scans and partition lookups (SRC1-SRC10, SRC14).

Filters are written as plain column predicates on the raw columns so that
Catalyst pushes them into the Parquet scan (equality / range on partition
columns prunes directories).  JSON parsing comes after the pushed filters.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coclick.functions.ids import item_id_cast, item_id_strict


def _date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def local_day_window(day, tz_hours: int) -> tuple[dt.datetime, dt.datetime]:
    """UTC [start, end) of local calendar day ``day`` at UTC offset ``tz_hours``."""
    start = dt.datetime.combine(_date(day), dt.time()) - dt.timedelta(hours=tz_hours)
    return start, start + dt.timedelta(days=1)


def local_day_filter(date_col: str, hour_col: str, day, tz_hours: int) -> Column:
    """SRC5 on (utc date, utc hour) partition columns.

    tz=+7, day D -> (date=D-1 and hour>=17) or (date=D and hour<=16).  Works for
    negative offsets too (the reference mis-handles those).
    """
    start, end = local_day_window(day, tz_hours)
    first = (F.col(date_col) == F.lit(start.date())) & (F.col(hour_col) >= start.hour)
    if end.hour == 0:
        return first
    second = (F.col(date_col) == F.lit(end.date())) & (F.col(hour_col) < end.hour)
    return first | second


def local_day_ts_filter(ts_col: str, day, tz_hours: int, ntz: bool = True) -> Column:
    """SRC5 on a UTC timestamp column: start <= ts < end (pushed to Parquet)."""
    start, end = local_day_window(day, tz_hours)
    kind = "timestamp_ntz" if ntz else "timestamp"
    lo = F.lit(start.isoformat(sep=" ")).cast(kind)
    hi = F.lit(end.isoformat(sep=" ")).cast(kind)
    return (F.col(ts_col) >= lo) & (F.col(ts_col) < hi)


def local_days_ts_filter(ts_col: str, day, n_days: int, tz_hours: int, ntz: bool = True) -> Column:
    """Local days D-n .. D (n+1 days) on a UTC timestamp column."""
    start, _ = local_day_window(_date(day) - dt.timedelta(days=n_days), tz_hours)
    _, end = local_day_window(day, tz_hours)
    kind = "timestamp_ntz" if ntz else "timestamp"
    return (F.col(ts_col) >= F.lit(start.isoformat(sep=" ")).cast(kind)) & \
        (F.col(ts_col) < F.lit(end.isoformat(sep=" ")).cast(kind))


def local_date(ts_col: str, tz_hours: int) -> Column:
    """Local calendar date of a UTC timestamp."""
    return F.to_date(F.col(ts_col) + F.make_interval(hours=F.lit(tz_hours)))


def day_range_filter(day_col: str, day, n_days: int) -> Column:
    """SRC9: the ``n_days + 1`` days D-n .. D, inclusive, on a date partition column."""
    d = _date(day)
    return F.col(day_col).between(F.lit(d - dt.timedelta(days=n_days)), F.lit(d))


def read_clicks(log: DataFrame, *, region: str | None = None, day=None, tz_hours: int | None = None,
                operation: str | None = "click", target_type: str | None = "item",
                placement: tuple[str, str] | None = None, strict_ids: bool = True,
                user_col: str = "userid", session_col: str | None = "session_id",
                ts_col: str = "event_timestamp", payload_col: str = "data",
                region_col: str = "region", date_col: str = "utc_date", hour_col: str = "hour",
                item_path: str = "$.itemid") -> DataFrame:
    """SRC1/SRC2/SRC3/SRC4/SRC5: project (user, session, item, ts) from a raw click log.

    ``strict_ids=True`` applies the digit-only parse and drops id 0 (item-CF,
    user-CF); ``False`` casts leniently and drops nulls (graph, Swing).
    """
    cond = (F.col(payload_col).isNotNull()) & (F.length(payload_col) > 0) & (F.col(user_col) > 0)
    if region is not None:
        cond = cond & (F.col(region_col) == region)
    if operation is not None:
        cond = cond & (F.col("operation") == operation)
    if target_type is not None:
        cond = cond & (F.col("target_type") == target_type)
    if placement is not None:
        page_type, section = placement
        cond = cond & (F.col("page_type") == page_type) & (F.col("page_section").getItem(0) == section)
    if day is not None:
        cond = cond & (local_day_filter(date_col, hour_col, day, tz_hours or 0) if tz_hours is not None
                       else (F.col(date_col) == F.lit(_date(day))))
    df = log.where(cond)
    item = item_id_strict(payload_col, item_path) if strict_ids else item_id_cast(payload_col, item_path)
    cols = [F.col(user_col).cast("bigint").alias("user")]
    if session_col:
        cols.append(F.col(session_col).alias("session"))
    cols += [item.alias("item"), F.col(ts_col).alias("ts")]
    out = df.select(*cols)
    return out.where(F.col("item") != 0) if strict_ids else out.where(F.col("item").isNotNull())


def read_whitelist(items: DataFrame, *, item_col: str = "itemid", region: str | None = None,
                   day=None, region_col: str = "region", date_col: str = "date") -> DataFrame:
    """SRC6: the recommendable id set for a region and day, as a distinct id column."""
    cond = F.lit(True)
    if region is not None:
        cond = cond & (F.col(region_col) == region)
    if day is not None:
        cond = cond & (F.col(date_col) == F.lit(_date(day)))
    return items.where(cond).select(F.col(item_col).cast("bigint").alias("item")).distinct()


def latest_partition(df: DataFrame, part_col: str, by: list[str] | None = None) -> DataFrame:
    """SRC7/SRC8: keep only rows of the newest ``part_col`` value (per ``by`` group).

    Without ``by`` this is a scalar subquery (``max`` computed once, then a
    plain filter); with ``by`` a join to the per-group maximum.  No value
    travels through the driver.
    """
    if not by:
        spark = df.sparkSession
        return spark.sql(f"SELECT * FROM {{src}} WHERE `{part_col}` = (SELECT max(`{part_col}`) FROM {{src}})",
                         src=df)
    newest = df.groupBy(*by).agg(F.max(part_col).alias("__newest"))
    return df.join(newest, on=by, how="inner").where(F.col(part_col) == F.col("__newest")).drop("__newest")


def latest_snapshot(spark, base: str) -> str | None:
    """SRC10: newest child directory of ``base`` holding a success marker; None when there is none."""
    from coclick.sinks.files import complete_snapshots

    done = complete_snapshots(spark, base)
    return done[0] if done else None
