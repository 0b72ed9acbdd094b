"""Scans: click logs, whitelists, partition lookups, text and vector inputs."""

from coclick.sources.clicks import (day_range_filter, latest_partition, latest_snapshot,
                                    local_date, local_day_filter, local_day_ts_filter,
                                    local_day_window, read_clicks, read_whitelist)
from coclick.sources.text import read_sentences, read_user_lists, read_vectors

__all__ = [
    "day_range_filter", "latest_partition", "latest_snapshot", "local_date",
    "local_day_filter", "local_day_ts_filter", "local_day_window", "read_clicks",
    "read_whitelist", "read_sentences", "read_user_lists", "read_vectors",
]
