"""Both nearest matches of a sensor row on streams, from one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.asof import Feed
from millrace.streaming.nearest import matched


def stream_matches(left: DataFrame, feeds: Sequence[Feed], columns: Sequence[str], delay: str = "1 hour") -> DataFrame:
    """Rows of ``left`` (``event_id``, ``machine_id``, ``ts`` and ``columns``) with the nearest row of every feed.

    The feeds and ``left`` form one stream, each feed matched within its own tolerance, and all best matches are found in
    one aggregation (see ``nearest.matched``). A chain of one match per feed would lose rows: what the first gives out
    late is behind the watermark of the second.
    """
    found = [F.col(f"_best_{f.name}.{c}").alias(c) for f in feeds for c in f.columns]
    return matched(left, feeds, columns, delay).select("event_id", "machine_id", "ts", *columns, *found)
