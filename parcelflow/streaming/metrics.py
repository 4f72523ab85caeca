"""What streams drop or set aside, counted over all of their progress.

Spark keeps the last hundred progress reports of a query, and counts late rows after they
were summed in part.  Here named observations count rows on their way, before anything is
summed, and a listener adds them up for as long as it is attached.
"""

from __future__ import annotations

from collections import Counter
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from parcelflow.functions import times

#: Names of the observations.
CAPTURE, DAYS = "capture", "days"

#: Days of a micro-batch that are counted one by one; a batch of more makes the count a lower bound.
MOST_DAYS = 1_000


def observe_days(rows: DataFrame, ts: str, offset_hours: int) -> DataFrame:
    """Count the rows of each business day of a micro-batch, before they are summed."""
    day = times.day_number(ts, offset_hours).cast("bigint")
    # with ten times as many places as days the counts are exact
    tally = F.expr(f"approx_top_k(_observed_day, {MOST_DAYS}, {10 * MOST_DAYS})").alias("days")
    return rows.withColumn("_observed_day", day).observe(DAYS, tally).drop("_observed_day")


class StreamCounts(StreamingQueryListener):
    """Adds up, per query id: rows captured, malformed ones, and rows that came after their day was over.

    A row is late if its day ended at or before the watermark of the micro-batch before its
    own, which is when the aggregation drops it (the first batch that a listener sees is held
    against its own watermark).  ``exact`` turns false should a batch ever have more days than
    are counted one by one.
    """

    def __init__(self, offset_hours: int = times.BUSINESS_OFFSET_HOURS):
        self.offset_ms = offset_hours * times.HOUR_MS
        self.captured, self.malformed, self.late = Counter(), Counter(), Counter()
        self.exact = True
        self._before: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.add(str(event.progress.id), event.progress.eventTime, event.progress.observedMetrics)

    def add(self, query: str, event_time: dict, observed: dict) -> None:
        seen = observed.get(CAPTURE)
        if seen is not None:
            self.captured[query] += seen["rows"]
            self.malformed[query] += seen["malformed"]
        now = event_time.get("watermark")
        now = int(datetime.fromisoformat(now.replace("Z", "+00:00")).timestamp() * 1000) if now else 0
        before, self._before[query] = self._before.get(query, now), now
        seen = observed.get(DAYS)
        if seen is not None and seen["days"]:
            over = [r for r in seen["days"] if r["item"] is not None and (r["item"] + 1) * times.DAY_MS - self.offset_ms <= before]
            self.late[query] += sum(r["count"] for r in over)
            self.exact &= len(seen["days"]) < MOST_DAYS


def count_streams(spark: SparkSession, offset_hours: int = times.BUSINESS_OFFSET_HOURS) -> StreamCounts:
    """Attach a listener to the session; it counts until ``spark.streams.removeListener``."""
    counts = StreamCounts(offset_hours)
    spark.streams.addListener(counts)
    return counts
