"""Event-time windows that only a stream needs; the others serve both."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.operators.windows import Merged, merged


def sessions(
    df: DataFrame, ts: str, gap: str, counts: Mapping[str, Column | Merged | None], keys: Sequence[str] = ()
) -> DataFrame:
    """Sessions per key of a watermarked stream, emitted when closed.

    Without keys a stream has one session sequence and so one reducer. Sessions
    made by ``build_session`` let the tasks merge their own rows first
    (``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition``), so that the
    reducer sees sessions only; set it in a session of your own.
    """
    # Spark asks for a grouping column beside the session; it must not be a literal.
    groups = [F.col(k) for k in keys] or [(F.pmod(F.xxhash64(ts), F.lit(1))).alias("all_rows")]
    grouped = df.groupBy(*groups, F.session_window(ts, gap).alias("session")).agg(
        *[merged(measure).of_rows.alias(name) for name, measure in counts.items()]
    )
    return grouped.select(
        *keys,
        F.col("session.start").alias("session_start"),
        F.col("session.end").alias("session_end"),
        *counts,
    )


def busiest_per_period(
    df: DataFrame, ts: str, size: str, slide: str, period: str, condition: Column | None = None
) -> DataFrame:
    """The sliding window with most rows (of those that satisfy ``condition``) in each period of a watermarked stream.

    Two aggregations one after the other: rows are counted per window, and when the watermark has closed a window, it
    enters the period its end lies in; a period is emitted when the watermark passes its end. The earliest window wins a tie.
    State holds one row per open window and one per open period, however many rows come in.
    """
    wanted = F.count(F.lit(1)) if condition is None else F.count_if(condition)
    counted = df.groupBy(F.window(ts, size, slide).alias("window")).agg(wanted.alias("n"))
    bounds = F.struct(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), F.col("n"))
    rank = F.struct(F.col("n"), (-F.unix_micros("window.start")).alias("early"))
    best = counted.groupBy(F.window(F.window_time("window"), period).alias("period")).agg(F.max_by(bounds, rank).alias("best"))
    return best.select(F.col("period.start").alias("period_start"), "best.*")


def stamp_arrival(df: DataFrame, name: str = "ingest_ts") -> DataFrame:
    """Add the processing time. Store it: a second run would see another clock."""
    return df.withColumn(name, F.current_timestamp())
