"""``foreachBatch`` functions for running state that one task cannot hold.

A whole stream has one running count, and a hot key may hold a third of it.
Keyed state would send either through one task; here every micro-batch runs the
distributed batch operator, and only the totals of the batch's own keys (one row when there is
no key) go from batch to batch, in a table. A repeated batch reads the totals
before it and overwrites its own folders, so results are exactly once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.functions.times import interval
from freshet.operators.joins import changing_threshold
from freshet.plans.ordering import highest, running, total


def _complete(spark: SparkSession, folder: str) -> bool:
    """Whether a write to the folder has been committed."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


Finish = Callable[[DataFrame], DataFrame]


def _remove(spark: SparkSession, folder: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@dataclass(frozen=True)
class Closing:
    """When a key is over: ``end`` names the key column with its last time, ``ts`` the event time, ``delay`` how late rows may be."""

    end: str
    ts: str
    delay: str


class _Totals:
    """The latest totals per key, as versions in a folder.

    The version of a batch has the keys of that batch alone, every ``compact``-th all keys that are not over yet. A
    batch reads the versions since the last whole one, of those only the buckets its keys fall in, and never its own;
    versions before the last whole one are removed once a batch after it runs.
    """

    def __init__(self, path: str, keys: Sequence[str], names: Sequence[str], compact: int, buckets: int):
        self.path, self.keys, self.names, self.compact, self.buckets = path, list(keys), list(names), compact, buckets

    def folder(self, version: int) -> str:
        return f"{self.path}/totals/version={version}"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int") if self.keys else F.lit(0)

    def whole_before(self, batch_id: int) -> int:
        return (batch_id - 1) // self.compact * self.compact

    def known(self, batch: DataFrame, batch_id: int) -> DataFrame | None:
        """(keys, names, __version, __bucket) of all versions a batch builds on."""
        if batch_id == 0:
            return None
        schema = T.StructType([batch.schema[k] for k in self.keys])
        for name in self.names:
            schema.add(name, T.LongType())
        schema.add("__version", T.IntegerType()).add("__bucket", T.IntegerType())
        versions = [self.folder(v) for v in range(self.whole_before(batch_id), batch_id)]
        return batch.sparkSession.read.schema(schema).option("basePath", f"{self.path}/totals").parquet(*versions)

    def latest(self, known: DataFrame) -> DataFrame:
        last = F.max_by(F.struct(*self.names), "__version").alias("__last")
        return known.groupBy(*self.keys).agg(last).select(*self.keys, "__last.*")

    def of_keys(self, known: DataFrame, touched: DataFrame, anti: bool = False) -> DataFrame:
        """Rows of ``known`` whose key is among those of ``touched`` (or is not)."""
        if not self.keys:
            return known.limit(0) if anti else known
        own = touched.select(*[F.col(k).alias(f"__{k}") for k in self.keys])
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in self.keys])
        return known.join(own, same, "left_anti" if anti else "left_semi")

    def write(self, totals: DataFrame, version: int) -> None:
        stored = totals.withColumn("__version", F.lit(version)).withColumn("__bucket", self.bucket())
        writer = stored.repartition("__bucket") if self.keys else stored
        writer.write.partitionBy("__bucket").mode("overwrite").parquet(self.folder(version))


def running_counts(
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    counts: Mapping[str, Column],
    finish: Finish | None = None,
    slot_rows: int | None = None,
    closing: Closing | None = None,
    compact: int = 32,
    buckets: int = 64,
    sums: Mapping[str, Column] | None = None,
) -> Callable[[DataFrame, int], None]:
    """Conditional counts, and sums of integer columns, so far, per key or over the whole stream, on every row.

    Writes ``path/rows/batch_id=N`` and the totals of the batch's keys; ``finish``
    is applied before the rows are written (a filter, a ratio). A condition of
    ``lit(True)`` counts rows; a sum is null before its first value. A key may hold any share of the rows. What a
    batch writes follows its own keys; totals of all keys are put together every ``compact`` batches. With
    ``closing`` keys that are over, such as past windows, are forgotten then, and rows
    that come for a key after its end plus the delay has passed are dropped as late.
    """
    values = {name: F.when(c, 1).otherwise(0) for name, c in counts.items()} | dict(sums or {})
    ones = {name: f"__one_{name}" for name in values}
    store = _Totals(path, keys, list(values), compact, buckets)

    def write(batch: DataFrame, batch_id: int) -> None:
        # The batch is read for totals, for slots and for rows: fetch it from the source once.
        batch = batch.persist()
        try:
            run(batch, batch_id)
        finally:
            batch.unpersist()

    def newest(batch: DataFrame, batch_id: int) -> tuple[DataFrame, Column | None]:
        """The rows that are not late, and the end up to which keys are over after this batch."""
        if closing is None:
            return batch, None
        spark, folder = batch.sparkSession, f"{path}/newest/batch_id="
        times = batch.select(closing.ts)
        if batch_id > 0:
            before = spark.read.parquet(f"{folder}{batch_id - 1}")
            over = before.first()[0]
            times = times.unionByName(before)
            if over is not None:
                batch = batch.where(F.col(closing.end).isNull() | (F.col(closing.end) > F.lit(over) - interval(closing.delay)))
        times.agg(F.max(closing.ts).alias(closing.ts)).write.mode("overwrite").parquet(f"{folder}{batch_id}")
        over = spark.read.parquet(f"{folder}{batch_id}").first()[0]
        return batch, None if over is None else F.lit(over) - interval(closing.delay)

    def run(batch: DataFrame, batch_id: int) -> None:
        names = batch.columns
        batch, over = newest(batch, batch_id)
        rows = batch.select(
            "*",
            *[c.cast("bigint").alias(ones[n]) for n, c in values.items()],
            F.lit(False).alias("__carried"),
        )
        known = store.known(batch, batch_id)
        touched = rows.select(*keys).distinct()
        if known is not None:
            # Earlier totals of the batch's keys enter as rows without a time, which come first in the order.
            at = [r[0] for r in rows.select(store.bucket().alias("b")).distinct().collect()] if keys else [0]
            before = store.latest(store.of_keys(known.where(F.col("__bucket").isin(at)), touched))
            before = before.select(*keys, *[F.col(n).alias(ones[n]) for n in values], F.lit(True).alias("__carried"))
            rows = rows.unionByName(before, allowMissingColumns=True)
        totals = rows.groupBy(*keys).agg(*[F.sum(ones[n]).alias(n) for n in values])
        if known is not None and batch_id % compact == 0:
            others = store.latest(known)
            totals = totals.unionByName(store.of_keys(others, touched, anti=True))
            if over is not None:
                totals = totals.where(F.col(closing.end).isNull() | (F.col(closing.end) > over))
        store.write(totals, batch_id)
        counted = running(rows, keys, order, {n: total(F.col(ones[n])) for n in values}, slot_rows=slot_rows)
        counted = counted.where(~F.col("__carried")).select(*names, *values)
        (finish(counted) if finish else counted).write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
        # Batches before this one are committed: none of them asks for what lies before the last whole version.
        gone = store.whole_before(batch_id) - 1 if batch_id else -1
        for version in range(max(0, gone - compact + 1), gone + 1):
            _remove(batch.sparkSession, store.folder(version))

    return write


def late_rows_aside(
    path: str, ts: str, arrival: Sequence[str], delay: str, slot_rows: int | None = None
) -> Callable[[DataFrame, int], None]:
    """Route rows more than ``delay`` behind the newest event that arrived before them to a side table.

    Writes the others to ``path/rows/batch_id=N``, late ones with that ``newest`` time to ``path/late/batch_id=N``. A row
    is judged by all rows before it along ``arrival``, also of earlier micro-batches, of which one
    time is carried in ``path/newest/batch_id=N``. Rows without a time are not late.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            run(batch, batch_id)
        finally:
            batch.unpersist()

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("__carried", F.lit(False))
        if batch_id > 0:
            # The newest time so far enters as a row without an arrival, which comes first.
            before = spark.read.parquet(f"{path}/newest/batch_id={batch_id - 1}").withColumn("__carried", F.lit(True))
            rows = rows.unionByName(before, allowMissingColumns=True)
        rows.agg(F.max(ts).alias(ts)).write.mode("overwrite").parquet(f"{path}/newest/batch_id={batch_id}")
        seen = running(rows, [], arrival, {"newest": highest(F.col(ts))}, include_current=False, slot_rows=slot_rows)
        seen = seen.where(~F.col("__carried")).select(*batch.columns, "newest")
        late = F.coalesce(F.col(ts) < F.col("newest") - interval(delay), F.lit(False))
        # Rows are asked for twice, but the order is worked out once.
        seen = seen.withColumn("__late", late).persist()
        try:
            for name, chosen in (("late", seen.where("__late")), ("rows", seen.where("not __late").drop("newest"))):
                chosen.drop("__late").write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")
        finally:
            seen.unpersist()

    return write


def thresholds_now(
    path: str, control: Callable[[], DataFrame], **options
) -> Callable[[DataFrame, int], None]:
    """Compare each micro-batch with the thresholds known when it first runs.

    Writes ``path/rows/batch_id=N`` and the thresholds used, ``path/control/batch_id=N``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # What was known at the first attempt counts for every later one.
        pinned = f"{path}/control/batch_id={batch_id}"
        if not _complete(batch.sparkSession, pinned):
            control().write.mode("overwrite").parquet(pinned)
        alerts = changing_threshold(batch, batch.sparkSession.read.parquet(pinned), **options)
        alerts.write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")

    return write
