"""Two streams, one of which carries snapshots that replace each other as a whole.

``SnapshotTable`` and ``stream_snapshot_lookup`` look rows up in the newest snapshot at the time a batch starts;
``asof_turns`` looks them up in the snapshot in force at their own time, whatever the order both streams come in.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.temporal import snapshot_lookup
from tidemill.streaming.runs import BATCH, QUERY, for_each_batch, query_id, read_or_none, refuse_foreign
from tidemill.streaming.turns import Turns

_PLACE = f"{QUERY} string, {BATCH} long"


class SnapshotTable:
    """Snapshots from a control stream, each a version; the largest version is in force and replaces all others as a whole.

    A version's rows come in one micro-batch (they are published together); a version that comes again replaces its former
    self. Rows whose keys are null make their version known without an entry, so a snapshot may be empty.
    """

    def __init__(self, path: str, version: str):
        self.path, self.version = path, version

    def publish(self, control: DataFrame, checkpoint: str) -> None:
        """Take in what has arrived. A batch's versions show all at once, when its entry is written after its rows."""
        spark = control.sparkSession
        query = query_id(spark, checkpoint)
        refuse_foreign(self._entries(spark), query, self.path)

        def write(batch: DataFrame, batch_id: int) -> None:
            place = f"{QUERY}={query}/{BATCH}={batch_id}"
            batch.write.mode("overwrite").parquet(f"{self.path}/rows/{place}")
            versions = spark.read.parquet(f"{self.path}/rows/{place}").where(F.col(self.version).isNotNull())
            versions.select(F.col(self.version).alias("version")).distinct().write.mode("overwrite").parquet(f"{self.path}/published/{place}")

        for_each_batch(control, write, checkpoint, "append")

    def _entries(self, spark: SparkSession) -> DataFrame | None:
        return read_or_none(lambda: spark.read.parquet(f"{self.path}/published"))

    def newest(self, spark: SparkSession) -> DataFrame | None:
        """One row: the version in force and the batch that published it; none before the first snapshot."""
        known = self._entries(spark)
        if known is None:
            return None
        best = known.select(F.max(F.struct("version", F.col(QUERY).cast("string").alias(QUERY), F.col(BATCH).cast("long").alias(BATCH))).alias("v"))
        return best.where("v IS NOT NULL").select("v.*")

    def rows(self, spark: SparkSession, version: DataFrame) -> DataFrame | None:
        """The entries of the version that a row of ``newest`` names; None without a row."""
        named = version.first()
        if named is None:
            return None
        batch = spark.read.parquet(f"{self.path}/rows/{QUERY}={named[QUERY]}/{BATCH}={named[BATCH]}")
        return batch.where(F.col(self.version) == F.lit(named["version"]))


def stream_snapshot_lookup(
    data: DataFrame, snapshots: SnapshotTable, keys: Sequence[tuple[str, str]], values: Mapping[str, str], path: str, checkpoint: str
) -> None:
    """Rows of a stream whose key is in the newest snapshot, with its ``values``, added to ``path`` (read with ``results``).

    ``values`` maps columns of the snapshot to their types. The snapshot is pinned per batch: the batch notes the version it
    found before it uses it, and a batch that comes again takes the noted one, whatever has been published since. A key
    missing from that snapshot gives no row, even if an older one had it; before the first snapshot no row has a partner.
    """
    spark = data.sparkSession
    query = query_id(spark, checkpoint)
    refuse_foreign(read_or_none(lambda: spark.read.schema(_PLACE).parquet(f"{path}/pins")), query, path)

    def pinned(place: str) -> DataFrame:
        pin = read_or_none(lambda: spark.read.parquet(f"{path}/pins/{place}"))
        if pin is None:
            found = snapshots.newest(spark)
            if found is None:
                found = spark.createDataFrame([], f"version string, {_PLACE}")
            found.withColumnsRenamed({QUERY: "of_query", BATCH: "of_batch"}).coalesce(1).write.mode("overwrite").parquet(f"{path}/pins/{place}")
            pin = spark.read.parquet(f"{path}/pins/{place}")
        return pin.withColumnsRenamed({"of_query": QUERY, "of_batch": BATCH})

    def write(batch: DataFrame, batch_id: int) -> None:
        place = f"{QUERY}={query}/{BATCH}={batch_id}"
        known = snapshots.rows(spark, pinned(place))
        if known is None:
            found = batch.limit(0).select("*", *(F.lit(None).cast(t).alias(v) for v, t in values.items()))
        else:
            entries = known.select(*(F.col(b).alias(f"_k{i}") for i, (_, b) in enumerate(keys)), *(F.col(v).alias(f"_v_{v}") for v in values))
            on = [batch[a] == F.col(f"_k{i}") for i, (a, _) in enumerate(keys)]
            found = batch.join(entries, on).select(*(batch[c] for c in batch.columns), *(F.col(f"_v_{v}").cast(t).alias(v) for v, t in values.items()))
        found.write.mode("overwrite").parquet(f"{path}/rows/{place}")

    for_each_batch(data, write, checkpoint, "append")


def asof_turns(
    data: DataFrame,
    snapshots: DataFrame,
    ts: str,
    valid_from: str,
    keys: Sequence[tuple[str, str]],
    values: Mapping[str, Column | None],
    keep_unknown: bool,
    path: str,
    checkpoint: str,
    delay_s: float,
    control_holds: bool = False,
) -> Turns:
    """``snapshot_lookup`` over two streams: ``run()`` the result for what has arrived, ``finish()`` it at the end.

    Both streams may be out of order by ``delay_s`` against the largest time of the data. A row waits until the watermark
    passes its time and then meets the snapshot in force at that time; of the snapshots the watermark has passed only the
    last is kept. With ``control_holds`` the watermark is the least of both streams', so a quiet control stream holds rows
    back. Rows later than the watermark go to ``late_rows``; a row without time comes out at once, without a snapshot.
    """

    def tagged(df: DataFrame, side: str, at: str) -> DataFrame:
        none = {"data": F.lit(None).cast(data.schema), "control": F.lit(None).cast(snapshots.schema)}
        structs = [(F.struct(*df.columns) if name == side else empty).alias(name) for name, empty in none.items()]
        return df.select(F.lit(side).alias("side"), F.col(at).cast("timestamp").alias("at"), *structs)

    def step(rows: DataFrame, passed: int) -> tuple[DataFrame, DataFrame]:
        at = F.unix_micros("at")
        control = rows.where("side = 'control' AND at IS NOT NULL")
        due = (F.col("side") == "data") & F.coalesce(at <= F.lit(passed), F.lit(True))
        out = snapshot_lookup(rows.where(due).select("data.*"), control.select("control.*"), ts, valid_from, keys, values, keep_unknown)
        last = control.where(at <= F.lit(passed)).agg(F.max("at").alias("last"))
        kept = control.join(F.broadcast(last)).where(F.col("last").isNull() | (F.col("at") >= F.col("last"))).drop("last")  # one row
        return out, rows.where((F.col("side") == "data") & ~due).unionByName(kept)

    def late(passed: int) -> Column:
        return (F.col("side") == "data") & (F.unix_micros("at") <= F.lit(passed))

    both = tagged(data, "data", ts).unionByName(tagged(snapshots, "control", valid_from))
    holding = ("data", "control") if control_holds else ("data",)
    return Turns(both, path, checkpoint, "at", delay_s, step, late, F.col("side"), holding)
