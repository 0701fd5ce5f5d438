"""Joins over time: same window, same session, within an interval, and the snapshot valid at a moment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.running import Running, running
from tidemill.operators.sessions import label_sessions
from tidemill.operators.slices import MAX_SLICES, _bucket
from tidemill.session import written


def _sided(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in df.columns if c not in keys})


def window_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], ts: str, size: str, slide: str | None = None
) -> DataFrame:
    """Pairs with equal keys in the same window; a pair shows once per window it shares.

    Columns: keys, ``window_start``, ``window_end``, and both sides' other columns as ``l_…`` and ``r_…``. For streams both
    sides need a watermark on ``ts``. A heavy (key, window) is split by AQE's skew join.
    """
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    a = _sided(left.withColumn("window", window), [*keys, "window"], "l_")
    b = _sided(right.withColumn("window", window), [*keys, "window"], "r_")
    pairs = a.join(b, [*keys, "window"])
    bounds = [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]
    return pairs.select(*keys, *bounds, *[c for c in pairs.columns if c not in (*keys, "window")])


def session_join(left: DataFrame, right: DataFrame, keys: Sequence[str], ts: str, gap: Column) -> DataFrame:
    """Pairs with equal keys in the same session; sessions are made from the rows of both sides together."""
    both = left.select(*keys, ts, F.struct(*left.columns).alias("l"), F.lit(None).alias("r")).unionByName(
        right.select(*keys, ts, F.lit(None).alias("l"), F.struct(*right.columns).alias("r"))
    )
    return session_pairs(written(label_sessions(both, keys, ts, gap), "labelled"), left.columns, right.columns, keys)


def session_pairs(labelled: DataFrame, left: Sequence[str], right: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Pairs of the rows in the structs ``l`` and ``r`` with the same keys and ``session_start``."""
    shared = [*keys, "session_start"]
    a = labelled.where(F.col("l").isNotNull()).select(*shared, *[F.col(f"l.{c}").alias(f"l_{c}") for c in left if c not in keys])
    b = labelled.where(F.col("r").isNotNull()).select(*shared, *[F.col(f"r.{c}").alias(f"r_{c}") for c in right if c not in keys])
    return a.join(b, shared)


def interval_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], ts: str, lower_s: float, upper_s: float
) -> DataFrame:
    """Pairs with equal keys and right time in ``[left time + lower_s, left time + upper_s]``.

    Right rows are filed under time buckets as wide as the interval; a left row visits the two or three buckets its
    interval touches. So candidates stay near the true pairs, where a join on the keys alone would try all of them.
    """
    low, high = round(lower_s * 1_000_000), round(upper_s * 1_000_000)
    width = max(high - low, 1)

    def at(name: str) -> Column:
        return F.unix_micros(F.col(name).cast("timestamp"))

    def bucket(t: Column) -> Column:
        return F.floor((t - F.pmod(t, F.lit(width))) / F.lit(width)).cast("long")

    a = _sided(left.withColumn("_t", at(ts)), [*keys, "_t"], "l_").withColumn(
        "_bucket", F.explode(F.sequence(bucket(F.col("_t") + low), bucket(F.col("_t") + high)))
    )
    b = _sided(right.withColumn("_u", at(ts)), [*keys, "_u"], "r_").withColumn("_bucket", bucket(F.col("_u")))
    near = a.join(b, [*keys, "_bucket"]).where(F.col("_u").between(F.col("_t") + low, F.col("_t") + high))
    return near.drop("_bucket", "_t", "_u")


def stream_interval_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], ts: str, lower_s: float, upper_s: float
) -> DataFrame:
    """The streaming form: the range condition lets Spark expire rows of both sides by their watermarks."""
    a, b = _sided(left, [], "l_"), _sided(right, [], "r_")
    on = [F.col(f"l_{k}") == F.col(f"r_{k}") for k in keys]
    distance = f"r_{ts} >= l_{ts} + interval {lower_s} seconds and r_{ts} <= l_{ts} + interval {upper_s} seconds"
    joined = a.join(b, [*on, F.expr(distance)])
    return joined.select(*[F.col(f"l_{k}").alias(k) for k in keys], *[c for c in joined.columns if c[2:] not in keys])


def version_at(data: DataFrame, versions: DataFrame, ts: str, valid_from: str, name: str) -> DataFrame:
    """``data`` plus the latest ``valid_from`` at or before each row's time; null before the first version.

    A bounded number of versions is looked up in place, without a shuffle. More of them are merged into the time order
    of the data and carried forward as a running maximum.
    """
    times = versions.select(F.col(valid_from).cast("timestamp").alias(valid_from)).where(F.col(valid_from).isNotNull()).distinct()
    times = written(times, "versions")
    at = F.col(ts).cast("timestamp")  # once, for both ways below
    if times.limit(MAX_SLICES + 1).count() <= MAX_SLICES:
        found = sorted(r["p"] for r in times.select(F.unix_micros(valid_from).alias("p")).collect())  # at most MAX_SLICES values
        placed = _bucket(data.withColumn("_pos", F.unix_micros(at).cast("double")), "_pos", "_no", [float(p) for p in found])
        micros = F.try_element_at(F.lit(found), F.col("_no")) if found else F.lit(None).cast("long")
        hit = F.when((F.col("_no") > 0) & at.isNotNull(), F.timestamp_micros(micros))
        return placed.select(*data.columns, hit.alias(name))
    marks = times.select(F.col(valid_from).alias("_at"), F.lit(0).alias("_row"), F.col(valid_from).alias("_valid"))
    rows = data.withColumns({"_at": at, "_row": F.lit(1)})
    merged = rows.unionByName(marks, allowMissingColumns=True)
    carried = running(merged, [], ["_at", "_row"], [Running(name, "max", F.col("_valid"))])
    hit = F.when(at.isNotNull(), F.col(name))
    return carried.where(F.col("_row") == 1).select(*data.columns, hit.alias(name))


def snapshot_lookup(
    data: DataFrame,
    snapshots: DataFrame,
    ts: str,
    valid_from: str,
    keys: Sequence[tuple[str, str]],
    values: Mapping[str, Column | None],
    keep_unknown: bool,
) -> DataFrame:
    """Enrich rows from the snapshot in force at their time. Each snapshot replaces the one before as a whole.

    ``snapshots`` has one row per (``valid_from``, key). A key missing from the current snapshot is unknown, even if an
    older one had it: the row is dropped, or kept with the defaults of ``values`` when ``keep_unknown``.
    """
    current = version_at(data, snapshots, ts, valid_from, "_version")
    entries = snapshots.select(
        F.col(valid_from).cast("timestamp").alias("_from"),
        *[F.col(b).alias(f"_k{i}") for i, (_, b) in enumerate(keys)],
        *[F.col(v).alias(f"_v_{v}") for v in values],
    )
    on = [F.col("_version") == F.col("_from"), *[current[a] == F.col(f"_k{i}") for i, (a, _) in enumerate(keys)]]
    joined = current.join(entries, on, "left" if keep_unknown else "inner")
    filled = [
        (F.col(f"_v_{v}") if d is None else F.coalesce(F.col(f"_v_{v}"), d)).alias(v) for v, d in values.items()
    ]
    return joined.select(*[current[c] for c in data.columns], *filled)
