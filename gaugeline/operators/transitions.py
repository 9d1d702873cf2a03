"""Fault onsets: a reading is a new event when it is faulty and the one before it was not.

Order is only needed inside a component, but a single component may hold a large share of all
readings, so no window spans a whole component. Readings are looked at in time buckets, and what a
bucket needs to know of the past - the state its predecessor ended in - is carried over a table with
one row per component and bucket.

Most buckets need no ordering at all: when the faulty readings of a bucket all lie before or all lie
after the others, first and last instants of both kinds tell the onsets, and those are plain
aggregates. Only readings of mixed buckets are put in order, after readings of the same instant have
been combined on the map side. Within an instant, healthy comes before faulty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.functions import CRITICAL, MS_PER_HOUR, WARNING, is_faulty, time_bucket

_OWNER = ("date", "hour", "location_id", "hvac_machine_id", "component_type")


def _onsets(points: DataFrame, key: str, instant: str, tie_keys: tuple[str, ...],
            bucket_ms: int) -> DataFrame:
    """Per instant: is there an onset, is that still open, and the state a bucket closes with.

    Expects ``_some`` / ``_every`` (1 when some / every reading of the instant is faulty).
    """
    points = points.withColumn("_bucket", time_bucket(F.col(instant), bucket_ms))
    inside = Window.partitionBy(key, "_bucket").orderBy(instant, *tie_keys)
    before = F.lag("_some").over(inside)
    starts = (F.col("_some") == 1) & ((F.col("_every") == 0) | (before == 0))
    return points.withColumns({
        "_onset": F.coalesce(starts, F.lit(False)).cast("int"),
        # Faulty from the first instant of the bucket on: depends on the bucket before.
        "_open": (before.isNull() & (F.col("_every") == 1)).cast("int"),
        "_closing": F.when(F.lead("_some").over(inside).isNull(), F.col("_some")),
    })


def reading_counts() -> list[Column]:
    """Readings, critical and warning ones, and the highest fault code."""
    code = F.col("health_active_fault_code").cast("double")
    return [F.count("timestamp").alias("total_readings"),
            F.count_if(F.col("health_status") == CRITICAL).alias("critical_readings"),
            F.count_if(F.col("health_status") == WARNING).alias("warning_readings"),
            F.max(F.when(~F.isnan(code), code)).alias("max_code")]


_COUNTED = ("total_readings", "critical_readings", "warning_readings", "max_code")


def health_spans(df: DataFrame, bucket_ms: int = MS_PER_HOUR) -> DataFrame:
    """Reading counts per component and bucket, and whether its onsets are clear without ordering.

    Where ``_clear`` holds, ``_onset``, ``_open`` and ``_closing`` are final.
    """
    ts, faulty = F.col("timestamp"), is_faulty(F.col("health_status"))
    spans = (df.withColumn("_bucket", time_bucket(ts, bucket_ms))
             .groupBy("component_id", "_bucket", *_OWNER).agg(
                 *reading_counts(),
                 F.min(F.when(faulty, ts)).alias("_bad_from"),
                 F.max(F.when(faulty, ts)).alias("_bad_to"),
                 F.min(F.when(~faulty, ts)).alias("_good_from"),
                 F.max(F.when(~faulty, ts)).alias("_good_to")))
    bad_from, bad_to = F.col("_bad_from"), F.col("_bad_to")
    good_from, good_to = F.col("_good_from"), F.col("_good_to")
    # A component that changes its owner within a bucket is left to ordering.
    owners = F.count(F.lit(1)).over(Window.partitionBy("component_id", "_bucket"))
    apart = (bad_from.isNull() | good_from.isNull() | (good_to < bad_from) | (bad_to < good_from))
    return spans.select(
        "component_id", "_bucket", *_OWNER, *_COUNTED,
        ((owners == 1) & apart & F.col("_bucket").isNotNull()).alias("_clear"),
        F.coalesce((good_to < bad_from).cast("bigint"), F.lit(0)).alias("_onset"),
        (bad_from.isNotNull() & (good_from.isNull() | (bad_to < good_from))).cast("int")
        .alias("_open"),
        (bad_from.isNotNull() & (good_to.isNull() | (bad_to > good_to))).cast("int")
        .alias("_closing"))


def mixed_buckets(spans: DataFrame) -> DataFrame:
    """Buckets whose readings have to be put in order."""
    return (spans.filter(~F.col("_clear"))
            .select(F.col("component_id").alias("_of"), F.col("_bucket").alias("_at")).distinct())


def _ordered_hours(df: DataFrame, mixed: DataFrame, bucket_ms: int) -> DataFrame:
    """The figures of mixed buckets, from their readings in order."""
    faulty = is_faulty(F.col("health_status")).cast("int")
    bucket = time_bucket(F.col("timestamp"), bucket_ms)
    readings = df.join(mixed, F.col("component_id").eqNullSafe(F.col("_of"))
                       & bucket.eqNullSafe(F.col("_at")), "left_semi")
    points = readings.groupBy("component_id", "timestamp", *_OWNER).agg(
        *reading_counts(), F.max(faulty).alias("_some"), F.min(faulty).alias("_every"))
    return _summed_hours(points, bucket_ms)


def _summed_hours(points: DataFrame, bucket_ms: int) -> DataFrame:
    """Summaries of the hours of a component from its instants."""
    return (_onsets(points, "component_id", "timestamp", _OWNER[2:], bucket_ms)
            .groupBy("component_id", "_bucket", *_OWNER).agg(
                *[F.sum(c).alias(c) for c in _COUNTED[:3]], F.max("max_code").alias("max_code"),
                F.sum("_onset").alias("_onset"), F.max("_open").alias("_open"),
                F.max("_closing").alias("_closing")))


def health_hours(df: DataFrame, bucket_ms: int = MS_PER_HOUR, spans: DataFrame | None = None,
                 mixed: DataFrame | None = None) -> DataFrame:
    """Reading counts, highest fault code and fault onsets per component and hour.

    Daily figures are sums over these rows, hourly ones are the rows themselves. ``spans`` and
    ``mixed`` may carry the results of :func:`health_spans` and :func:`mixed_buckets` read back
    from storage; a small list of mixed buckets is then broadcast and readings are not shuffled.
    """
    spans = health_spans(df, bucket_ms) if spans is None else spans
    mixed = mixed_buckets(spans) if mixed is None else mixed
    return _carried(spans.filter("_clear").drop("_clear").unionByName(
        _ordered_hours(df, mixed, bucket_ms)))


def _carried(hours: DataFrame) -> DataFrame:
    """Events of each hour, an open one counted where the hours before did not close faulty."""
    # Exactly one row of a bucket carries its closing state; look at all earlier buckets.
    earlier = (Window.partitionBy("component_id").orderBy("_bucket")
               .rangeBetween(Window.unboundedPreceding, -1))
    carried = F.coalesce(F.last("_closing", ignorenulls=True).over(earlier), F.lit(0))
    events = F.col("_onset") + F.when(carried == 0, F.col("_open")).otherwise(0)
    return hours.withColumn("critical_event_count", events.cast("bigint")).select(
        *_OWNER, "component_id", *_COUNTED, "critical_event_count")


def health_hours_in_one_scan(df: DataFrame, bucket_ms: int = MS_PER_HOUR) -> DataFrame:
    """The result of :func:`health_hours` from one pass over the readings.

    Readings of one instant are combined on the map side, so an hour of a component holds no more points
    than it has milliseconds, whatever its share of the readings; those are put in order inside the hour.
    An hour is then summed up by its onsets, whether it opens faulty, and the state it closes with, and
    these summaries are merged over the hours before. To be preferred where reading the source again is
    dear or most hours are mixed; :func:`health_hours` moves less where hours are steady.
    """
    faulty = is_faulty(F.col("health_status")).cast("int")
    points = df.groupBy("component_id", "timestamp", *_OWNER).agg(
        *reading_counts(), F.max(faulty).alias("_some"), F.min(faulty).alias("_every"))
    return _carried(_summed_hours(points, bucket_ms))


def with_new_event(df: DataFrame, key: str = "component_id", order: str = "timestamp",
                   row_id: str = "event_id", bucket_ms: int = MS_PER_HOUR) -> DataFrame:
    """Row-level form: adds ``is_faulty`` and ``is_new_event`` (0/1) to every reading.

    ``row_id`` tells readings of the same instant apart; the smallest faulty one takes the event.
    Wide rows are not ranked: onsets are found on (key, instant) pairs and joined back.
    """
    state = is_faulty(F.col("health_status"))
    points = df.groupBy(key, order).agg(
        F.max(state.cast("int")).alias("_some"), F.min(state.cast("int")).alias("_every"),
        F.min(F.when(state, F.col(row_id))).alias("_first"))
    points = _onsets(points, key, order, (), bucket_ms)
    opening = F.col("_open") == 1
    buckets = points.groupBy(key, "_bucket").agg(
        F.max("_closing").alias("_state"), F.max(F.when(opening, F.col(order))).alias("_at"),
        F.max(F.when(opening, F.col("_first"))).alias("_first"), F.max("_open").alias("_open"))
    before = F.lag("_state").over(Window.partitionBy(key).orderBy("_bucket"))
    settled = (buckets.withColumn("_carried", F.coalesce(before, F.lit(0)))
               .filter("_open = 1 and _carried = 0").select(F.col(key).alias("_key"), "_at", "_first"))
    certain = points.filter("_onset = 1").select(F.col(key).alias("_key"),
                                                 F.col(order).alias("_at"), "_first")
    onsets = certain.unionByName(settled).withColumn("_new", F.lit(1))
    match = (F.col(key).eqNullSafe(F.col("_key")) & F.col(order).eqNullSafe(F.col("_at"))
             & F.col(row_id).eqNullSafe(F.col("_first")) & is_faulty(F.col("health_status")))
    return (df.join(onsets, match, "left")
            .withColumns({"is_faulty": state, "is_new_event": F.coalesce("_new", F.lit(0))})
            .select(*df.columns, "is_faulty", "is_new_event"))
