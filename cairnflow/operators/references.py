"""Orphan references from signed reference and existence counts per key.

Layers deliver rows over time; a row may take its feature away (``is_deleted``) and a later one bring it back. From
the change deltas two signed counts per target key are kept: existence (+1 when the feature appears, -1 when it goes)
and references (+n where n live rows loaded at that time name the key). A reference made at time t is an orphan where
the running existence count of its key at t is zero.

The running counts are two-level prefix sums, by day and within the day, so no task holds the whole history of a hot
key, and references are counted per (key, time) before they meet the existence counts.

Defined results: ids that are null or blank name nothing. Rows without loaded_at or is_deleted: a missing time lies
before all others, a missing flag is false. Where rows of one feature with the same time disagree, the live one
counts. Repeated rows change nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairnflow.session import materialise

#: Texts that stand for no reference, upper case.
NO_REFERENCE = ("", "0", "-1", "NULL", "NONE", "NAN")
SEPARATORS = "[,;|/\\s\\u00a0\\u3000\\uff0c\\uff1b\\u3001]+"
_BLANK_ENDS = "^[\\s\\u00a0\\u3000\\ufeff]+|[\\s\\u00a0\\u3000\\ufeff]+$"
_START = "0001-01-01 00:00:00"


def normal_id(column: Column) -> Column:
    return F.upper(F.regexp_replace(column.cast("string"), _BLANK_ENDS, ""))


def reference_list(column: Column) -> Column:
    """The ids a packed reference field holds, normalised, each once."""
    return F.array_distinct(F.filter(F.transform(F.split(F.coalesce(column.cast("string"), F.lit("")), SEPARATORS), normal_id), lambda v: ~v.isin(*NO_REFERENCE)))


def _when(df: DataFrame) -> Column:
    return F.coalesce(F.col("loaded_at").cast("timestamp"), F.lit(_START).cast("timestamp"))


def references(layers: dict[str, DataFrame], targets: dict[str, dict[str, str]]) -> DataFrame:
    """layer, id, field, target, key, at: one row per reference of a live row. targets: layer -> field -> target layer."""
    parts = []
    for layer, fields in targets.items():
        df = layers[layer].where(~F.coalesce(F.col("is_deleted"), F.lit(False)))
        packed = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(t).alias("target"), reference_list(F.col(f)).alias("keys")) for f, t in fields.items()])
        rows = df.select(normal_id(F.col("id")).alias("id"), _when(df).alias("at"), F.explode(packed).alias("p"))
        parts.append(rows.select(F.lit(layer).alias("layer"), "id", "at", F.col("p.field").alias("field"), F.col("p.target").alias("target"), F.explode("p.keys").alias("key")))
    return reduce(DataFrame.unionByName, parts)


def existence(layers: dict[str, DataFrame]) -> DataFrame:
    """target, key, at, alive: the state each delivery leaves its feature in."""
    parts = [df.select(F.lit(name).alias("target"), normal_id(F.col("id")).alias("key"), _when(df).alias("at"), (~F.coalesce(F.col("is_deleted"), F.lit(False))).alias("alive")) for name, df in layers.items()]
    return reduce(DataFrame.unionByName, parts).where("key IS NOT NULL AND key <> ''").groupBy("target", "key", "at").agg(F.max("alive").alias("alive"))


def signed_counts(layers: dict[str, DataFrame], targets: dict[str, dict[str, str]]) -> DataFrame:
    """target, key, at, refs, existence: references made to the key at that time, and its running existence count."""
    refs = references(layers, targets).groupBy("target", "key", "at").agg(F.count("*").alias("refs"))
    events = (
        existence(layers).select("target", "key", "at", F.col("alive").cast("int").alias("state"), F.lit(0).cast("bigint").alias("refs"))
        .unionByName(refs.select("target", "key", "at", F.lit(None).cast("int").alias("state"), "refs"))
        .groupBy("target", "key", "at").agg(F.max("state").alias("state"), F.sum("refs").alias("refs"))
        .withColumn("day", F.to_date("at"))
    )
    # Three reads of the events follow; written once, the layers are read once for them.
    events = materialise(events, "reference-events")
    in_day = Window.partitionBy("target", "key", "day").orderBy("at")
    over_days = Window.partitionBy("target", "key").orderBy("day")
    # The state a day ends in carries to the next day that has events.
    ends = events.where("state IS NOT NULL").groupBy("target", "key", "day").agg(F.max_by("state", "at").alias("end_state"))
    days = events.select("target", "key", "day").distinct().join(ends, ["target", "key", "day"], "left")
    days = days.withColumn("carry", F.coalesce(F.last("end_state", ignorenulls=True).over(over_days.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("end_state")
    before = F.last("state", ignorenulls=True).over(in_day.rowsBetween(Window.unboundedPreceding, -1))
    counted = events.join(days, ["target", "key", "day"])
    delta = F.when(F.col("state").isNotNull(), F.col("state") - F.coalesce(before, F.col("carry"))).otherwise(0)
    return counted.withColumn("delta", delta).select(
        "target", "key", "at", "refs", "delta", (F.col("carry") + F.sum("delta").over(in_day.rowsBetween(Window.unboundedPreceding, 0))).alias("existence")
    )


def key_states(layers: dict[str, DataFrame], targets: dict[str, dict[str, str]]) -> DataFrame:
    """target, key, state, state_at, refs: what a batch of deliveries says of each key, as counts that compose.

    refs is the number of references made; state whether the feature exists after its last delivery, null where none is
    in the batch.
    """
    refs = references(layers, targets).groupBy("target", "key").agg(F.count("*").alias("refs"))
    states = existence(layers).groupBy("target", "key").agg(F.max(F.struct("at", F.col("alive").cast("int").alias("state"))).alias("s"))
    none = F.lit(None)
    return _composed(states.select("target", "key", "s.state", F.col("s.at").alias("state_at"), F.lit(0).cast("bigint").alias("refs")).unionByName(refs.select("target", "key", none.cast("int").alias("state"), none.cast("timestamp").alias("state_at"), "refs")))


def _composed(parts: DataFrame) -> DataFrame:
    last = F.max(F.when(F.col("state").isNotNull(), F.struct("state_at", "state"))).alias("s")
    return parts.groupBy("target", "key").agg(last, F.sum("refs").alias("refs")).select("target", "key", "s.state", "s.state_at", "refs")


def maintain(stored: DataFrame, deltas: DataFrame) -> DataFrame:
    """Stored key states with those of a further batch put onto them, whatever the order in which batches come.

    The cost is that of the states and of the batch; earlier deliveries aren't read again.
    """
    return _composed(stored.unionByName(deltas))


def current_orphans(states: DataFrame) -> DataFrame:
    """target, key, refs of the keys that are referred to and don't exist."""
    return states.where("refs > 0 AND coalesce(state, 0) = 0").select("target", "key", "refs")


def orphan_references(layers: dict[str, DataFrame], targets: dict[str, dict[str, str]]) -> DataFrame:
    """layer, id, field, ref_id, at: references made while the existence count of their key was zero."""
    counts = signed_counts(layers, targets).where("refs > 0 AND existence = 0").select("target", "key", "at")
    return references(layers, targets).join(counts, ["target", "key", "at"], "left_semi").select("layer", "id", "field", F.col("key").alias("ref_id"), "at")
