"""Rebuilding the current state of a table from a change feed by associative patch composition.

A change is a function on one record's state: a full image or a delete forgets what was before, a partial change sets
some columns. Functions of one record compose associatively in the order of the feed, so they are reduced in a tree:
within range chunks of the order key first, then across chunks, then onto the base. A hot record is thus never
ordered in one task; each level keeps one patch per (key, chunk).

Defined results: repeated changes compose to themselves; changes with equal order are resolved by the tie columns,
the greater wins; null order values count as 0; records whose key holds nulls are records like any other. A partial
change to a record of the base keeps the base's values in the columns it doesn't set; to a record that is nowhere, it
makes one whose other columns are null; after a delete it brings the record back with its own columns alone. Base
rows are taken as they are, a key that is there twice comes out twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Spellings of a delete.
DELETE_WORDS = ("d", "del", "delete", "deleted", "remove", "removed", "rm")


#: The columns a composed patch sets; only patches composed with partial changes have it.
TOUCHED = "touched_columns"


def says_delete(flag: Column, op: Column) -> Column:
    return F.coalesce(flag, F.lit(False)) | F.coalesce(F.lower(F.trim(op)).isin(*DELETE_WORDS), F.lit(False))


def _level(df: DataFrame, by: list[str], image: list[str], partial: bool) -> DataFrame:
    if not partial:
        return df.groupBy(*by).agg(F.max_by("patch", F.struct("pos", "tie")).alias("patch"), F.max(F.struct("pos", "tie")).alias("at")).select(*by, "patch", F.col("at.pos").alias("pos"), F.col("at.tie").alias("tie"))
    last = [F.max(F.col(f"set_{c}")).alias(f"set_{c}") for c in image]
    return df.groupBy(*by).agg(F.max("reset").alias("reset"), *last)


def compose(changes: DataFrame, keys: list[str], order: list[str], tie: list[str], delete: Column, image: list[str], chunk: Column | None = None, partial: Column | None = None) -> DataFrame:
    """One patch per key: keys, deleted, order_*, image columns, with partial also the names of the columns it sets.

    order: numeric columns, the major one first. chunk: range of the order key a patch is first reduced within; by
    default the major order value divided by 16. partial: true for changes that only set their non-null columns.
    """
    pos = F.struct(*[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in order])
    ties = F.struct(*[F.col(c) for c in tie]) if tie else F.struct(F.lit(0).alias("none"))
    chunk = chunk if chunk is not None else F.floor(F.coalesce(F.col(order[0]), F.lit(0)) / 16)
    base = [F.col(c).alias(f"k_{c}") for c in keys]
    by, chunked = [f"k_{c}" for c in keys], [*[f"k_{c}" for c in keys], "chunk"]
    if partial is None:
        rows = changes.select(*base, chunk.alias("chunk"), pos.alias("pos"), ties.alias("tie"), F.struct(delete.alias("deleted"), *[F.col(c).alias(c) for c in image]).alias("patch"))
        done = _level(_level(rows, chunked, image, False), by, image, False)
        return done.select(*[F.col(f"k_{c}").alias(c) for c in keys], F.col("patch.deleted").alias("deleted"), *[F.col(f"pos.{c}").alias(f"order_{c}") for c in order], *[F.col(f"patch.{c}").alias(c) for c in image])
    full = ~F.coalesce(partial, F.lit(False)) | delete
    at = F.struct(pos.alias("pos"), ties.alias("tie"))
    # A column's patch holds the place of the change that last set it; a full image or a delete sets every column.
    sets = [F.when(full | F.col(c).isNotNull(), F.struct(at.alias("at"), F.when(~delete, F.col(c)).alias("v"))).alias(f"set_{c}") for c in image]
    rows = changes.select(*base, chunk.alias("chunk"), F.struct(at.alias("at"), delete.alias("deleted")).alias("reset"), *sets)
    done = _level(_level(rows, chunked, image, True), by, image, True)
    touched = F.array_compact(F.array(*[F.when(F.col(f"set_{c}").isNotNull(), F.lit(c)) for c in image]))
    return done.select(
        *[F.col(f"k_{c}").alias(c) for c in keys], F.col("reset.deleted").alias("deleted"), touched.alias(TOUCHED), *[F.col(f"reset.at.pos.{c}").alias(f"order_{c}") for c in order], *[F.col(f"set_{c}.v").alias(c) for c in image]
    )


def apply_patches(base: DataFrame | None, patches: DataFrame, keys: list[str], image: list[str]) -> DataFrame:
    """The state after the patches: keys, order columns, image. base: keys and image, or None for an empty table.

    Order columns of base rows that no patch touches are null.
    """
    order = [c for c in patches.columns if c.startswith("order_")]
    if base is None:
        return patches.where(~F.col("deleted")).select(*keys, *order, *image)
    on = [F.col(f"b.{k}").eqNullSafe(F.col(f"p.{k}")) for k in keys]
    merged = base.select(*keys, *image, F.lit(True).alias("there")).alias("b").join(patches.withColumn("there", F.lit(True)).alias("p"), on, "full_outer")
    patched = F.col("p.there").isNotNull()

    def value(c: str) -> Column:
        own = patched & F.array_contains(f"p.{TOUCHED}", c) if TOUCHED in patches.columns else patched
        return F.when(own, F.col(f"p.{c}")).otherwise(F.col(f"b.{c}")).alias(c)

    chosen = [F.when(patched, F.col(f"p.{k}")).otherwise(F.col(f"b.{k}")).alias(k) for k in keys]
    return merged.where(~F.coalesce(F.col("p.deleted"), F.lit(False))).select(*chosen, *[F.col(f"p.{c}") for c in order], *[value(c) for c in image])
