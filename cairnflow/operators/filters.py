"""Conjunctive filters compiled from conditions, with data-frame null rules.

A condition set maps a column to a value and an operator. Null rules follow data-frame comparison, not SQL: ``neq`` and
``not in`` keep null rows, every other operator drops them. Numeric comparison reads text as numbers where it can. A
column that is missing counts as constant false. Errors are raised when the filter is built, not when it runs.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Operators and their wording.
OPERATORS = {
    "eq": "equals", "neq": "does not equal", "gt": "is greater than", "lt": "is less than", "ge": "is at least", "le": "is at most",
    "in": "is one of", "not in": "is none of",
}


@dataclass(frozen=True)
class Condition:
    value: Any
    operator: str = "eq"

    def __post_init__(self) -> None:
        if self.operator not in OPERATORS:
            raise ValueError(f"unknown operator {self.operator!r}")
        if self.operator in ("in", "not in") and not isinstance(self.value, (list, tuple, set)):
            raise ValueError(f"operator {self.operator!r} needs a list")


def parse_conditions(raw: dict[str, Any]) -> dict[str, Condition]:
    """Conditions from plain dictionaries {column: {"value": ..., "operator": ...}}; a bare value means eq."""
    out = {}
    for name, c in raw.items():
        if isinstance(c, Condition):
            out[name] = c
        elif isinstance(c, dict):
            if "value" not in c or set(c) - {"value", "operator"}:
                raise ValueError(f"condition of {name!r} must hold value and operator")
            out[name] = Condition(c["value"], c.get("operator", "eq"))
        else:
            out[name] = Condition(c)
    return out


def predicate(df: DataFrame, name: str, c: Condition) -> Column:
    column = F.col(f"`{name}`") if name in df.columns else F.lit(False)
    if c.operator in ("gt", "lt", "ge", "le"):
        number, limit = column.cast("string").try_cast("double") if name in df.columns else F.lit(0.0), F.lit(float(c.value))
        test = {"gt": number > limit, "lt": number < limit, "ge": number >= limit, "le": number <= limit}[c.operator]
        return F.coalesce(test & ~F.isnan(number), F.lit(False))
    if name not in df.columns:
        # False equals 0 and False, and nothing else.
        hits = [v for v in (c.value if c.operator in ("in", "not in") else [c.value]) if v in (0, False) and v is not None and not isinstance(v, str)]
        return F.lit(bool(hits) == (c.operator in ("eq", "in")))
    if c.operator == "eq":
        return F.coalesce(column == F.lit(c.value), F.lit(False))
    if c.operator == "neq":
        return ~column.eqNullSafe(F.lit(c.value)) if c.value is not None else F.lit(True)
    values = [v for v in c.value if v is not None]
    if c.operator == "in":
        return F.coalesce(column.isin(*values), F.lit(False)) if values else F.lit(False)
    return F.coalesce(~column.isin(*values), F.lit(True)) if values else F.lit(True)


def filter_rows(df: DataFrame, conditions: dict[str, Any]) -> DataFrame:
    """Rows that meet all conditions; no conditions keep all rows."""
    parsed = parse_conditions(conditions)
    return df.where(reduce(and_, (predicate(df, n, c) for n, c in parsed.items()))) if parsed else df


def describe(conditions: dict[str, Any]) -> str:
    return " AND ".join(f"{n} {OPERATORS[c.operator]} {list(c.value) if isinstance(c.value, (list, tuple, set)) else c.value}" for n, c in parse_conditions(conditions).items())


#: Sideways distance of a lane line from the vehicle, up to which it is sampled, and where along the way from which distance on.
SIDEWAYS_LIMIT = 6.0
ALONG = ((3.0, 4.0, 14.0), (6.0, 6.0, 16.0), (9.0, 8.0, 18.0), (12.0, 10.0, 20.0), (22.0, 14.0, 24.0))
ALONG_BEYOND = (16.0, 26.0)
#: Fixed value: a scan file of fewer bytes is a bad one.
WHOLE_SCAN_BYTES = 500 * 1024


def sampling_window(sideways: Column, limit: float = SIDEWAYS_LIMIT) -> Column:
    """Struct start, end: the stretch ahead in which a line at this sideways distance is sampled; null beyond the limit."""
    y = F.abs(sideways)
    window = F.struct(F.lit(ALONG_BEYOND[0]).alias("start"), F.lit(ALONG_BEYOND[1]).alias("end"))
    for below, start, end in reversed(ALONG):
        window = F.when(y < below, F.struct(F.lit(start).alias("start"), F.lit(end).alias("end"))).otherwise(window)
    return F.when(y <= limit, window)


def whole_scans(files: DataFrame, size: str, least: int = WHOLE_SCAN_BYTES) -> DataFrame:
    """The scans of at least so many bytes; a file of unknown size is none."""
    return files.where(F.col(size) >= least)


def bad_share(bad: Column, total: Column) -> Column:
    """Percentage of bad in all as text, rounded half to even to two places and without trailing zeros but one; blank without any."""
    share = F.bround(100 * bad / F.nullif(total, F.lit(0)), 2)
    return F.when(total > 0, F.concat(share.cast("string"), F.lit("%"))).otherwise("")


def first_match(name: Column, mapping: dict[str, str], partial: bool = False) -> Column:
    """The new name of a file: the first key its name contains decides; partial keeps the extension."""
    extension = F.regexp_extract(name, r"(\.[^.]*)$", 1)
    out = None
    for key, new in mapping.items():
        value = F.concat(F.lit(new), extension) if partial else F.lit(new)
        out = F.when(F.contains(name, F.lit(key)), value) if out is None else out.when(F.contains(name, F.lit(key)), value)
    return name if out is None else out.otherwise(name)


@dataclass(frozen=True)
class Rule:
    """What a column of a layer must be."""

    column: str
    kind: str = "string"
    nullable: bool = True
    allowed: tuple[int, ...] | None = None


def integrity(df: DataFrame, layer: str, rules: list[Rule]) -> DataFrame:
    """layer, rule_column, rule, n_bad for every rule that some row breaks; a missing column is one broken rule.

    All rules are counted in one pass over the layer.
    """
    spark = df.sparkSession
    missing = [r for r in rules if r.column not in df.columns]
    counts: list[tuple[str, str, Column]] = []
    for r in rules:
        if r in missing:
            continue
        c = F.col(r.column)
        if r.kind in ("int", "float"):
            counts.append((r.column, "type", F.count_if(c.isNotNull() & c.cast("string").try_cast("double").isNull())))
        if not r.nullable:
            counts.append((r.column, "null", F.count_if(c.isNull())))
        if r.allowed is not None:
            counts.append((r.column, "domain", F.count_if(c.isNotNull() & ~c.isin(*r.allowed))))
    lost = spark.createDataFrame([(layer, r.column, "missing", 1) for r in missing], "layer string, rule_column string, rule string, n_bad bigint")
    if not counts:
        return lost
    packed = F.array(*[F.struct(F.lit(layer).alias("layer"), F.lit(a).alias("rule_column"), F.lit(b).alias("rule"), c.alias("n_bad")) for a, b, c in counts])
    return df.agg(packed.alias("p")).select(F.inline("p")).where("n_bad > 0").unionByName(lost)
