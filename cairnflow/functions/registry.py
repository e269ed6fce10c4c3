"""Checks and tools by name: registered functions on DataFrames, run together, with failures kept per function."""

from __future__ import annotations

import importlib
import json
import pkgutil
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from types import ModuleType
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnflow.operators.aggregates import LEVEL_WEIGHTS

STATISTIC = "inspector_name string, level string, level_weight int, feature_type string, total_count bigint, log_count bigint"


@dataclass(frozen=True)
class Check:
    """bad(df) gives the rows of the layer that break the check."""

    name: str
    feature_type: str
    level: str
    bad: Callable[[DataFrame], DataFrame]


class Checks:
    def __init__(self) -> None:
        self._known: dict[str, Check] = {}

    def register(self, name: str, feature_type: str, level: str) -> Callable:
        if level not in LEVEL_WEIGHTS:
            raise ValueError(f"unknown level {level!r}")

        def add(f: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
            if name in self._known:
                raise ValueError(f"check {name!r} exists")
            self._known[name] = Check(name, feature_type, level, f)
            return f

        return add

    def select(self, names: Iterable[str] | str) -> tuple[list[Check], list[str]]:
        """The checks of the names, or of 'All', and the names that are unknown."""
        if names == "All":
            return list(self._known.values()), []
        wanted = list(names)
        return [self._known[n] for n in wanted if n in self._known], [n for n in wanted if n not in self._known]

    def run(self, spark: SparkSession, layers: dict[str, DataFrame], names: Iterable[str] | str = "All") -> tuple[DataFrame, dict[str, str]]:
        """Statistics of the chosen checks (one plan for all of them) and the errors of those that can't be planned."""
        chosen, unknown = self.select(names)
        errors = {n: "unknown" for n in unknown}
        out = spark.createDataFrame([], STATISTIC)
        for c in chosen:
            try:
                layer = layers[c.feature_type]
                every = layer.agg(F.count("*").alias("total_count"), F.lit(0).cast("bigint").alias("log_count"))
                bad = c.bad(layer).agg(F.lit(0).cast("bigint").alias("total_count"), F.count("*").alias("log_count"))
                one = every.unionByName(bad).agg(F.sum("total_count").alias("total_count"), F.sum("log_count").alias("log_count"))
                out = out.unionByName(one.select(F.lit(c.name).alias("inspector_name"), F.lit(c.level).alias("level"), F.lit(LEVEL_WEIGHTS[c.level]).alias("level_weight"), F.lit(c.feature_type).alias("feature_type"), "total_count", "log_count"))
            except Exception as e:  # noqa: BLE001 - one check's error must not stop the others
                errors[c.name] = str(e).splitlines()[0]
        return out, errors


def discover(package: ModuleType, prefix: str) -> list[ModuleType]:
    """Import the modules of a package whose names begin with the prefix, so that they register themselves."""
    return [importlib.import_module(f"{package.__name__}.{m.name}") for m in pkgutil.iter_modules(package.__path__) if m.name.startswith(prefix)]


class Tools:
    """Named functions with a JSON schema of their input; results and failures come as documents."""

    def __init__(self) -> None:
        self._known: dict[str, tuple[str, dict, Callable[[dict], Any]]] = {}

    def register(self, name: str, description: str, schema: dict) -> Callable:
        def add(f: Callable[[dict], Any]) -> Callable[[dict], Any]:
            if name in self._known:
                raise ValueError(f"tool {name!r} exists")
            self._known[name] = (description, schema, f)
            return f

        return add

    def catalogue(self) -> list[dict]:
        return [{"name": n, "description": d, "inputSchema": s} for n, (d, s, _) in sorted(self._known.items())]

    def call(self, name: str, arguments: dict) -> dict:
        if name not in self._known:
            return {"isError": True, "content": [{"type": "text", "text": f"unknown tool {name}"}]}
        _, schema, f = self._known[name]
        missing = [k for k in schema.get("required", []) if k not in arguments]
        try:
            if missing:
                raise ValueError(f"missing {', '.join(missing)}")
            result = f(arguments)
        except Exception as e:  # noqa: BLE001 - a tool's failure is part of its answer
            return {"isError": True, "content": [{"type": "text", "text": str(e)}]}
        return {"isError": False, "content": [{"type": "text", "text": result if isinstance(result, str) else json.dumps(result)}]}


tools = Tools()


@tools.register("echo", "Return the text given", {"type": "object", "required": ["text"]})
def _echo(arguments: dict) -> str:
    return str(arguments["text"])


@tools.register("status", "Report that the engine is up", {"type": "object"})
def _status(arguments: dict) -> dict:
    return {"status": "ok"}


class Pipeline:
    """Named stages on a DataFrame. A disabled stage is skipped, a suspended one ends the run, a failing one stops it."""

    def __init__(self) -> None:
        self.stages: list[tuple[str, Callable[[DataFrame], DataFrame], str]] = []

    def add(self, name: str, stage: Callable[[DataFrame], DataFrame], status: str = "enabled") -> Pipeline:
        if status not in ("enabled", "disabled", "suspended"):
            raise ValueError(f"unknown status {status!r}")
        self.stages.append((name, stage, status))
        return self

    def run(self, df: DataFrame) -> tuple[DataFrame, list[tuple[str, str]]]:
        log = []
        for name, stage, status in self.stages:
            if status == "suspended":
                log.append((name, "suspended"))
                break
            if status == "disabled":
                log.append((name, "disabled"))
                continue
            try:
                df = df.transform(stage)
            except Exception as e:  # noqa: BLE001 - reported in the log
                log.append((name, f"failed: {str(e).splitlines()[0]}"))
                break
            log.append((name, "succeeded"))
        return df, log
