"""Features of several parts: queries see all of them, as their SQL does."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.test_oracle import plain

GEOM = "struct<kind:string,parts:array<array<struct<x:double,y:double,z:double>>>>"


def part(*xy):
    return [(float(x), float(y), 1.0) for x, y in xy]


@pytest.mark.parametrize("name", ["w1_measure", "g20_polyline_length", "j3_line_crossings", "w9_without_repeats", "w19_spaced", "f15_along_line"])
def test_all_parts_count(spark, tmp_path, name):
    rows = [
        ("a", False, "2025-01-01 00:00:00", ("line", [part((0, 0), (30, 0), (60, 1)), part((0, 50), (30, 50), (30, 90))])),
        ("b", False, "2025-01-01 00:00:00", ("line", [part((10, -10), (10, 100), (12, 120))])),
        ("c", False, "2025-01-01 00:00:00", ("line", [])),
        ("d", True, "2025-01-01 00:00:00", ("line", [part((0, 0), (9, 9))])),
        ("e", False, "2025-01-01 00:00:00", ("line", [part((5, 5)), part((400, 5), (500, 60), (500, 60))])),
    ]
    df = spark.createDataFrame(rows, f"id string, is_deleted boolean, loaded_at string, geom {GEOM}").withColumn("loaded_at", F.col("loaded_at").cast("timestamp"))
    df.coalesce(1).write.parquet(str(tmp_path / "lane_lines.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lane_lines AS SELECT * FROM '{tmp_path}/lane_lines.parquet/*.parquet'")
    got = entry.queries()[name](spark, str(tmp_path))
    result = con.sql(entry.oracle_sql()[name])
    columns = list(result.columns)
    rows = sorted(tuple(plain(r[c]) for c in columns) for r in got.collect())
    assert rows == sorted(tuple(plain(v) for v in r) for r in result.fetchall()) and rows
    if name == "w1_measure":
        assert {r[columns.index("line")] for r in rows} == {"A.0", "A.1", "B", "E.0", "E.1"}
