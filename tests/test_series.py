"""Alignment and positions over long series."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.text import safe_label, safe_name
from tidemark.operators import series as S
from tidemark.operators.chunks import running_index, running_last

NAN = float("nan")


def frame(spark, rows):
    df = spark.createDataFrame(rows, "run_id string, series string, s long, value double")
    return df.withColumn("timestamp", F.timestamp_seconds("s")).drop("s")


def clock(spark, times, run="r"):
    df = spark.createDataFrame([(run, t) for t in times], "run_id string, s long")
    return df.withColumn("timestamp", F.timestamp_seconds("s")).drop("s")


def values(df):
    rows = df.withColumn("s", F.unix_seconds("timestamp")).orderBy("series", "s").collect()
    return ["nan" if r["value"] is not None and math.isnan(r["value"]) else r["value"]
            for r in rows]


def test_exact_and_forward_fill(spark):
    s = frame(spark, [("r", "a", 1, 5.0), ("r", "a", 3, NAN)])
    c = clock(spark, [1, 2, 3, 4])
    assert values(S.align_exact(c, s)) == [5.0, None, "nan", None]
    assert values(S.align_ffill(c, s)) == [5.0, 5.0, "nan", "nan"]
    late = clock(spark, [0, 400_000])  # before the start, and days after the last row
    assert values(S.align_ffill(late, s)) == [None, "nan"]


def test_the_clock_of_the_series_itself(spark):
    """Without a clock, times are all that any series of the run has, those without a name too."""
    s = frame(spark, [("r", "a", 1, 5.0), ("r", "b", 3, NAN), ("r", None, 7, 1.0), ("q", "a", 9, None), ("n", None, 1, 2.0)])
    own, given = S.align_ffill(None, s), S.align_ffill(S.master_clock(s), s)
    rows = [sorted(str((r["run_id"], r["series"], r["timestamp"], r["value"])) for r in df.collect()) for df in (own, given)]
    assert rows[0] == rows[1] and len(rows[0]) == 7


def test_forward_fill_equals_naive_over_many_chunks(spark):
    rng = random.Random(3)
    rows, times = [], {}
    for run, n in (("hot", 3000), ("cold", 40)):
        for name in ("a", "b"):
            at = sorted(rng.sample(range(0, 86_400 * 9), n))
            times.setdefault(run, set()).update(at)
            rows += [(run, name, t, rng.choice([NAN, rng.random()])) for t in at]
    s = frame(spark, rows)
    got = {(r["run_id"], r["series"], r["s"]): r["value"] for r in
           S.align_ffill(S.master_clock(s), s)
           .withColumn("s", F.unix_seconds("timestamp")).collect()}
    assert len(got) == sum(2 * len(t) for t in times.values())
    by = {}
    for run, name, t, v in rows:
        by.setdefault((run, name), {})[t] = v
    for (run, name), known in by.items():
        current = None
        for t in sorted(times[run]):
            current = known.get(t, current) if t in known else current
            have = got[(run, name, t)]
            assert have == current or (have is not None and math.isnan(have)
                                       and math.isnan(current))


def test_running_index_over_chunks(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 5 == 0, F.lit("b")).otherwise(F.lit("a")).alias("k"),
        F.timestamp_seconds(F.col("id") * 977).alias("timestamp"), "id")
    rows = running_index(df, ["k"]).collect()
    for key in "ab":
        mine = sorted((r["id"], r["index"], r["total"]) for r in rows if r["k"] == key)
        assert [i for _, i, _ in mine] == list(range(len(mine)))
        assert {t for *_, t in mine} == {len(mine)}


def test_running_last_ignores_nulls(spark):
    rows = [("k", t, None if t % 4 else t) for t in range(0, 400_000, 997)]
    df = spark.createDataFrame(rows, "k string, s long, v long").withColumn(
        "timestamp", F.timestamp_seconds("s"))
    got = {r["s"]: r["v"] for r in running_last(df, ["k"], "v", ["s"]).collect()}
    last = None
    for _, t, v in rows:
        last = v if v is not None else last
        assert got[t] == last


@pytest.mark.parametrize("start,end,want", [
    (None, -1, [0, 1, 2, 3, 4]), (None, -2, [0, 1, 2, 3]), (1, 3, [1, 2]), (2, None, [2, 3, 4]),
    (None, None, [0, 1, 2, 3, 4]), ("t1", "t3", [1, 2, 3]), ("t2", -2, [2, 3])])
def test_slice(spark, start, end, want):
    s = frame(spark, [("r", "a", t, float(t)) for t in range(5)])
    def limit(x):
        return F.timestamp_seconds(F.lit(int(x[1:]))) if isinstance(x, str) else x
    got = S.slice_series(s, limit(start), limit(end)).collect()
    assert sorted(r["value"] for r in got) == [float(v) for v in want]


def test_area_clip_with_nan(spark):
    s = frame(spark, [("r", "a", t, v) for t, v in enumerate([1.0, 3.0, NAN])])
    got = [r["value_fill_gt"] for r in S.area_clip(s, "value", 2.0, "gt")
           .orderBy("timestamp").collect()]
    assert got == [2.0, 3.0, 2.0]
    other = s.withColumn("line", F.lit(2.0))
    got = [r["value_fill_lt"] for r in S.area_clip(other, "value", "line", "lt")
           .orderBy("timestamp").collect()]
    assert got == [1.0, 2.0, 2.0]


def test_lookback_wide_and_names(spark):
    s = frame(spark, [("r", n, t, float(t)) for n in ("a.b", "c") for t in range(40)])
    assert S.lookback(s).count() == 46
    wide = S.wide_series(s, ["a.b", "c"])
    assert wide.columns == ["run_id", "timestamp", "a_b", "c"] and wide.count() == 40
    for text in ("a.b", "x(y),/z", "__a__b__", "plain name"):
        got = spark.range(1).select(safe_name(F.lit(text))).head()[0]
        assert got == safe_label(text)
    assert safe_label("x(y),/z") == "x_y_z"
