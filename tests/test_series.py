"""Chunked windows and positions equal the plain ones, whatever the buckets, chunks and hot keys."""

import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from daystrata.operators import features as FE, series


def lines(df):
    return sorted(map(str, df.collect()))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "a", "a", "b", None]), st.integers(0, 60)), max_size=60), st.integers(3, 9), st.integers(1, 30))
def test_split_windows_equal_plain_windows(spark, items, chunk, width):
    rows = [(k, day, i, (i * 7919) % 13 if i % 5 else None) for i, (k, day) in enumerate(items)]
    df = spark.createDataFrame(rows, "k string, day int, id int, v int")

    def columns(w):
        return {
            "mean": F.avg("v").over(w.rowsBetween(-3, 0)), "before": F.lag("v", 2).over(w), "after": F.lead("v", 1).over(w),
            "total": F.sum("v").over(w.rowsBetween(-2, 1)),
        }

    plain = df.withColumns(columns(Window.partitionBy("k").orderBy("day", "id")))
    split = series.split_windows(
        df, columns, [F.col("day"), F.col("id")], buckets=[F.floor(F.col("day") / width)], before=3, after=1, keys=["k"], chunk=chunk)
    assert lines(split) == lines(plain)


def test_position_with_a_hot_key_and_no_key(spark):
    random.seed(1)
    rows = [("hot" if i % 3 else f"k{i % 50}", random.randrange(40), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, day int, id int")
    order, buckets = [F.col("day"), F.col("id")], [F.col("day"), F.floor(F.col("id") / 100)]
    for keys in ((), ("k",)):
        window = Window.partitionBy(*keys)
        plain = df.withColumn("position", (F.row_number().over(window.orderBy(*order)) - 1).cast("bigint")).withColumn(
            "n", F.count(F.lit(1)).over(window))
        placed = series.with_position(df, order, buckets=buckets, keys=keys, total="n")
        assert lines(placed) == lines(plain)


def test_chunk_must_cover_the_frame(spark):
    with pytest.raises(ValueError):
        series.split_windows(spark.range(3), lambda w: {}, [F.col("id")], buckets=[F.col("id")], before=9, after=0, chunk=4)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 11])
def test_contiguous_folds(spark, n):
    df = spark.range(n).withColumnRenamed("id", "day")
    got = [r.fold for r in series.nth_partition_split(df, [F.col("day")], buckets=[F.col("day")]).orderBy("day").collect()]
    sizes = [n // 3 + (i < n % 3) for i in range(3)]
    assert got == [i for i, s in enumerate(sizes) for _ in range(s)]


@pytest.mark.parametrize("n,test", [(1, 1), (4, 1), (5, 1), (6, 2), (10, 2), (11, 3), (15, 3)])
def test_chronological_split_rounds_the_test_part_up(spark, n, test):
    df = spark.range(n).selectExpr("date_add(date'2025-01-01', cast(id as int)) as date")
    rows = FE.chronological_split(df.repartition(4)).orderBy("date").collect()
    assert [r.split for r in rows] == ["train"] * (n - test) + ["test"] * test


def test_stratified_split_is_exact_and_independent_of_order(spark):
    df = spark.range(1000).selectExpr("id", "cast(id % 10 = 0 as int) label")
    a = FE.stratified_split(df, "label", ["id"])
    b = FE.stratified_split(df.repartition(7).orderBy(F.desc("id")), "label", ["id"])
    assert lines(a.select("id", "split")) == lines(b.select("id", "split"))
    sizes = {(r.label, r.split): r["count"] for r in a.groupBy("label", "split").count().collect()}
    assert sizes == {(0, "train"): 720, (0, "test"): 180, (1, "train"): 80, (1, "test"): 20}
    other = FE.stratified_split(df, "label", ["id"], seed=7)
    assert lines(a.select("id", "split")) != lines(other.select("id", "split"))
