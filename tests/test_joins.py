"""Joins and numbering keep every row when a third of them share one key, and spread that key."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from roadtally.operators.joins import _cells, fits_broadcast, heavy_keys, join_counts, lookup_join, salted_join
from roadtally.operators.numbering import number_rows, total_order

ROWS = 3000


def children(spark, hot="7"):
    """A third of the rows on one key, half of those copies of one row, and some without a key."""
    key = F.when(F.col("id") % 3 == 0, F.lit(hot)).when(F.col("id") % 50 == 1, F.lit(None)).otherwise((F.col("id") % 100).cast("string"))
    value = F.when(F.col("id") % 2 == 0, F.lit("copy")).otherwise(F.col("id").cast("string"))
    return spark.range(0, ROWS, 1, 12).select(key.alias("k"), value.alias("v"))


def parents(spark, copies):
    """Keys 0..99; the hot key repeats."""
    rows = [(str(i), f"p{i}") for i in range(100)] + [("7", f"p7-{i % 2}") for i in range(copies)]
    return spark.createDataFrame(rows, "k string, p string").repartition(6)


def counted(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("copies", [0, 40])
@pytest.mark.parametrize("rows_per_cell", [5, 100, 1_000_000])
def test_salted_join_is_the_bag_join(spark, copies, rows_per_cell):
    left, right = children(spark), parents(spark, copies)
    expected = counted(left.join(right, "k").select("k", "v", "p"))
    assert counted(salted_join(left, right, "k", rows_per_cell).select("k", "v", "p")) == expected


def test_heavy_keys_are_found(spark):
    heavy = {r["k"]: r["cells"] for r in heavy_keys(children(spark), "k", 100).collect()}
    assert heavy == {"7": 11}


def test_thousands_of_heavy_keys_are_all_found(spark):
    rows = spark.range(0, 36_000).select((F.col("id") % 3000).cast("string").alias("k"))
    assert {r["cells"] for r in heavy_keys(rows, "k", 4).collect()} == {3}
    assert heavy_keys(rows, "k", 4).count() == 3000


def test_join_with_an_empty_side(spark):
    left, right = children(spark), parents(spark, 0)
    assert salted_join(left.limit(0), right, "k").count() == 0
    assert salted_join(left, right.limit(0), "k").count() == 0


def test_hot_key_is_spread(spark):
    """No task of the join gets the whole hot key, copies included."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        joined = salted_join(children(spark), parents(spark, 0), "k", 50).where("k = '7'")
        per_task = joined.groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    sizes = [r["count"] for r in per_task]
    assert sum(sizes) >= ROWS // 3 and len(sizes) >= 6 and max(sizes) <= ROWS // 3 / 2


def test_a_rerun_puts_rows_in_the_same_cells(spark, tmp_path):
    """Cells depend on partition and content, not on the order in which a task meets its rows."""
    children(spark).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    heavy = heavy_keys(rows, "k", 100).select("k", F.col("cells").alias("left_cells"), F.lit(2).alias("right_cells"))
    placed = [
        counted(_cells(one, "k", heavy, "left", "right", ["k", "v"]).select("k", "v", "left_cell", "right_cell"))
        for one in (rows, rows.sortWithinPartitions(F.desc("v"), "k"))
    ]
    assert placed[0] == placed[1]
    assert len({cell for (k, _, cell, _) in placed[0] if k == "7"}) == 11


def test_lookup_join_both_ways(spark):
    left, right = children(spark), parents(spark, 0)
    assert counted(lookup_join(left, right, "k", limit=0).select("k", "v", "p")) == counted(
        lookup_join(left, right, "k").select("k", "v", "p")
    )
    known_size = spark.range(100)
    assert fits_broadcast(known_size, 1 << 20) and not fits_broadcast(known_size, 0)
    assert not fits_broadcast(right, 1 << 40)  # no estimate, no broadcast


def test_join_counts_without_pairs(spark):
    left, right = children(spark).withColumn("v", F.length("v")), parents(spark, 200)
    expected = counted(left.join(right, "k").groupBy("v", "p").count())
    assert counted(join_counts(left, right, "k")) == expected
    below_join = join_counts(left, right, "k")._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")[1]
    assert below_join.count("Aggregate [") == 2  # both sides are counted before they meet


def test_numbering_is_contiguous_and_ordered(spark):
    numbered = number_rows(children(spark).where("k is not null"), ["k"]).orderBy("seq").collect()
    assert [r["seq"] for r in numbered] == list(range(len(numbered)))
    keys = [(r["k"], r["v"]) for r in numbered]
    assert keys == sorted(keys)


@pytest.mark.parametrize("ranges", [1, 2, 7])
@pytest.mark.parametrize("rows_per_range", [10, 5_000_000])
def test_numbering_by_ranges_and_copies(spark, ranges, rows_per_range):
    """A third of the rows on one key, half of those copies, and missing keys, which come first."""
    rows = children(spark)
    numbered = number_rows(rows, ["k"], "seq", ranges, rows_per_range)
    got = numbered.orderBy("seq").collect()
    assert [r["seq"] for r in got] == list(range(ROWS))
    assert [(r["k"], r["v"]) for r in got] == [tuple(r) for r in rows.orderBy("k", "v").collect()]
    assert "checkpoint" not in numbered._jdf.queryExecution().toString().lower()


def test_numbering_of_nothing_and_of_one_row(spark):
    rows = children(spark)
    assert number_rows(rows.limit(0), ["k"]).collect() == []
    assert [r["seq"] for r in number_rows(rows.where("k = '3'").limit(1), ["k"]).collect()] == [0]


def test_total_order_splits_a_hot_key_and_its_copies(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        only_copies = children(spark).where("k = '7' and v = 'copy'")
        tasks = total_order(only_copies, ["k"]).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(tasks) >= 3
