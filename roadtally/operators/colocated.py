"""Two tables stored together by their join key, so that joins and counts by it move no rows.

Both sides are bucketed and sorted by the key when they are stored, each row once; every later join, and every aggregation by
key, works bucket by bucket in place. A bucket must hold whole keys, so keys with more rows than one join cell may hold are
kept apart, found by an exact count: their rows lie in plain tables and are joined by the salted join, or counted after
copies have collapsed. Rows without a key are in no pair and are not stored.

    <root>/<side>/light/    bucketed rows      <root>/<side>/heavy/    rows of heavy keys

Bucketed tables need a catalog entry; it is made under a name of its own for each opening and holds no data.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadtally.operators.joins import ROWS_PER_CELL, heavy_keys, join_counts, joined_rows, salted_join

# Both sides come in the right places: a join that sends either of them would move rows for nothing.
IN_PLACE = "merge"


@dataclass(frozen=True)
class ColocatedTables:
    """``light`` and ``heavy`` are pairs of children and parents; ``heavy`` is None where no key is heavy."""

    key: str
    light: tuple[DataFrame, DataFrame]
    heavy: tuple[DataFrame, DataFrame] | None
    rows_per_cell: int = ROWS_PER_CELL

    def join(self) -> DataFrame:
        """The inner join with bag semantics."""
        children, parents = self.light
        joined = children.hint(IN_PLACE).join(parents.hint(IN_PLACE), self.key)
        if self.heavy is None:
            return joined
        return joined.unionByName(salted_join(*self.heavy, self.key, self.rows_per_cell))

    def prepared(self, prepare: Callable[[DataFrame, DataFrame], Sequence[DataFrame]]) -> ColocatedTables:
        """The same tables with filters and projections applied to both sides; the key must stay."""
        heavy = tuple(prepare(*self.heavy)) if self.heavy else None
        return ColocatedTables(self.key, tuple(prepare(*self.light)), heavy, self.rows_per_cell)

    def rows(self) -> DataFrame:
        """``joined_rows`` of the two sides."""
        return self._summed(joined_rows)

    def counts(self) -> DataFrame:
        """``join_counts`` of the two sides: groups of a few columns, so that only these are exchanged."""
        counted = self._summed(join_counts)
        return counted.groupBy(*[c for c in counted.columns if c != "n"]).agg(F.sum("n").alias("n")) if self.heavy else counted

    def _summed(self, count: Callable[..., DataFrame]) -> DataFrame:
        parts = [count(*self.light, self.key, IN_PLACE)]
        if self.heavy:
            parts.append(count(*self.heavy, self.key))
        return reduce(DataFrame.unionByName, parts)


def colocate(
    children: DataFrame,
    parents: DataFrame,
    key: str,
    root: str,
    buckets: int | None = None,
    rows_per_cell: int = ROWS_PER_CELL,
) -> ColocatedTables:
    """Store both sides below ``root``, which must be new, and open them. ``buckets``: default as many as shuffle partitions."""
    spark = children.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = heavy_keys(children, key, rows_per_cell).select(key).union(heavy_keys(parents, key, rows_per_cell).select(key))
    found.distinct().write.parquet(f"{root}/heavy-keys")
    for name, rows in (("children", children), ("parents", parents)):
        _store(rows, key, root, name, buckets)
    return open_colocated(spark, root, key, children.schema, parents.schema, buckets, rows_per_cell)


def append_colocated(
    tables_root: str, key: str, buckets: int, children: DataFrame | None = None, parents: DataFrame | None = None
) -> None:
    """Add rows to tables that ``colocate`` stored; tables opened before do not see them.

    A key that has become heavy since then stays where it is.
    """
    for name, rows in (("children", children), ("parents", parents)):
        if rows is not None:
            _store(rows, key, tables_root, name, buckets)


def _store(rows: DataFrame, key: str, root: str, name: str, buckets: int) -> None:
    spark, columns = rows.sparkSession, rows.columns
    rows = rows.where(F.col(key).isNotNull())
    heavy = _heavy(spark, root, key, rows.schema)
    if heavy is not None:
        rows.join(heavy, key, "left_semi").select(*columns).write.mode("append").parquet(f"{root}/{name}/heavy")
        rows = rows.join(heavy, key, "left_anti").select(*columns)
    # The same hash deals rows to tasks and to buckets, so each task writes one file.
    table = _bucketed(spark, f"{root}/{name}/light", key, rows.schema, buckets)
    rows.repartition(buckets, key).sortWithinPartitions(key).write.insertInto(table)


def _heavy(spark: SparkSession, root: str, key: str, schema: T.StructType) -> DataFrame | None:
    """The heavy keys as stored, of which there are at most rows / rows per cell; None if there are none."""
    keys = spark.read.schema(T.StructType([schema[key]])).parquet(f"{root}/heavy-keys")
    return keys if keys.limit(1).count() else None


def open_colocated(
    spark: SparkSession,
    root: str,
    key: str,
    children: T.StructType,
    parents: T.StructType,
    buckets: int,
    rows_per_cell: int = ROWS_PER_CELL,
) -> ColocatedTables:
    """Tables stored before, as ``colocate`` gave them; of the same schemas and number of buckets."""
    sides = (("children", children), ("parents", parents))
    light = tuple(spark.table(_bucketed(spark, f"{root}/{name}/light", key, schema, buckets)) for name, schema in sides)
    apart = None
    if _heavy(spark, root, key, children) is not None:
        apart = tuple(spark.read.schema(schema).parquet(f"{root}/{name}/heavy") for name, schema in sides)
    return ColocatedTables(key, light, apart, rows_per_cell)


def _bucketed(spark: SparkSession, path: str, key: str, schema: T.StructType, buckets: int) -> str:
    """The name of a new catalog entry for the bucketed table at this path."""
    name = f"colocated_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"create table {name} ({columns}) using parquet clustered by (`{key}`) sorted by (`{key}`)"
        f" into {buckets} buckets location '{path}'"
    )
    return name
