"""Training data as counted groups.

Features and target are a few categories, so rows with equal values are interchangeable. Everything from the
class shares to the fitted model depends on the group counts alone, and the full join is never formed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadtally.functions.casts import blank_to_null
from roadtally.operators.colocated import ColocatedTables
from roadtally.operators.joins import join_counts, joined_rows, salted_join
from roadtally.schemas import KEY_COLUMN
from roadtally.session import scratch_path

# Model columns, rejected feature values, least rows to train on, split and its seed.
FEATURES = ("age_band_of_driver", "sex_of_driver", "vehicle_type")
TARGET = "accident_severity"
REJECTED = ("Data missing or out of range", "Not known", "Unknown", "-1", "Other")
MIN_ROWS = 100
TEST_PERCENT = 20
SEED = 42
# Bits of a row's draw, and bits of it that one histogram resolves.
DRAW_BITS, STEP_BITS = 60, 15


def _usable(vehicles: DataFrame, accidents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides cleaned before the join: a blank is a missing value, rejected feature values go."""
    sides = [(vehicles, FEATURES, REJECTED), (accidents, (TARGET,), ())]
    cleaned = []
    for side, columns, rejected in sides:
        rows = side.select(KEY_COLUMN, *[blank_to_null(c).alias(c) for c in columns])
        rows = rows.dropna(how="any", subset=list(columns))
        for c in columns if rejected else ():
            rows = rows.where(~F.col(c).isin(*rejected))
        cleaned.append(rows)
    return cleaned[0], cleaned[1]


def training_rows(vehicles: DataFrame, accidents: DataFrame) -> DataFrame:
    """The cleaned join row by row."""
    return salted_join(*_usable(vehicles, accidents), KEY_COLUMN)


def training_groups(vehicles: DataFrame, accidents: DataFrame) -> DataFrame:
    """Features, target and the number ``n`` of cleaned joined rows."""
    return join_counts(*_usable(vehicles, accidents), KEY_COLUMN)


def target_distribution(groups: DataFrame) -> DataFrame:
    """Share of each class among all rows."""
    counts = groups.groupBy(TARGET).agg(F.sum("n").alias("n"))
    total = groups.agg(F.sum("n")).scalar()
    return counts.select(TARGET, "n", (F.col("n").cast("double") / total.cast("double")).alias("share"))


def feature_options(groups: DataFrame) -> DataFrame:
    """Known values per feature with their alphabetic place, one row each."""
    named = F.explode(F.create_map(*[part for c in FEATURES for part in (F.lit(c), F.col(c))]))
    values = groups.select(named.alias("feature", "value")).distinct()
    place = Window.partitionBy("feature").orderBy("value")
    return values.withColumn("place", F.row_number().over(place))


def draw(seed: int = SEED) -> Column:
    """A row's place in the drawing order: bits of a hash of the seed, the key and the features."""
    seeded = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(KEY_COLUMN), *FEATURES))
    return F.conv(F.substring(seeded, 1, DRAW_BITS // 4), 16, 10).cast("bigint")


def split_groups(
    vehicles: DataFrame, accidents: DataFrame, test_percent: int = TEST_PERCENT, seed: int = SEED
) -> DataFrame:
    """``training_groups`` with ``n_train`` and ``n_test``: of each class the rounded share of its rows is held out."""
    children, parents = _usable(vehicles, accidents)
    drawn = children.withColumn("draw", draw(seed)).select(KEY_COLUMN, *FEATURES, "draw")
    return _split(joined_rows(drawn, parents, KEY_COLUMN), test_percent)


def split_colocated(tables: ColocatedTables, test_percent: int = TEST_PERCENT, seed: int = SEED) -> DataFrame:
    """``split_groups`` of tables that lie together by key."""

    def prepare(vehicles: DataFrame, accidents: DataFrame) -> tuple[DataFrame, DataFrame]:
        children, parents = _usable(vehicles, accidents)
        return children.withColumn("draw", draw(seed)).select(KEY_COLUMN, *FEATURES, "draw"), parents

    return _split(tables.prepared(prepare).rows(), test_percent)


def groups_colocated(tables: ColocatedTables) -> DataFrame:
    """``training_groups`` of tables that lie together by key."""
    return tables.prepared(_usable).counts()


def _split(rows: DataFrame, test_percent: int) -> DataFrame:
    """Groups of drawn rows: per class the first rows in drawing order are held out, exactly as many as the share gives.

    The draw at which a class reaches its number is narrowed down by histograms of ever finer bits; the driver sees their
    counts. The rows that have this very draw are copies of one row, or a few, and fill the number in the order of features.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "drawn")
    rows.write.parquet(path)  # read several times
    rows = spark.read.schema(rows.schema).parquet(path)
    cuts = _cuts(rows, test_percent)
    if not cuts:
        return rows.groupBy(*FEATURES, TARGET).agg(
            F.sum("n").alias("n"), F.sum("n").alias("n_test"), F.sum("n").alias("n_train")
        )
    known = spark.createDataFrame([(c, at, rest) for c, (at, rest) in cuts.items()], f"{TARGET} string, cut long, rest long")
    placed = rows.join(F.broadcast(known), TARGET)  # a row per class
    sure = placed.where("draw != cut").withColumn("held", F.when(F.col("draw") < F.col("cut"), F.col("n")).otherwise(F.lit(0)))
    in_order = Window.partitionBy(TARGET).orderBy(*FEATURES)
    before = F.sum("n").over(in_order) - F.col("n")
    left = F.greatest(F.col("rest") - before, F.lit(0))
    at_cut = placed.where("draw = cut").withColumn("held", F.least("n", left))
    summed = sure.unionByName(at_cut).groupBy(*FEATURES, TARGET).agg(F.sum("n").alias("n"), F.sum("held").alias("n_test"))
    return summed.withColumn("n_train", F.col("n") - F.col("n_test"))


def _cuts(rows: DataFrame, test_percent: int) -> dict[str, tuple[int, int]]:
    """Per class the draw at which its number is reached, and how many of the rows that have it are still held out."""
    totals = {r[TARGET]: r["n"] for r in rows.groupBy(TARGET).agg(F.sum("n").alias("n")).collect()}
    rest = {c: (n * test_percent + 50) // 100 for c, n in totals.items()}
    begun = dict.fromkeys(totals, 0)  # leading bits of the draw that is looked for
    for shift in range(DRAW_BITS - STEP_BITS, -1, -STEP_BITS):
        open_ = F.lit(False)
        for c, bits in begun.items():
            open_ = open_ | ((F.col(TARGET) == c) & (F.shiftright("draw", shift + STEP_BITS) == bits))
        bin_ = F.shiftright("draw", shift).alias("bin")
        counted = rows.where(open_).groupBy(TARGET, bin_).agg(F.sum("n").alias("n")).collect()
        bins: dict[str, list[tuple[int, int]]] = {}
        for r in counted:
            bins.setdefault(r[TARGET], []).append((r["bin"], r["n"]))
        for c, found in bins.items():
            for at, n in sorted(found):
                begun[c] = at
                if n >= rest[c]:
                    break
                rest[c] -= n
    return {c: (at, rest[c]) for c, at in begun.items()}


def split_sizes(groups: DataFrame) -> DataFrame:
    """Rows per part and class of split groups."""
    parts = F.explode(F.create_map(F.lit("train"), F.col("n_train"), F.lit("test"), F.col("n_test")))
    return groups.select(TARGET, parts.alias("part", "n")).groupBy("part", TARGET).agg(F.sum("n").alias("n"))


def class_weights(groups: DataFrame, count: str = "n_train") -> DataFrame:
    """Balanced weight ``rows / (classes * rows of the class)``, a row per class."""
    counts = groups.groupBy(TARGET).agg(F.sum(count).alias("n")).where(F.col("n") > 0)
    totals = counts.agg(F.sum("n").alias("rows"), F.count("*").alias("classes"))
    balanced: Column = totals.select("rows").scalar().cast("double") / (
        totals.select("classes").scalar() * F.col("n")
    ).cast("double")
    return counts.select(TARGET, "n", balanced.alias("weight"))
