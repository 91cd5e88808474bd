"""Benchmark decontamination with a positional inverted index, in DataFrame operations only.

Words are runs of digits, ASCII letters (A-Z lower-cased) and characters above U+007F. An item's windows are its runs of
``WINDOW`` words; a shorter item is one window. Steps, each over whole tables:

1. count the benchmark's words in the documents;
2. take the two rarest positions of every window as its anchors; windows with a word that no document has are out;
3. store the postings ``(document, word, position)`` of the anchor words, and every document's number of words;
4. join postings with anchors and intersect the lists adjusted by offset: a document and item meet on a diagonal
   (document position minus item position) if two anchors do, or one for one-word items;
5. compare the words along those diagonals; ``WINDOW`` equal ones in a row are an occurrence.

Proximity matches need no exact order: two different anchors of an item whose diagonals differ by at most ``slop``.

Null and empty texts have no words: such documents have no hits and such items no windows. Repeated documents each get
their row; items that repeat an id count once. Rows are told apart by id and a 64-bit hash of the text. The benchmark's
tables are broadcast only where Spark finds their written size below its threshold; beyond it the joins shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadtally.llm.common import ascii_lower, written

WINDOW = 10
ANCHORS = 2
# Fixed value: everything that separates words, after lower-casing.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DOC = ["doc_id", "text_hash"]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


@dataclass
class Index:
    """Items with words, anchors ``(item, word, item_position)``, and postings with one marker row per document."""

    items: DataFrame
    anchors: DataFrame
    postings: DataFrame


def _tokenized(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        words_of(F.col("text")).alias("words"),
    )


def rarest_anchors(items: DataFrame, counts: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(item, word, item_position)`` of the rarest positions of all windows; ties go by word, then position."""
    place = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "item_position")
    counted = (
        items.select("item", F.posexplode("words").alias("item_position", "word"))
        .join(counts, "word", "left")
        .groupBy("item")
        .agg(F.array_sort(F.collect_list(F.struct("item_position", place.alias("place")))).alias("places"))
        .select("item", F.col("places.place").alias("places"))
    )
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("places") - window + 1))
    rarest = F.transform(starts, lambda s: F.slice(F.array_sort(F.slice("places", s, window)), 1, ANCHORS))
    possible = F.filter(rarest, lambda w: F.element_at(w, 1)["n"] > 0)
    return counted.select("item", F.explode(F.array_distinct(F.flatten(possible))).alias("anchor")).select(
        "item", "anchor.word", "anchor.item_position"
    )


def build_index(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> Index:
    tokenized = _tokenized(docs)
    items = written(
        benchmark.select("item_id", words_of(F.col("text")).alias("words"))
        .where(F.size("words") > 0)
        .withColumn("item", F.monotonically_increasing_id()),
        "items",
    )
    vocabulary = written(items.select(F.explode("words").alias("word")).distinct(), "vocabulary")
    counts = written(
        tokenized.select(F.explode("words").alias("word")).join(vocabulary, "word").groupBy("word").agg(F.count("*").alias("n")),
        "counts",
    )
    anchors = written(rarest_anchors(items, counts, window), "anchors")
    wanted = written(anchors.select("word").distinct(), "wanted")
    postings = written(
        tokenized.select(*DOC, F.size("words").cast("long").alias("n_words"), F.posexplode_outer("words").alias("position", "word"))
        .join(wanted.withColumn("is_anchor", F.lit(True)), "word", "left")
        .where("is_anchor or position = 0 or position is null")
        .select(*DOC, "n_words", "position", F.when(F.col("is_anchor"), F.col("word")).alias("word")),
        "postings",
    )
    return Index(items, anchors, postings)


def anchor_hits(index: Index) -> DataFrame:
    """``(doc_id, text_hash, item, item_position, diagonal)``: postings met by anchors, adjusted by offset."""
    return (
        index.postings.where("word is not null")
        .join(index.anchors, "word")
        .select(*DOC, "item", "item_position", "position", (F.col("position") - F.col("item_position")).alias("diagonal"))
    )


def phrase_matches(docs: DataFrame, index: Index, window: int = WINDOW) -> DataFrame:
    """``(doc_id, text_hash, item, item_id, starts, length)``: document positions where windows of an item occur exactly."""
    sizes = index.items.select("item", F.size("words").alias("item_size"))
    # Candidates learn their item's length before they meet the text, which is cut to the diagonal before it is unfolded.
    asked = written(
        anchor_hits(index)
        .groupBy(*DOC, "item", "diagonal")
        .agg(F.min("item_position").alias("low"), F.max("item_position").alias("high"))
        .join(sizes, "item")
        .where("item_size = 1 or low < high")
        .groupBy(*DOC)
        .agg(F.collect_list(F.struct("item", "diagonal", "item_size")).alias("candidates")),
        "candidates",
    )
    items = index.items.select("item", "item_id", F.col("words").alias("item_words"), F.size("words").alias("item_size"))
    # The slice starts at the diagonal, or at the text's start with the item's first words left out.
    stretch = F.transform(
        "candidates",
        lambda c: F.struct(
            c["item"].alias("item"),
            c["diagonal"].alias("diagonal"),
            F.slice("words", F.greatest(c["diagonal"], F.lit(0)) + 1, c["item_size"] + F.least(c["diagonal"], F.lit(0))).alias("doc_words"),
        ),
    )
    texts = docs.withColumn("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), "text"
    )
    stretches = (
        texts.join(asked, DOC)
        .select(*DOC, words_of(F.col("text")).alias("words"), "candidates")
        .select(*DOC, F.explode(stretch).alias("c"))
        .select(*DOC, "c.*")
        .join(items, "item")
    )
    skipped = F.greatest(-F.col("diagonal"), F.lit(0))
    length = F.least(F.col("item_size"), F.lit(window))
    aligned = F.slice("item_words", skipped + 1, F.greatest(F.size("doc_words"), F.lit(0)))
    equal = F.zip_with("doc_words", aligned, lambda a, b: F.coalesce(a == b, F.lit(False)))
    last = F.size("equal") - F.col("length")
    every = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    starts = F.filter(every, lambda s: F.forall(F.slice("equal", s + 1, F.col("length")), lambda e: e))
    return (
        stretches.select(*DOC, "item", "item_id", "diagonal", length.alias("length"), equal.alias("equal"))
        .withColumn("starts", F.transform(starts, lambda s: s + F.greatest(F.col("diagonal"), F.lit(0))))
        .where(F.size("starts") > 0)
        .select(*DOC, "item", "item_id", "starts", "length")
    )


def proximity_matches(index: Index, slop: int) -> DataFrame:
    """``(doc_id, text_hash, item, position, next_position)``: neighbouring hits of two anchors that are nearly aligned."""
    from pyspark.sql import Window

    order = Window.partitionBy(*DOC, "item").orderBy("position", "item_position")
    return (
        anchor_hits(index)
        .distinct()
        .withColumn("after", F.lead(F.struct("position", "item_position", "diagonal")).over(order))
        .where(F.col("after.item_position") != F.col("item_position"))
        .where(F.abs(F.col("after.diagonal") - F.col("diagonal")) <= slop)
        .select(*DOC, "item", "position", F.col("after.position").alias("next_position"))
    )


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated``.

    A null id comes back as null.
    """
    index = build_index(docs, benchmark, window)
    found = written(phrase_matches(docs, index, window), "matches")
    covered = F.array_distinct(
        F.flatten(F.transform("starts", lambda s: F.sequence(s, s + F.col("length") - 1)))
    )
    hits = (
        found.select(*DOC, F.explode(covered).alias("position"))
        .distinct()
        .groupBy(*DOC)
        .agg(F.count("*").alias("n_hit"))
    )
    named = (
        found.select(*DOC, F.col("item_id").cast("string").alias("item_id"))
        .distinct()
        .groupBy(*DOC)
        .agg(F.count("*").alias("n_items"), F.concat_ws(",", F.array_sort(F.collect_list("item_id"))).alias("items"))
    )
    per_document = written(hits.join(named, DOC), "hits")
    rows = index.postings.where("position = 0 or position is null").select(*DOC, "n_words")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return rows.join(per_document, DOC, "left").select(
        F.when(F.col("doc_id") != -(1 << 63), F.col("doc_id")).alias("doc_id"),
        "text_hash",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
