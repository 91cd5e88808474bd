"""Parity-sketch join: components of texts whose shingle sets have a Jaccard similarity of 0.8 or more.

A set of n shingles becomes a sketch of words; each shingle XORs its hash into the word that its hash selects. A shingle
outside the intersection changes at most one word, so two sketches differ in at most as many words as the symmetric
difference has members, which for linked sets of sizes a and b is at most (a + b) / 9. Each text therefore publishes
that number of words plus one (pigeonhole), the fullest first, and linked texts publish a common word. A second sketch
with one parity bit per shingle gives a Hamming distance that bounds the symmetric difference from below and drops
most false candidates; the rest are checked on the shingle sets themselves.

Sizes fall into bands [2^j, 2^(j+1)); the number of words follows from the band, and a text that may have a partner in
the band below publishes there too. Should a text have too few filled words for the pigeonhole, it also publishes
shingles themselves, which meet those of other such texts; any other text meets it through its words.

Null and empty texts, and texts of white space, have no shingles and link with nothing. Rows with equal texts link with
each other if the text has words. Repeated rows stay as they are. A row without an id links as any other, and may link two
rows with ids; it gives no component its name. Columns other than the id and the text are ignored.
A set is named by 64 bits of a hash over its shingles (about 3 % risk of one clash among 10^9 different texts).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadtally.llm.common import as_long, mix, released, shingle_hashes, slices, word_hashes, written
from roadtally.llm.graph import components

WIDTH = 5
# Links hold when OF * intersection >= PARTS * union.
PARTS, OF = 80, 100
# Sketch words per shingle at the lower end of a band.
WORDS_PER_SHINGLE = 0.55
# Members of one run that a comparing task holds at a time.
RUN_CELL = 8192
# Orders of the keys under which entities are paired by their smallest key.
KEY_ORDERS = 8

# Bits of the sketch that travels with every key at most; larger ones are folded.
MOST_BRIEF = 1 << 15

FEATURES = "doc_id long, h long, n_shingles long, entity long, sketch binary, brief binary, keys array<long>"
# In place of a missing id, so that such rows can be joined; other ids come before it.
NAMELESS = (1 << 63) - 1
_KEY_SALT = 0xD6E8FEB86659FD93


def _salt(at: int) -> np.uint64:
    return np.uint64(at * _KEY_SALT & 0xFFFFFFFFFFFFFFFF)


def band(n: int) -> int:
    return n.bit_length() - 1


def largest_difference(a, b):
    """Most shingles outside the intersection of linked sets of these sizes."""
    return (a + b) * (OF - PARTS) // (OF + PARTS)


def _word_keys(shingles: np.ndarray, at: int, partner: int) -> list[np.ndarray]:
    """Keys published in band ``at`` by sorted distinct shingles whose largest partner there has ``partner`` members."""
    words = np.uint64(int(WORDS_PER_SHINGLE * (1 << at)) + 2)
    wanted = largest_difference(len(shingles), partner) + 1
    word = ((shingles >> np.uint64(32)) * words) >> np.uint64(32)
    starts = np.concatenate(([0], np.flatnonzero(word[1:] != word[:-1]) + 1))
    counts = np.diff(np.append(starts, len(shingles))).astype(np.uint64)
    content = np.bitwise_xor.reduceat(mix(shingles), starts)
    keys = mix(content ^ mix(word[starts] ^ (counts << np.uint64(40)) ^ _salt(at)))
    if len(keys) < wanted:
        return [keys, mix(shingles[:wanted] ^ _salt(at + 64))]
    return [keys[np.lexsort((keys, -counts.astype(np.int64)))[:wanted]]]


def published_keys(shingles: np.ndarray) -> np.ndarray:
    """All keys that a set publishes, in its own band and, where a smaller partner may be, in the one below."""
    n = len(shingles)
    own, largest, smallest = band(n), n * OF // PARTS, -(-n * PARTS // OF)
    keys = _word_keys(shingles, own, largest)
    if smallest < 1 << own:
        keys += _word_keys(shingles, own - 1, (1 << own) - 1)
    return np.concatenate(keys)


def sketch_bits(shingles: np.ndarray) -> np.ndarray:
    """Parity bits, four per shingle at the lower end of the band; folded halves give the sketch of the band below."""
    bits = 4 << band(len(shingles))
    return (np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)


def _folded(bits: np.ndarray, size: int) -> np.ndarray:
    while len(bits) > size:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def brief_bits(n: int) -> int:
    """Bits of the sketch that travels with a set of this size."""
    return min(4 << band(n), MOST_BRIEF)


def fold_packed(sketch: np.ndarray, bits: int, size: int) -> np.ndarray:
    """As ``_folded``, of bits packed into bytes."""
    while bits > size:
        bits //= 2
        half = bits // 8
        sketch = sketch[:half] ^ sketch[half:] if half else (sketch ^ (sketch << bits)) & np.uint8(0xFF << (8 - bits) & 0xFF)
    return sketch


def may_link(n_a: int, sketch_a: bytes, n_b: int, sketch_b: bytes) -> bool:
    """False only if sizes or sketches rule out a link."""
    low, high = min(n_a, n_b), max(n_a, n_b)
    if OF * low < PARTS * high:
        return False
    size = 4 << band(low)
    a = _folded(np.unpackbits(np.frombuffer(sketch_a, np.uint8))[: 4 << band(n_a)], size)
    b = _folded(np.unpackbits(np.frombuffer(sketch_b, np.uint8))[: 4 << band(n_b)], size)
    return int(np.count_nonzero(a != b)) <= largest_difference(n_a, n_b)


def _sets(batch: pa.RecordBatch, text: str) -> Iterator[tuple[int, np.ndarray, int]]:
    """``(row, sorted distinct shingles, entity)`` of the rows with words."""
    words, offsets = word_hashes(batch.column(text))
    for row in range(batch.num_rows):
        own = words[offsets[row] : offsets[row + 1]]
        if len(own):
            shingles = np.unique(shingle_hashes(own, WIDTH))
            digest = np.frombuffer(xxhash.xxh3_64_digest(shingles.tobytes()), np.int64)[0]
            yield row, shingles, int(digest)


def _features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(iter(batches), "text"):
        rows = batch.num_rows
        counts, entities, sketches, keys = np.zeros(rows, np.int64), [None] * rows, [None] * rows, [[]] * rows
        briefs = [None] * rows
        for row, shingles, entity in _sets(batch, "text"):
            counts[row], entities[row] = len(shingles), entity
            bits = sketch_bits(shingles)
            sketches[row] = np.packbits(bits).tobytes()
            briefs[row] = np.packbits(_folded(bits, brief_bits(len(shingles)))).tobytes()
            keys[row] = as_long(published_keys(shingles))
        sizes = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int32)
        flat = np.concatenate([np.asarray(k, np.int64) for k in keys]) if sizes[-1] else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("h"),
                pa.array(counts),
                pa.array(entities, pa.int64()),
                pa.array(sketches, pa.binary()),
                pa.array(briefs, pa.binary()),
                pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat)),
            ],
            ["doc_id", "h", "n_shingles", "entity", "sketch", "brief", "keys"],
        )


def _shared_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key and entity, the distinct ones whose key has several entities."""
    last = None  # key, entity, whether its key is known to be shared
    for batch in batches:
        key, entity = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(key):
            continue
        if last:
            key, entity = np.append(last[0], key), np.append(last[1], entity)
        new = np.append(True, (key[1:] != key[:-1]) | (entity[1:] != entity[:-1]))
        key, entity = key[new], entity[new]
        same = key[1:] == key[:-1]
        shared = np.append(False, same) | np.append(same, False)
        if last:
            shared[0] |= last[2]
        last = (key[-1], entity[-1], bool(shared[-1]))
        out = np.flatnonzero(shared[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(x[out]) for x in (key, entity)], ["key", "entity"])
    if last and last[2]:
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in last[:2]], ["key", "entity"])


def _possible(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_a, sketch_a, n_b, sketch_b = (batch.column(c).to_pylist() for c in ("n_a", "sketch_a", "n_b", "sketch_b"))
        kept = [may_link(*x) for x in zip(n_a, sketch_a, n_b, sketch_b, strict=True)]
        yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))


def _entity_sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(iter(batches), "text"):
        wanted, entities, sets = batch.column("entity").to_pylist(), [], []
        for row, shingles, entity in _sets(batch, "text"):
            if entity == wanted[row]:  # ids need not be unique
                entities.append(entity)
                sets.append(shingles.tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(entities, pa.int64()), pa.array(sets, pa.binary())], ["entity", "shingles"]
        )


def _linked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(iter(batches), "set_a"):
        kept = []
        for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
            a, b = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
            common = len(np.intersect1d(a, b, assume_unique=True))
            kept.append(OF * common >= PARTS * (len(a) + len(b) - common))
        yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))


def _crossing(batches: Iterable[pa.RecordBatch], nearest: bool) -> Iterator[pa.RecordBatch]:
    """Pairs of one run in different components that sizes and sketches allow; rows come sorted by run cell.

    ``nearest`` keeps for each member the one partner whose sketch is relatively closest.
    """
    held, members = None, []

    def pairs():
        if held is None:
            return
        _, left, right = held
        sizes = np.array([m[3] for m in members])
        component, entity, cell = (np.array([m[i] for m in members]) for i in (2, 1, 0))
        # All sketches folded to the run's smallest, which bounds the distance from below as well.
        least = min(brief_bits(m[3]) for m in members)
        sketches = np.stack([fold_packed(np.frombuffer(m[4], np.uint8), brief_bits(m[3]), least) for m in members])
        order = np.arange(len(members))
        found = []
        for i in np.flatnonzero(cell == left):
            other = (component != component[i]) & (cell == right)
            if left == right and not nearest:
                other &= order > i
            other &= OF * np.minimum(sizes, sizes[i]) >= PARTS * np.maximum(sizes, sizes[i])
            at = np.flatnonzero(other)
            if not len(at):
                continue
            apart = np.bitwise_count(sketches[at] ^ sketches[i]).sum(axis=1, dtype=np.int64)
            good = apart <= largest_difference(sizes[at], sizes[i])
            at, apart = at[good], apart[good]
            if nearest and len(at):
                at = at[[np.argmin(apart / (sizes[at] + sizes[i]))]]
            for j in at:
                found.append((int(min(entity[i], entity[j])), int(max(entity[i], entity[j]))))
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in found], pa.int64()), pa.array([p[1] for p in found], pa.int64())], ["a", "b"]
        )

    for batch in slices(iter(batches), "brief"):
        for row in batch.to_pylist():
            run = (row["key"], row["left"], row["right"])
            if run != held:
                yield from pairs()
                held, members = run, []
            members.append((row["cell"], row["entity"], row["component"], row["n_shingles"], row["brief"]))
    yield from pairs()


def _nearest(batches):
    yield from _crossing(batches, True)


def _every(batches):
    yield from _crossing(batches, False)


def _open_runs(runs: DataFrame, parts: DataFrame) -> DataFrame:
    """The runs of keys whose holders lie in more than one component.

    Components only merge, so a key whose holders share one component stays so, and later rounds need not read it again.
    """
    placed = runs.join(parts, F.col("entity") == F.col("node"), "left").select(
        "key", "entity", F.coalesce("component", "entity").alias("component")
    )
    open_keys = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return written(placed.join(open_keys.where("low != high").select("key"), "key").select("key", "entity"), "open_runs")


def _crossing_pairs(runs: DataFrame, parts: DataFrame, info: DataFrame, search) -> DataFrame:
    """Candidate pairs ``(a, b)`` of entities that share a key but no component yet, from cells of each key's holders."""
    placed = runs.join(parts, F.col("entity") == F.col("node"), "left").select(
        "key", "entity", F.coalesce("component", "entity").alias("component")
    )
    open_keys = (
        placed.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members"))
        .where("low != high")
        .select("key", F.ceil(F.col("members") / RUN_CELL).cast("int").alias("cells"))
    )
    cells = (
        placed.join(open_keys, "key")
        .join(info.select("entity", "n_shingles", "brief"), "entity")
        .withColumn("cell", F.pmod(F.xxhash64("entity"), F.col("cells")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
        .withColumn("left", F.least("cell", "other"))
        .withColumn("right", F.greatest("cell", "other"))
        .select("key", "left", "right", "cell", "entity", "component", "n_shingles", "brief")
    )
    found = (
        cells.repartition("key", "left", "right")
        .sortWithinPartitions("key", "left", "right")
        .mapInArrow(search, "a long, b long")
    )
    return written(found.distinct(), "crossing")


def _verified(pairs: DataFrame, info: DataFrame, docs: DataFrame) -> DataFrame | None:
    """Of candidate pairs ``(a, b)`` those whose sets link; texts are read again for the entities still in question."""
    sides = [
        info.select(F.col("entity").alias(s), F.col("n_shingles").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}"))
        for s in ("a", "b")
    ]
    possible = written(
        pairs.join(sides[0], "a").join(sides[1], "b").mapInArrow(_possible, "a long, b long"), "possible"
    )
    if not possible.limit(1).count():
        return None
    asked = possible.select(F.col("a").alias("entity")).union(possible.select("b")).distinct()
    asked = written(info.join(asked, "entity", "left_semi").select("first.*", "entity"), "asked")
    # One row of each entity: the same id and text may come again.
    texts = docs.join(asked, ["named", "h"]).dropDuplicates(["named", "h"])
    sets = written(texts.mapInArrow(_entity_sets, "entity long, shingles binary"), "sets")
    a, b = (sets.select(F.col("entity").alias(s), F.col("shingles").alias(f"set_{s}")) for s in ("a", "b"))
    links = written(possible.join(a, "a").join(b, "b").mapInArrow(_linked, "a long, b long").distinct(), "links")
    released(info.sparkSession, possible, asked, sets)
    return links


def _look_alikes(runs: DataFrame) -> DataFrame:
    """Entities with the same smallest key, under several orders of the keys, paired with the first of them.

    Near copies share many keys, hence probably a smallest one, while texts that share a passage do not.
    """
    least = runs.groupBy("entity").agg(
        F.array(*[F.min(F.xxhash64(F.lit(i), "key")) for i in range(KEY_ORDERS)]).alias("least")
    )
    signs = written(least.select("entity", F.posexplode("least").alias("turn", "sign")), "signs")
    firsts = signs.groupBy("turn", "sign").agg(F.min("entity").alias("a"), F.count("*").alias("members"))
    firsts = written(firsts.where("members > 1").drop("members"), "firsts")
    pairs = signs.join(firsts, ["turn", "sign"]).select("a", F.col("entity").alias("b"))
    return pairs.where("a != b").distinct()


def jaccard_components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row; see the module's text."""
    return jaccard_rows(docs, id_column, text_column).select("doc_id", "n_shingles", "component_id")


def jaccard_rows(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(doc_id, h, n_shingles, group, component_id)`` for every row.

    ``h`` is a hash of the text; ``group`` names the component apart from ids, which need not be unique, and is null for
    rows without shingles.

    Entities that publish a common key are candidates, but pairs are tested only between components that the tests before
    left apart, so a large group of near copies is joined without listing its pairs: first entities that agree in a smallest
    key; then, per key, every holder with the holder of another component that looks nearest, as long as half of them link; and
    last all holders of different components that sizes and sketches allow. Holders are compared in cells of ``RUN_CELL``.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    docs = docs.withColumn("h", F.xxhash64("text")).withColumn("named", F.coalesce("doc_id", F.lit(NAMELESS)))
    features = written(docs.mapInArrow(_features, FEATURES), "features")
    keys = features.select(F.explode("keys").alias("key"), "entity").repartition("key")
    runs = written(keys.sortWithinPartitions("key", "entity").mapInArrow(_shared_runs, "key long, entity long"), "runs")
    known = features.where(F.col("entity").isNotNull())
    info = written(
        known.join(runs.select("entity").distinct(), "entity", "left_semi")
        .groupBy("entity")
        .agg(
            F.min(F.struct(F.coalesce("doc_id", F.lit(NAMELESS)).alias("named"), "h")).alias("first"),
            F.max("n_shingles").alias("n_shingles"),
            F.max("sketch").alias("sketch"),
            F.max("brief").alias("brief"),
        ),
        "info",
    )
    links, verified = spark.createDataFrame([], "a long, b long"), []
    parts, labels = spark.createDataFrame([], "node long, component long"), []

    def tested(pairs: DataFrame) -> int:
        """Add the links among the pairs; their number."""
        nonlocal links, parts
        more = _verified(pairs, info, docs)
        found = more.count() if more is not None else 0
        if found:
            links = links.union(more)
            verified.append(more)
            parts = components(links)
            released(spark, *labels)
            labels[:] = [parts]
        return found

    tested(_look_alikes(runs))
    held = []  # the open runs of the last round

    def still_open() -> DataFrame:
        more = _open_runs(held[0] if held else runs, parts)
        released(spark, *held)
        held[:] = [more]
        return more

    while tried := (near := _crossing_pairs(still_open(), parts, info, _nearest)).count():
        found = tested(near)
        released(spark, near)
        if 2 * found < tried:
            rest = _crossing_pairs(still_open(), parts, info, _every)
            tested(rest)
            released(spark, rest)
            break

    first = known.groupBy("entity").agg(F.min("doc_id").alias("first_id"))
    grouped = parts.withColumnRenamed("node", "entity").join(first, "entity")
    smallest = grouped.groupBy("component").agg(F.min("first_id").alias("component_id"))
    members = grouped.select("entity", "component").join(smallest, "component").select("entity", "component", "component_id")
    named = written(
        first.join(members, "entity", "left").select(
            "entity", F.coalesce("component", "entity").alias("group"), F.coalesce("component_id", "first_id").alias("component_id")
        ),
        "members",
    )
    released(spark, info, runs, *held, *verified, *labels)
    return features.select("doc_id", "h", "n_shingles", "entity").join(named, "entity", "left").select(
        "doc_id", "h", "n_shingles", "group", F.coalesce("component_id", "doc_id").alias("component_id")
    )
