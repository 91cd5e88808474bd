"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton over folded text.

Folding lower-cases, drops accents and invisible characters, maps look-alike letters of other scripts and the usual
digit and sign substitutions to Latin letters, and turns everything else into spaces. As 1 stands for i and for l,
both letters fold to i. The lexicon holds whole words and word beginnings, as patterns that start with a space.

A text's load is the sum of the weights of its matches (the heaviest per word start, none inside an exception phrase)
divided by its words plus ``PRIOR_WORDS``; the score is ``load / (load + c)`` with c set so that the calibrated cut is
0.3. Lexicon, exception phrases and cut come from labelled rows: at most ``SAMPLE_ROWS`` per label, taken in the order
of a hash of the id. The cut is set on rows with id hash 3 (mod 4) by a lexicon from those with 0 and 1; the lexicon in use is
then learned from all three parts. Rows with 2 are held out.

Null and empty texts and texts without letters score 0. Without labels of both kinds the lexicon is empty and all
scores are 0. Repeated rows get equal scores; an id labelled twice is toxic if any label says so.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadtally.llm.common import slices, written

# Bounds of the fit: labelled rows per label, lexicon entries, exception phrases.
SAMPLE_ROWS = 9000
MAX_TERMS = 2000
MAX_PHRASES = 2000
# A term needs this many toxic rows and this share of them, odds of at least so many e-folds, and a likelihood ratio that chance
# alone would reach for about ``CHANCE`` of all terms seen.
MIN_ROWS, MIN_SHARE, MIN_WEIGHT, CHANCE = 3, 0.02, 1.0, 0.1
# Standard errors taken off a term's log odds.
CAUTION = 1.5
# Terms that a counting task holds at a time.
HELD_TERMS = 100_000
PREFIXES = (4, 5, 6, 7)
PRIOR_WORDS = 20
CUT_SCORE = 0.3
DEFAULT_CUT = 0.05
PLATEAU = 0.01

# Look-alike letters (Cyrillic, Greek) and substitutions, each with the Latin letter meant.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y",
    "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i",
    "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "l": "i"}


class Folding(dict):
    """Character table for ``str.translate``, filled as characters turn up."""

    def __missing__(self, code: int):
        out = ""
        for c in unicodedata.normalize("NFKD", chr(code)).casefold():
            kind = unicodedata.category(c)
            if kind in ("Mn", "Cf"):
                continue
            c = LOOKALIKES.get(c, c)
            c = SUBSTITUTES.get(c, c)
            out += c if c.isalnum() else " "
        self[code] = out
        return out


def folded(text: str | None, table: Folding) -> str:
    return " " + (text or "").translate(table) + " "


@dataclass
class Lexicon:
    """Folded patterns with weights, folded exception phrases, and the load at which a text counts as toxic."""

    terms: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    cut: float = DEFAULT_CUT

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for term, weight in self.terms.items():
            found.add_word(term, (len(term), weight))
        for phrase in self.exceptions:
            found.add_word(phrase, (len(phrase), None))
        if len(found):
            found.make_automaton()
        return found


def matches(text: str, automaton) -> dict[int, tuple[float, int]]:
    """Heaviest match per word start, as ``start: (weight, length)``, outside exception phrases."""
    best: dict[int, tuple[float, int]] = {}
    excepted = []
    if len(automaton):
        for end, (length, weight) in automaton.iter(text):
            start = end - length + 1
            if weight is None:
                excepted.append((start, end))
            elif weight > best.get(start, (0.0, 0))[0]:
                best[start] = (weight, length)
    return {s: w for s, w in best.items() if not any(a <= s < b for a, b in excepted)} if excepted else best


def load_of(text: str, automaton) -> tuple[float, int]:
    """``(load, matches)`` of a folded text."""
    found = matches(text, automaton)
    if not found:
        return 0.0, 0
    return sum(w for w, _ in found.values()) / (len(text.split()) + PRIOR_WORDS), len(found)


def terms_of(text: str) -> set[str]:
    """Whole words and word beginnings of a folded text, as patterns."""
    out = set()
    for word in set(text.split()):
        out.add(f" {word} ")
        out.update(f" {word[:n]}" for n in PREFIXES if len(word) >= n)
    return out


def _counts_by_label(batches: Iterable[pa.RecordBatch], items) -> Iterator[pa.RecordBatch]:
    """Rows per term and label, in parts of about ``HELD_TERMS`` terms that Spark sums; a task holds no more."""
    table = Folding()
    counts = (Counter(), Counter())

    def part() -> pa.RecordBatch:
        terms = list(counts[0].keys() | counts[1].keys())
        numbers = [pa.array([c[t] for t in terms], pa.int64()) for c in (counts[1], counts[0])]
        counts[0].clear()
        counts[1].clear()
        return pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *numbers], ["term", "toxic_rows", "clean_rows"])

    for batch in slices(iter(batches), "text"):
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            counts[toxic].update(items(folded(text, table)))
            if len(counts[0]) + len(counts[1]) >= HELD_TERMS:
                yield part()
    yield part()


_COUNTS = "term string, toxic_rows long, clean_rows long"


def _term_counts(batches):
    yield from _counts_by_label(batches, terms_of)


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("term").agg(F.sum("toxic_rows").alias("p"), F.sum("clean_rows").alias("n"))


def fold_of(id_column: Column) -> Column:
    """Which of four parts a row belongs to; part 2 is held out."""
    return F.coalesce(F.crc32(id_column.cast("string")) % 4, F.lit(0))


def fit(docs: DataFrame, labels: DataFrame, exceptions: Iterable[str] = ()) -> Lexicon:
    """Learn a lexicon from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``; what is collected is bounded."""
    known = (
        labels.where("doc_id is not null and toxic in (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .withColumn("part", fold_of(F.col("doc_id")))
        .where("part != 2")
    )
    samples = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS) for y in (0, 1)]
    chosen = samples[0].union(samples[1])  # at most 2 * SAMPLE_ROWS narrow rows, so a broadcast is bounded
    rows = written(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "labelled")
    table = Folding()
    given = sorted({" " + " ".join(folded(e, table).split()) + " " for e in exceptions})
    first = _mined(rows.where("part in (0, 1)"), given)
    if not first.terms:
        return _mined(rows, given)
    seen = loads(rows.where("part = 3"), first, ["toxic"]).select("row.toxic", "load").collect()  # bounded sample
    lexicon = _mined(rows, given)
    lexicon.cut = best_cut([(r["load"], r["toxic"]) for r in seen])
    return lexicon


def _mined(rows: DataFrame, exceptions: list[str]) -> Lexicon:
    """Terms and exception phrases from sampled rows."""
    lexicon = Lexicon(exceptions=exceptions)
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return lexicon
    counted = _summed(rows.select("text", "toxic").mapInArrow(_term_counts, _COUNTS))
    counted = written(counted.where(F.col("p") + F.col("n") >= MIN_ROWS), "terms")
    p, n = F.col("p") + 0.5, F.col("n") + 0.5
    weight = F.log(p / (sizes[1] + 1)) - F.log(n / (sizes[0] + 1)) - CAUTION * F.sqrt(1 / p + 1 / n)
    share = sizes[1] / (sizes[0] + sizes[1])
    both = F.col("p") + F.col("n")
    ratio = 2 * (
        F.col("p") * F.log(F.greatest("p", F.lit(1)) / (both * share))
        + F.col("n") * F.log(F.greatest("n", F.lit(1)) / (both * (1 - share)))
    )
    needed = 2 * math.log(max(1, counted.count()) / CHANCE)
    best = (
        counted.where((F.col("p") >= max(MIN_ROWS, MIN_SHARE * sizes[1])) & (weight >= MIN_WEIGHT) & (ratio >= needed))
        .select("term", weight.alias("weight"), ratio.alias("ratio"), "n")
        .orderBy(F.desc("ratio"), "term")
        .limit(MAX_TERMS)
        .collect()
    )
    lexicon.terms = {r["term"]: float(r["weight"]) for r in best}
    if any(r["n"] for r in best):  # only terms that clean rows hold can need exceptions
        terms = Lexicon(lexicon.terms)

        def phrases(batches):
            automaton = terms.automaton()

            def around(text: str) -> set[str]:
                out = set()
                for start in matches(text, automaton):
                    before, after = text[max(0, start - 200) : start].split()[-1:], text[start : start + 200].split()[:2]
                    out.update(" " + " ".join(x) + " " for x in (before + after[:1], after) if len(x) == 2)
                return out

            yield from _counts_by_label(batches, around)

        found = (
            _summed(rows.select("text", "toxic").mapInArrow(phrases, _COUNTS))
            .where(F.col("n") >= MIN_ROWS)
            .where(F.col("p") * sizes[0] < F.col("n") * sizes[1])
            .orderBy(F.desc("n"), "term")
            .limit(MAX_PHRASES)
            .collect()
        )
        lexicon.exceptions = sorted({*exceptions, *(r["term"] for r in found)})
    return lexicon


def best_cut(seen: list[tuple[float, int]]) -> float:
    """The highest load that separates the labels with an F1 within ``PLATEAU`` of the best: clean texts should stay."""
    seen = sorted(seen, reverse=True)
    total = sum(y for _, y in seen)
    cuts, caught = [], 0
    for i, (load, toxic) in enumerate(seen):
        if load <= 0:
            break
        caught += toxic
        below = seen[i + 1][0] if i + 1 < len(seen) else 0.0
        if below < load:
            cuts.append((2 * caught / (i + 1 + total), math.sqrt(load * below) if below > 0 else load / 4))
    best = max((f1 for f1, _ in cuts), default=0.0)
    if not best:
        return DEFAULT_CUT
    return max(cut for f1, cut in cuts if f1 >= best - PLATEAU)


def loads(docs: DataFrame, lexicon: Lexicon, keep: Iterable[str]) -> DataFrame:
    """``(row, load, n_matches)``: the columns to keep are fields of one struct, so that no name can clash."""
    keep = list(keep)
    inside = "text" in keep

    def scored(batches):
        automaton, table = lexicon.automaton(), Folding()
        for batch in slices(iter(batches), "row.text" if inside else "text"):
            texts = batch.column("row").field("text") if inside else batch.column("text")
            found = [load_of(folded(t, table), automaton) for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array([x for x, _ in found], pa.float64()),
                    pa.array([m for _, m in found], pa.int64()),
                ],
                ["row", "load", "n_matches"],
            )

    rows = docs.select(F.struct(*keep).alias("row"), *([] if inside else ["text"]))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(scored, f"row {kind}, load double, n_matches long")


def score_toxicity(docs: DataFrame, lexicon: Lexicon, keep: Iterable[str]) -> DataFrame:
    """``(row, score, predicted, n_matches)`` for every row of ``docs``, of which ``row`` holds the columns ``keep``; ``predicted`` is 1 from a score of 0.3 on."""
    scale = lexicon.cut * (1 - CUT_SCORE) / CUT_SCORE
    score = F.col("load") / (F.col("load") + F.lit(scale))
    return loads(docs, lexicon, keep).select(
        "row", score.alias("score"), (score >= CUT_SCORE).cast("int").alias("predicted"), "n_matches"
    )
