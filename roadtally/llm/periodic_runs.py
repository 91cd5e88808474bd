"""Periodic run detection on grammar-compressed text: stretches of words that repeat with some period three times or more.

A run is a stretch of at least ``max(24, 3 q)`` words with smallest period q that no neighbouring word extends. Inside a run
each word comes again within q words, so only zones in which enough words in a row do so are looked at. A zone's word ids
are compressed by Re-Pair: frequent pairs become new symbols, level by level, so a repeated block is one symbol. For each
symbol the repetitions that cross the boundary between its two halves are computed once, with prefix matches in linear time;
they are then placed at every position the symbol has in the derivation, and stretches of one period that overlap by it are
merged. A run lies in a smallest symbol that holds it whole and crosses the boundary there, so all runs are found, however
often the block repeats. Of equal stretches the smallest period counts.

Words are maximal runs of characters other than space and U+0009 to U+000D; null and empty texts have none. Rows are judged one by
one: repeated rows and ids give repeated results, other columns are ignored. ``looped`` is the given way of planting
periodic tails into one document of ten, chosen by its id; a row without an id gets none.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadtally.llm.common import slices

LEAST_WORDS, LEAST_TIMES = 24, 3

SCHEMA = (
    "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)

Run = tuple[int, int, int]  # first word, word after the last, period


def looped(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words, or for one id of ten the words up to some place and then a block from there over and over."""
    code = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if code % 10 or not words:
        return words
    n, g = len(words), code // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    block = words[a : a + p]
    return words[:a] + (block * ((n - a) // p + 1))[: n - a]


def zones(ids: np.ndarray) -> list[tuple[int, int]]:
    """Stretches outside of which there is no run.

    A run of period q has ``max(LEAST_WORDS - q, 2 q)`` or more words in a row that come again within q words. Periods are
    taken together between powers of two.
    """
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    ahead = np.full(n, n, np.int64)
    again = ids[order[1:]] == ids[order[:-1]]
    ahead[order[:-1][again]] = (order[1:] - order[:-1])[again]
    found, most = [], 1
    while most // 2 < n // LEAST_TIMES:
        near = np.flatnonzero(np.diff((ahead <= most).astype(np.int8), prepend=0, append=0))
        starts, ends = near[::2], near[1::2]
        lower = most // 2 + 1
        long = ends - starts >= max(LEAST_WORDS - most, (LEAST_TIMES - 1) * lower)
        found += [(int(a), min(n, int(b) + most)) for a, b in zip(starts[long], ends[long], strict=True)]
        most *= 2
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


class Grammar:
    """Re-Pair: ``rules`` gives the two halves of each new symbol, ``length`` its words, ``place`` one place it stands at."""

    def __init__(self, ids: list[int]):
        self.rules: dict[int, tuple[int, int]] = {}
        self.length: dict[int, int] = {}
        self.place: dict[int, int] = {}
        self.next = max(ids) + 1
        self.sequence = ids
        while self._replace_pairs():
            pass
        self._join_rest()

    def size(self, symbol: int) -> int:
        return self.length.get(symbol, 1)

    def _new(self, left: int, right: int, place: int) -> int:
        symbol = self.next
        self.next += 1
        self.rules[symbol] = (left, right)
        self.length[symbol] = self.size(left) + self.size(right)
        self.place[symbol] = place
        return symbol

    def _replace_pairs(self) -> bool:
        """Replace the most frequent pairs, down to half of the highest count, in one sweep from the left."""
        old = self.sequence
        counts = Counter(zip(old, old[1:]))
        most = max(counts.values(), default=0)
        if most < 2:
            return False
        names: dict[tuple[int, int], int] = {}
        new, place, i, last = [], 0, 0, len(old) - 1
        least = max(2, most // 2)
        while i <= last:
            symbol = old[i]
            if i < last and counts[pair := (symbol, old[i + 1])] >= least:
                symbol = names.get(pair) or names.setdefault(pair, self._new(*pair, place))
                i += 1
            new.append(symbol)
            place += self.size(symbol)
            i += 1
        self.sequence = new
        return True

    def _join_rest(self) -> None:
        """Symbols that are left stand once each; they are joined in pairs up to a single symbol."""
        while len(self.sequence) > 1:
            old, place, new = self.sequence, 0, []
            for i in range(0, len(old), 2):
                joined = self._new(old[i], old[i + 1], place) if i + 1 < len(old) else old[i]
                new.append(joined)
                place += self.size(joined)
            self.sequence = new

    def places(self, wanted: Iterable[int]) -> dict[int, list[int]]:
        """All places of the wanted symbols in the derivation of the whole text."""
        wanted, leading = set(wanted), set()
        for symbol, halves in self.rules.items():  # halves come before the symbols made of them
            if symbol in wanted or halves[0] in leading or halves[1] in leading:
                leading.add(symbol)
        found: dict[int, list[int]] = defaultdict(list)
        found[self.sequence[0]] = [0]
        for symbol in reversed(self.rules):
            if symbol in leading and symbol in found:
                left, right = self.rules[symbol]
                at = found[symbol] if symbol in wanted else found.pop(symbol)
                if left in leading:
                    found[left] += at
                if right in leading:
                    shift = self.size(left)
                    found[right] += [p + shift for p in at]
        return {s: found[s] for s in wanted}


def prefix_matches(s: list[int]) -> list[int]:
    """At each place, how many symbols from there on agree with the beginning."""
    n = len(s)
    out = [0] * n
    left = right = 0
    for i in range(1, n):
        k = min(out[i - left], right - i) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        out[i] = k
        if i + k > right:
            left, right = i, i + k
    if n:
        out[0] = n
    return out


def crossing(u: list[int], v: list[int]) -> list[Run]:
    """Repetitions in ``u + v`` that touch both parts, as long as those parts allow; of equal stretches the smallest period."""
    n_u, n_v = len(u), len(v)
    most = (n_u + n_v) // LEAST_TIMES
    back_u = u[::-1]
    onward = prefix_matches(v)
    onward_from_u = prefix_matches([*v, -1, *u, *v])
    backward = prefix_matches(back_u)
    backward_from_v = prefix_matches([*back_u, -1, *v[::-1], *back_u])
    found: dict[tuple[int, int], int] = {}
    for q in range(1, most + 1):
        least = max(LEAST_WORDS, LEAST_TIMES * q)
        if q <= n_v:
            start = n_u - min(backward_from_v[n_u + 1 + n_v - q], n_u)
            stop = n_u + q + (onward[q] if q < n_v else 0)
            if stop - start >= least and start < n_u:
                found.setdefault((start, stop), q)
        if q <= n_u:
            start = n_u - q - (backward[q] if q < n_u else 0)
            stop = n_u + min(onward_from_u[n_v + 1 + n_u - q], n_v)
            if stop - start >= least and stop > n_u:
                found.setdefault((start, stop), q)
    return [(start, stop, q) for (start, stop), q in found.items()]


def runs_of(ids: list[int]) -> list[Run]:
    """All runs of a sequence, by first word and period."""
    if len(ids) < LEAST_WORDS:
        return []
    grammar = Grammar(ids)
    local: dict[int, list[Run]] = {}
    for symbol, (left, _) in grammar.rules.items():
        if grammar.length[symbol] >= LEAST_WORDS:
            start = grammar.place[symbol]
            middle = start + grammar.size(left)
            if found := crossing(ids[start:middle], ids[middle : start + grammar.length[symbol]]):
                local[symbol] = found
    by_period: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for symbol, places in grammar.places(local).items():
        for start, stop, q in local[symbol]:
            by_period[q] += [(p + start, p + stop) for p in places]
    smallest: dict[tuple[int, int], int] = {}
    for q, stretches in sorted(by_period.items()):
        stretches.sort()
        low, high = stretches[0]
        for start, stop in [*stretches[1:], (1 << 62, 1 << 62)]:
            if start <= high - q:
                high = max(high, stop)
            else:
                smallest.setdefault((low, high), q)
                low, high = start, stop
    return sorted((start, stop, q) for (start, stop), q in smallest.items())


def _judged(text: bytes | None, doc_id: int | None, planted: bool) -> tuple:
    words = (text or b"").split()  # of bytes: at exactly the six separators
    if planted:
        words = looped(words, doc_id)
    n, runs = len(words), []
    if n >= LEAST_WORDS:
        codes: dict[bytes, int] = {}
        ids = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, n)
        for a, b in zones(ids):
            runs += [(a + start, a + stop, q) for start, stop, q in runs_of(ids[a:b].tolist())]
    if not runs:
        kept = words
        best = (None, None, None, None)
    else:
        gone = bytearray(n)
        for start, stop, q in runs:
            gone[start + q : stop] = b"\1" * (stop - start - q)
        kept = [w for w, dropped in zip(words, gone, strict=True) if not dropped]
        start, stop, q = min(runs, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2]))
        best = (start, stop - start, q, 1000 * (stop - start) // q)
    lines = "".join(f"{start},{stop - start},{q}\n" for start, stop, q in runs)
    return (n, len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", planted: bool = False) -> DataFrame:
    """A row per document: its runs, the one of the greatest exponent, and the digest of the text without repetitions.

    ``planted`` loops the tails of one document of ten first. Of a run the first period stays, later words are dropped.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(iter(batches), "text"):
            ids = batch.column("doc_id").to_pylist()
            found = [_judged(t.as_py(), i, planted) for t, i in zip(batch.column("text").cast(pa.binary()), ids, strict=True)]
            columns = list(zip(*found, strict=True))
            arrays = [pa.array(c, pa.int64()) for c in columns[:6]] + [pa.array(c, pa.string()) for c in columns[6:]]
            names = ["n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", *names])

    return rows.mapInArrow(judge, SCHEMA)
