"""Secret scan: fixed patterns, and a token-efficiency test that exposes random strings.

Pattern kinds are ``assign``, ``access`` and ``hex`` as in ``ASSIGN``, ``ACCESS`` and runs of hex digits. The method adds
``random``: runs of ``RANDOM_CHARS`` or more letters, digits and ``+/_-`` (with up to two ``=`` after them) that a byte-pair
vocabulary needs many tokens for, that is fewer than ``MAX_CHARS_PER_TOKEN`` characters per token. Natural words, even long
compounds, stay above it. Known digests (hex runs of the usual lengths), UUIDs, pure numbers, runs without a digit or of
one letter case only without one, and runs inside a span of another kind are not reported as random.

Spans are code points, end exclusive. A match that is too short is dropped and still consumes its text. Null texts count as
empty; empty texts have no spans. Repeated rows give equal results. Runs longer than ``PIECE`` are tokenised in pieces.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadtally.llm.common import slices

KINDS = ("assign", "access", "hex", "random")
# The patterns of the base kinds and their least lengths.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 6, 20, 24
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
# Hex lengths of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
DIGEST_CHARS = {32, 40, 56, 64, 96, 128}
UUID = r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"

RANDOM_CHARS = 20
MAX_CHARS_PER_TOKEN = 2.0
PIECE = 256
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# The public pre-tokenizer pattern of that vocabulary, over ASCII words.
PIECES = r"'(?:[sdmt]|ll|ve|re)| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+"

RESULT = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"
)


def encoding(path: str = VOCABULARY):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("vocabulary", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})


def _classes(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(chars.encode(), np.uint8)] = True
    return table


_DIGITS = "0123456789"
_HEX = _classes(_DIGITS + "abcdef")
_DENSE = _classes(_DIGITS + "abcdefghijklmnopqrstuvwxyz" + "ABCDEFGHIJKLMNOPQRSTUVWXYZ" + "+/_-")


def _runs(data: np.ndarray, breaks: np.ndarray, members: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of member bytes that are long enough; no run crosses a break."""
    inside = members[data]
    edge = np.empty(len(data) + 1, bool)
    edge[0], edge[-1] = True, True
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[breaks] = True
    at = np.flatnonzero(edge)
    start, end = at[:-1], at[1:]
    good = (end - start >= least) & inside[np.minimum(start, len(data) - 1)]
    return start[good], end[good]


def known_identifier(run: str) -> bool:
    """Digests, UUIDs, numbers and plain names, which may look random but give nothing away."""
    if re.fullmatch(UUID, run) or run.isdigit():
        return True
    if len(run) in DIGEST_CHARS and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", run):
        return True
    digits = any(c.isdigit() for c in run)
    mixed = re.search(r"[a-z][A-Z].*[A-Z][a-z]|[A-Z]{2}[a-z]+[A-Z]", run) is not None
    return not digits and not mixed


def chars_per_token(run: str, vocabulary) -> float:
    return len(run) / max(1, sum(len(vocabulary.encode_ordinary(run[i : i + PIECE])) for i in range(0, len(run), PIECE)))


def _row(text: str, hex_runs, dense_runs, assign, access, vocabulary) -> tuple:
    """Result of one text; runs come as code point offsets."""
    base = []
    low = text.lower() if not text.isascii() else text.casefold()
    if any(k in low for k in KEYWORDS):
        base += [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m.group(2)) >= ASSIGN_CHARS]
    if "AKIA" in text:
        base += [(m.start(), 1, m.end()) for m in access.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    base += [(a, 2, b) for a, b in hex_runs]
    base.sort()
    more = []
    for a, b in dense_runs:
        end = b
        while end < len(text) and end - b < 2 and text[end] == "=":
            end += 1
        if any(s < end and a < e for s, _, e in base) or known_identifier(text[a:b]):
            continue
        if chars_per_token(text[a:end], vocabulary) < MAX_CHARS_PER_TOKEN:
            more.append((a, 3, end))
    counts = [sum(k == i for _, k, _ in base) for i in range(3)]
    show = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
    return (*counts, hashlib.sha256(show(base).encode()).hexdigest(), show(sorted(base + more)), len(more))


def scan_secrets(docs: DataFrame, vocabulary_path: str = VOCABULARY) -> DataFrame:
    """Counts and spans of every row of ``docs(doc_id, text)``. Each task loads the vocabulary from the given path."""

    def scanned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = encoding(vocabulary_path)
        assign = re.compile(ASSIGN.replace("password|passwd|secret|token|api_?key", "(?ai:password|passwd|secret|token|api_?key)"))
        access = re.compile(ACCESS)
        for batch in slices(batches, "text"):
            texts = pc.fill_null(batch.column("text"), "")
            ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
            starts = np.append(0, ends[:-1])
            strings = texts.to_pylist()
            data = np.frombuffer("".join(strings).encode(), np.uint8)
            runs = {}
            for name, members, least in (("hex", _HEX, HEX_CHARS), ("dense", _DENSE, RANDOM_CHARS)):
                found: dict[int, list] = {}
                if len(data):
                    a, b = _runs(data, starts[starts < len(data)], members, least)
                    for i, j, row in zip(a, b, np.searchsorted(ends, a, side="right"), strict=True):
                        i, j, row = int(i - starts[row]), int(j - starts[row]), int(row)
                        if not strings[row].isascii():
                            before = len(strings[row].encode()[:i].decode())
                            i, j = before, before + j - i
                        found.setdefault(row, []).append((i, j))
                runs[name] = found
            rows = [
                _row(t, runs["hex"].get(r, ()), runs["dense"].get(r, ()), assign, access, vocabulary)
                for r, t in enumerate(strings)
            ]
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                [x.split()[0] for x in RESULT.split(", ")],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scanned, RESULT)
