import hashlib
import random

import numpy as np

from roadtally.llm import weighted_sampling as C
from roadtally.llm.queries import op4_weighted_sampling
from tests.llm.cases import ROWS, documents


def check(rows, texts):
    ordered = sorted([(i, t or "") for i, t in texts if i is not None], key=lambda r: (-r[0], 0))
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(texts)
    sampler = C.Sampler()
    for (i, t), (_, following) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        cut = len(t) // 3
        changed = t[: len(t) - cut] + following[:cut]
        own, after, edited = sampler.of_texts([t, following, changed])
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(changed.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (own.hex(), edited.hex())
        assert (r.near_edited, r.near_next) == (C.likeness(own, edited), C.likeness(own, after))


def test_query(spark, sf_dir):
    texts = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    check(op4_weighted_sampling(spark, sf_dir).collect(), texts)


def test_collisions_are_the_generalised_jaccard_similarity():
    draw, sampler = random.Random(5), C.Sampler(samples=4096)
    for _ in range(6):
        terms = np.array([draw.getrandbits(64) for _ in range(60)], np.uint64)
        a, b = (np.array([draw.choice([0, 0, 1, 1, 2, 5, 30]) for _ in terms]) for _ in range(2))
        b[:30] = a[:30]
        similarity = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        x, y = (sampler.signature(terms[w > 0], w[w > 0]) for w in (a, b))
        assert abs(C.likeness(x, y) - similarity) < 4 * (similarity * (1 - similarity) / 4096) ** 0.5 + 0.01


def test_odd_rows(spark):
    rows = C.fingerprints(documents(spark)).collect()
    assert len(rows) == len(ROWS)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].fingerprint == "" and by_id[1].near_edited == 1.0 and by_id[2].near_next == 1.0
    assert by_id[4].fingerprint == by_id[5].fingerprint == by_id[6].fingerprint != by_id[7].fingerprint
    assert len({r.fingerprint for r in rows if r.doc_id == 8}) == 1
    assert C.fingerprints(documents(spark, [])).count() == 0
    assert [r.near_next for r in C.fingerprints(documents(spark, ROWS[3:4])).collect()] == [1.0]
