"""Co-occurrence vectors: counts and weights against plain loops, eigenvectors against numpy, hit rate."""

import random
from collections import Counter

import numpy as np
import pytest

from quiver.operators import factor, knn, learn, metrics


def _walks(n=300, groups=12, each=8, seed=1):
    """Sequences that stay inside one group of items, so that neighbours can be learned."""
    rng = random.Random(seed)
    rows = []
    for p in range(n):
        g = rng.randrange(groups)
        for i in range(rng.randint(3, 25)):
            item = f"g{g}i{rng.randrange(each)}" if rng.random() < 0.9 else f"g{rng.randrange(groups)}i{rng.randrange(each)}"
            rows.append((f"p{p}", i, item))
    return rows


def _counts(rows, window, min_count):
    often = Counter(v for _, _, v in rows if v is not None)
    lists = {}
    for k, _, v in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        if v is not None and often[v] >= min_count:
            lists.setdefault(k, []).append(v)
    out = Counter()
    for v in lists.values():
        for i, a in enumerate(v):
            for b in v[i + 1: i + 1 + window]:
                if a != b:
                    out[a, b] += 1
                    out[b, a] += 1
    return out


@pytest.mark.parametrize("chunk", [4, 7, 1000])
def test_pairs_across_chunks(spark, chunk):
    rows = _walks(40) + [("p0", 99, None), ("q", 0, "rare"), (None, 0, "g0i0"), (None, 1, "g0i1")]
    df = spark.createDataFrame(rows, "k string, row_id int, v string").repartition(3)
    got = factor.windowed_pairs(df, "k", "row_id", "v", window=4, min_count=2, chunk_size=chunk).collect()
    assert {(r.item, r.other): r.n for r in got} == dict(_counts(rows, 4, 2))


def test_weights_and_vectors_match_numpy(spark):
    rows = _walks()
    df = spark.createDataFrame(rows, "k string, row_id int, v string").repartition(3)
    pairs = _counts(rows, 5, 1)
    items = sorted({a for a, _ in pairs})
    at = {v: i for i, v in enumerate(items)}
    n = np.zeros((len(items), len(items)))
    for (a, b), c in pairs.items():
        n[at[a], at[b]] = c
    with np.errstate(divide="ignore"):
        m = np.maximum(np.log(n * n.sum() / np.outer(n.sum(1), n.sum(1))), 0)
    weights = factor.shifted_ppmi(factor.windowed_pairs(df, "k", "row_id", "v", 5, 1))
    got = np.zeros_like(m)
    for r in weights.collect():
        got[at[r.item], at[r.other]] = r.weight
    assert np.allclose(got, m)
    e, v = np.linalg.eigh(m)
    vec = np.array([r.vec for r in sorted(factor.leading_vectors(weights, 8, steps=6).collect(), key=lambda r: r.item)])
    want = v[:, ::-1][:, :8] * np.sqrt(e[::-1][:8])
    assert np.allclose(vec @ vec.T, want @ want.T, atol=0.02)


def test_hit_rate_is_no_worse_than_word2vec(spark):
    rows = _walks(400, seed=3)
    lists = {}
    for k, _, v in rows:
        lists.setdefault(k, []).append(v)
    train = {k for i, k in enumerate(lists) if i % 4}
    pairs = spark.createDataFrame([(k, v[-2], v[-1]) for k, v in lists.items() if k not in train],
                                  "playlist_id string, x_last string, track_test_y string")
    df = spark.createDataFrame([r for r in rows if r[0] in train], "k string, row_id int, v string")
    seqs = spark.createDataFrame([(lists[k],) for k in train], "track_sequence array<string>")
    rates = []
    for vec in (factor.cooccurrence_embeddings(df, "k", "row_id", "v", vector_size=16, window=5),
                learn.item_embeddings(seqs, vector_size=16, window=5, max_iter=5, partitions=2)):
        nt = knn.next_track(pairs, vec.checkpoint(), k=7)
        rates.append(metrics.hit_rate(nt, "predictions", "track_test_y").first().hit_rate)
    assert rates[0] >= rates[1] and rates[0] > 0.6


def test_no_pairs(spark):
    df = spark.createDataFrame([("p", 1, "a"), ("q", 1, "b"), ("q", 2, "b")], "k string, row_id int, v string")
    assert factor.cooccurrence_embeddings(df, "k", "row_id", "v", min_count=1).collect() == []
