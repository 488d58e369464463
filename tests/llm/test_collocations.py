"""Collocations: against a plain count over all phrases, with small heads, tiles and edge rows."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from quiver.llm.collocations import PairTiles, WidePairs, collocations


def _brute(rows, least, top, cover):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, 5):
                counts.setdefault(lang, Counter()).update(" ".join(w[i: i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        cand = {p: n for p, n in f.items() if n >= least and " " in p}
        most = Counter()
        for p, n in cand.items():
            w = p.split(" ")
            for k in range(2, len(w)):
                for i in range(len(w) - k + 1):
                    inner = " ".join(w[i: i + k])
                    most[inner] = max(most[inner], n)
        found = []
        for p, a in cand.items():
            if 100 * most[p] >= cover * a and most[p]:
                continue
            w = p.split(" ")
            cuts = [(2000000 * a // (f[" ".join(w[:k])] + f[" ".join(w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            found.append((-score, -a, p.encode(), p, a, f[" ".join(w[:k])], f[" ".join(w[k:])], score))
        for rank, x in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, *x[3:7], totals[lang], x[7]))
    return sorted(out)


def _texts(seed, n=120):
    rng = random.Random(seed)
    words = ["a", "B", "the", "New", "York", "City", "of", "é", "日本", "x" * 600, "#", "c-d"]
    rows = [(1, "en", "new york city. New York  City\tof the a a a a a! a")] * 7
    for i in range(n):
        lang = rng.choice(["en", "en", "de", None, "und", ""])
        rows.append((i, lang, "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "\x0b"])
                                      for _ in range(rng.randint(0, 60)))))
    return rows + [(None, "en", None), (5, None, ""), (6, "zz", " \n"), (7, "zz", "only.one")]


def _run(spark, rows, **options):
    df = spark.createDataFrame([(i, t, g, 1, "q", 2.0) for i, g, t in rows],
                               "doc_id long, text string, lang string, n int, phrase string, score double").repartition(3)
    return sorted(tuple(r) for r in collocations(df, **options).collect())


def test_matches_a_plain_count(spark):
    rows = _texts(1)
    want = _brute([(g, t) for _, g, t in rows], 6, 40, 80)
    assert len(want) > 50 and any(len(w[2].split()) == 4 for w in want)
    assert _run(spark, rows, least=6, top=40) == want


@pytest.mark.parametrize("head, pair_head", [(0, 9), (3, 2), (7, 0), (25, 5), (100, 0)])
def test_small_heads_change_nothing(spark, head, pair_head):
    rows = _texts(2)
    assert _run(spark, rows, least=5, top=1000, head=head, pair_head=pair_head) == _brute([(g, t) for _, g, t in rows], 5, 1000, 80)


def test_tables_without_phrases(spark):
    assert _run(spark, [(1, "en", None), (2, None, " . ")], least=1) == []
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert collocations(df).collect() == []
    assert _run(spark, [(1, "en", "x " * 50000)], least=30) == _brute([("en", "x " * 50000)], 30, 2000, 80)


def test_tiles_count_exactly_and_hand_out():
    rng = np.random.default_rng(0)
    a = np.minimum(rng.zipf(1.3, 300_000), 5000)
    b = np.minimum(rng.zipf(1.3, 300_000), 5000)
    tiles, total = PairTiles(buffer=100_000, listed=1000, tiles=2), Counter()
    for i in range(0, len(a), 7000):
        for x, y, n in tiles.add(a[i: i + 7000], b[i: i + 7000]):
            total.update(dict(zip(zip(x.tolist(), y.tolist()), n.tolist())))
    assert tiles.dense
    for x, y, n in tiles.rest():
        for p, k in zip(zip(x.tolist(), y.tolist()), n.tolist()):
            total[p] += k
    assert total == Counter(zip(a.tolist(), b.tolist()))


def test_wide_pairs_count_exactly_and_hand_out():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 40, 50_000) << 40, rng.integers(0, 30, 50_000)
    wide, total = WidePairs(buffer=3000, listed=500), Counter()
    for i in range(0, len(a), 1000):
        for x, y, n in wide.add(a[i: i + 1000], b[i: i + 1000]):
            total.update(dict(zip(zip(x.tolist(), y.tolist()), n.tolist())))
    for x, y, n in wide.rest():
        total.update(dict(zip(zip(x.tolist(), y.tolist()), n.tolist())))
    assert total == Counter(zip(a.tolist(), b.tolist())) and list(wide.rest()) == []


def test_scores_beyond_64_bits(spark):
    from quiver.llm.collocations import _floor_ratio

    a, l, r = 8 * 10 ** 18, 9 * 10 ** 18, 9 * 10 ** 18
    got = spark.createDataFrame([(a, l, r)], "a long, l long, r long").select(_floor_ratio("a", "l", "r")).first()[0]
    assert got == 2000000 * a // (l + r)
