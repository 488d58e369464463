"""Exact, near and substring dedup and decontamination against brute force."""

import hashlib
import random
import re

import numpy as np

from quiver.llm.components import components
from quiver.llm.decontaminate import bins_of, contaminated, drop_contaminated
from quiver.llm.exact_dedup import drop_exact_copies, exact_dedup
from quiver.llm.near_dedup import drop_near_duplicates, near_duplicates
from quiver.llm.sketch import similarity_sketches
from quiver.llm import substring_dedup
from quiver.llm.substring_dedup import remove_repeats, repeated_spans

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x20\x09-\x0d]+")


def words_of(text, fold=True):
    return WORD.findall((text or "").translate(FOLD) if fold else text or "")


def shingles(text, n):
    w = words_of(text)
    return {tuple(w[i: i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def corpus(seed=3):
    """Copies, near copies at many distances, shared passages, edge texts; ids with gaps."""
    rng = random.Random(seed)
    texts = [None, "", " \n\t", "one", "ONE", "one two", "One  two", "x" * 30000, "É é", "é É"]
    for _ in range(12):
        base = prose(rng, rng.randint(30, 120)).split()
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = f"n{rng.randrange(10 ** 6)}"
            texts.append(rng.choice([" ", "\n"]).join(copy).upper() if rng.random() < .2 else " ".join(copy))
    passage = prose(rng, 40)
    texts += [f"{prose(rng, 50)} {passage} {prose(rng, 50)}" for _ in range(5)]
    texts.append(" ".join(["again"] * 60))
    texts.append(prose(rng, 20000, 5000) + " " + passage)
    ids = rng.sample(range(1000), len(texts))
    return list(zip(ids, texts))


# ---------------------------------------------------------------- exact

def exact_truth(rows):
    out = {}
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", t or ""), []).append((i, t or ""))
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0]))[0]
        for i, _ in members:
            out[i] = (keep, len(members), hashlib.sha256(norm.encode()).hexdigest())
    return out


def test_exact_dedup_matches_brute_force(docs_of):
    rows = corpus() + [(2000, "o\x0bn\x0ce\r"), (2001, "ONE"), (None, "one  "), (2002, "\x0b")]
    want = exact_truth(rows)
    for all_digests in (True, False):
        got = exact_dedup(docs_of(rows, 5), digest_all=all_digests).collect()
        assert len(got) == len(rows)
        for r in got:
            keep, size, sha = want[r.doc_id]
            assert (r.keep_id, r.group_size, r.kept) == (keep, size, r.doc_id == keep)
            assert r.text_sha256 == sha or (not all_digests and size == 1 and r.text_sha256 is None)


def test_exact_dedup_keeps_one_of_repeated_rows(docs_of):
    rows = [(1, "a b")] * 3 + [(1, "other")] + [(2, "ab")] + [(None, "z")] * 2
    got = exact_dedup(docs_of(rows, 3)).collect()
    assert sorted((r.doc_id or -1, r.group_size, r.kept) for r in got) == [
        (-1, 2, False), (-1, 2, True), (1, 1, True), (1, 4, False), (1, 4, False), (1, 4, True), (2, 4, False)]
    left = drop_exact_copies(docs_of(rows, 3))
    assert left.columns == ["doc_id", "text", "keep_id", "n"]
    assert sorted((r.doc_id or -1, r.text) for r in left.collect()) == [(-1, "z"), (1, "a b"), (1, "other")]


def test_exact_dedup_of_nothing(docs_of):
    empty = docs_of([(1, "x")], 0).where("doc_id > 5")
    assert exact_dedup(empty).count() == 0 and drop_exact_copies(empty).count() == 0


# ---------------------------------------------------------------- near

def near_truth(rows, n, percent):
    sets = {i: shingles(t, n) for i, t in rows}
    link = {i: i for i in sets}

    def root(i):
        while link[i] != i:
            i = link[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    link[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_near_duplicates_match_all_pairs(docs_of):
    rows = corpus(5)
    for n in (4, 5):
        want = near_truth(rows, n, 80)
        got = near_duplicates(docs_of(rows, 4), words=n, percent=80).collect()
        assert len(got) == len(rows)
        for r in got:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r
            assert r.kept == (r.doc_id == r.component_id)


def test_large_group_of_near_copies(docs_of):
    """A chain-like group: many members are not linked to the first one directly."""
    rng = random.Random(1)
    base = prose(rng, 150).split()
    rows = []
    for i in range(150):
        copy = list(base)
        for _ in range(rng.randint(0, 12)):
            copy[rng.randrange(150)] = f"e{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(copy)))
    want = near_truth(rows, 4, 80)
    got = {r.doc_id: r.component_id for r in near_duplicates(docs_of(rows, 3), words=4, partners=1).collect()}
    assert got == {i: c for i, (_, c) in want.items()}


def test_near_duplicates_nulls_and_repeats(docs_of):
    text = "a b c d e f g h"
    rows = [(5, text), (5, text), (None, text), (7, None), (8, None), (9, text.upper())]
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs_of(rows)).collect())
    assert got == [(-1, 4, 5, False), (5, 4, 5, True), (5, 4, 5, True), (7, 0, 7, True), (8, 0, 8, True), (9, 4, 5, False)]
    left = drop_near_duplicates(docs_of(rows))
    assert sorted(r.doc_id for r in left.collect()) == [5, 5, 7, 8] and "keep_id" in left.columns
    assert near_duplicates(docs_of(rows).where("doc_id > 50")).count() == 0


def test_rows_that_share_an_id_are_dropped_by_their_own_text(spark, docs_of):
    rng = random.Random(9)
    a, b, c, d = (prose(rng, 40, 10 ** 6) for _ in range(4))
    rows = [(3, b), (5, a), (5, b), (None, b), (None, c), (None, d), (6, None), (None, None)]
    left = drop_near_duplicates(docs_of(rows))
    assert left.columns == ["doc_id", "text", "keep_id", "n"]
    want = {(3, b), (5, a), (None, c), (None, d), (6, None), (None, None)}
    assert {(r.doc_id, r.text) for r in left.collect()} == want and left.count() == len(want)
    got = {(r.doc_id, r.component_id, r.kept) for r in near_duplicates(docs_of(rows)).where("n_shingles > 0").collect()}
    assert got == {(3, 3, True), (5, 5, True), (5, 3, False), (None, 3, False), (None, None, True)}
    near = b + " more"  # near copies that share an id: one stays
    assert drop_near_duplicates(docs_of([(4, b), (4, near), (None, near)])).count() == 1
    items = spark.createDataFrame([(1, b)], "item_id long, text string")
    left = drop_contaminated(docs_of(rows), items)
    assert left.columns == ["doc_id", "text", "keep_id", "n"]
    assert {(r.doc_id, r.text) for r in left.collect()} == {r for r in rows if r[1] != b}


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2 ** 63, 1200).astype(np.uint64)
    for shared in (0, 300, 800):
        a, b = x[:1000], np.concatenate([x[1000 - shared: 1000], rng.integers(0, 2 ** 63, 1000 - shared).astype(np.uint64)])
        s = similarity_sketches(np.concatenate([a, b]), np.array([0, 1000, 2000]), 512)
        assert abs((s[0] == s[1]).mean() - shared / (2000 - shared)) < 0.09
    tiny = similarity_sketches(x[:1], np.array([0, 0, 1]), 64)  # an empty set, then one element in every bin
    assert (tiny[0] == 2 ** 64 - 1).all() and (tiny[1] < 2 ** 64 - 1).all()


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(200, 200), (300, 299)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{k: 100 for k in range(100, 140)}, 299: 299, 300: 299}


# ---------------------------------------------------------------- decontamination

def leak_truth(rows, items, percent=80):
    out = {}
    for j, q in items:
        own = shingles(q, 5) if len(words_of(q)) >= 5 else set()
        for i, t in rows:
            both = len(own & shingles(t, 5)) if len(words_of(t)) >= 5 else 0
            if own and 100 * both >= percent * len(own):
                out[i, j] = (len(own), both)
    return out


def test_contaminated_matches_brute_force(spark, docs_of):
    rng = random.Random(8)
    items = [(k, prose(rng, n, 3000)) for k, n in enumerate([5, 6, 7, 9, 12, 16, 20, 31, 32, 33, 59, 64, 130, 400] * 2)]
    items += [(90, "too short here"), (91, None), (92, "")]
    rows = []
    for k, text in items[:28]:
        w = text.split()
        cut = max(len(w) // 10, 0)
        parts = [" ".join(w), " ".join(w[cut:]).upper(), " ".join(w[: len(w) // 2])]
        for t in parts:
            rows.append((len(rows), f"{prose(rng, rng.randint(0, 300), 3000)} {t} {prose(rng, rng.randint(0, 3000), 3000)}"))
    rows += [(900, None), (901, ""), (902, "short"), (903, prose(rng, 20000, 3000) + " " + items[7][1])]
    tests = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    got = contaminated(docs_of(rows, 3), tests).collect()
    assert {(r.doc_id, r.item_id): (r.item_shingles, r.shared) for r in got} == leak_truth(rows, items)
    assert len(got) == len({(r.doc_id, r.item_id) for r in got})
    left = drop_contaminated(docs_of(rows, 3), tests)
    leaky = {i for i, _ in leak_truth(rows, items)}
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i, _ in rows if i not in leaky)
    assert contaminated(docs_of(rows, 3), tests.where("item_id > 500")).count() == 0
    assert contaminated(docs_of(rows, 3).where("doc_id > 5000"), tests).count() == 0


def test_contaminated_with_null_and_repeated_ids(spark, docs_of):
    item = "one two three four five six seven"
    rows = [(None, "x " + item), (3, item + " y"), (3, item + " y")]
    tests = spark.createDataFrame([(None, item), (1, item), (1, item)], "item_id long, text string")
    got = sorted((r.doc_id or -1, r.item_id or -1, r.shared) for r in contaminated(docs_of(rows), tests).collect())
    assert got == [(-1, -1, 3), (-1, 1, 3), (3, -1, 3), (3, 1, 3)]


def test_bins_follow_the_size_class():
    assert bins_of(2) == 0 and 0 < bins_of(4) <= 2048 and bins_of(8) >= 2 ** 10


# ---------------------------------------------------------------- substrings

def repeat_truth(rows, window):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0]))
    seen, out = set(), {}
    for i, t in order:
        w = words_of(t, fold=False)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            g = tuple(w[k: k + window])
            if g in seen:
                gone[k: k + window] = [True] * window
            seen.add(g)
        out[i] = (len(w), sum(gone), " ".join(x for x, z in zip(w, gone) if not z))
    return out


def test_repeats_match_brute_force(docs_of):
    rows = corpus(11) + [(5000, "ab " * 25), (5001, None), (None, corpus(11)[15][1])]
    for window, bits in ((20, 20), (10, 8)):  # 8: a filter full of false hits changes nothing
        want = repeat_truth(rows, window)
        got = remove_repeats(docs_of(rows, 4), window=window, log2_bits=bits, group_windows=500).collect()
        assert len(got) == len(rows)
        for r in got:
            assert (r.n_words, r.n_removed, r.kept_text) == want[r.doc_id]


def test_windows_around_a_common_short_passage_spread_over_the_groups():
    """A passage shorter than the window is in every text; the windows around it all differ."""
    import pyarrow as pa

    rng = random.Random(5)
    passage = prose(rng, 12, 10 ** 6)
    rows = [(k, f"{prose(rng, 30, 10 ** 6)} {passage} {prose(rng, 30, 10 ** 6)}") for k in range(200)]
    batch = pa.RecordBatch.from_pydict({"node": [i for i, _ in rows], "tag": [0] * len(rows), "text": [t for _, t in rows]})

    def around(w):  # the windows that hold the whole passage
        return np.flatnonzero((w.start > 22) & (w.start <= 30))

    sizes = {}
    for out in substring_dedup._last_level([batch], 20, around, 16):
        for r in out.to_pylist():
            if r["hashes"] is not None:
                sizes[r["grp"]] = sizes.get(r["grp"], 0) + len(r["hashes"]) // 8
    assert len(sizes) == 16 and max(sizes.values()) < 3 * sum(sizes.values()) / 16


def test_spans_of_a_document_are_joined(docs_of):
    rng = random.Random(6)
    passage = prose(rng, 300, 10 ** 6)
    rows = [(1, passage), (2, f"a b c {passage} d"), (3, f"{passage} x {passage}")]
    got = sorted((r.node, r.start, r.length) for r in repeated_spans(docs_of(rows), group_windows=50).collect())
    assert got == [(2, 3, 300), (3, 0, 300), (3, 301, 300)]


def test_repeated_rows_are_one_document(docs_of):
    text = " ".join(f"t{k}" for k in range(30))
    rows = [(4, text), (4, text), (9, text), (2, "short")]
    got = sorted((r.doc_id, r.n_removed) for r in remove_repeats(docs_of(rows)).collect())
    assert got == [(2, 0), (4, 0), (4, 0), (9, 30)]
    assert remove_repeats(docs_of(rows).where("doc_id > 50")).count() == 0


def test_kept_is_the_own_id_and_first_tells_equal_ids_apart(spark, docs_of):
    from quiver.llm.near_dedup import near_duplicates

    base = " ".join(f"w{i}" for i in range(60))
    rows = [(4, base), (4, base + " more"), (9, base + " other"), (None, "alone in this text of several words"), (None, base)]
    got = near_duplicates(docs_of(rows), words=4).collect()
    by = sorted(((str(r.doc_id), r.component_id, r.kept) for r in got), key=str)
    assert by == sorted([("4", 4, True), ("4", 4, True), ("9", 4, False), ("None", 4, False), ("None", None, True)], key=str)
    assert sum(r["first"] for r in got) == 2
