"""Keywords in names: ten thousand of them against plain containment, the plan, odd keywords."""

import random

from quiver.operators import profile


def _names(n=400, seed=1):
    rng = random.Random(seed)
    parts = ["rock", "radio", "error", "click", "été", "日本", "a", "", "sum", "mix", "x" * 30]
    return [f"{i}-" + "".join(rng.choice(parts) + rng.choice(["", " ", str(rng.randrange(200))]) for _ in range(4)) for i in range(n)]


def _brute(names, words):
    out = {}
    for n in names:
        hit = next((w for w in words if w in n), None)
        if hit is not None:
            out[n] = hit
    return out


def _found(spark, names, words):
    df = spark.createDataFrame([(n,) for n in [*names, *names[:5], None]], "playlist_id string")
    return profile.first_keyword(df, "playlist_id", words)


def test_ten_thousand_keywords(spark):
    rng = random.Random(2)
    names = _names()
    words = ["error" + str(i) for i in range(4000)] + ["".join(rng.choice("rockadisumx") for _ in range(rng.randint(2, 6))) for _ in range(6000)]
    rng.shuffle(words)
    got = _found(spark, names, words)
    assert {r.playlist_id: r.word for r in got.collect()} == _brute(names, words)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_short_repeated_and_empty_keywords(spark):
    names = _names(60, 3) + ["", "k"]
    for words in (["日本", "é", "rock", "rock", "a"], ["zzz", "k"], ["mix", ""], [], ["x" * 29, "ad"]):
        got = _found(spark, names, words)
        assert {r.playlist_id: (r.word, r.priority) for r in got.collect()} == {
            n: (w, words.index(w) + 1) for n, w in _brute(names, words).items()}, words


def test_tags_take_the_earliest_keyword_over_all_playlists(spark):
    seqs = spark.createDataFrame([("1-click", ["a", "b"]), ("2-error", ["b", "c"]), ("3-none", ["d"])],
                                 "playlist_id string, track_sequence array<string>")
    tracks = spark.createDataFrame([("a",), ("b",), ("d",), ("z",)], "track_id string")
    got = profile.tag_categories(tracks, seqs, ["error", "click"]).collect()
    assert {r.track_id: r.category for r in got} == {"a": "click", "b": "error", "d": "unknown", "z": "unknown"}
