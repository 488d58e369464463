"""Traps of the playlist sequence operators (NULL handling, order, lengths)."""

from quiver.operators import sequences


def test_concat_skips_null_parts(spark):
    raw = spark.createDataFrame([(0, "u1", None, "t1", "p")], "row_id long, user_id string, artist string, "
                                "track string, playlist string")
    r = sequences.add_playlist_ids(raw).collect()[0]
    assert r.playlist_id == "u1-p"
    assert r.track_id == "|||t1"  # NULL artist skipped, not a NULL key


def test_ordered_lists_keep_nulls_and_row_order(spark):
    df = spark.createDataFrame([("p", 3, None, "c"), ("p", 1, "x", "a"), ("p", 2, "y", "b"), ("q", 1, "z", "d")],
                               "playlist_id string, row_id int, artist string, track_id string")
    out = {r.playlist_id: r for r in sequences.ordered_lists(df, "playlist_id", "row_id",
                                                            ["artist", "track_id"]).collect()}
    assert out["p"].artist_list == ["x", "y", None]
    assert out["p"].track_id_list == ["a", "b", "c"]


def test_playlist_sequences_length_filter_and_leave_last_out(spark):
    rows = [("p", i, "a", f"t{i}") for i in range(1, 4)] + [("q", i, "a", f"s{i}") for i in range(1, 3)]
    df = spark.createDataFrame(rows, "playlist_id string, row_id int, artist string, track_id string")
    out = sequences.playlist_sequences(df).collect()
    assert [r.playlist_id for r in out] == ["p"]  # length 2 is dropped (HAVING len > 2)
    assert out[0].track_test_x == ["t1", "t2"] and out[0].track_test_y == "t3"


def test_ordered_chunks_concatenate_to_ordered_lists(spark):
    rows = [("hot", i, f"t{i}") for i in range(500)] + [("cold", i, f"c{i}") for i in range(3)]
    df = spark.createDataFrame(rows, "k string, row_id int, v string")
    chunks = sequences.ordered_chunks(df, "k", "row_id", ["v"], chunk_size=64).collect()
    joined = {}
    for r in sorted(chunks, key=lambda r: (r.k, r.chunk)):
        joined.setdefault(r.k, []).extend(r.v_list)
    assert joined["hot"] == [f"t{i}" for i in range(500)]
    assert joined["cold"] == ["c0", "c1", "c2"]
    assert max(len(r.v_list) for r in chunks) <= 64


def _hot_rows(n=3000):
    """A third of all rows in one playlist, the others in playlists of one to nine rows."""
    rows = [("hot", i, f"t{i % 7}") for i in range(n // 3)]
    k = 0
    while len(rows) < n:
        rows += [(f"p{k}", i, f"t{(i + k) % 7}") for i in range(1 + k % 9)]
        k += 1
    return rows


def test_last_pairs_of_a_hot_playlist(spark):
    rows = _hot_rows() + [(None, 1, "a"), (None, 2, "b"), (None, 3, None)]
    df = spark.createDataFrame(rows, "k string, row_id int, v string").repartition(5)
    lists = {}
    for k, i, v in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        lists.setdefault(k, []).append(v)
    pairs = sequences.last_pairs(df, "k", "row_id", "v")
    assert {r.k: (r.x_last, r.y) for r in pairs.collect()} == {k: (v[-2], v[-1]) for k, v in lists.items() if len(v) > 2}
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan  # a few rows per key leave a task
    assert "collect_list" not in plan


def test_chunks_and_transitions_of_a_hot_playlist(spark):
    from collections import Counter

    rows = _hot_rows()
    df = spark.createDataFrame(rows, "k string, row_id int, v string").repartition(5)
    chunks = sequences.ordered_chunks(df, "k", "row_id", ["v"], chunk_size=50).collect()
    assert max(len(r.v_list) for r in chunks) == 50 and sum(r.k == "hot" for r in chunks) == 20
    want = Counter()
    lists = {}
    for k, _, v in sorted(rows):
        lists.setdefault(k, []).append(v)
    for v in lists.values():
        want.update(zip(v, v[1:]))
    for size in (1, 7, 50, 100_000):
        got = sequences.next_pairs(df, "k", "row_id", "v", size).collect()
        assert {(r.item, r.next_item): r.n for r in got} == dict(want), size
    assert sequences.next_pairs(df.where("k = 'none'"), "k", "row_id", "v").collect() == []
