"""P1 playlist plans: ids, sequences, profiles, splits, samples, tagging."""

from __future__ import annotations


from quiver.functions.common import arr_text
from quiver.operators import profile, sampling, sequences
from quiver.plans.registry import plan
from quiver.plans.sqlparts import PLAYLISTS, SEQUENCES, with_
from quiver.sources.tables import raw_playlists


def _playlists(spark, sf):
    return sequences.add_playlist_ids(raw_playlists(spark, sf))


def _sequences(spark, sf):
    return sequences.playlist_sequences(_playlists(spark, sf))


def _pairs(spark, sf):
    """(playlist_id, x_last, track_test_y) of the playlists with more than two rows."""
    return sequences.last_pairs(_playlists(spark, sf), "playlist_id", "row_id", "track_id").withColumnRenamed("y", "track_test_y")


@plan("playlist_ids", with_(PLAYLISTS) + " SELECT * FROM playlists")
def q_playlist_ids(spark, sf):
    """All columns plus playlist_id and track_id."""
    return _playlists(spark, sf)


@plan("playlist_sequences", with_(SEQUENCES) + """
SELECT playlist_id, array_to_string(artist_sequence, '>') AS artist_sequence,
       array_to_string(track_sequence, '>') AS track_sequence,
       array_to_string(array_pop_back(track_sequence), '>') AS track_test_x,
       track_sequence[-1] AS track_test_y
FROM seqs""")
def q_playlist_sequences(spark, sf):
    """Ordered lists per playlist, len > 2, leave-last-out pair."""
    s = _sequences(spark, sf)
    return s.select("playlist_id", arr_text("artist_sequence").alias("artist_sequence"),
                    arr_text("track_sequence").alias("track_sequence"),
                    arr_text("track_test_x").alias("track_test_x"), "track_test_y")


@plan("last_pairs", with_(SEQUENCES) + """
SELECT playlist_id, track_sequence[-2] AS x_last, track_sequence[-1] AS track_test_y FROM seqs""")
def q_last_pairs(spark, sf):
    """The last input track and the held-out track of every playlist, without its list."""
    return _pairs(spark, sf)


CHUNK = 1000


@plan("playlist_chunks", with_(PLAYLISTS) + f""",
placed AS (SELECT *, row_number() OVER (PARTITION BY playlist_id ORDER BY row_id) - 1 AS pos FROM playlists)
SELECT playlist_id, pos // {CHUNK} AS chunk, string_agg(artist, '>' ORDER BY pos) AS artists,
       string_agg(track_id, '>' ORDER BY pos) AS tracks
FROM placed GROUP BY playlist_id, pos // {CHUNK}""")
def q_playlist_chunks(spark, sf):
    """Every playlist's ordered list in chunks of at most 1,000 rows."""
    c = sequences.ordered_chunks(_playlists(spark, sf), "playlist_id", "row_id", ["artist", "track_id"], CHUNK)
    return c.select("playlist_id", "chunk", arr_text("artist_list").alias("artists"), arr_text("track_id_list").alias("tracks"))


@plan("next_pairs", with_(PLAYLISTS) + """,
n AS (SELECT track_id AS item, lead(track_id) OVER (PARTITION BY playlist_id ORDER BY row_id) AS next_item,
             lead(row_id) OVER (PARTITION BY playlist_id ORDER BY row_id) AS more FROM playlists)
SELECT item, next_item, COUNT(*) AS n FROM n WHERE more IS NOT NULL GROUP BY item, next_item""")
def q_next_pairs(spark, sf):
    """How often a track follows another in a playlist, counted over chunk rows."""
    return sequences.next_pairs(_playlists(spark, sf), "playlist_id", "row_id", "track_id", CHUNK)


@plan("distinct_counts", with_(PLAYLISTS) + """
SELECT COUNT(DISTINCT row_id) AS n_row_id, COUNT(DISTINCT user_id) AS n_user_id,
       COUNT(DISTINCT track_id) AS n_track_id, COUNT(DISTINCT playlist_id) AS n_playlist_id,
       COUNT(DISTINCT artist) AS n_artist FROM playlists""")
def q_distinct_counts(spark, sf):
    """Exact distinct counts of five columns in one job."""
    return profile.distinct_counts(_playlists(spark, sf),
                                   ["row_id", "user_id", "track_id", "playlist_id", "artist"])


@plan("profile_counts", with_(PLAYLISTS) + """
SELECT COUNT(*) AS n_rows, min(row_id) AS first_row_id,
       arg_min(playlist_id, row_id) AS first_playlist_id,
       arg_min(track_id, row_id) AS first_track_id FROM playlists""")
def q_profile_counts(spark, sf):
    """Row count and the first row (by row id) in one aggregate."""
    return profile.peek(_playlists(spark, sf), "row_id", ["playlist_id", "track_id"])


@plan("head_rows", with_(PLAYLISTS) + " SELECT * FROM playlists ORDER BY row_id LIMIT 5")
def q_head_rows(spark, sf):
    """The first five rows by row id."""
    return profile.head(_playlists(spark, sf), ["row_id"], 5)


@plan("table_shape", "SELECT COUNT(*) AS n_rows, 4 + 3 AS n_columns FROM events")
def q_table_shape(spark, sf):
    """Number of rows and columns of the playlist table."""
    return profile.shape(_playlists(spark, sf))


@plan("column_types", with_(PLAYLISTS) + " " + " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column_name, CASE lower(any_value(typeof({c}))) WHEN 'varchar' THEN 'string' "
    f"ELSE lower(any_value(typeof({c}))) END AS dtype, count({c}) AS n_values FROM playlists"
    for i, c in enumerate(["row_id", "user_id", "artist", "track", "playlist", "playlist_id", "track_id"])))
def q_column_types(spark, sf):
    """Every column's type and number of values."""
    return profile.column_types(_playlists(spark, sf))


@plan("top_artists", with_(PLAYLISTS) + """
SELECT artist, COUNT(*) AS n FROM playlists GROUP BY artist ORDER BY n DESC, artist LIMIT 20""")
def q_top_artists(spark, sf):
    """20 most common artists (ties by name)."""
    return profile.most_common(_playlists(spark, sf), "artist", 20)


@plan("top_tracks", with_(SEQUENCES) + """,
items AS (SELECT unnest(track_sequence) AS track_id FROM seqs)
SELECT track_id, COUNT(*) AS n FROM items GROUP BY track_id ORDER BY n DESC, track_id LIMIT 250""")
def q_top_tracks(spark, sf):
    """D06+U04: 250 most common tracks over the flattened sequences."""
    items = sequences.flatten_items(_sequences(spark, sf), "track_sequence", "track_id")
    return profile.most_common(items, "track_id", 250)


@plan("playlist_names", with_(PLAYLISTS) + """
SELECT DISTINCT lower(trim(string_split(playlist_id, '-')[2])) AS playlist_name FROM playlists""")
def q_playlist_names(spark, sf):
    """Distinct ``split('-')[1].lower().strip()`` of playlist ids."""
    return profile.playlist_names(_playlists(spark, sf))


@plan("split_70_20_10", with_(SEQUENCES) + """,
r AS (SELECT playlist_id, row_number() OVER (ORDER BY md5(playlist_id || '42'), playlist_id) AS rank,
             COUNT(*) OVER () AS n FROM seqs)
SELECT playlist_id, rank,
       CASE WHEN rank <= floor(0.7::DOUBLE * n) THEN 'train'
            WHEN rank <= floor(0.9::DOUBLE * n) THEN 'validate' ELSE 'test' END AS split
FROM r""")
def q_split(spark, sf):
    """Seeded shuffle + positional 70/20/10 cut of the sequence table."""
    s = sampling.positional_split(_sequences(spark, sf), "playlist_id", (0.7, 0.9), seed=42)
    return s.select("playlist_id", "rank", "split")


@plan("hash_sample", with_(SEQUENCES) + """
SELECT playlist_id FROM seqs
WHERE ('0x' || substr(md5(playlist_id || '42'), 1, 8))::BIGINT < 429496729""")
def q_hash_sample(spark, sf):
    """P01 (testable twin): deterministic 10 % sample of the sequence table by md5."""
    return sampling.hash_sample(_sequences(spark, sf), "playlist_id", 10, seed=42).select("playlist_id")


@plan("bernoulli_sample")
def q_bernoulli_sample(spark, sf):
    """Bernoulli 10 % sample of the sequence table (random; rows-only check)."""
    return sampling.bernoulli_sample(_sequences(spark, sf), 10, seed=42).select("playlist_id")


TAG_WORDS = ["error", "click"]


@plan("tag_categories", with_(SEQUENCES) + """,
items AS (SELECT unnest(track_sequence) AS track_id FROM seqs),
top AS (SELECT track_id FROM items GROUP BY track_id ORDER BY COUNT(*) DESC, track_id LIMIT 250),
words AS (SELECT * FROM (VALUES ('error', 1), ('click', 2)) t(word, priority)),
hits AS (
  SELECT t.track_id, min(w.priority) AS p
  FROM seqs s JOIN words w ON contains(s.playlist_id, w.word)
  CROSS JOIN unnest(s.track_sequence) AS t(track_id)
  GROUP BY t.track_id)
SELECT top.track_id, COALESCE(w.word, 'unknown') AS category
FROM top LEFT JOIN hits h ON top.track_id = h.track_id LEFT JOIN words w ON w.priority = h.p""")
def q_tag_categories(spark, sf):
    """Top-250 tracks tagged with the first keyword whose playlists contain them."""
    seqs = _sequences(spark, sf)
    items = sequences.flatten_items(seqs, "track_sequence", "track_id")
    top = profile.most_common(items, "track_id", 250).select("track_id")
    return profile.tag_categories(top, seqs, TAG_WORDS)
