"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

1. One pass over the texts gives each document its shingle count, a 128-bit hash of its
   shingle set and the band keys of its sketch. Documents with equal sets are one class;
   only class representatives (smallest hash of id and text) go on.
2. Representatives that share a band key are candidates. Rounds of few pairs come first:
   each representative is checked against the bucket minimum it shares most bands with,
   then against up to ``partners`` others picked by hash, and the links found join
   components. In between, representatives that cannot reach the similarity with any
   bucket neighbour are set aside, judged by the shingles that occur in no other candidate.
   Then, in buckets that still hold several components, every pair across components whose
   shingle numbers per hash block leave the similarity possible is checked, with the
   bucket's largest component on one side only. So large groups of copies
   never meet in pairs, and no candidate pair that could join two components goes unchecked.
3. Checks compare the full shingle sets, 100 * intersection >= percent * union, and
   components of the links give the result.

With 40 bands of 6 coordinates, a pair at similarity 0.8 shares no band with probability
(1 - 0.8**6)**40 = 5e-6, and less above.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quiver.llm.common import (NULL_KEY, bit_filter, bounded_batches, column, drop_keys, id_text, maybe_in, pin,
                               shingle_sets, text_key, text_steps, word_hashes)
from quiver.llm.components import components
from quiver.llm.sketch import band_keys, similarity_sketches

BLOCKS = 64  # hash blocks of a set's profile
_BLOCK_SHIFT = 58


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, bands: int = 40, rows: int = 6,
                    partners: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept, first.

    Words are ``[^\\x20\\x09-\\x0D]+`` after folding A-Z; a text of fewer than ``words``
    words is one shingle; a null, empty or blank text has none and is linked with nothing.
    component_id is the smallest id reachable over links (null ids sort last); kept means that
    it is the row's own id (both null: yes). first means that no row of the component has a
    smaller id, or of equal ids, null or not, a smaller xxhash64 of its text: rows that share
    an id are told apart by their texts there, and rows that repeat id and text are one node.
    An empty table gives an empty result. Other columns are ignored.
    """
    found = _near_duplicates(docs, words, percent, bands, rows, partners, id_col, text_col)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
                        F.col("kept").alias("first"))


def _near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, bands: int = 40, rows: int = 6,
                     partners: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """near_duplicates with each row's text_key as ``key``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = id_text(docs, id_col, text_col)
    keyed = texts.select(text_key(F.col("doc_id"), F.col("text")).alias("node"),
                         F.coalesce("doc_id", F.lit(NULL_KEY)).alias("id"), F.xxhash64("text").alias("tag"), "text")

    def sketch(batches):
        import xxhash

        for step in text_steps(batches):
            flat, offsets = shingle_sets(*word_hashes(column(step, "text"), lower=True), words)
            keys = band_keys(similarity_sketches(flat, offsets, bands * rows), bands)
            cuts = zip(offsets[:-1].tolist(), offsets[1:].tolist())
            yield pa.RecordBatch.from_pydict({
                "node": column(step, "node"), "id": column(step, "id"), "tag": column(step, "tag"), "n_shingles": pa.array(np.diff(offsets)),
                "set_hash": pa.array([xxhash.xxh3_128_digest(flat[a:b].tobytes()) for a, b in cuts], pa.binary()),
                "bands": pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, bands), pa.int32()),
                                                  pa.array(keys.reshape(-1)))})

    sketched = pin(keyed.mapInArrow(sketch, "node long, id long, tag long, n_shingles long, set_hash binary, bands array<long>"),
                   "sketches")
    classes = pin(sketched.where("n_shingles > 0").groupBy("set_hash")
                  .agg(F.min("node").alias("rep"), F.min(F.struct("id", "tag")).alias("first"), F.any_value("n_shingles").alias("n"),
                       F.any_value("bands").alias("bands")), "shingle-classes")

    members = _shared_buckets(classes)
    sets = _sets(keyed, members.select("rep").distinct(), words)
    hubs = members.where("rep != hub").groupBy("rep", "hub").agg(F.count(F.lit(1)).alias("shared"))
    first = (hubs.groupBy("rep").agg(F.max(F.struct("shared", (-F.col("hub")).alias("low"))).alias("best"))
             .select(F.col("rep").alias("a"), (-F.col("best.low")).alias("b")))
    links = pin(_verified(sets, first, percent), "links-first")
    groups = components(links)
    open_rows = _within_reach(_mixed(members, groups), sets, percent)
    more = pin(_verified(sets, _partners(open_rows, partners), percent), "links-second")
    groups = components(_hung(groups).unionByName(more))
    more = pin(_verified(sets, _across(_mixed(open_rows.drop("comp", "major"), groups), percent), percent),
               "links-third")

    # classes hang on their representative; components join representatives
    joined = components(_hung(groups).unionByName(more))
    hung = pin(classes.select("set_hash", "rep", "first").join(joined, F.col("rep") == F.col("node"), "left").select(
        "set_hash", "first", "component"), "class-components")
    named = hung.where("component is not null").groupBy("component").agg(F.min("first").alias("least"))
    hung = hung.join(named, "component", "left").select("set_hash", F.coalesce("least", "first").alias("least"))
    # rows without shingles get a key of their own, so that they do not meet in one partition
    own = F.when(F.col("n_shingles") > 0, F.col("set_hash")).otherwise(F.col("node").cast("string").cast("binary"))
    linked = sketched.select(F.col("node").alias("key"), "id", "tag", "n_shingles", own.alias("set_hash")).join(
        pin(hung, "class-least"), "set_hash", "left")
    itself = F.struct("id", "tag")
    least = F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(itself)
    real = lambda c: F.when(c != NULL_KEY, c)
    return linked.select(real(F.col("id")).alias("doc_id"), "n_shingles", real(least["id"]).alias("component_id"),
                         (itself == least).alias("kept"), "key")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with all its columns and one document (the smallest id, of equal ids the
    smallest xxhash64 of the text) of each component."""
    found = _near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    return drop_keys(docs, id_col, text_col, found.where("not kept").select(F.col("key").alias("doc_id")))


def _shared_buckets(classes: DataFrame) -> DataFrame:
    """(key, rep, n, hub) of every representative in a bucket of two or more; hub is the
    bucket's smallest representative."""
    rows = classes.select("rep", "n", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.min("rep").alias("hub"), F.max("rep").alias("top")).where("hub != top")
    return pin(rows.join(shared.select("key", "hub"), "key"), "shared-buckets")


def _hung(groups: DataFrame) -> DataFrame:
    return groups.select(F.col("node").alias("a"), F.col("component").alias("b"))


def _mixed(members: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of ``members`` in buckets of several components, with comp and the
    bucket's largest component, major."""
    labelled = pin(members.join(groups, F.col("rep") == F.col("node"), "left").drop("node")
                   .withColumn("comp", F.coalesce("component", "rep")).drop("component"), "labelled-buckets")
    sizes = labelled.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("size"))
    mixed = pin(sizes.groupBy("key").agg(F.max(F.struct("size", "comp")).alias("top"), F.count(F.lit(1)).alias("comps"))
                .where("comps > 1").select("key", F.col("top.comp").alias("major")), "mixed-buckets")
    return pin(labelled.join(mixed, "key"), "mixed-members")


def _within_reach(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``rows`` with profile, a representative's numbers of shingles per hash block that
    occur in another candidate too, and their sum, most; without those that even ``most``
    equal shingles cannot bring to the similarity with the smallest set of the bucket."""
    nodes = rows.select(F.col("rep").alias("node")).distinct()
    own = sets.join(nodes, "node", "left_semi")

    def spread(batches):
        for batch in batches:
            raw = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column("shingles")]
            sizes = [len(x) for x in raw]
            yield pa.RecordBatch.from_pydict({
                "node": pa.array(np.repeat(batch.column("node").to_numpy(), sizes)),
                "shingle": pa.array(np.concatenate(raw) if raw else np.zeros(0, np.int64))})

    def subtract(batches):
        for batch in batches:
            out = []
            for profile, alone in zip(batch.column("profile"), batch.column("alone")):
                left = profile.values.to_numpy().copy()
                if alone.is_valid:
                    left -= np.bincount(alone.values.to_numpy(), minlength=BLOCKS).astype(np.int32)
                out.append(left)
            yield pa.RecordBatch.from_pydict({
                "rep": batch.column("node"), "most": pa.array([int(x.sum()) for x in out], pa.int64()),
                "profile": pa.array(out, pa.list_(pa.int32()))})

    alone = (own.select("node", "shingles").mapInArrow(spread, "node long, shingle long").groupBy("shingle")
             .agg(F.min("node").alias("node"), F.max("node").alias("other")).where("node = other")
             .groupBy("node").agg(F.collect_list(F.shiftrightunsigned("shingle", _BLOCK_SHIFT).cast("int")).alias("alone")))
    shared = (own.select("node", "profile").join(alone, "node", "left")
              .mapInArrow(subtract, "rep long, most long, profile array<int>"))
    least = rows.groupBy("key").agg(F.min("n").alias("least"))
    known = rows.join(pin(shared, "profiles"), "rep").join(least, "key")
    return pin(known.where((100 + percent) * F.col("most") >= percent * (F.col("n") + F.col("least"))).drop("least"),
               "open-members")


def _partners(rows: DataFrame, count: int) -> DataFrame:
    """For each representative up to ``count`` pairs with representatives of other
    components: of each bucket the one first by hash, those sharing most buckets first."""
    picked = rows.groupBy("key").agg(F.min(F.struct(F.xxhash64("rep").alias("h"), "rep", "comp")).alias("pick"))
    pairs = (rows.join(picked, "key").where("comp != pick.comp")
             .groupBy("rep", F.col("pick.rep").alias("other")).agg(F.count(F.lit(1)).alias("shared")))
    # a representative has at most one pick per band
    order = Window.partitionBy("rep").orderBy(F.desc("shared"), "other")
    return (pairs.withColumn("place", F.row_number().over(order)).where(F.col("place") <= count)
            .select(F.greatest("rep", "other").alias("a"), F.least("rep", "other").alias("b")).distinct())


def _across(rest: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of representatives of different components that share a bucket;
    each pair is formed once, in the first of the buckets they share."""
    keys = rest.groupBy("rep").agg(F.collect_set("key").alias("keys"))  # at most one per band
    rest = rest.join(keys, "rep")
    minor = rest.where("comp != major").select("key", F.col("rep").alias("a"), F.col("n").alias("n_a"),
                                               F.col("comp").alias("comp_a"), F.col("most").alias("most_a"),
                                               F.col("keys").alias("keys_a"), F.col("profile").alias("profile_a"))
    reach = (100 + percent) * F.least("most", "most_a") >= percent * (F.col("n") + F.col("n_a"))
    # no block can share more shingles than either side has there
    equal = F.aggregate(F.zip_with("profile", "profile_a", lambda x, y: F.least(x, y)), F.lit(0), lambda total, x: total + x)
    close = (100 + percent) * equal >= percent * (F.col("n") + F.col("n_a"))
    pairs = rest.join(minor, "key").where((F.col("comp") != F.col("comp_a")) & reach &
                                          ((F.col("comp") == F.col("major")) | (F.col("rep") < F.col("a"))) &
                                          (100 * F.least("n", "n_a") >= percent * F.greatest("n", "n_a")) &
                                          close & (F.array_min(F.array_intersect("keys", "keys_a")) == F.col("key")))
    return pairs.select(F.greatest("a", "rep").alias("a"), F.least("a", "rep").alias("b")).distinct()


def _sets(keyed: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, shingles, profile) of the wanted nodes (column rep), found in the scan by a bit
    filter; profile is the number of shingles per hash block."""
    wanted = pin(wanted, "candidates")
    near = keyed.where(maybe_in(bit_filter(F.col("rep"), wanted), F.col("node")))

    def sets(batches):
        for step in text_steps(batches):
            flat, offsets = shingle_sets(*word_hashes(column(step, "text"), lower=True), words)
            cuts = list(zip(offsets[:-1].tolist(), offsets[1:].tolist()))
            yield pa.RecordBatch.from_pydict({
                "node": column(step, "node"),
                "shingles": pa.array([flat[a:b].tobytes() for a, b in cuts], pa.binary()),
                "profile": pa.array([np.bincount((flat[a:b] >> np.uint64(_BLOCK_SHIFT)).astype(np.int64), minlength=BLOCKS)
                                     .astype(np.int32) for a, b in cuts], pa.list_(pa.int32()))})

    # an exact copy has its representative's id only if rows repeat an id
    return pin(near.mapInArrow(sets, "node long, shingles binary, profile array<int>").join(wanted, F.col("node") == F.col("rep"),
                                                                        "left_semi"), "shingle-sets")


def _verified(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the similarity."""
    pairs = pin(pairs, "candidate-pairs")

    def check(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if not len(x) or not len(y) or 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    good.append(False)
                    continue
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    bounded_batches(sets.sparkSession, 100)
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
    return (left.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
            .select("a", "b", "x", "y").mapInArrow(check, "a long, b long"))
