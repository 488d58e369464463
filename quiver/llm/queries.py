"""Registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quiver.llm.common import read_table

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return register


#: Words with A-Z folded; distinct 5-word shingles of items that occur in the document.
OP1_SQL = r"""
WITH a AS (
  SELECT 0 AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
w AS (
  SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM a),
s AS (
  SELECT DISTINCT kind, id, array_to_string(w[i:i+4], ' ') AS g
  FROM (SELECT kind, id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
n AS (SELECT id, count(*) AS n FROM s WHERE kind = 1 GROUP BY id)
SELECT d.id AS doc_id, t.id AS item_id, n.n AS item_shingles, count(*) AS shared, count(*) / n.n AS containment
FROM s d JOIN s t ON d.g = t.g AND d.kind = 0 AND t.kind = 1 JOIN n ON n.id = t.id
GROUP BY d.id, t.id, n.n HAVING 100 * count(*) >= 80 * n.n
"""


@query("op1_decontaminate", OP1_SQL)
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold 80 % or more of a benchmark item's 5-word shingles."""
    from quiver.llm.decontaminate import contaminated

    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP2_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS cp,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents),
g AS (SELECT norm, count(*) AS group_size, arg_min(doc_id, (-cp, doc_id)) AS keep_id FROM n GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM n JOIN g USING (norm)
"""


@query("op2_exact_dedup", OP2_SQL)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact dedup of all documents with the digest of every text."""
    from quiver.llm.exact_dedup import exact_dedup

    return exact_dedup(read_table(spark, sf_dir, "documents"), digest_all=True)


@query("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum-of-squares packing of all documents into sequences of at most 1024 ids."""
    from quiver.llm.packing import pack

    return pack(read_table(spark, sf_dir, "documents"), size=1024, end_id=0)


@query("op8_token_files")
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as Huffman-coded token files in id order and read back."""
    from quiver.llm.huffman import read_token_files, write_token_files

    return read_token_files(spark, write_token_files(read_table(spark, sf_dir, "documents"), end_id=2))


#: Words of the texts with A-Z folded, and distinct 4-word shingles; links over all pairs that share one.
OP5_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i+3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT d.doc_id, count(g) AS n FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id),
l AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b USING (g) JOIN n p ON p.doc_id = a.doc_id
  JOIN n q ON q.doc_id = b.doc_id WHERE a.doc_id <> b.doc_id
  GROUP BY x, y, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))),
r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y)
SELECT r.x AS doc_id, n.n AS n_shingles, min(r.y) AS component_id, r.x = min(r.y) AS kept
FROM r JOIN n ON n.doc_id = r.x GROUP BY r.x, n.n
""".replace("\\\\", "\\")


@query("op5_near_dedup", OP5_SQL)
def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents at 4-word shingle similarity of 80 % or more."""
    from quiver.llm.near_dedup import near_duplicates

    return near_duplicates(read_table(spark, sf_dir, "documents"), words=4, percent=80).drop("first")


OP10_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, len(w) AS n_words, unnest(range(1, len(w) - 18)) AS i, w FROM d WHERE len(w) >= 20),
h AS (SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(w[i:i+19], ' ') ORDER BY doc_id, i) AS k FROM p),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM h WHERE k > 1),
x AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
k AS (
  SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.i) FILTER (g.i IS NULL) AS kept, count(g.i) AS n_removed,
         count(*) AS n_words
  FROM x LEFT JOIN g ON g.doc_id = x.doc_id AND g.i = x.i GROUP BY x.doc_id)
SELECT d.doc_id, coalesce(k.n_words, 0) AS n_words, coalesce(k.n_removed, 0) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


@query("op10_substring_dedup", OP10_SQL)
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the words of 20-word windows that also start earlier."""
    from pyspark.sql import functions as F

    from quiver.llm.substring_dedup import remove_repeats

    found = remove_repeats(read_table(spark, sf_dir, "documents"), window=20)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learned from the labels outside the held-out fold."""
    from quiver.llm.quality import quality_scores

    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), cut=0.3,
                          folds=5).drop("tag")


OP7_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
  FROM pages),
b AS (
  SELECT h, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((('0x' || substr(h, 1 + 5 * (k // 4), 5))::BIGINT >> (15 - 5 * (k % 4))) % 32)::INT, 1), '' ORDER BY k) AS digest
  FROM (SELECT DISTINCT h FROM p), range(32) r(k) GROUP BY h)
SELECT page_id, octet_length(encode(html)) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN b USING (h)
"""


@query("op7_warc", OP7_SQL)
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as monolithic WARC files, normalised and read back by their index."""
    from quiver.llm.warc import normalise, read_records, write_monolithic

    whole = write_monolithic(read_table(spark, sf_dir, "pages"), min_revisit_bytes=0)
    return read_records(*normalise(spark, whole))


# ---------------------------------------------------------------- chat transcripts

#: How a stand-in transcript names the speakers, by style (fixed values).
_STYLES = (("System: ", "User: ", "Assistant: "), ("[system] ", "[human] ", "[ai] "),
           ("### Instructions:\n", "### Human:\n", "### Assistant:\n"), ("Context> ", "Q> ", "A> "))
_SPAN = 512  # lines of a chunk


def transcript_lines(conversations: DataFrame) -> DataFrame:
    """Stand-in transcripts from a turn table: (conv_id, pos, line, state). Every
    conversation has a marker style; one turn in five comes without its marker; half of
    the styles put a blank line between turns. ``state`` is the line's true state. ``pos``
    numbers a conversation's lines from 0: turns in order, null turns last, turns that
    repeat a number by a hash of role and text; rows of a null conv_id are one conversation."""
    from pyspark.sql import functions as F

    from quiver.llm.chat_format import ROLES, starts_of

    c = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                             F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(_STYLES))).cast("int")
    known = F.array_position(F.array(*[F.lit(r) for r in ROLES]), F.col("role")).cast("int")
    known = F.when(known > 0, known - 1).otherwise(1)
    table = F.array(*[F.array(*[F.lit(m) for m in marks]) for marks in _STYLES])
    marker = F.when(F.pmod(F.xxhash64("conv_id", "turn"), F.lit(5)) == 0, "").otherwise(F.get(F.get(table, style), known))
    gap = F.when(style % 2 == 1, "\n").otherwise("")
    lines = F.split(F.concat(marker, F.col("text"), gap), "\n", -1)
    placed = starts_of(c.select("conv_id", "turn", F.xxhash64("role", "text").alias("tie"), known.alias("known"),
                                lines.alias("lines")), "conv_id", ["turn", "tie"], F.size("lines"))
    told = placed.select("conv_id", "start", "known", F.posexplode("lines").alias("k", "line"))
    kind = F.when(F.col("k") == 0, 0).when(F.length(F.trim("line")) == 0, 2).otherwise(1)
    return told.select("conv_id", (F.col("start") + F.col("k")).alias("pos"), "line",
                       (F.col("known") * 3 + kind).cast("int").alias("state"))


@query("op4_chat_format")
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns recovered from all transcripts by the hidden Markov model, rendered. The model
    is counted over the transcripts whose crc32(conv_id as text) mod 5 is not 0."""
    from pyspark.sql import functions as F

    from quiver.llm.chat_format import fit, parse_transcripts
    from quiver.llm.common import pin

    lines = pin(transcript_lines(read_table(spark, sf_dir, "conversations")), "transcripts")
    fold = F.crc32(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).cast("binary")) % 5
    return parse_transcripts(lines.drop("state"), fit(lines.where(fold != 0), _SPAN), _SPAN)


@query("op6_lm_scoring")
def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attention-model and word-unigram scores of all documents."""
    from quiver.llm.lm_scoring import lm_scores

    return lm_scores(read_table(spark, sf_dir, "documents"), folds=10)


#: Words of the pieces with A-Z folded; every phrase of one to four words with its count.
OP11_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
t AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, k, array_to_string(w[i:i+k-1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, k, w, unnest(range(1, (len(w) - k + 2)::BIGINT)) AS i FROM w, range(1, 5) r(k) WHERE len(w) >= k)
  GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM g WHERE k > 1),
s AS (
  SELECT c.lang, c.phrase, c.a, j, x.f AS l, y.f AS r, ((2000000::HUGEINT * c.a) // (x.f + y.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
  JOIN g x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:j], ' ')
  JOIN g y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[j+1:c.k], ' ')),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS first FROM s),
o AS (
  SELECT lang, array_to_string(w[i:i+m-1], ' ') AS phrase, max(a) AS most
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c WHERE k > 2)) GROUP BY ALL),
z AS (
  SELECT b.lang, b.phrase, b.a, b.l, b.r, b.score,
         row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, encode(b.phrase)) AS rank
  FROM b LEFT JOIN o ON o.lang = b.lang AND o.phrase = b.phrase
  WHERE first = 1 AND 100 * coalesce(o.most, 0)::HUGEINT < 80 * b.a)
SELECT z.lang, z.rank, z.phrase, z.a, z.l, z.r, t.n, z.score FROM z JOIN t ON t.lang = z.lang WHERE z.rank <= 2000
"""


@query("op11_collocations", OP11_SQL)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of two to four words of every language."""
    from quiver.llm.collocations import collocations

    return collocations(read_table(spark, sf_dir, "documents"), least=30, top=2000, cover=80)


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on the first four whitened components."""
    from quiver.llm.whitening import whiten

    return whiten(read_table(spark, sf_dir, "embeddings"), components=4, scale=256)


@query("op13_toxicity")
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents, learned from the labels outside the held-out fold."""
    from quiver.llm.toxicity import toxicity_scores

    return toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), cut=0.3,
                           folds=4, held=2).drop("tag")
