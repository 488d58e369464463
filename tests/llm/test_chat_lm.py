"""Transcript parsing and language-model scores against brute force."""

import collections
import inspect
import itertools
import math
import random
import re
import zlib

import numpy as np

from pyspark.sql import functions as F

from quiver.llm import lm_scoring
from quiver.llm.attention_lm import AttentionModel
from quiver.llm.chat_format import N_SYMBOLS, S, START, STATES, Hmm, fit, parse_transcripts, symbol, viterbi
from quiver.llm.common import read_table
from quiver.llm.lm_scoring import Symbols, lm_scores
from quiver.llm.queries import transcript_lines
from quiver.llm.tokens import default_vocabulary


def random_hmm(seed=0):
    rng = np.random.default_rng(seed)
    return Hmm(rng.random((S + 1, S)) * 5, rng.random((S, N_SYMBOLS)) * 5)


def plain_path(hmm, symbols):
    score, back = hmm.step[START] + hmm.emit[:, symbols[0]], []
    for k in symbols[1:]:
        ways = score[:, None] + hmm.step[:S]
        back.append(ways.argmax(0))
        score = ways.max(0) + hmm.emit[:, k]
    path = [int(score.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def test_chunked_viterbi_is_exact(spark):
    rng = random.Random(4)
    hmm = random_hmm()
    convs = {c: [rng.randrange(N_SYMBOLS) for _ in range(n)] for c, n in ((1, 1), (2, 5), (3, 130), (None, 40), (5, 2500))}
    rows = [(c, p * 3, k) for c, ks in convs.items() for p, k in enumerate(ks)]
    lines = spark.createDataFrame(rows, "conv_id long, pos long, symbol int").repartition(3)
    got = collections.defaultdict(dict)
    for r in viterbi(lines, hmm, span=6).collect():  # two lines a chunk: up to three levels of products
        got[r.conv_id][r.pos // 3] = r.state
    for c, ks in convs.items():
        assert [got[c][p] for p in range(len(ks))] == plain_path(hmm, ks)


def test_plain_path_is_the_best_of_all():
    hmm, ks = random_hmm(3), [4, 0, 11]
    best = max(itertools.product(range(S), repeat=3), key=lambda s: hmm.step[START, s[0]] + hmm.step[s[0], s[1]]
               + hmm.step[s[1], s[2]] + sum(hmm.emit[a, k] for a, k in zip(s, ks)))
    assert list(best) == plain_path(hmm, ks)


def test_counts_of_the_model(spark):
    rows = [(1, 0, "User: hi", 3), (1, 1, "more", 4), (1, 2, "Bot: yes", 6), (1, 3, "", 8), (2, 0, "AI> x?", 6)]
    hmm = fit(spark.createDataFrame(rows, "conv_id long, pos long, line string, state int"), span=2)
    steps = np.exp(hmm.step)
    assert steps[START, 3] == steps[START, 6] and steps[START, 3] > 10 * steps[START, 0]
    assert steps[3, 4] > 0.5 and steps[4, 6] > 0.5 and steps[6, 8] > 0.5


def test_symbols_of_lines(spark):
    cases = {"": 0, "  ": 0, "User: hi": 1 + 2 * 2 * 3, "### Human:": 1 + 2 * 2 * 3, "[AI] ok?": 1 + (3 * 2 + 1) * 3,
             "plain": 1, "x" * 100: 2, "x" * 300: 3, "system> y": 1 + 2 * 3, "questions are": 1}
    df = spark.createDataFrame([(k,) for k in cases], "line string")
    assert {r.line: r.s for r in df.select("line", symbol(df.line).alias("s")).collect()} == cases


def test_roles_are_recovered(spark):
    conversations = read_table(spark, "/root/testdata/sf0.01", "conversations")
    lines = transcript_lines(conversations).cache()
    span = 64 << 20
    model = fit(lines.where("conv_id % 2 = 0"), span)
    turns = parse_transcripts(lines.drop("state").where("conv_id % 2 = 1"), model, span).collect()
    truth = {(r.conv_id, r.turn): r for r in conversations.where("conv_id % 2 = 1").collect()}
    same = [truth[k].role == r.role for r in turns if (k := (r.conv_id, r.turn)) in truth]
    assert np.mean(same) > 0.9 and abs(len(turns) - len(truth)) < 0.1 * len(truth)
    assert all(r.rendered == f"<|{r.role}|>\n{r.text}\n<|end|>\n" for r in turns)


def test_turns_across_chunks_and_edge_lines(spark):
    rows = [(1, 0, "User: one"), (1, 1, "two"), (1, 2, None), (1, 5, "Assistant: three"), (1, 9, "four"),
            (None, 0, "User: x"), (2, 0, "")]
    model = fit(spark.createDataFrame([(1, 0, "User: a", 3), (1, 1, "b", 4), (1, 2, "", 5), (1, 3, "Assistant: c", 6),
                                       (1, 4, "d", 7)], "conv_id long, pos long, line string, state int"), 100)
    lines = spark.createDataFrame([(*r, 7) for r in rows], "conv_id long, pos long, line string, turn int")
    for span in (1, 2, 1000):
        got = sorted(((r.conv_id or -1), r.turn, r.role, r.text) for r in parse_transcripts(lines, model, span).collect())
        assert [g for g in got if g[0] != 2] == [(-1, 0, "user", "x"), (1, 0, "user", "one\ntwo"),
                                                 (1, 1, "assistant", "three\nfour")]
    assert parse_transcripts(lines.where("pos > 99"), model, 10).count() == 0
    assert len(STATES) == S


def test_null_and_repeated_turns_lose_and_multiply_no_line(spark):
    rows = [(1, 0, "user", "one"), (1, None, "assistant", "two\nthree"), (1, 1, "user", "four"), (1, 1, "assistant", "five\nsix?"),
            (2, None, "user", "seven"), (2, None, "user", "eight")] + [(None, 0, "user", "same")] * 3 + [(None, None, None, None)]
    rows += [(3, k // 2, "user", f"n{k}") for k in range(300)]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(3)
    lines = transcript_lines(turns).cache()
    places = collections.defaultdict(list)
    for r in lines.collect():
        places[r.conv_id].append((r.pos, r.line))
    assert all(sorted(p for p, _ in x) == list(range(len(x))) for x in places.values())
    assert places.keys() == {1, 2, 3, None}
    words = lambda texts: collections.Counter(re.findall(r"\b(?:one|two|three|four|five|six|seven|eight|same|n\d+)\b", "\n".join(texts)))
    told = [line for _, line in sorted(places[1])]
    assert words(told[-4:]).keys() >= {"two", "three"}  # the null turn is last
    for span in (2, 512):
        model = fit(lines, span)
        got = parse_transcripts(lines.drop("state"), model, span).collect()
        assert words(r.text for r in got) == words(t or "" for *_, t in rows)


# ---------------------------------------------------------------- language model

def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    m = AttentionModel(50, 8, 2, 8, 4)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    ids, offsets = rng.integers(0, 50, 60), np.array([0, 1, 25, 60])
    x, _ = m.windows(ids, offsets)
    _, grads = m.gradients(x)
    for name, g in grads.items():
        at = np.unravel_index(np.abs(g if name != "w" else g[:-1]).argmax(), (g if name != "w" else g[:-1]).shape)
        old = m.p[name][at]
        m.p[name][at] = old + 1e-4
        a = m.gradients(x)[0]
        m.p[name][at] = old - 1e-4
        b = m.gradients(x)[0]
        m.p[name][at] = old
        assert abs((a - b) / 2e-4 - g[at]) < 1e-3 * max(1, abs(g[at])), name


def test_probabilities_sum_to_one_and_ignore_the_batch():
    m = AttentionModel(30, 8, 2, 8, 4, seed=2)
    ids, offsets = np.arange(30).repeat(3) % 30, np.array([0, 0, 7, 90])
    a, b = m.score(ids, offsets, 2), m.score(ids, offsets, 1000)
    assert np.allclose(a, b, atol=1e-5)
    x, _ = m.windows(ids[:1], np.array([0, 1]))
    z = m._quick_hidden(x, m._quick_tables())[:1]
    total = sum(math.exp(m.log_probabilities(z, np.array([k]))[0]) for k in range(30))
    assert abs(total - 1) < 1e-5


def test_score_matches_a_plain_loop_over_tokens():
    """Attention and both softmax levels written out per token, in plain Python floats."""
    rng = np.random.default_rng(7)
    m = AttentionModel(23, 8, 2, 6, 4, seed=3)
    for name in ("R", "b", "c"):
        m.p[name] = rng.standard_normal(m.p[name].shape).astype(np.float32)
    p = {k: v.astype(np.float64) for k, v in m.p.items()}
    ids, offsets = rng.integers(0, 23, 40), np.array([0, 0, 1, 18, 40])

    def plain(text, t):
        span, half = m.span, m.dim // m.heads
        back = [text[t - 1 - r] if t - 1 - r >= 0 else m.size for r in range(span)]  # the nearest first
        e = [p["E"][x] for x in back]
        seen = []
        for h in range(m.heads):
            cut = slice(h * half, (h + 1) * half)
            weights = [math.exp((e[0] @ p["Q"])[cut] @ (e[r] @ p["K"])[cut] / math.sqrt(half) + p["R"][h, r])
                       for r in range(span)]
            seen += list(sum(w * (x @ p["V"])[cut] for w, x in zip(weights, e)) / sum(weights))
        z = np.tanh(np.array(seen) @ p["O"] + e[0] @ p["D"] + p["b"])
        group, member = divmod(int(text[t]), m.per)
        share = lambda x, k: x[k] - math.log(sum(math.exp(y) for y in x))
        return share(z @ p["C"] + p["c"], group) + share(z @ p["W"][group] + p["w"][group], member)

    want = [plain(ids[a:b], t) for a, b in zip(offsets, offsets[1:]) for t in range(b - a)]
    assert np.allclose(m.score(ids, offsets, batch=3), want, atol=1e-4)


def test_rounds_grow_and_hold_every_text_once(spark):
    got = dict(spark.range(70_000).groupBy(lm_scoring.rounds_of(F.col("id"), 3).alias("r")).count().collect())
    assert sorted(got) == [0, 1, 2] and sum(got.values()) == 70_000
    assert all(abs(got[k] - 10_000 * 2 ** k) < 1_000 for k in got)


def test_copies_of_one_row_train_in_several_parts(docs_of, monkeypatch):
    seen = {}

    def fit(texts, symbols, *args, **shape):
        seen["parts"] = collections.Counter(r.part for r in texts.select("part").collect())
        return AttentionModel(symbols.size, **shape)

    monkeypatch.setattr(lm_scoring, "fit", fit)
    lm_scores(docs_of([(1, "the same words again and again")] * 600, 3), part_ids=1_500)
    assert sum(seen["parts"].values()) == 600 and max(seen["parts"].values()) < 300


def test_windows_score_each_token_once_with_context():
    m = AttentionModel(9, 8, 2, 8, 4)
    x, first = m.windows(np.arange(9), np.array([0, 0, 9]))
    assert x.tolist() == [[9] * 4 + [0, 1, 2, 3], list(range(8)), [4, 5, 6, 7, 8, -1, -1, -1]]
    assert first.tolist() == [0, 4, 8]


def test_symbols_spell_every_id():
    s = Symbols(np.array([464, 1169]), np.array([5, 9]), default_vocabulary(), most=300)
    assert s.size <= 300 + 256 + 1 and (s.lengths > 0).sum() >= 50000
    import pyarrow as pa

    symbols, at = s.of_words(pa.array(["the", "zzzz", "é日"]))
    assert len(at) == 4 and (np.diff(at) > 0).all() and symbols.max() < s.end


def brute_base(rows, folds=10):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = [(i, re.findall("[^\x20\x09-\x0d]+", (t or "").translate(fold))) for i, t in rows]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % folds == 0
    c, ends = collections.Counter(), 0
    for i, w in words:
        if not held(i):
            c.update(w)
            ends += 1
    n, v = sum(c.values()) + ends, len(c) + (ends > 0)
    log = lambda k: math.log10((k + 0.1) / (n + 0.1 * (v + 1)))
    return [(i, held(i), len(w) + 1, sum(c[x] > 0 for x in w) + (ends > 0), n, sum(log(c[x]) for x in w) + log(ends))
            for i, w in words]


def check(rows, got):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    want = sorted(brute_base(rows), key=key)
    have = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    assert [h[:5] for h in have] == [w[:5] for w in want]
    assert all(abs(h[5] - w[5]) < 1e-6 * max(1, abs(w[5])) for h, w in zip(have, want))
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_base_is_exact_and_edge_texts_are_scored(docs_of):
    rng = random.Random(1)
    rows = [(k, " ".join(f"W{rng.randrange(300)}" for _ in range(rng.randint(0, 60)))) for k in range(120)]
    rows += [(500, None), (501, ""), (None, "null id w1"), (3, "repeated id"), (502, "long " * 20000), (503, "日本 é x\x0by")]
    for common in (1 << 18, 5):  # with 5, nearly all words go through the join
        check(rows, lm_scores(docs_of(rows, 3), common=common, warm_steps=5, least_steps=2).collect())


def test_no_training_documents_and_no_documents(docs_of):
    rows = [(None, "a b"), (None, "")]
    check(rows, lm_scores(docs_of(rows)).collect())
    assert lm_scores(docs_of(rows).where("doc_id > 5")).count() == 0


def test_model_beats_the_base_on_held_out_documents(spark):
    got = lm_scores(read_table(spark, "/root/testdata/sf0.01", "documents")).where("held_out").collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_the_model_learns_from_whole_texts(docs_of, monkeypatch):
    rng = random.Random(2)
    rows = [(k, " ".join(f"w{rng.randrange(50)}" for _ in range(10_000))) for k in range(75)]  # over 600,000 words
    seen = {}

    def fit(texts, symbols, *args, **shape):
        seen.update(texts=sorted(r.text for r in texts.select("text").collect()), shape=shape)
        return AttentionModel(symbols.size, **shape)

    monkeypatch.setattr(lm_scoring, "fit", fit)
    lm_scores(docs_of(rows, 4))
    assert seen["texts"] == sorted(t for k, t in rows if zlib.crc32(str(k).encode()) % 10)
    own = AttentionModel(10)
    assert seen["shape"] == {"dim": own.dim, "heads": own.heads, "hidden": own.hidden, "span": own.span}


def test_every_window_is_trained(monkeypatch):
    m, met = AttentionModel(9, 8, 2, 8, 4), []
    monkeypatch.setattr(m, "gradients", lambda x: (met.extend(x[:, 0].tolist()), (0.0, {}))[1])
    lm_scoring.train_windows(m, np.arange(70).reshape(10, 7), 3, 1e-3, 0.1, 0, batch=4)
    assert sorted(met) == list(range(0, 70, 7))


def test_averaged_parts_beat_the_base_on_held_out_documents(spark):
    """Several parts, as large inputs have; no option makes the model see less of a text."""
    assert not {"share", "least_words"} & set(inspect.signature(lm_scores).parameters)
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    got = lm_scores(docs, part_ids=300_000, warm_steps=400).where("held_out").collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_few_training_documents(docs_of):
    for n in (1, 2, 3):
        rows = [(k, f"some words of text {k}") for k in range(1, n + 1)] + [(None, "held out words")]
        for options in ({}, {"part_ids": 4}):  # the second: more parts than documents
            check(rows, lm_scores(docs_of(rows), warm_steps=5, least_steps=2, **options).collect())
