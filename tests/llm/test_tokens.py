"""Token ids, packing and token files against the tokenizers library used plainly."""

import random
import zlib

import numpy as np
import pyarrow as pa

from quiver.llm.huffman import LANE, Code, code_lengths, read_file, read_token_files, write_token_files
from quiver.llm.packing import SumOfSquares, pack
from quiver.llm.tokens import Encoder, default_vocabulary

EDGE = ["", " ", "\n", "a", "  two  spaces ", "tab\tand\r\nline\n\n", "wide space 　 x", "l'été isn't it's",
        "!! a,b;c 12.5 x|y", "<|endoftext|> in text", "日本語 テキスト 😀", "\x0b\x0c", "word " * 3000]


def plain(texts):
    enc = Encoder.of(default_vocabulary())
    return [e.ids for e in enc.library.encode_batch(texts, add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_pieces_give_the_ids_of_the_whole():
    rng = random.Random(5)
    parts = ["a", "b", "th", "Ing", "\n", " ", "  ", "\t", "\r\n", "é", "'s", "12", "!!", " ", "　", "\x1c", "'", "日", "\x0b"]
    texts = EDGE + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    ids, offsets = Encoder.of(default_vocabulary()).encode(pa.array(texts))
    for i, want in enumerate(plain(texts)):
        assert ids[offsets[i]: offsets[i + 1]].tolist() == want, texts[i]


def test_length_limited_code_is_a_prefix_code_and_round_trips():
    rng = np.random.default_rng(3)
    for n, v in ((1, 1), (257, 2), (5, 5), (LANE, 30), (40000, 20000)):
        ids = np.minimum(rng.zipf(1.2, n) - 1, v - 1).astype(np.uint32)
        counts = np.bincount(ids)
        used = np.flatnonzero(counts)
        lengths = code_lengths(counts[used])
        assert lengths.max() <= 16 and (2.0 ** -lengths.astype(float)).sum() <= 1 + 1e-9
        code = Code.from_bytes(Code(used, lengths).to_bytes())
        words, marks = code.encode(ids)
        assert (code.decode(words, marks, n, LANE) == ids).all()


def test_code_is_optimal_when_the_limit_does_not_bind():
    # Huffman lengths of 1,1,2,3,5: 4,4,3,2,1
    assert sorted(code_lengths(np.array([1, 1, 2, 3, 5])).tolist()) == [1, 2, 3, 4, 4]
    assert code_lengths(np.array([1, 1, 2, 3, 5]), 3).max() == 3


def rows_for(texts):
    return [(i * 7 % len(texts), t) for i, t in enumerate(texts)]


def test_token_files_round_trip(spark, docs_of):
    rows = rows_for(EDGE) + [(None, "null id"), (100, None), (3, "repeated id")]
    folder = write_token_files(docs_of(rows, 3), end_id=2)
    got = read_token_files(spark, folder, with_ids=True).collect()
    want = {}
    for (i, t), ids in zip(rows, plain([t or "" for _, t in rows])):
        want.setdefault(i, []).append(ids + [2])
    assert len(got) == len(rows)
    start = 0
    for r in sorted(got, key=lambda r: r.start):
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == start and ids in want[r.doc_id] and r.n_tokens == len(ids) and r.ids_crc32 == crc(ids)
        start += r.n_tokens
    order = [r.doc_id if r.doc_id is not None else -1 for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order)


def test_token_files_of_nothing(spark, docs_of):
    folder = write_token_files(docs_of([(1, "x")], 0).where("doc_id > 5"))
    assert read_token_files(spark, folder).count() == 0


def test_token_files_spread_the_rows_of_one_id(spark, docs_of):
    """A third of all rows without an id, and rows that repeat id and text."""
    rows = [(k if k % 3 else None, f"text {k % 400} of many") for k in range(1200)]
    joined = "spark.sql.adaptive.coalescePartitions.enabled"  # it would make one range of so few rows
    before = spark.conf.get(joined)
    spark.conf.set(joined, "false")
    try:
        folder = write_token_files(docs_of(rows, 4))
    finally:
        spark.conf.set(joined, before)
    got = sorted(read_token_files(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    counted = lambda x: sorted(x, key=str)
    assert counted((r.doc_id, r.ids_crc32) for r in got) == counted(
        (i, crc(ids + [2])) for (i, _), ids in zip(rows, plain([t for _, t in rows])))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.qhf").load(folder).select("content").collect()
    code = Code.from_bytes(spark.read.format("binaryFile").load(f"{folder}/code.qhc").head().content)
    assert sum(None in read_file(r.content, code)[0] for r in files) > 1  # rows without an id lie in several ranges


def check_packing(rows, got, size):
    ids_of = {i: ids + [0] for (i, _), ids in zip(rows, plain([t or "" for _, t in rows]))}
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == ids_of.keys()
    for i, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            part = ids_of[i][r.start: r.start + r.length]
            assert r.start == at and len(part) == r.length > 0 and r.ids_crc32 == crc(part)
            assert r.doc_tokens == len(ids_of[i])
            at += r.length
        assert at == len(ids_of[i])
    padding = 0
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding


def test_packing_keeps_every_id_once(docs_of):
    rng = random.Random(9)
    texts = EDGE + ["w%d " % k * rng.randint(1, 900) for k in range(150)]
    rows = list(enumerate(texts)) + [(None, "null id"), (5000, None)]
    for size, parts in ((1024, 1), (64, 4)):
        assert check_packing(rows, pack(docs_of(rows, parts), size=size).collect(), size) == 0


def test_packing_of_nothing(docs_of):
    assert pack(docs_of([(1, "x")], 0).where("doc_id > 5")).count() == 0


def test_level_choice_minimises_squares():
    """Each rest goes where the sum of squared level counts is least (by brute force)."""
    rng = random.Random(2)
    packer = SumOfSquares(16, 0, 10 ** 6)
    for _ in range(300):
        s = rng.randint(1, 15)
        before = packer.levels.copy()
        best = None
        for h in [0] + [x for x in range(1, 16) if before[x]]:
            if h + s <= 16:
                after = before.copy()
                after[h] -= h > 0
                after[h + s] += h + s < 16
                cost = int((after ** 2).sum())
                best = cost if best is None else min(best, cost)
        packer.add(0, np.zeros(s, np.uint32))
        assert int((packer.levels ** 2).sum()) == best


def test_open_windows_stay_bounded():
    packer = SumOfSquares(16, 0, 8)
    for _ in range(200):
        packer.add(0, np.zeros(9, np.uint32))  # no two fit together
        assert packer.n_open <= 9
    packer.finish()
    assert sum(r[2] for r in packer.rows()) == 1800


def test_few_ids_are_cut_anew():
    """Filling the fullest windows from the emptiest keeps the places of nearly all ids."""
    rng = np.random.default_rng(0)
    for n, low, high, most in ((600, 20, 1500, 0.05), (2000, 20, 1500, 0.05), (8000, 300, 700, 0.05)):
        packer, total = SumOfSquares(1024, 0, 4096), 0
        for doc in range(n):
            ids = np.zeros(rng.integers(low, high), np.uint32)
            total += len(ids)
            packer.add(doc, ids)
        packer.finish()
        rows = packer.rows()
        assert packer.recut < most * total and sum(r[2] for r in rows) == total
        sizes = {}
        for r in rows:
            sizes[r[5]] = sizes.get(r[5], 0) + r[2]
        assert all(x == 1024 or x & (x - 1) == 0 for x in sizes.values())


def test_repeated_rows_are_packed_like_any_others(docs_of):
    got = pack(docs_of([(4, "the same row")] * 5 + [(None, "the same row")] * 3, 2)).collect()
    whole = crc(plain(["the same row"])[0] + [0])
    assert {r.doc_tokens for r in got} == {4}
    assert sum(r.length for r in got) == 32 and sum(r.start == 0 for r in got) == 8
    assert all(r.ids_crc32 == whole for r in got if r.length == r.doc_tokens)
