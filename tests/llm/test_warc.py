"""WARC archives: exact round trips, revisits, stream inflation."""

import base64
import glob
import gzip
import hashlib
import os
import zlib

import pytest

from quiver.llm.warc import (headers, inflate, member, normalise, read_records, split_records, write_monolithic)


def pages(spark, rows, parts=3):
    data = [(i, u, h, "x") for i, u, h in rows]
    return spark.createDataFrame(data, "page_id long, url string, html string, digest string").repartition(parts)


ROWS = [(1, "http://a/\nb", "<p>é</p>"), (2, None, None), (3, "u", ""), (5, "v", "<p>é</p>"), (4, "w", "<p>é</p>"),
        (6, "x", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n\r\n"), (None, "n", "only null"), (7, "y", "z" * 300000),
        (8, "dup", "tail\r\n\r\n"), (8, "dup", "tail\r\n\r\n"), (None, "n2", "<p>é</p>")]


def test_round_trip_and_revisits(spark):
    whole = write_monolithic(pages(spark, ROWS), records_per_file=3)
    folder, index = normalise(spark, whole)
    got = read_records(folder, index, with_payload=True).collect()
    assert len(got) == len(ROWS)
    first = {}
    for i, _, h in ROWS:
        key = h or ""
        first[key] = min(first.get(key, 10 ** 9), i if i is not None else 10 ** 9)
    expected = []
    for i, _, h in ROWS:
        raw = (h or "").encode()
        mine = first[h or ""] in (i, 10 ** 9)
        expected.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                         "response" if mine else "revisit", None if mine else first[h or ""], raw if mine else None))
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    have = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to,
             None if r.payload is None else bytes(r.payload)) for r in got]
    assert sorted(have, key=key) == sorted(expected, key=key)


def test_members_and_sidecar_index(spark):
    whole = write_monolithic(pages(spark, ROWS, 1))
    folder, index = normalise(spark, whole)
    root = folder.removeprefix("file:")
    archives = sorted(glob.glob(os.path.join(root, "*.warc.gz")))
    assert archives and len(glob.glob(os.path.join(root, "*.idx"))) == len(archives)
    seen = 0
    for path in archives:
        raw = open(path, "rb").read()
        lines = [tuple(map(int, x.split())) for x in open(path + ".idx")]
        assert sum(n for _, n in lines) == len(raw)
        for at, n in lines:
            one = zlib.decompressobj(31)
            record = one.decompress(raw[at: at + n]) + one.flush()
            assert one.eof and not one.unused_data and record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
            seen += 1
        assert gzip.decompress(raw).count(b"WARC-Record-ID") >= len(lines)
    assert seen == len(ROWS) == index.count()


def test_small_payloads_below_the_limit_are_responses(spark):
    folder, index = normalise(spark, write_monolithic(pages(spark, ROWS), min_revisit_bytes=8))
    got = read_records(folder, index).collect()
    assert all(r.record_type == "response" for r in got if r.payload_bytes < 8)
    assert sum(r.record_type == "revisit" for r in got) == 3


def test_no_pages(spark):
    folder, index = normalise(spark, write_monolithic(pages(spark, ROWS).where("page_id > 99")))
    assert read_records(folder, index).count() == 0


def test_inflate_in_pieces_and_many_members():
    content = os.urandom(70000) + b"a" * 3_000_000
    raw = gzip.compress(content[:50000]) + gzip.compress(content[50000:])
    pieces = list(inflate(raw, step=1000))
    assert b"".join(pieces) == content and max(map(len, pieces)) <= 8000


def test_split_records_over_any_cuts():
    one = b"WARC/1.1\r\nContent-Length: 5\r\n\r\nab\r\n\r\r\n\r\n"
    two = b"WARC/1.1\r\nX: y\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    stream = one + two + one
    for step in (1, 2, 7, 1000):
        assert list(split_records(stream[k: k + step] for k in range(0, len(stream), step))) == [one, two, one]
    with pytest.raises(ValueError):
        list(split_records([one[:-1]]))
    assert headers(b"WARC/1.1\r\nA: b: c")["a"] == "b: c"
    assert zlib.decompress(member(one), 31) == one
