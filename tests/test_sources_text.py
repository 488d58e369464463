"""Sources and text: tolerant CSV, header clean-up, row ids, ASCII folding."""

import os
import tempfile

from pyspark.sql import functions as F

from quiver.functions.text import accent_table, tokens
from quiver.sources import files


def test_tolerant_csv_skips_long_lines_fills_short(spark):
    d = tempfile.mkdtemp(prefix="quiver-test-")
    p = os.path.join(d, "x.csv")
    with open(p, "w") as f:
        f.write('user_id,artist,track,playlist\nu1,a,t,p\nu2,a,t,p,extra\nu3,a\n"u4","x,y",t,p\n\n')
    out = files.read_csv_tolerant(spark, p).orderBy("user_id").collect()
    assert [r.user_id for r in out] == ["u1", "u3", "u4"]
    assert out[1].track is None and out[2].artist == "x,y"


def test_clean_header_order():
    assert files.clean_name(' "artistname"') == "artist"
    assert files.clean_name("track name") == "track"


def test_row_ids_dense_in_file_order(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ids = [r.row_id for r in files.row_ids(df).orderBy("row_id").collect()]
    assert ids == list(range(len(ids)))


def test_accent_folding_and_tokens(spark):
    src, dst = accent_table()
    assert len(src) == len(dst) and "é" in src and "ß" not in src
    df = spark.createDataFrame([("Élève CAFÉ, straße a b2 x_y",)], "t string")
    assert df.select(tokens("t").alias("k")).collect()[0].k == ["eleve", "cafe", "strae", "b2", "x_y"]
    assert F is not None


def test_annotation_json_whole_file_per_class(spark):
    import json

    d = tempfile.mkdtemp(prefix="quiver-ann-")
    docs = {
        "call": {"img1": {"bboxes": [[0.1, 0.2, 0.3, 0.4]], "labels": ["call"], "leading_hand": "right",
                          "user_id": "u1"},
                 "img2": {"bboxes": [[0.0, 0.0, 0.5, 0.5], [0.5, 0.5, 0.1, 0.1]], "labels": ["call", "no_gesture"],
                          "leading_hand": "left", "user_id": "u2"}},
        "like": {"img3": {"bboxes": [], "labels": [], "leading_hand": "left", "user_id": "u1"}},
    }
    for target, obj in docs.items():
        with open(os.path.join(d, f"{target}.json"), "w") as f:
            json.dump(obj, f, indent=2)  # a multi-line document: needs whole-file reading
    out = files.read_annotation_json(spark, d, whole_file=True, targets=["call", "like", "mute"]).collect()
    got = sorted((r.name, r.target, len(r.labels)) for r in out)
    assert got == [("img1.jpg", "call", 1), ("img2.jpg", "call", 2), ("img3.jpg", "like", 0)]


def test_list_files_extension_case_sensitive(spark):
    d = tempfile.mkdtemp(prefix="quiver-files-")
    for name in ["a.jpg", "b.JPG", "c.png", "d.txt"]:
        with open(os.path.join(d, name), "wb") as f:
            f.write(b"x")
    names = sorted(r.name for r in files.list_files(spark, d).collect())
    assert names == ["a.jpg", "c.png"]


def _png(path, width, height):
    import struct
    import zlib

    def chunk(kind, data):
        body = kind + data
        return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body) & 0xFFFFFFFF)

    raw = b"".join(b"\x00" + b"\x80\x40\x20" * width for _ in range(height))
    png = (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0))
           + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))
    with open(path, "wb") as f:
        f.write(png)


def test_image_dims_reads_width_and_height(spark):
    d = tempfile.mkdtemp(prefix="quiver-img-")
    _png(os.path.join(d, "a.png"), 7, 5)
    _png(os.path.join(d, "b.png"), 3, 9)
    got = sorted((r.name, r.width, r.height) for r in files.image_dims(spark, d).collect())
    assert got == [("a.png", 7, 5), ("b.png", 3, 9)]


def test_membership_filter_semi_and_anti(spark):
    from quiver.operators.sampling import membership_filter

    df = spark.createDataFrame([("u1", 1), ("u2", 2), ("u3", 3)], "user string, v int")
    members = spark.createDataFrame([("u1",), ("u1",), ("u3",)], "user string")
    assert sorted(r.v for r in membership_filter(df, members, "user").collect()) == [1, 3]
    assert [r.v for r in membership_filter(df, members, "user", keep=False).collect()] == [2]
