"""File sources (A01-A04, A07-A10, A13): tolerant CSV, header clean-up,
file-order row ids, annotation JSON, file listings, image sizes, feature rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quiver.sources import ranges

# a delimiter outside double quotes (quote-aware field split)
_SPLIT_OUTSIDE_QUOTES = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'

# Image file extensions, matched case-sensitively at the end of the name.
IMAGE_EXTENSIONS = (".jpeg", ".jpg", ".jp2", ".png", ".tiff", ".jfif", ".bmp", ".webp", ".heic")


def clean_name(name: str) -> str:
    """Remove '"', then the substring 'name', then blanks, in that order."""
    return name.replace('"', "").replace("name", "").replace(" ", "")


def clean_header(df: DataFrame) -> DataFrame:
    """A03 applied to every column of a frame."""
    return df.toDF(*[clean_name(c) for c in df.columns])


def read_csv_tolerant(spark: SparkSession, path: str, header_line: str | None = None,
                      types: dict | None = None, multi_line: bool = False) -> DataFrame:
    """CSV read that skips records with more fields than the header and
    null-fills records with fewer (the semantics of a pandas ``on_bad_lines='skip'``
    read); blank lines are skipped.

    Without ``header_line`` every file starts with a header line, which names the
    columns; with it the files hold data only, and no line is taken for a header.
    ``multi_line`` allows line ends inside quotes; a file is still read in byte ranges by
    many tasks (``ranges``).
    Spark's CSV parser marks records of the wrong width; only their fields are
    counted, with a quote-aware split.
    """
    own_header = header_line is None
    if own_header:
        header_line = spark.read.text(path).filter(F.col("value") != "").limit(1).collect()[0][0]
    names = [n.strip().strip('"') for n in header_line.split(",")]
    ddl = ", ".join(f"`c{i}` string" for i in range(len(names))) + ", `_wrong` string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_wrong", "escape": '"'}
    if multi_line:
        records = ranges.read_records(spark, path, ranges.CsvRecords()).select("first", F.regexp_replace("record", "\r$", "").alias("r"))
        records = records.where(F.col("r") != "")
        if own_header:
            records = records.where(~F.col("first"))
        raw = records.select(F.from_csv("r", ddl, options).alias("c")).select("c.*")
    else:
        raw = spark.read.csv(path, schema=ddl, header=own_header, **options)
    n_fields = F.size(F.split("_wrong", _SPLIT_OUTSIDE_QUOTES, -1))
    kept = raw.filter(F.col("_wrong").isNull() | (n_fields <= len(names)))
    out = kept.drop("_wrong").toDF(*names)
    for c, t in (types or {}).items():
        out = out.withColumn(c, F.col(c).try_cast(t))
    return out


def row_ids(scan: DataFrame, col: str = "row_id") -> DataFrame:
    """Dense 0..n-1 ids in file order (files by path, rows by their place in
    the file), for a DataFrame straight from a Parquet scan. Spark's file metadata
    gives each row's file and place; the rows of earlier files are added from a
    table with one row per file (broadcast)."""
    d = scan.select("*", F.col("_metadata.file_path").alias("_fp"), F.col("_metadata.row_index").alias("_fl"))
    counts = d.groupBy("_fp").agg(F.count(F.lit(1)).alias("_fn"))
    w = Window.orderBy("_fp").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("_fp", F.coalesce(F.sum("_fn").over(w), F.lit(0)).alias("_fo"))
    out = d.join(F.broadcast(offs), "_fp")
    return out.select((F.col("_fl") + F.col("_fo")).cast("bigint").alias(col),
                      *[c for c in scan.columns])


ANNOTATION_SCHEMA = ("map<string, struct<bboxes: array<array<double>>, labels: array<string>, "
                     "leading_hand: string, user_id: string>>")


def write_annotation_json(boxes: DataFrame, images: DataFrame, path: str) -> str:
    """Annotations as JSON text, one folder per class; each line is an object
    keyed by image name (the per-class file format, line-delimited so no
    class has to fit in one record)."""
    per = (boxes.groupBy("image_key")
                .agg(F.sort_array(F.collect_list(F.struct("box_pos", "x", "y", "w", "h", "label"))).alias("_b")))
    ann = per.join(images.select("image_key", "target", "leading_hand", "user_id"), "image_key")
    val = F.struct(F.transform("_b", lambda e: F.array(e["x"], e["y"], e["w"], e["h"])).alias("bboxes"),
                   F.transform("_b", lambda e: e["label"]).alias("labels"),
                   "leading_hand", "user_id")
    ann.select("target", F.to_json(F.create_map(F.col("image_key"), val)).alias("value")) \
       .write.mode("overwrite").partitionBy("target").text(path)
    return path


def write_annotation_objects(boxes: DataFrame, images: DataFrame, path: str) -> str:
    """Annotations as one JSON object per class, in one file per class folder: the entries of
    ``write_annotation_json`` between braces, with commas, indented over several lines."""
    lines = write_annotation_json(boxes, images, path + "-lines")
    # an entry's comma stands before it, so only the first of a class has none; entries keep no order, and
    # two numbers are compared, not texts
    rows = images.sparkSession.read.text(lines).select(
        "target", F.expr("substring(value, 2, length(value) - 2)").alias("value"), F.monotonically_increasing_id().alias("_o"))
    first = rows.groupBy("target").agg(F.min("_o").alias("_first"))
    rows = rows.join(first, "target").select("target", "_o", F.when(F.col("_o") == F.col("_first"), F.col("value")).otherwise(
        F.concat(F.lit(", "), F.col("value"))).alias("value"))
    ends = first.select("target", F.explode(F.array(F.struct(F.lit(-1).cast("long").alias("_o"), F.lit("{").alias("value")),
                                                    F.struct(F.lit((1 << 63) - 1).alias("_o"), F.lit("}").alias("value")))).alias("e"),
                        ).select("target", "e._o", "e.value")
    (rows.unionByName(ends).repartition("target").sortWithinPartitions("target", "_o")
     .select("target", "value").write.partitionBy("target").text(path))
    return path


def read_annotation_json(spark: SparkSession, path: str, whole_file: bool = False,
                         targets: list[str] | None = None) -> DataFrame:
    """Annotation objects keyed by image name -> one row per image with
    ``name = key + '.jpg'`` and ``target`` = the class (file stem or class folder).

    ``whole_file=True`` reads files that are one JSON object each (the original
    one-object-per-class layout), in byte ranges by many tasks; otherwise each line is an
    object. Classes without a file are simply absent; ``targets`` keeps only the listed ones."""
    if whole_file:
        entries = ranges.read_records(spark, path, ranges.JsonEntries())
        body = F.regexp_replace("record", r"^\s*[{,]\s*", "")
        raw = entries.select(F.concat(F.lit("{"), body, F.lit("}")).alias("value"), F.col("file").alias("_path")).where(
            F.col("value").contains('"'))
    else:
        raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_path"))
    folder = F.regexp_extract("_path", r"target=([^/]+)/", 1)
    stem = F.regexp_extract("_path", r"([^/]+)\.json$", 1)
    target = F.when(folder != "", F.url_decode(folder)).otherwise(stem)
    rows = raw.select(target.alias("target"), F.explode(F.from_json("value", ANNOTATION_SCHEMA)).alias("key", "a"))
    out = rows.select(F.concat("key", F.lit(".jpg")).alias("name"), "target", "a.bboxes", "a.labels",
                      "a.leading_hand", "a.user_id")
    if targets is not None:
        out = out.filter(F.col("target").isin(list(targets)))
    return out


def list_files(spark: SparkSession, root: str, extensions=IMAGE_EXTENSIONS) -> DataFrame:
    """Paths under ``root`` ending in one of ``extensions`` (case-sensitive);
    only the path column is read, file contents are pruned."""
    pattern = "(" + "|".join(e.replace(".", r"\.") for e in extensions) + ")$"
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
               .select("path", "length"))
    return df.filter(F.col("path").rlike(pattern)).select(
        "path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "length")


def image_dims(spark: SparkSession, root: str) -> DataFrame:
    """A10: (path, name, width, height) of every decodable image under ``root``."""
    img = spark.read.format("image").option("recursiveFileLookup", "true").option("dropInvalid", "true").load(root)
    return img.select(F.col("image.origin").alias("path"),
                      F.regexp_extract("image.origin", r"([^/]+)$", 1).alias("name"),
                      F.col("image.width").alias("width"), F.col("image.height").alias("height"))


def feature_rows(df: DataFrame, array_col: str, label_col: str, scale: float | None = None) -> DataFrame:
    """Array column (optionally scaled, e.g. 1/255) -> ML vector + label."""
    from pyspark.ml.functions import array_to_vector

    arr = F.col(array_col).cast("array<double>")
    if scale is not None:
        arr = F.transform(arr, lambda x: x * F.lit(scale))
    return df.select(array_to_vector(arr).alias("features"), F.col(label_col).cast("double").alias("label"))
