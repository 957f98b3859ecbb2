"""Readers and writers: JSON arrays and maps, CSV with a byte-order mark, DBF, HTML pages, caches."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as t
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from souche.session import cut


def exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm_path)


def json_array(spark: SparkSession, path: str, schema: str, tolerant: bool = False, lines: bool = False) -> DataFrame:
    """A file holding one JSON array of records, or with ``lines`` one record a line (which is read in parallel); with ``tolerant`` a missing or broken file is empty."""
    if tolerant and not exists(spark, path):
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("multiLine", not lines).option("mode", "DROPMALFORMED" if tolerant else "FAILFAST")
    return reader.json(path)


def json_map(spark: SparkSession, path: str, value: str = "string", lines: bool = False) -> DataFrame:
    """(key, value) of a file holding one JSON object (one task), or with ``lines`` an object a line (read in parallel)."""
    whole = spark.read.text(path, wholetext=not lines)
    return whole.select(F.explode(F.from_json("value", f"map<string,{value}>")).alias("key", "value"))


def csv_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    df = spark.read.option("header", True).option("encoding", "UTF-8").csv(path) if schema is None else spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)
    return df.toDF(*(c.lstrip("﻿") for c in df.columns))


def require(df: DataFrame, columns: set[str]) -> DataFrame:
    missing = columns - set(df.columns)
    if missing:
        raise ValueError(f"columns missing: {', '.join(sorted(missing))}")
    return df


def listing(spark: SparkSession, folder: str, suffix: str, without: str | None = None) -> DataFrame:
    """Paths below ``folder`` with a suffix, sorted, without those in folders of a name."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").load(folder).select("path")
    if without:
        df = df.where(~F.col("path").contains(f"/{without}/"))
    return df.orderBy("path")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_json_map(df: DataFrame, key: str, path: str) -> None:
    """One JSON object a line, each of one key: a map that is written and read in parallel."""
    rest = F.struct(*(c for c in df.columns if c != key))
    df.select(F.to_json(F.map_from_arrays(F.array(key), F.array(rest))).alias("value")).write.mode("overwrite").text(path)


def joined_file(spark: SparkSession, parts: str, path: str, head: str = "", tail: str = "") -> None:
    """One file of the text files below ``parts`` in order, between ``head`` and ``tail``: bytes are copied, nothing is parsed or kept."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    source, target = jvm.org.apache.hadoop.fs.Path(parts), jvm.org.apache.hadoop.fs.Path(path)
    files = source.getFileSystem(conf)
    out = target.getFileSystem(conf).create(target, True)
    try:
        out.write(bytearray(head.encode()))
        for status in sorted((f for f in files.listStatus(source) if f.getPath().getName().startswith("part-")), key=lambda f: f.getPath().getName()):
            data = files.open(status.getPath())
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(data, out, 1 << 16, False)
            data.close()
        out.write(bytearray(tail.encode()))
    finally:
        out.close()


def _separated(df: DataFrame, value, path: str, ends: tuple[str, str]) -> None:
    """Rows as the entries of one JSON array or object in one file, each but the first behind a comma."""
    rows = cut(df.select(value.alias("value")), "entries").withColumn("at", F.monotonically_increasing_id())
    first = rows.agg(F.min("at")).first()[0]
    parts = f"{path}.parts"
    rows.select(F.when(F.col("at") == F.lit(first), F.col("value")).otherwise(F.concat(F.lit(","), "value")).alias("value")).write.mode("overwrite").text(parts)
    joined_file(df.sparkSession, parts, path, ends[0] + "\n", ends[1] + "\n")


def write_json_array(df: DataFrame, path: str) -> None:
    """One file holding one JSON array of records."""
    _separated(df, F.to_json(F.struct(*df.columns)), path, ("[", "]"))


def write_json_object(df: DataFrame, key: str, path: str) -> None:
    """One file holding one JSON object, an entry per key."""
    entry = F.to_json(F.map_from_arrays(F.array(F.col(key).cast("string")), F.array(F.struct(*(c for c in df.columns if c != key)))))
    _separated(df, entry.substr(F.lit(2), F.length(entry) - 2), path, ("{", "}"))


def write_csv_files(df: DataFrame, key: str, folder: str) -> list[str]:
    """One CSV file a first letter, with a byte-order mark and a header; rows are written in parallel, then joined a letter."""
    spark = df.sparkSession
    parts = f"{folder}.parts"
    df.withColumn("lettre", F.upper(F.substring(key, 1, 1))).write.mode("overwrite").partitionBy("lettre").option("header", False).csv(parts)
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(parts)
    letters = [f.getPath().getName().partition("=")[2] for f in root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(root) if f.isDirectory()]
    for letter in letters:
        joined_file(spark, f"{parts}/lettre={letter}", f"{folder}/{letter}.csv", "\ufeff" + ",".join(df.columns) + "\n")
    return sorted(letters)


def write_csv_by_letter(df: DataFrame, key: str, path: str) -> None:
    df.withColumn("lettre", F.upper(F.substring(key, 1, 1))).write.mode("overwrite").partitionBy("lettre").option("header", True).csv(path)


def append_cache(df: DataFrame, path: str, keys: list[str]) -> None:
    """Append to a Parquet cache what it does not hold yet."""
    spark = df.sparkSession
    fresh = df.dropDuplicates(keys)
    if exists(spark, path):
        fresh = fresh.join(spark.read.parquet(path).select(*keys), keys, "left_anti")
    fresh.write.mode("append").parquet(path)


def read_cache(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


# --- DBF ------------------------------------------------------------------------------------


class _Slice(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


def _dbf_header(path: str) -> tuple[int, int, int, list[tuple[str, str, int]]]:
    with open(path, "rb") as file:
        head = file.read(32)
        rows, start, width = struct.unpack("<IHH", head[4:12])
        fields = []
        while (raw := file.read(32)) and raw[0] != 0x0D and len(raw) == 32:
            fields.append((raw[:11].split(b"\0")[0].decode("latin-1"), chr(raw[11]), raw[16]))
    return rows, start, width, fields


class DbfSource(DataSource):
    """``spark.read.format("dbf").load(path)``: fixed-width records, read in slices of the file."""

    @classmethod
    def name(cls) -> str:
        return "dbf"

    def schema(self) -> t.StructType:
        kinds = {"N": t.DoubleType(), "F": t.DoubleType(), "L": t.BooleanType()}
        return t.StructType([t.StructField(n, kinds.get(k, t.StringType())) for n, k, _ in _dbf_header(self.options["path"])[3]])

    def reader(self, schema: t.StructType) -> DataSourceReader:
        return _DbfReader(self.options)


class _DbfReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.encoding = options["path"], options.get("encoding", "latin-1")
        self.slice = int(options.get("rows", "200000"))

    def partitions(self) -> list[InputPartition]:
        rows = _dbf_header(self.path)[0]
        return [_Slice(a, min(a + self.slice, rows)) for a in range(0, rows, self.slice)] or [_Slice(0, 0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        _, start, width, fields = _dbf_header(self.path)
        with open(self.path, "rb") as file:
            file.seek(start + partition.first * width)
            for _ in range(partition.first, partition.last):
                raw = file.read(width)
                if len(raw) < width or raw[:1] == b"*":  # cut short, or marked as deleted
                    continue
                out, at = [], 1
                for _, kind, size in fields:
                    text = raw[at : at + size].decode(self.encoding).strip(" \0")
                    at += size
                    if kind in "NF":
                        try:
                            out.append(float(text))
                        except ValueError:
                            out.append(None)
                    elif kind == "L":
                        out.append({"T": True, "Y": True, "F": False, "N": False}.get(text.upper()))
                    else:
                        out.append(text)
                yield tuple(out)


# --- HTML -----------------------------------------------------------------------------------


class _Sections(HTMLParser):
    """Paragraphs after each h2 with an id, up to the next h2 or h3."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: dict[str, list[str]] = {}
        self.at: str | None = None
        self.open: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag in ("h2", "h3"):
            self.at, self.open = (dict(attrs).get("id") if tag == "h2" else None), None
            if self.at:
                self.parts.setdefault(self.at, [])
        elif tag == "p" and self.at:
            self.open = []

    def handle_endtag(self, tag):
        if tag == "p" and self.open is not None:
            body = " ".join("".join(self.open).split())
            if body:
                self.parts[self.at].append(body)
            self.open = None

    def handle_data(self, data):
        if self.open is not None:
            self.open.append(data)


def sections(pages: DataFrame, key: str, html: str, ids: list[str]) -> DataFrame:
    """(key, one column per section id): text of each section, '' where it is absent."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for body in batch.column(1).to_pylist():
                parser = _Sections()
                parser.feed(body or "")
                parser.close()
                found.append({k: " ".join(v) for k, v in parser.parts.items()})
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([f.get(i, "") for f in found], pa.string()) for i in ids)], names=[key, *ids])

    kind = dict(pages.dtypes)[key]
    return pages.select(key, html).mapInArrow(parse, ", ".join([f"`{key}` {kind}", *(f"`{i}` string" for i in ids)]))


def page_links(pages: DataFrame, key: str, html: str, css: str = "prenom-title") -> DataFrame:
    """(key, url, title): links of a class, in any order of attributes, without empty ones."""
    tags = F.explode(F.regexp_extract_all(html, F.lit(r"(?is)(<a\b[^>]*>.*?</a>)"), 1))
    rows = pages.select(key, tags.alias("a")).where(F.col("a").rlike(rf"""(?i)^<a\b[^>]*class\s*=\s*["'][^"']*\b{css}\b"""))
    url = F.regexp_extract("a", r"""(?i)\bhref\s*=\s*["']([^"']*)["']""", 1)
    title = F.trim(F.regexp_replace(F.regexp_replace("a", r"<[^>]+>", ""), r"\s+", " "))
    return rows.select(key, url.alias("url"), title.alias("title")).where("url <> '' AND title <> ''")


def page_count(subtitle, per_page: int = 30):
    """Pages of a listing from the first integer of its subtitle, at least one."""
    total = F.coalesce(F.nullif(F.regexp_extract(F.regexp_replace(subtitle, r"(?<=\d)[\s.](?=\d{3})", ""), r"(\d+)", 1), F.lit("")).try_cast("bigint"), F.lit(0))
    return F.greatest(F.lit(1), F.ceil(total / per_page))
