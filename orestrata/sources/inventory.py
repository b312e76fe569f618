"""Inventory of landed files: name below the landing folder, size, digests and the first line.

A file's identity is the SHA-256 of its bytes (and of name, NUL, bytes), whatever its size. How it is computed is
not: files up to ``STREAM_ABOVE`` bytes are hashed by Spark's binary reader, which holds a file in one row; a larger
one is streamed through a task in pieces, in constant memory. Both give the same values.
"""
from __future__ import annotations

import codecs
import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orestrata.functions.digests import content_digest, object_id
from orestrata.functions.urls import percent_decoded
from orestrata.session import in_arrow, staged

STREAM_ABOVE = 32 << 20
PIECE = 1 << 20
#: A first line beyond this is not a header.
HEADER_BYTES = 1 << 20
#: Paths that one reader is given at once; there are as many readers as it takes.
PATHS_AT_ONCE = 10_000

IDENTITY = ("sha256", "object_id", "header", "is_utf8")
_DIGESTS = "path STRING, sha256 STRING, object_id STRING, header STRING, is_utf8 BOOLEAN"


def _below(folder: str) -> Column:
    """The decoded path below the landing folder."""
    base = folder.rstrip("/")
    plain = base.split("://", 1)[-1] if "://" in base else base.removeprefix("file:")
    location = percent_decoded(F.col("path"))
    return F.substring(location, F.instr(location, F.lit(plain + "/")) + len(plain) + 1, F.length(location))


def _files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)


def _empty_files(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Paths of the files without a byte: Spark lists them but leaves them out of every scan. They are what the file
    index, which the driver holds in any case, names beyond the scan; the names stay in the JVM."""
    names = Column(spark._jvm.org.apache.spark.sql.functions.lit(files._jdf.inputFiles()))
    # the index writes file:///a where the scan writes file:/a
    paths = spark.range(0, 1, 1, 1).select(F.explode(names).alias("path")).select(
        F.regexp_replace("path", r"^(\w+):///", "$1:/").alias("path")
    )
    return paths.join(files.select(F.col("_metadata.file_path").alias("path")), "path", "left_anti")


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """(path, location, source_name, bytes, modified) without reading any content. ``path`` is as Spark's metadata has
    it, ``location`` is decoded, ``source_name`` is the name below ``folder``."""
    files = _files(spark, folder)
    found = files.select(
        F.col("_metadata.file_path").alias("path"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")
    )
    if len(files._jdf.inputFiles()) > files.count():
        nothing = [F.lit(0).cast("bigint").alias("bytes"), F.lit(None).cast("timestamp").alias("modified")]
        found = found.unionByName(_empty_files(spark, files).select("path", *nothing))
    return found.select("path", percent_decoded(F.col("path")).alias("location"), _below(folder).alias("source_name"), "bytes", "modified")


def path_batches(files: DataFrame) -> Iterator[list[str]]:
    """The locations of ``files`` for a reader, ``PATHS_AT_ONCE`` at a time. Readers expand patterns in paths, so the
    characters of patterns are escaped."""
    batch: list[str] = []
    # the driver's file index holds every path already; one partition makes it one job
    for row in files.select("location").coalesce(1).toLocalIterator():
        batch.append("".join(f"\\{c}" if c in "[]{}*?\\" else c for c in row["location"]))
        if len(batch) == PATHS_AT_ONCE:
            yield batch
            batch = []
    if batch:
        yield batch


def content_inventory(spark: SparkSession, folder: str, known: DataFrame | None = None) -> DataFrame:
    """One row per file: the columns of :func:`listing` and (sha256, object_id, header, is_utf8).

    ``known`` is an earlier inventory: a file with the same name, size and modification time keeps its digests and is
    not read. Without it every file is read."""
    files = staged(spark, listing(spark, folder), "listing")
    if known is None:
        return files.join(_read(spark, files), "path")
    same = known.filter(F.col("modified").isNotNull()).select("source_name", "bytes", "modified", *IDENTITY)
    keys = ["source_name", "bytes", "modified"]
    kept = files.join(same, keys)
    rest = staged(spark, files.join(same, keys, "left_anti"), "unread")
    columns = [*files.columns, *IDENTITY]
    return kept.select(*columns).unionByName(rest.join(_read(spark, rest), "path").select(*columns))


def _read(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(path, sha256, object_id, header, is_utf8) of every file in ``files`` (stored)."""
    nothing = F.lit("").cast("binary")
    empty = files.filter("bytes = 0").select(
        "path",
        content_digest(nothing).alias("sha256"),
        object_id(F.col("source_name"), nothing).alias("object_id"),
        F.lit("").alias("header"),
        F.lit(True).alias("is_utf8"),
    )
    small = files.filter((F.col("bytes") > 0) & (F.col("bytes") <= STREAM_ABOVE))
    names = small.select("path", "source_name")
    first = F.substring_index(F.col("content").cast("string"), "\n", 1)
    whole = [
        _files(spark, paths)
        .select(F.col("_metadata.file_path").alias("path"), "content")
        .join(names, "path")
        .select(
            "path",
            content_digest(F.col("content")).alias("sha256"),
            object_id(F.col("source_name"), F.col("content")).alias("object_id"),
            F.when(F.octet_length(first) <= HEADER_BYTES, F.try_validate_utf8(F.rtrim(first, F.lit("\r")))).alias("header"),
            F.is_valid_utf8(F.col("content").cast("string")).alias("is_utf8"),
        )
        for paths in path_batches(small)
    ]
    out = reduce(DataFrame.unionByName, whole, empty)
    large = files.filter(F.col("bytes") > STREAM_ABOVE).select("path", "source_name")
    n = large.count()
    return out.unionByName(large.repartition(n).transform(in_arrow, _streamed, _DIGESTS)) if n else out


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of large files, one after the other, a piece at a time."""
    from pyarrow import fs

    for batch in batches:
        for path, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            scheme, _, rest = path.partition(":")
            files, place = fs.FileSystem.from_uri(path if rest.startswith("//") else f"{scheme}://{rest}")
            own, named = hashlib.sha256(), hashlib.sha256(name.encode() + b"\0")
            decoder, valid, head, open_line = codecs.getincrementaldecoder("utf-8")(), True, b"", True
            with files.open_input_stream(place) as source:
                while piece := source.read(PIECE):
                    own.update(piece)
                    named.update(piece)
                    if valid:
                        try:
                            decoder.decode(piece)
                        except UnicodeDecodeError:
                            valid = False
                    if open_line:
                        line, end, _ = piece.partition(b"\n")
                        head, open_line = head + line, not end and len(head) <= HEADER_BYTES
            if valid:
                try:
                    decoder.decode(b"", final=True)
                except UnicodeDecodeError:
                    valid = False
            try:
                header = head.rstrip(b"\r").decode() if len(head) <= HEADER_BYTES else None
            except UnicodeDecodeError:
                header = None
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], kind) for x, kind in zip(
                    (path, own.hexdigest(), named.hexdigest(), header, valid), (pa.string(),) * 4 + (pa.bool_(),)
                )],
                ["path", "sha256", "object_id", "header", "is_utf8"],
            )
