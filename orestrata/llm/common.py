"""What the corpus operators share: reading documents, ordering rows over many tasks, files in the shared folder."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orestrata.session import scratch, staged
from orestrata.sources.sizing import broadcast_within

#: A row's number holds its partition (or file) above these bits and the row within it below.
ROW_BITS = 33
#: The contract's words and white space.
WORD = "[^\\x20\\x09-\\x0D]+"
SPACE = "[\\x20\\x09-\\x0D]+"


#: What empties the caches of each operator that keeps some between tasks, and the operator whose task the worker ran last.
_CACHES: dict[str, list] = {}
_OWNER: list[str] = []


def keeps_cache(owner: str, *caches: dict) -> None:
    """Register caches that tasks of ``owner`` fill in a Python worker."""
    _CACHES.setdefault(owner, []).extend(caches)


def own_caches(owner: str) -> None:
    """Called where a task of ``owner`` begins: workers are used again, and what another operator's tasks keep is dropped."""
    if _OWNER != [owner]:
        for name, caches in _CACHES.items():
            if name != owner:
                for cache in caches:
                    cache.clear()
        _OWNER[:] = [owner]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _read_from_files(docs: DataFrame) -> bool:
    """Whether ``docs`` is a table of files as it is read, with nothing done to it yet."""
    return docs._jdf.queryExecution().analyzed().nodeName() == "LogicalRelation" and bool(docs._jdf.inputFiles())


def with_rows(docs: DataFrame, label: str = "rows") -> tuple[DataFrame, str]:
    """``docs`` with a number of each row, and the number's column, which has a name that ``docs`` doesn't use. The number says
    which row is meant however often the rows are read; a doc_id doesn't, as several rows may have the same or none.

    Where ``docs`` is read straight from files, the number is the file's number and the row's place in the file, and nothing is
    stored but one row for each file. Anything else is stored with numbers that are taken as it is written."""
    used, row = {c.lower() for c in docs.columns}, "_row"
    while row in used:
        row = f"_{row}"
    if not _read_from_files(docs):
        return staged(docs.sparkSession, docs.withColumn(row, F.monotonically_increasing_id()), label), row
    place = docs.metadataColumn("_metadata")
    path, number = f"{row}_path", f"{row}_file"
    files = docs.select(place["file_path"].alias(path)).distinct().coalesce(1)
    files = staged(docs.sparkSession, files.withColumn(number, F.monotonically_increasing_id()), f"{label}-files")
    placed = docs.withColumns({path: place["file_path"], row: place["row_index"]}).join(broadcast_within(files), path)
    return placed.withColumn(row, F.shiftleft(number, ROW_BITS).bitwiseOR(F.col(row))).drop(path, number), row


def text_of(column: str = "text") -> Column:
    """The text; null is empty."""
    return F.coalesce(F.col(column), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is. Texts of one byte a character take the short way."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )


def staged_in_order(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """``df`` range-sorted by ``order`` and stored, with ``part`` (its range) and ``at`` (its row in the range).

    Both are taken as the rows are written, so that they can't change if a task runs again. Parts ascend with the order.
    """
    sorted_df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = staged(df.sparkSession, sorted_df.withColumn("_row", F.monotonically_increasing_id()), label)
    return kept.select(
        *[F.col(c) for c in df.columns],
        F.shiftright("_row", ROW_BITS).alias("part"),
        F.col("_row").bitwiseAND((1 << ROW_BITS) - 1).alias("at"),
    )


def sample_texts(docs: DataFrame, n: int, longest: int, having: str = "TRUE") -> list[str]:
    """About ``n`` texts of at most ``longest`` characters, for training: those whose row's hash lies below the share of
    rows that ``n`` is. Tasks pass on only what is taken, whatever the size of the table; never more than 2 n."""
    texts = docs.select("doc_id", text_of().alias("text")).filter((F.length("text") <= longest) & F.expr(having))
    total = texts.count()
    below = -(2**63) + int(2**64 * min(1.0, n / max(1, total))) - 1
    taken = texts.filter(F.xxhash64("doc_id", "text") <= below).limit(2 * n)
    return [r["text"] for r in sorted(taken.toLocalIterator(), key=lambda r: (r["doc_id"] is not None, r["doc_id"], r["text"]))]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder that driver and executors share, as a URI."""
    path = scratch(spark, label)
    if path.startswith("file:/") and not path.startswith("file://"):
        return "file://" + path.removeprefix("file:")
    return path


def store(folder: str):
    """(file system, path in it) of a shared folder, for the tasks that write or read plain files there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)
