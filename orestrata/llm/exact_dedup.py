"""Exact duplicates by a tree merge of sorted digest runs.

Every input partition is one run: its digests, sorted, each with the identifier that stays and a count. In each round
``FAN_IN`` neighbouring runs (three binomial rounds at once) merge into one, which keeps one entry for each text; rows
travel only as digests, and a copy that was merged travels no further. A run is dealt over tasks by digest, so that the
last run, which holds every distinct text, is as parallel as the first. The answer goes back down the same tree: an
entry asks the run that it went into, so no task ever gets more rows of one text than one partition of the input held.

An entry's identity is its SHA-256 together with the byte length and a second hash of the text, compared at every level.

Defined results: null text is empty text; a null doc_id is smaller than any other; of rows with the same text and the
same doc_id one stays (the last read); an empty table gives no rows. Other columns are not looked at.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orestrata.llm.common import ROW_BITS, lower_ascii, text_of, with_rows
from orestrata.session import staged
from orestrata.sources.sizing import broadcast_within

FAN_IN_BITS = 3
IDENTITY = ["digest", "n_bytes", "second"]


def digested(docs: DataFrame, label: str = "digests", row: str | None = None) -> DataFrame:
    """One small row for each document, stored: doc_id, its row and run in the input, and its identity. ``row`` names a
    column of with_rows() that has the row; without it rows are numbered here."""
    text = lower_ascii(text_of())
    number = F.col(row) if row else F.monotonically_increasing_id()
    rows = docs.select(F.col("doc_id"), number.alias("row"), text.alias("_text")).select(
        "doc_id",
        F.unhex(F.sha2("_text", 256)).alias("digest"),
        F.octet_length("_text").alias("n_bytes"),
        F.xxhash64("_text").alias("second"),
        "row",
    )
    return staged(docs.sparkSession, rows, label).withColumn("run", F.shiftright("row", ROW_BITS))


def exact_groups(docs: DataFrame, keep: str = "largest", row: str | None = None) -> DataFrame:
    """One row for each document: doc_id, row, digest, the doc_id that stays, the group's size and whether it stays itself.
    ``row`` names the column of with_rows(), if ``docs`` has it."""
    spark = docs.sparkSession
    best = {"largest": F.max, "smallest": F.min}[keep]
    rows = digested(docs, row=row)
    runs = (rows.agg(F.max("run")).first()[0] or 0) + 1
    entry = F.struct("doc_id", "row")
    levels = [
        rows.groupBy("run", *IDENTITY).agg(best(entry).alias("best"), F.count("*").alias("n"))
        .sortWithinPartitions("run", *IDENTITY)
    ]
    while runs > 1:
        levels[-1] = staged(spark, levels[-1], "run")
        merged = levels[-1].withColumn("run", F.shiftright("run", FAN_IN_BITS)).groupBy("run", *IDENTITY)
        levels.append(merged.agg(best("best").alias("best"), F.sum("n").alias("n")).sortWithinPartitions("run", *IDENTITY))
        runs = -(-runs // (1 << FAN_IN_BITS))
    answer = levels.pop()
    while levels:
        lower = levels.pop().select("run", *IDENTITY).withColumn("into", F.shiftright("run", FAN_IN_BITS))
        answer = lower.join(answer.withColumnRenamed("run", "into"), ["into", *IDENTITY]).drop("into")
    return rows.join(answer, ["run", *IDENTITY]).select(
        "doc_id",
        "row",
        "digest",
        F.col("best.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("best.row") == F.col("row")).alias("kept"),
    )


def without_copies(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """The documents that stay, with all their columns: one row of each text, whatever its doc_id. Texts move only if the
    numbers of the rows that go are too many to broadcast."""
    numbered, row = with_rows(docs)
    gone = staged(docs.sparkSession, exact_groups(numbered, keep, row).filter("NOT kept").select(F.col("row").alias(row)), "copies")
    return numbered.join(broadcast_within(gone), row, "left_anti").select(*[numbered[c] for c in docs.columns])


def op1_exact_dedup(spark, sf_dir):
    from orestrata.llm.common import table

    return exact_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


OP1_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
  FROM documents
)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY h) AS keep_id,
       count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY h) AS kept,
       h AS text_sha256
FROM d
"""
