"""Contiguous shards of nearly equal bytes: global prefix sums from the totals of partitions, cut at equal targets.

Documents are range-sorted by doc_id. Each range adds up its bytes; the ranges' totals (one row each) become offsets,
and a document's middle byte in the whole corpus says which of the equal byte targets it falls into. A shard is thus a
run of neighbouring documents, and is off its target by half a document at each end at most. No text moves for the plan.

Defined results: a null text has no bytes and still counts 1; null doc_ids come first; ties in doc_id are ordered by
size, then by checksum, then as stored; an empty table gives no rows. Other columns are not looked at.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orestrata.llm.common import staged_in_order, with_rows

SHARDS = 8


def shard_plan(docs: DataFrame, shards: int = SHARDS, row: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (place in the shard) of each document. If ``row`` names the column of
    with_rows(), also row."""
    spark = docs.sparkSession
    number = ["row"] if row else []
    sized = docs.select(
        *[F.col(row).alias(c) for c in number],
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    order = [F.col("doc_id").asc_nulls_first(), F.col("size").asc(), F.col("text_crc32").asc()]
    rows = staged_in_order(sized, order, "shard-order")
    # one row for each range of the sort
    ranges = rows.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
    )
    total = ranges.agg(F.sum("bytes")).first()[0] or 1
    inside = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        rows.withColumn("_to", F.sum("size").over(inside))
        .join(F.broadcast(offsets), "part")
        .select(
            *number,
            "doc_id",
            "size",
            "text_crc32",
            F.least(
                F.lit(shards - 1),
                F.floor((2 * (F.col("bytes_before") + F.col("_to")) - F.col("size")) * shards / F.lit(2.0 * total)),
            ).cast("int").alias("shard"),
            (F.col("rows_before") + F.col("at")).alias("_rank"),
        )
    )
    from orestrata.session import staged

    placed = staged(spark, placed, "shard-places")
    firsts = placed.groupBy("shard").agg(F.min("_rank").alias("_first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        *number, "doc_id", "size", "text_crc32", "shard", (F.col("_rank") - F.col("_first")).alias("slot")
    )


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS) -> DataFrame:
    """Write the documents below ``folder``, a folder for each shard with its rows in slot order; returns the plan.
    Rows are told apart by a stored number, whatever their doc_id."""
    numbered, row = with_rows(docs)
    plan = shard_plan(numbered, shards, row)
    places = plan.select(F.col("row").alias(row), F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    placed = numbered.join(places, row).drop(row)
    (
        placed.repartitionByRange("_shard", "_slot").sortWithinPartitions("_shard", "_slot").drop("_slot")
        .write.partitionBy("_shard").parquet(folder)
    )
    return plan.drop("row")


def op10_byte_shards(spark, sf_dir):
    from orestrata.llm.common import table

    return shard_plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
