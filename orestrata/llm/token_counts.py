"""Token counts of documents in flat files of token ids that have no index, found by their end-of-document ids.

A flat file is nothing but ids (unsigned 16-bit, little endian), each document followed by the end id, which no text can
produce. The scan cuts files into blocks regardless of documents; a task looks for the end id in a whole block at once
with numpy and reports where the ends are. A prefix scan over the blocks of a file (one row each) then says how many
documents ended before a block and where the last one did, which numbers a block's documents and completes its first.

Defined results: null text is empty and has 0 tokens (its end id isn't counted); repeated rows and equal doc_ids are
documents of their own; null doc_ids stay null; an empty table gives no files and no rows. Other columns are not
looked at.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orestrata.llm.common import new_folder, store, text_of
from orestrata.llm.tokens import encoder
from orestrata.session import in_arrow, staged

#: Fixed value: <|endoftext|> of the vocabulary.
END_ID = 49407
BLOCK_BYTES = 4 * 1024 * 1024


def write_flat_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write all documents' ids below ``folder``; one row for each document: file, ordinal (its place in it), doc_id.
    A file has a name of its own for each attempt of its task; the returned table, which Spark commits, says which count."""
    files, root = store(folder)
    files.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the end id marks ends only, whatever a text says
        encode, out, n = encoder(tokenizer, plain=True).encode_bytes, None, 0
        end = np.array([end_id], "<u2").tobytes()
        for batch in batches:
            if batch.num_rows and out is None:
                files, root = store(folder)
                name = f"{uuid.uuid4().hex}.ids"
                out = files.open_output_stream(f"{root}/{name}")
            for text in batch.column(1).to_pylist():
                out.write(np.frombuffer(encode(text), "<u4").astype("<u2").tobytes() + end)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * batch.num_rows, pa.string()), pa.array(range(n, n + batch.num_rows), pa.int64()), batch.column(0)],
                ["file", "ordinal", "doc_id"],
            ) if batch.num_rows else pa.RecordBatch.from_pylist([], pa.schema([("file", pa.string()), ("ordinal", pa.int64()), ("doc_id", pa.int64())]))
            n += batch.num_rows
        if out is not None:
            out.close()

    rows = docs.select("doc_id", text_of().alias("text")).transform(in_arrow, write, "file string, ordinal long, doc_id long")
    return staged(docs.sparkSession, rows, "flat-rows")


def scan_flat_files(files: DataFrame, folder: str, end_id: int = END_ID, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``file, ordinal, n_tokens`` of every document in ``files`` (a column ``file``), from the files' ids alone."""
    spark = files.sparkSession

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files, root = store(folder)
            names = batch.column(0).to_pylist()
            sized = [files.get_file_info(f"{root}/{n}").size for n in names]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sized, pa.int64())], ["file", "n_bytes"])

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, at, size in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                files, root = store(folder)
                with files.open_input_file(f"{root}/{name}") as source:
                    ids = np.frombuffer(source.read_at(min(block_bytes, size - at), at), "<u2")
                found = np.flatnonzero(ids == end_id) + at // 2
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name], pa.string()), pa.array([at], pa.int64()), pa.array([found], pa.list_(pa.int64()))],
                    ["file", "at", "ends"],
                )

    sized = files.select("file").distinct().transform(in_arrow, sizes, "file string, n_bytes long")
    blocks = sized.filter("n_bytes > 0").select(
        "file", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_bytes") - 1, F.lit(block_bytes).cast("long"))).alias("at"), "n_bytes"
    )
    blocks = staged(spark, blocks, "blocks")
    n = max(1, blocks.count())
    found = staged(spark, blocks.repartition(min(n, 16 + n // 4)).transform(in_arrow, ends, "file string, at long, ends array<long>"), "block-ends")
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    stitched = found.select(
        "file",
        "ends",
        F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)).alias("base"),
        F.coalesce(F.max(F.try_element_at("ends", F.lit(-1))).over(before), F.lit(-1)).alias("last"),
    ).filter(F.size("ends") > 0)
    starts = F.concat(F.array("last"), F.slice("ends", 1, F.size("ends") - 1))
    return stitched.select("file", "base", F.posexplode(F.zip_with("ends", starts, lambda e, s: e - s - 1))).select(
        "file", (F.col("base") + F.col("pos")).alias("ordinal"), F.col("col").alias("n_tokens")
    )


def token_counts(docs: DataFrame, folder: str, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens (without the end id) and the file and ordinal of every document."""
    rows = write_flat_files(docs, folder, tokenizer)
    return rows.join(scan_flat_files(rows, folder), ["file", "ordinal"])


def op9_token_counts(spark, sf_dir):
    import public_tokenizers

    from orestrata.llm.common import table

    folder = new_folder(spark, "flat-tokens")
    counts = token_counts(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return counts.select("doc_id", "n_tokens")
