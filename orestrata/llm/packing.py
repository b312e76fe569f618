"""Pack documents into as few sequences as possible: large items are matched, small ones best-fit the gaps.

Lengths are whole numbers up to the capacity, so how many pieces there are of each length is all a packing depends on: one
count for each length is gathered, bounded by the capacity whatever the corpus. On these counts:

* pieces as long as the capacity fill a sequence each;
* large pieces, longer than a third of it, go at most two to a sequence: the longest is matched with the longest other
  large piece that still fits, all equal pairs in one step;
* smaller pieces, the longest first, go into the tightest gap that takes them, as many as it takes; only when no gap is
  left, a new sequence begins.

The outcome is a list of slots, "pieces number a to b of length n, k to a sequence, from sequence s on, at offset o". Each
piece gets its number among those of its length from counts of ranges, and looks its place up; no text moves.

Defined results: null text is empty, so such a document is its end id only; longer documents are cut into pieces of the
capacity, the last may be shorter; repeated rows and equal doc_ids are packed once each; an empty table gives no rows.
Other columns are not looked at.
"""
from __future__ import annotations

import bisect
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orestrata.llm.common import ROW_BITS, text_of
from orestrata.llm.tokens import encoder
from orestrata.session import in_arrow, literal_rows, staged

CAPACITY = 2048
#: Words and pieces that a worker keeps; fewer than alone, as packing ends a pipeline whose executors hold much already.
CACHED_WORDS = 400_000
Slot = tuple[int, int, int, int, int, int]


def plan_slots(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Slot], int]:
    """Slots (length, first piece, end piece, pieces a sequence, first sequence, offset) and the number of sequences.

    Sequences with the same gap are kept as runs of consecutive numbers; a step takes whole runs or a part of one."""
    left = {n: c for n, c in counts.items() if c > 0}
    used: dict[int, int] = defaultdict(int)
    slots: list[Slot] = []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap: runs of (first sequence, how many)
    open_gaps: list[int] = []  # ascending
    made = 0

    def place(length: int, per: int, first: int, n_pieces: int, offset: int) -> None:
        slots.append((length, used[length], used[length] + n_pieces, per, first, offset))
        used[length] += n_pieces
        left[length] -= n_pieces
        if not left[length]:
            del left[length]

    def leave(gap: int, first: int, n: int) -> None:
        if gap and n:
            if not gaps[gap]:
                bisect.insort(open_gaps, gap)
            gaps[gap].append((first, n))

    def fill(length: int, first: int, n: int, gap: int) -> int:
        """Put pieces into sequences first..first+n-1, as many as their gap takes; the number of sequences touched."""
        per, have = gap // length, left[length]
        whole = min(n, have // per)
        if whole:
            place(length, per, first, whole * per, capacity - gap)
            leave(gap - per * length, first, whole)
        rest = have - whole * per
        if whole < n and rest:
            place(length, rest, first + whole, rest, capacity - gap)
            leave(gap - rest * length, first + whole, 1)
            whole += 1
        return whole

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for length in large:
        while length in left:
            fits = [m for m in large if m in left and m <= capacity - length and (m != length or left[m] > 1)]
            if fits:
                mate = max(fits)
                n = left[length] // 2 if mate == length else min(left[length], left[mate])
                if mate == length:
                    place(length, 2, made, 2 * n, 0)
                else:
                    place(length, 1, made, n, 0)
                    place(mate, 1, made, n, length)
                leave(capacity - length - mate, made, n)
            else:
                n = left[length]
                place(length, 1, made, n, 0)
                leave(capacity - length, made, n)
            made += n
    for length in sorted(left, reverse=True):
        while length in left:
            at = bisect.bisect_left(open_gaps, length)
            if at == len(open_gaps):
                per = capacity // length
                n = -(-left[length] // per)
                fill(length, made, n, capacity)
                made += n
                continue
            gap = open_gaps[at]
            first, n = gaps[gap].pop()
            if not gaps[gap]:
                del open_gaps[at]
            touched = fill(length, first, n, gap)
            leave(gap, first + touched, n - touched)
    return slots, made


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and the ids, little-endian unsigned 32-bit) of every document's pieces."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, step = struct.pack("<I", end_id), 4 * capacity
        encode = encoder(tokenizer, cached=CACHED_WORDS).encode_bytes
        for batch in batches:
            out: list[list] = [[] for _ in range(5 + with_ids)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = encode(text) + end
                for piece, at in enumerate(range(0, len(raw), step)):
                    ids = raw[at : at + step]
                    for column, value in zip(out, (doc_id, piece, at // 4, len(ids) // 4, zlib.crc32(ids), ids)):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], schema.replace(" long", "").replace(" int", "").replace(" binary", "").split(", "))

    return docs.select("doc_id", text_of().alias("text")).transform(in_arrow, cut, schema)


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with a column ``length`` from 1 to the capacity) with sequence_id and offset."""
    spark = pieces.sparkSession
    names = pieces.columns
    rows = staged(spark, pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    rows = rows.withColumn("_part", F.shiftright("_row", ROW_BITS))
    # one row for each length and part of the input
    parts = staged(spark, rows.groupBy("_part", "length").agg(F.count("*").alias("n")), "piece-counts")
    counts = parts.groupBy("length").agg(F.sum("n").alias("n"))
    slots, _ = plan_slots({r["length"]: r["n"] for r in counts.collect()}, capacity)
    places = literal_slots(spark, slots)
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("length", "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_part", "length").orderBy("_row")
    numbered = rows.withColumn("_in", F.row_number().over(inside) - 1).join(bases, ["_part", "length"])
    number = F.col("_base") + F.col("_in")
    hit = (F.col("length") == F.col("_length")) & (number >= F.col("_from")) & (number < F.col("_end"))
    # slots are bounded by the capacity: a few for each length
    placed = numbered.join(F.broadcast(places), hit).withColumn("_n", number - F.col("_from"))
    return placed.select(
        *names,
        (F.col("_first") + F.floor(F.col("_n") / F.col("_per"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + F.col("_n") % F.col("_per") * F.col("length")).cast("long").alias("offset"),
    )


def literal_slots(spark, slots: list[Slot]) -> DataFrame:
    schema = "_length long, _from long, _end long, _per long, _first long, _offset long"
    if len(slots) < 64:
        return literal_rows(spark, slots, schema)
    table = pa.table({f"c{i}": pa.array([s[i] for s in slots], pa.int64()) for i in range(6)})
    return spark.createDataFrame(table).toDF(*[f.split()[0] for f in schema.split(", ")])


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    return place_pieces(cut_pieces(docs, tokenizer, capacity, end_id, with_ids), capacity)


def op4_packing(spark, sf_dir):
    import public_tokenizers

    from orestrata.llm.common import table

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
