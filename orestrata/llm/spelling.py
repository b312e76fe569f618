"""Spelling variants of words, found by blocked Gram matrices of letter counts.

1. **Words.** Maximal runs of letters are counted in the tasks that read them, a table of counts at a time, and added up by
   word. One in ``SLIP_RATE`` runs of a document loses a letter first, chosen by a checksum of document and run.
2. **Blocks.** A word's letter counts c say how near another can be: one replaced letter changes the squared distance
   |c - d|^2 by at most two (one letter less, another more) at the same length, one deleted letter by one at the next
   length. Blocks hold words of one length with the same sums of counts over ``GROUPS`` groups of letters; as a word
   differs from a near one by one letter, their sums differ by one in one group (adjacent lengths) or in two (the same
   length), so a block has a known, fixed number of blocks to look at. A block is dealt by hash into tiles of about
   ``TILE_WORDS`` words, so no task holds a block.
3. **Gram matrices.** For two tiles A and B of counts, |a|^2 + |b|^2 - 2 A B^T gives all squared distances in one NumPy
   product; pairs at most two apart (two at equal, one at adjacent lengths) are kept and their letters compared.
4. **Forms.** A word's form is the near word of the largest count, ties by code points, if it is at least ``OFTEN``
   times as frequent; a root is reached by doubling steps along forms, which only ever go to more frequent words.

The tiles decide how the work is cut, never what is near: every pair of words one edit apart lies in one pair of tiles.

Defined results: null and empty texts have no runs; a null doc_id counts as empty text in the checksum; repeated rows count
once each; a word without near words has n_near 0, no form and is its own root; an empty table gives no rows. Other columns
are not looked at.
"""
from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orestrata.llm.common import text_of
from orestrata.session import in_arrow, staged
from orestrata.sources.sizing import broadcast_within

#: The contract's letters, least length and count, rate of slips and how much more frequent a form is.
LETTERS = "A-Za-z\\u00C0-\\u00FF"
LEAST_CHARS = 6
LEAST_COUNT = 5
SLIP_RATE = 199
OFTEN = 5
GROUPS = 6
TILE_WORDS = 1024
TILE_CHARS = 1 << 20
#: Words that a task counts before it passes them on.
HELD_WORDS = 400_000
#: Squares of counts are exact in single precision up to this length.
SINGLE = 2048


def runs_of(doc_id: int | None, text: str, find, slip_rate: int = SLIP_RATE, least: int = LEAST_CHARS) -> Iterator[tuple[str, int]]:
    """(word, occurrences) of one text, after slips; A-Z in lower case."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    lowered = text.lower() if text.isascii() else text.encode().lower().decode()
    for run, n in Counter(find(lowered)).items():
        h = zlib.crc32(run.encode(), start)
        if h % slip_rate == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < least:
                continue
        yield run, n


def word_counts(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, slip_rate: int = SLIP_RATE) -> DataFrame:
    """(word, n) of every word of at least so many characters and occurrences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a shorter run gives no word, with or without a slip
        find = re.compile(f"[{LETTERS}]{{{least_chars},}}").findall
        held: dict[str, int] = {}

        def passed_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held, pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                ids, texts = (batch.column(i).slice(at, 256).to_pylist() for i in (0, 1))
                for doc_id, text in zip(ids, texts, strict=True):
                    for word, n in runs_of(doc_id, text, find, slip_rate, least_chars):
                        held[word] = held.get(word, 0) + n
                if len(held) > HELD_WORDS:
                    yield passed_on()
                    held.clear()
        yield passed_on()

    counted = docs.select("doc_id", text_of().alias("text")).transform(in_arrow, count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def letter_sums(groups: int = GROUPS) -> Column:
    """How many letters of each group the word has; a letter's group is its code point modulo the number of groups."""
    members = ["" for _ in range(groups)]
    for code in (*range(0x61, 0x7B), *range(0xC0, 0x100)):
        members[code % groups] += chr(code)
    return F.array(*[F.length("word") - F.length(F.translate("word", m, "")) for m in members])


def tiles_of(words: DataFrame, groups: int = GROUPS, tile_words: int = TILE_WORDS, tile_chars: int = TILE_CHARS) -> DataFrame:
    """Stored: (block, tile, words, counts). ``block`` is the array of letter sums, whose total is the length."""
    spark = words.sparkSession
    placed = staged(spark, words.withColumn("block", letter_sums(groups)), "blocked")
    size = F.length("word").cast("bigint")
    # one row for each block
    dealt = placed.groupBy("block").agg(
        F.greatest(F.ceil(F.count("*") / tile_words), F.ceil(F.sum(size) / tile_chars)).alias("tiles")
    )
    in_tile = F.pmod(F.xxhash64("word"), F.col("tiles"))
    tiled = placed.join(broadcast_within(staged(spark, dealt, "tiles-of")), "block").groupBy("block", in_tile.alias("tile"))
    # the hash deals a block evenly, so a group here is about a tile's size whatever the block's
    return staged(spark, tiled.agg(F.collect_list("word").alias("words"), F.collect_list("n").alias("counts")), "tiles")


def neighbours(groups: int = GROUPS) -> Column:
    """The blocks that a block is compared with: itself, those of the same length with one letter moved to a later group (the
    others look at it in turn), and those of one letter less."""
    block = F.col("block")

    def changed(steps: dict[int, int]) -> Column:
        return F.array(*[block[g] + steps.get(g, 0) for g in range(groups)])

    moved = [changed({a: -1, b: 1}) for a in range(groups) for b in range(a + 1, groups)]
    return F.array(block, *moved, *[changed({a: -1}) for a in range(groups)])


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The letters of words of one length (each is one byte in Latin-1), and how often each letter occurs in each word."""
    letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)
    n, length = letters.shape
    place = np.repeat(np.arange(n), length) * 256 + letters.ravel()
    counts = np.bincount(place, minlength=n * 256).reshape(n, 256)
    kept = np.r_[0x61:0x7B, 0xC0:0x100]
    return letters, counts[:, kept].astype(np.float32 if length < SINGLE else np.float64)


def near_in_tiles(a: list[str], b: list[str], same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) of words of ``a`` and ``b`` that one edit parts; the words of ``b`` are as long as those of ``a``
    or one letter shorter. ``same``: both are the same tile, each pair is given once."""
    (x, p), (y, q) = _codes(a), _codes(b)
    apart = (p * p).sum(1)[:, None] + (q * q).sum(1)[None, :] - 2 * (p @ q.T)
    equal = x.shape[1] == y.shape[1]
    i, j = np.nonzero(apart == (2 if equal else 1))
    if same:
        i, j = i[i < j], j[i < j]
    good = np.zeros(len(i), bool)
    step = max(1, (1 << 24) // x.shape[1])
    for at in range(0, len(i), step):
        u, v = x[i[at : at + step]], y[j[at : at + step]]
        if equal:
            good[at : at + step] = (u != v).sum(1) == 1
        else:
            # up to some place the letters agree, from there on with the next letter of the longer word
            differ, shifted = u[:, :-1] != v, u[:, 1:] != v
            n = v.shape[1]
            first = np.where(differ.any(1), differ.argmax(1), n)
            last = np.where(shifted.any(1), n - 1 - shifted[:, ::-1].argmax(1), -1)
            good[at : at + step] = last < first
    return i[good], j[good]


def near_words(tiles: DataFrame, groups: int = GROUPS) -> DataFrame:
    """(word, n, near, near_n) for every ordered pair of words that one edit parts."""
    schema = "word string, n long, near string, near_n long"

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                a, n_a, b, n_b, same = (c[at].as_py() for c in batch.columns)
                i, j = near_in_tiles(a, b, same)
                if len(i):
                    u, v = pa.array(a).take(pa.array(i)), pa.array(b).take(pa.array(j))
                    n, m = pa.array(n_a, pa.int64()).take(pa.array(i)), pa.array(n_b, pa.int64()).take(pa.array(j))
                    both = [pa.concat_arrays(c) for c in ((u, v), (n, m), (v, u), (m, n))]
                    yield pa.RecordBatch.from_arrays(both, ["word", "n", "near", "near_n"])

    asking = tiles.select(F.col("block").alias("own"), F.col("tile").alias("own_tile"), "words", "counts", F.explode(neighbours(groups)).alias("block"))
    asked = tiles.select("block", "tile", F.col("words").alias("others"), F.col("counts").alias("other_counts"))
    # within a block, of two tiles the one with the smaller number asks
    pairs = asking.join(asked, "block").filter("own <> block OR own_tile <= tile")
    return pairs.select("words", "counts", "others", "other_counts", F.expr("own = block AND own_tile = tile").alias("same")).transform(in_arrow, compare, schema)


def with_roots(forms: DataFrame) -> DataFrame:
    """``forms`` (word, form, ..) with root: the last word on the way along forms. Each round doubles the steps taken."""
    spark = forms.sparkSession
    steps = staged(spark, forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "steps")
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        far = staged(spark, steps.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "steps")
        steps = far.drop("moved")
        if far.filter("moved").isEmpty():
            break
    return forms.join(steps, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_forms(docs: DataFrame, often: int = OFTEN, groups: int = GROUPS, **options) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word of the documents."""
    spark = docs.sparkSession
    words = staged(spark, word_counts(docs, **options), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    near = near_words(tiles_of(words, groups), groups).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    enough = -F.col("best.less") >= often * F.col("n")
    forms = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"),
        F.when(enough, -F.col("best.less")).alias("form_n"),
    )
    return with_roots(staged(spark, forms, "forms"))


def op11_spelling_variants(spark, sf_dir):
    from orestrata.llm.common import table

    return spelling_forms(table(spark, sf_dir, "documents"))
