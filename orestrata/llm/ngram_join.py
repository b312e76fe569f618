"""Exact Jaccard self-join on word n-grams with a token-group matrix, and its connected components.

Two documents link when their sets of distinct five-word shingles share at least 75 % of their union. Texts with equal sets
are one class; classes are what is joined. A shingle is a token, held as its 64-bit hash, a class as the hash of its set.

1. **Groups.** Classes whose min-hashes agree (four pairs of them) are compared with the first of their group; those that
   truly link become one group of similar documents. All other classes are groups of their own.
2. **Matrix.** Tokens are put in one order for all documents: from rare to frequent by counts of tokens with the same hash in
   ``ORDERED`` places, which don't depend on how documents are dealt to tasks but for copies, and by hash where counts are equal. Sets of n and m <= n tokens
   that link share at least 3 (n + m) / 7 tokens, so the first that they share stands at a place i of the one and j of the
   other (from 0) with 7 i <= 4 n - 3 m and 7 j <= 4 m - 3 n: within the first quarter of the larger and the first seventh of
   the smaller. Only these places are stored, and only tokens that at least two classes have.
3. **Rounds.** Groups grow before they are compared with each other. In a round each token that several groups have names one
   holder, of the largest of them and in which the token stands first; every other class that has the token within reach is
   compared with that one holder, links merge groups, and tokens of one group only are put aside. A round makes at most as
   many pairs as there are rows. Rounds go on as long as they merge groups, and leave clearly fewer rows or more meetings of
   classes with other groups in step 4 than there are rows.
4. **Bound and open.** For the groups that are left the matrix stores the union of their members' first sevenths, with the
   least size and the furthest reach 4 m - 7 j of a token. A class asks with its own first quarter. If none of it lies within
   reach in a group's union, its overlap with any member stays below what a link needs, and the group stays shut. A group
   that qualifies is opened at the tokens that were hit: first for a few members, and where that did not make the two groups
   one component, for all members that have such a token within reach.

Pairs are bounded once more by sketches: a sketch has a bit for the parity of the tokens in each of its places, so two sets
differ in as many tokens as their sketches differ in bits, at least. What passes is compared token by token.

The order, the min-hashes, the holders and the groups decide how much is compared, never what links: step 4 looks at every
class against every group but its own. Links are turned into components by alternating star contraction, also exact.

Defined results: a text with fewer than five words has its whole sequence as one shingle; null, empty and blank texts have
no shingle and stand alone; component_id is the smallest doc_id of a component, null ids last; repeated rows are linked like
any equal texts; an empty table gives no rows. Other columns are not looked at.

64-bit hashes stand for tokens and classes. A second hash and the size of each class's set are compared over the whole corpus:
should two sets share the first hash, all is done again with other hashes.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orestrata.llm.common import keeps_cache, own_caches, text_of, with_rows
from orestrata.session import in_arrow, staged
from orestrata.sources.sizing import broadcast_within

WORDS = 5
#: Places in which tokens are counted by hash, in as many slices; four bytes each in every task.
ORDERED = 1 << 21
SLICES = 64
#: Least bits of the sketch of a set; a set of more tokens has the next power of two.
SKETCH_BITS = 2048
SIGNATURES = 4
#: Rounds end when more than this share of the rows is left.
LEFT = 0.9
#: Bits of the filter that spares texts nobody asks for; its size is fixed, a full one only lets more through.
FILTER_BITS = 1 << 23
CACHED_WORDS = 150_000
#: Characters of text that are split into words at once, and tokens after which a task forgets the sets it has counted.
CHUNK_CHARS = 1_000_000
COUNTED_TOKENS = 1_500_000
#: Pairs of sets that are compared at once.
PAIRS = 256
U = np.uint64


class _Words(dict):
    """Hashes of words, as they are met."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        got = self[word] = xxhash.xxh64_intdigest(word)
        return got


_WORDS = _Words()
keeps_cache("words", _WORDS)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A public finaliser of 64-bit hashes (splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


#: Factors of the words of a shingle by their place: odd, without a pattern.
FACTORS = [_mixed(np.array([2 * i + 3], U))[0] | U(1) for i in range(WORDS)]


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    own_caches("words")
    if len(_WORDS) > CACHED_WORDS:
        _WORDS.clear()
    split = [(t or "").encode().lower().split() for t in texts]
    ends = np.cumsum([len(w) for w in split])
    flat = np.fromiter(map(_WORDS.__getitem__, chain.from_iterable(split)), U, int(ends[-1]) if len(ends) else 0)
    padded = np.concatenate([flat, np.zeros(WORDS, U)])
    with np.errstate(over="ignore"):
        # words are mixed once, places by odd factors
        mixed = _mixed(padded + U(1))
        total = np.zeros(len(flat), U)
        for i, factor in enumerate(FACTORS):
            total += mixed[i : i + len(flat)] * factor
        whole = _mixed(total)
        sets = []
        for words, end in zip(split, ends.tolist(), strict=True):
            n = len(words)
            if n >= WORDS:
                sets.append(np.unique(whole[end - n : end - WORDS + 1]))
            else:
                short = sum((mixed[end - n + i : end - n + i + 1] * FACTORS[i] for i in range(n)), np.full(1, n, U))
                sets.append(_mixed(short) if n else np.zeros(0, U))
    return sets


def class_key(tokens: np.ndarray, seed: int) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(tokens.tobytes(), seed)


def _chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``CHUNK_CHARS`` characters, one row at least."""
    sizes = np.nan_to_num(pc.utf8_length(texts).to_numpy(zero_copy_only=False)).astype(np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK_CHARS, side="right")))
        yield at, stop
        at = stop


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    starts = np.cumsum([0] + [len(s) for s in sets])
    return (np.concatenate(sets) if sets else np.zeros(0, U)), starts


def _sketches(sets: list[np.ndarray]) -> Iterator[bytes]:
    """A bit for each place, of at least SKETCH_BITS and as many as the set has tokens: the parity of the tokens there."""
    for s in sets:
        bits = max(SKETCH_BITS, 1 << (len(s) - 1).bit_length()) if len(s) else SKETCH_BITS
        n = np.bincount((s % U(bits)).astype(np.int64), minlength=bits)
        yield np.packbits((n & 1).astype(np.uint8)).tobytes()


def _apart(a: bytes, b: bytes) -> int:
    """In how many bits two sketches differ. The longer one is folded to the length of the shorter, which gives the sketch
    that its set would have there."""
    x, y = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x.view(U) ^ y.view(U)).sum())


def described(docs: DataFrame, row: str | None = None, seed: int = 0) -> DataFrame:
    """Stored: of each document doc_id, row (null unless ``row`` names its column), n_shingles, key (its class), second (another hash of its
    set) and min-hash signatures; besides, for each task, rows with a ``slice`` of the places and its ``counts`` of tokens in the task's distinct sets."""
    schema = "doc_id long, row long, n int, key long, second long, sigs array<long>, sketch binary, slice int, counts binary"
    names = ["doc_id", "row", "n", "key", "second", "sigs", "sketch", "slice", "counts"]
    sig_list = pa.list_(pa.int64())

    def one_chunk(ids: pa.Array, numbers: pa.Array, sets: list[np.ndarray], keys: np.ndarray) -> pa.RecordBatch:
        second = np.array([class_key(s, ~seed & (2**64 - 1)) for s in sets], U)
        sizes = np.array([len(s) for s in sets], np.int32)
        sigs = np.zeros((len(sets), SIGNATURES), U)
        some = np.flatnonzero(sizes)
        if len(some):
            tokens, starts = _flat([sets[i] for i in some])
            with np.errstate(over="ignore"):
                for s in range(SIGNATURES):
                    seeds = (U(0x9E3779B97F4A7C15 * (2 * s + k + 1) & (2**64 - 1)) for k in (0, 1))
                    # tokens are mixed already: another factor gives another order
                    a, b = (np.minimum.reduceat((tokens ^ by) * (_mixed(np.array([by]))[0] | U(1)), starts[:-1]) for by in seeds)
                    sigs[some, s] = _mixed(a * U(3) + b)
        n = len(sets)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * SIGNATURES, SIGNATURES, dtype=np.int32)), _signed(sigs.ravel()))
        sketches = pa.array(list(_sketches(sets)), pa.binary())
        return pa.RecordBatch.from_arrays(
            [ids, numbers, pa.array(sizes), _signed(keys), _signed(second), lists, sketches, pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names
        )

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(ORDERED, np.uint32)
        met: set[int] = set()
        n = 0
        for batch in batches:
            for at, stop in _chunks(batch.column(2)):
                sets = shingle_sets(batch.column(2)[at:stop].to_pylist())
                keys = [class_key(s, seed) for s in sets]
                yield one_chunk(batch.column(0)[at:stop], batch.column(1)[at:stop], sets, np.array(keys, U))
                own = [s for s, k in zip(sets, keys, strict=True) if not (k in met or met.add(k))]
                where, times = np.unique(np.concatenate([*own, np.zeros(0, U)]) % U(ORDERED), return_counts=True)
                counts[where.astype(np.int64)] += times.astype(np.uint32)
                n += sum(map(len, sets))
                if n > COUNTED_TOKENS:
                    n = 0
                    met.clear()
        some = [(i, c) for i, c in enumerate(np.split(counts, SLICES)) if c.any()]
        m = len(some)
        nothing = [pa.nulls(m, kind) for kind in (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), sig_list, pa.binary())]
        small = [np.minimum(c, 65_535).astype("<u2").tobytes() for _, c in some]
        yield pa.RecordBatch.from_arrays([*nothing, pa.array([i for i, _ in some], pa.int32()), pa.array(small, pa.binary())], names)

    number = (F.col(row) if row else F.lit(None)).cast("long").alias("row")
    return staged(docs.sparkSession, docs.select("doc_id", number, "text").transform(in_arrow, describe, schema), "shingles")


def frequent_tokens(rows: DataFrame, most: int = ORDERED) -> np.ndarray:
    """How many tokens fall into each place of their hash, with ``most`` places. Tasks add up slices, which are then put side by side."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[i] = sums.get(i, 0) + np.frombuffer(counts, "<u2").astype(np.uint64)
        whole = [np.minimum(c, U(2**32 - 1)).astype("<u4").tobytes() for c in sums.values()]
        yield pa.RecordBatch.from_pydict({"slice": pa.array(list(sums), pa.int32()), "counts": pa.array(whole, pa.binary())})

    places = np.zeros(ORDERED, np.uint32)
    width = ORDERED // SLICES
    by_slice = rows.filter("slice IS NOT NULL").select("slice", "counts").repartition("slice")
    for row in by_slice.transform(in_arrow, add_up, "slice int, counts binary").toLocalIterator():
        places[row["slice"] * width : (row["slice"] + 1) * width] = np.frombuffer(row["counts"], "<u4")
    if most == ORDERED:
        return places
    folded = np.bincount(np.arange(ORDERED) % most, weights=places, minlength=most)
    return np.minimum(folded, 2**32 - 1).astype(np.uint32)


def matrix_rows(docs: DataFrame, frequent: np.ndarray, seed: int = 0) -> DataFrame:
    """(token, key, packed) of every document's tokens that decide; packed: the set's size above 32 bits, the place below."""
    # a fold of ORDERED places to fewer keeps the place of the place
    places, most = U(ORDERED), U(len(frequent))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in (batch.column(0)[at:stop] for batch in batches for at, stop in _chunks(batch.column(0))):
            sets = {}
            for s in shingle_sets(texts.to_pylist()):
                if len(s):
                    sets[class_key(s, seed)] = s
            if not sets:
                continue
            keys, own = np.array(list(sets), U), list(sets.values())
            tokens, starts = _flat(own)
            sizes = np.diff(starts)
            of = np.repeat(np.arange(len(own)), sizes)
            # within a set from rare to frequent, and by hash where counts are equal
            order = np.lexsort((tokens, frequent[(tokens % places % most).astype(np.int64)], of))
            nth = np.arange(len(tokens)) - np.repeat(starts[:-1], sizes)
            chosen = 4 * nth <= np.repeat(sizes, sizes)
            picked = order[chosen]
            packed = (sizes[of[picked]].astype(np.int64) << 32) + nth[chosen]
            yield pa.RecordBatch.from_arrays([_signed(tokens[picked]), _signed(keys[of[picked]]), pa.array(packed)], ["token", "key", "packed"])

    return docs.select("text").transform(in_arrow, emit, "token long, key long, packed long")


def shared_rows(rows: DataFrame) -> DataFrame:
    """Only the tokens that at least two classes have, each class once, stored: (token, key, n, at). One shuffle by token, one look
    at sorted runs, of which no more than a batch and one row is held."""
    names = ["token", "key", "packed"]

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list[np.ndarray] | None = None  # the last class met, and whether it was given already
        given = False
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy() for c in batch.columns]
            if last is not None:
                columns = [np.concatenate(x) for x in zip(last, columns)]
            token, key = columns[:2]
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1])
            columns = [c[new] for c in columns]
            token = columns[0]
            same = token[1:] == token[:-1]
            shared = np.concatenate([[False], same]) | np.concatenate([same, [False]])
            out = shared.copy()
            out[0] &= not (last is not None and given)
            # only its successor says whether the last class has company
            given = bool(out[-1]) or (len(token) == 1 and last is not None and given)
            last = [c[-1:] for c in columns]
            yield pa.RecordBatch.from_arrays([pa.array(c[out]) for c in columns], names)

    by_token = rows.repartition("token").sortWithinPartitions("token", "key")
    kept = by_token.transform(in_arrow, keep, "token long, key long, packed long")
    unpacked = kept.select("token", "key", F.shiftright("packed", 32).alias("n"), F.col("packed").bitwiseAND((1 << 32) - 1).alias("at"))
    return staged(rows.sparkSession, unpacked, "matrix")


def _filter_of(ids: DataFrame) -> np.ndarray:
    """A bit for the hash of each id. Tasks fill filters of the fixed size, which are then put together."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS, bool)
        for batch in batches:
            for b in _bits(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)):
                bits[b] = True
        yield pa.RecordBatch.from_pydict({"bits": [np.packbits(bits).tobytes()]})

    whole = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in ids.coalesce(4).transform(in_arrow, fill, "bits binary").toLocalIterator():
        whole |= np.frombuffer(row["bits"], np.uint8)
    return whole


def _bits(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        x = _mixed(ids.view(U) + U(1))
    return (x % U(FILTER_BITS)).astype(np.int64), ((x >> U(32)) % U(FILTER_BITS)).astype(np.int64)


def sets_of(docs: DataFrame, wanted: DataFrame, seed: int = 0) -> DataFrame:
    """Stored (key, tokens) of the classes in ``wanted`` (key, doc_id of one member)."""
    wanted = staged(docs.sparkSession, wanted, "wanted")
    filled = _filter_of(wanted.filter("doc_id IS NOT NULL").select("doc_id"))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(filled).astype(bool)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            valid = ~np.asarray(batch.column(0).is_null())
            first, second = _bits(np.nan_to_num(ids).astype(np.int64))
            at = np.flatnonzero(~valid | bits[first] & bits[second])
            texts = batch.column(1).take(pa.array(at))
            for start, stop in _chunks(texts):
                sets = shingle_sets(texts[start:stop].to_pylist())
                keys = np.array([class_key(s, seed) for s in sets], U)
                yield pa.RecordBatch.from_arrays([_signed(keys), pa.array([s.tobytes() for s in sets], pa.binary())], ["key", "tokens"])

    got = docs.select("doc_id", "text").transform(in_arrow, emit, "key long, tokens binary")
    # the filter lets a few others through, and a doc_id may stand on several rows
    exact = got.join(wanted.select("key"), "key", "left_semi").groupBy("key").agg(F.first("tokens").alias("tokens"))
    return staged(docs.sparkSession, exact, "sets")


def bounded(classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """``pairs`` without those that differ in more than a seventh of their tokens by their sketches already: sets of a and b
    tokens that share 75 % of their union differ in (a + b) / 7 tokens at most."""

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*[batch.column(c).to_pylist() for c in (2, 3, 4)], strict=True)
            yield batch.select([0, 1]).filter(pa.array([7 * _apart(x, y) <= size for x, y, size in rows], pa.bool_()))

    known = classes.select("key", "n", "sketch")
    left = known.select(F.col("key").alias("u"), F.col("n").alias("a"), F.col("sketch").alias("x"))
    right = known.select(F.col("key").alias("v"), F.col("n").alias("b"), F.col("sketch").alias("y"))
    full = pairs.join(left, "u").join(right, "v").select("u", "v", "x", "y", (F.col("a") + F.col("b")).cast("long").alias("sum"))
    return full.transform(in_arrow, sift, "u long, v long")


def linked(docs: DataFrame, classes: DataFrame, pairs: DataFrame, seed: int = 0) -> DataFrame:
    """Those of the distinct ``pairs`` (u, v) of classes that link, stored."""
    spark = docs.sparkSession
    pairs = staged(spark, bounded(classes, pairs), "pairs")
    if pairs.isEmpty():
        return pairs
    ends = pairs.select(F.col("u").alias("key")).union(pairs.select(F.col("v").alias("key"))).distinct()
    sets = sets_of(docs, ends.join(classes.select("key", F.col("rep").alias("doc_id")), "key"), seed)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, PAIRS) for b in batches for at in range(0, b.num_rows, PAIRS)):
            keep = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(a, U), np.frombuffer(b, U)
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= 75 * (len(both) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("key").alias("u"), F.col("tokens").alias("a"))
    right = sets.select(F.col("key").alias("v"), F.col("tokens").alias("b"))
    full = pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b")
    return staged(spark, full.transform(in_arrow, compare, "u long, v long"), "links")


def components(edges: DataFrame) -> DataFrame:
    """(key, label) of every end of an edge; label: the smallest key that it reaches. Alternating large and small stars."""
    spark = edges.sparkSession
    pairs = staged(spark, edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "edges")
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = staged(spark, both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = staged(spark, large, "large-star")
        low = staged(spark, large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        after = staged(spark, small.filter("u <> v").distinct(), "edges")
        pairs = after
        # done when every node points once, and to a root: to one that does not point itself
        ends = after.select(F.col("u").alias("k"), F.lit(1).alias("points"), F.lit(0).alias("root")).union(
            after.select(F.col("v").alias("k"), F.lit(0).alias("points"), F.lit(1).alias("root"))
        )
        roles = ends.groupBy("k").agg(F.sum("points").alias("points"), F.max("root").alias("root"))
        if roles.filter("points > 1 OR points + root > 1").isEmpty():
            break
    return pairs.select(F.col("u").alias("key"), F.col("v").alias("label")).union(pairs.select(F.col("v").alias("key"), F.col("v").alias("label"))).distinct()


def similar_pairs(classes: DataFrame) -> DataFrame:
    """Each class with the first one, the smallest, of every signature that they share."""
    signed = classes.select("key", "n", F.posexplode("sigs").alias("which", "sig"))
    own = F.struct("n", "key")
    firsts = signed.groupBy("which", "sig").agg(F.min(own).alias("low"), F.max(own).alias("high")).filter("low <> high")
    firsts = staged(classes.sparkSession, firsts.select("which", "sig", F.col("low.key").alias("other")), "firsts")
    near = signed.join(firsts, ["which", "sig"]).filter("key <> other")
    return near.select(F.least("key", "other").alias("u"), F.greatest("key", "other").alias("v")).distinct()


#: Whether token places i of a set of n and j of one of m tokens can be the first that two linking sets share.
WITHIN = "7 * {i} <= 4 * {n} - 3 * {m} AND 7 * {j} <= 4 * {m} - 3 * {n}"


def labelled(rows: DataFrame, links: DataFrame) -> DataFrame:
    """Stored: ``rows`` (token, key, n, at) with their group grp and its size, by ``links`` so far; only tokens that several groups
    have, with one holder each: of the largest group, and of its classes the one in which the token stands first."""
    spark = rows.sparkSession
    whole = staged(spark, components(links), "groups")
    sizes = staged(spark, whole.groupBy("label").agg(F.count("*").alias("size")), "group-sizes")
    grouped = staged(spark, whole.join(sizes, "label"), "sized-groups")
    known = rows.select("token", "key", "n", "at").join(grouped, "key", "left").select(
        "token", "key", "n", "at", F.coalesce("label", "key").alias("grp"), F.coalesce("size", F.lit(1)).alias("size")
    )
    known = staged(spark, known, "grouped-rows")
    order = F.struct((-F.col("size")).alias("less"), "at", F.col("key").alias("v"), F.col("n").alias("m"), "grp")
    holders = known.groupBy("token").agg(F.min("grp").alias("low"), F.max("grp").alias("high"), F.min(order).alias("holder"))
    holders = staged(spark, holders.filter("low < high").select("token", "holder"), "holders")
    return staged(spark, known.join(holders, "token"), "asks")


def holder_pairs(asks: DataFrame) -> DataFrame:
    """Pairs (u, v) of each class with the holders of its tokens, where the holder is of another group and within reach."""
    fits = WITHIN.format(i="at", n="n", j="holder.at", m="holder.m")
    other = asks.filter(f"grp <> holder.grp AND {fits}")
    return other.select(F.least("key", "holder.v").alias("u"), F.greatest("key", "holder.v").alias("v")).distinct()


def meetings(asks: DataFrame) -> DataFrame:
    """Stored (token, grp, g, low, reach, asking): tokens at which a group meets the union of another group g, as far as the sizes and
    places of its ``asking`` classes that have the token, taken together, tell."""
    spark = asks.sparkSession
    own = asks.groupBy("token", "grp").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max(F.expr("4 * n - 7 * at")).alias("gives"), F.count("*").alias("asking")
    )
    union = asks.filter("7 * at <= n").groupBy("token", "grp").agg(F.min("n").alias("low"), F.max(F.expr("4 * n - 7 * at")).alias("reach"))
    union = staged(spark, union.withColumnRenamed("grp", "g"), "unions")
    within = "grp <> g AND low <= most AND 3 * least <= reach AND 3 * low <= gives"
    return staged(spark, own.join(union, "token").filter(within).select("token", "grp", "g", "low", "reach", "asking"), "meetings")


def hits_of(asks: DataFrame, met: DataFrame) -> DataFrame:
    """Stored hits (u, grp, g, token, n, at): tokens of class u of group grp hit the union of another group g within reach."""
    within = "low <= n AND 3 * n <= reach AND 3 * low <= 4 * n - 7 * at"
    hits = asks.select(F.col("key").alias("u"), "grp", "token", "n", "at").join(met, ["token", "grp"]).filter(within)
    return staged(asks.sparkSession, hits.select("u", "grp", "g", "token", "n", "at"), "hits")


def some_members(hits: DataFrame, asks: DataFrame) -> DataFrame:
    """Pairs (u, v) of each asking class with a few members of the groups it hits: those of extreme sizes and keys."""
    own = F.struct("n", "key")
    few = asks.groupBy(F.col("grp").alias("g")).agg(
        F.array_distinct(F.array(F.min("key"), F.max("key"), F.max(own)["key"], F.min(own)["key"])).alias("few")
    )
    pairs = hits.select("u", "g").distinct().join(few, "g").select("u", F.explode("few").alias("v"))
    return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def opened(hits: DataFrame, asks: DataFrame) -> DataFrame:
    """Pairs (u, v) of each asking class with every member that has one of its tokens within reach, of the groups it hits. Only
    tokens that hit the group can be such."""
    inside = asks.filter("7 * at <= n").select(F.col("grp").alias("g"), "token", F.col("key").alias("v"), F.col("n").alias("m"), F.col("at").alias("j"))
    fits = "m <= n AND " + WITHIN.format(i="at", n="n", j="j", m="m")
    pairs = hits.join(inside, ["g", "token"]).filter(fits)
    return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def unsettled(hits: DataFrame, links: DataFrame) -> DataFrame:
    """The hits whose two groups are not one component yet, as ``links`` have it; grp and g stay the groups' first names, which are
    the keys of members."""
    whole = staged(hits.sparkSession, components(links), "settled")
    mine, theirs = whole.select(F.col("key").alias("grp"), F.col("label").alias("_x")), whole.select(F.col("key").alias("g"), F.col("label").alias("_y"))
    known = hits.join(mine, "grp", "left").join(theirs, "g", "left")
    return known.filter("coalesce(_x, grp) <> coalesce(_y, g)").drop("_x", "_y")


def all_links(docs: DataFrame, classes: DataFrame, rows: DataFrame, seed: int = 0, tally: list | None = None) -> DataFrame:
    """Links (u, v) that give the same components as all links do. ``tally`` gets the name and the number of pairs of each step."""
    spark = docs.sparkSession

    def compared(name: str, pairs: DataFrame, tried: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        pairs = staged(spark, pairs.join(tried, ["u", "v"], "left_anti") if tried is not None else pairs, "candidates")
        if tally is not None:
            tally.append((name, pairs.count()))
        return linked(docs, classes, pairs, seed), pairs if tried is None else staged(spark, tried.union(pairs), "tried")

    links, tried = compared("similar", similar_pairs(classes), None)
    asks = labelled(rows, links)
    left, met = asks.count(), None
    while left:
        found, tried = compared("round", holder_pairs(asks), tried)
        if found.isEmpty():
            break
        links = staged(spark, links.union(found), "links")
        asks = labelled(asks, links)
        before, left = left, asks.count()
        if left > LEFT * before:
            # what would hit is more than another round compares: it may merge groups that hit each other
            met = meetings(asks)
            if (met.agg(F.sum("asking")).first()[0] or 0) <= left:
                break
            met = None
    if not left:
        return links
    hits = hits_of(asks, meetings(asks) if met is None else met)
    found, tried = compared("few", some_members(hits, asks), tried)
    links = links.union(found)
    found, tried = compared("opened", opened(unsettled(hits, links), asks), tried)
    return links.union(found)


def described_classes(docs: DataFrame, row: str | None = None) -> tuple[DataFrame, DataFrame, int]:
    """``described`` rows, the stored classes and the seed of their hashes, with which no two sets share a key."""
    first_of = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")
    seed = 0
    while True:
        rows = described(docs, row, seed)
        sizes = F.struct("n", "second")
        classes = rows.filter("slice IS NULL AND n > 0").groupBy("key").agg(
            F.min("doc_id").alias("rep"), F.min(first_of).alias("best"), F.first("n").alias("n"), F.first("sigs").alias("sigs"),
            F.first("sketch").alias("sketch"), (F.min(sizes) != F.max(sizes)).alias("clash"),
        )
        classes = staged(docs.sparkSession, classes, "classes")
        if classes.filter("clash").isEmpty():
            return rows, classes.drop("clash"), seed
        seed += 1


def near_components(docs: DataFrame, numbered: DataFrame | None = None, row: str | None = None, tally: list | None = None) -> DataFrame:
    """doc_id, n_shingles and component_id of every document. If ``numbered`` and ``row`` are the documents and the column of
    with_rows(), also row and kept: of each component one row stays, of the smallest doc_id and then of the smallest number."""
    spark = docs.sparkSession
    rows, classes, seed = described_classes(docs if numbered is None else numbered, row)
    own = rows.filter("slice IS NULL").drop("slice", "counts")
    shared = shared_rows(matrix_rows(docs, frequent_tokens(rows), seed))
    whole = components(all_links(docs, classes, shared, seed, tally))
    firsts = staged(
        spark, classes.join(whole, "key", "left").select("key", "best", F.coalesce("label", "key").alias("label")), "labelled"
    )
    smallest = staged(spark, firsts.groupBy("label").agg(F.min("best").alias("first")), "smallest")
    named = staged(spark, firsts.join(smallest, "label").select("key", F.col("first.doc_id").alias("component_id"), F.col("first.row").alias("keep_row")), "named")
    found = own.join(named, "key", "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "row",
        ((F.col("n") == 0) | (F.col("row") == F.col("keep_row"))).alias("kept"),
    )
    return found if row else found.drop("row", "kept")


def one_of_each(docs: DataFrame) -> DataFrame:
    """Of each component the row with the smallest doc_id (null ids last, repeated rows once), with all its columns."""
    numbered, row = with_rows(docs)
    gone = near_components(docs, numbered, row).filter("NOT kept").select(F.col("row").alias(row))
    gone = staged(docs.sparkSession, gone, "near-copies")
    return numbered.join(broadcast_within(gone), row, "left_anti").select(*[numbered[c] for c in docs.columns])


def op7_ngram_join(spark, sf_dir):
    from orestrata.llm.common import table

    return near_components(table(spark, sf_dir, "documents"))
