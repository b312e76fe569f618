"""I-Match fingerprints: terms of a middle band of document frequency, hashed by several randomised parts of the lexicon.

The lexicon holds the terms whose document frequency lies in ``BAND``, as shares of the distinct texts, so that a text with
many copies doesn't push its own terms out. As every term in it is in ``BAND[0]`` of them at least, it has at most (distinct terms of a mean document) / BAND[0] terms however large
the corpus, which is what makes its broadcast bounded (its size is checked all the same). A term is held as its 64-bit hash.

Each of ``PARTS`` randomised parts keeps a term by a hash of part and term, at a rate of a power of two. A document takes
the rate at which its own number of terms leaves about one term in a part, so that short and long documents answer alike
to edits, and the next lower rate, so that two documents of nearly equal length always share a rate. A part's hash is over
its sorted distinct terms. Likeness is the share of parts with equal hashes at the shared rate; parts empty in both texts
don't count.

The same parts are also hashed over all terms of a text, where those of more than ``LONG_TERM`` characters (writing without
separators) count as their runs of three characters. A text with less than one term in ``FEW`` in the lexicon (a small
language, a member of a large group of near copies) has this as its fingerprint, marked ``a:``, and is compared by it with
any other text.

Defined results: null text is empty; a text without any term has its lower-cased text's hash as fingerprint, and likeness 1
to the same text and 0 to others; null doc_ids come first; rows with the same doc_id are ordered by their
text, repeated rows follow each other; a single document is its own next one; an empty table gives no rows.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orestrata.llm.common import lower_ascii, text_of
from orestrata.session import staged
from orestrata.sources.sizing import broadcast_within

BAND = (0.0005, 0.02)
PARTS = 12
#: Of a rate of 2^-n, up to so many halvings are a part's own.
OWN_BITS = 4
#: Documents in a range of doc_id; neighbours are found within ranges.
RANGE_ROWS = 400
#: Of a text's terms, one in so many is in the lexicon, else all of them are hashed.
FEW = 8
LONG_TERM = 32
#: What stands between terms: ASCII characters but for letters and digits.
BETWEEN = "[\\x00-/:-@\\[-`{-\\x7f]+"
#: A term no text has; it keeps texts without any term of the lexicon, and carries the hashes of all terms.
NO_TERM = "\x00"
PRINT = "struct<level: int, near: array<bigint>, far: array<bigint>>"


def terms_of(text: Column) -> Column:
    return F.array_distinct(F.split(lower_ascii(text), BETWEEN))


def lexicon(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """``term`` (hash) of every term whose frequency among the distinct texts lies in the band; stored."""
    lower = lower_ascii(text_of())
    which = [F.xxhash64(lower).alias("hash"), F.octet_length(lower).alias("bytes")]
    texts = docs.select(*which, text_of().alias("text")).groupBy("hash", "bytes").agg(F.first("text").alias("text"))
    terms = texts.select(F.explode(terms_of(F.col("text"))).alias("term")).filter("term <> ''")
    counted = terms.select(F.xxhash64("term").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    n = docs.select(*which).distinct().count()
    kept = counted.filter((F.col("df") >= band[0] * n) & (F.col("df") <= max(band[1] * n, 2))).select("term")
    return staged(docs.sparkSession, kept, "lexicon")


def _search(cuts: list[int], value: Column) -> Column:
    """How many of the ascending cuts are at most ``value``, by bisection; 0 for null."""
    if not cuts:
        return F.lit(0)
    table = F.expr(f"array({','.join(f'{c}L' for c in cuts)})")
    steps = F.sequence(F.lit(1), F.lit(len(cuts).bit_length()))

    def halve(state: Column, _: Column) -> Column:
        low, high = state["low"], state["high"]
        middle = F.floor((low + high) / 2).cast("int")
        below = (low < high) & (F.element_at(table, F.least(middle + 1, F.lit(len(cuts)))) <= value)
        return F.struct(
            F.when(below, middle + 1).otherwise(low).alias("low"),
            F.when(below | (low >= high), high).otherwise(middle).alias("high"),
        )

    start = F.struct(F.lit(0).alias("low"), F.lit(len(cuts)).alias("high"))
    return F.when(value.isNull(), F.lit(0)).otherwise(F.aggregate(steps, start, halve)["low"])


def with_next(docs: DataFrame, order_id: str = "doc_id", rows_in_range: int = RANGE_ROWS) -> DataFrame:
    """Each document with the next one's text (after the last: the first's), grouped by ``range``.

    Ranges are cut at quantiles of the ids. The documents with a range's smallest id are also sent to the range before,
    as its end (``border``); they stay in the result so that further columns of the next document can be looked up."""
    spark = docs.sparkSession
    ids = docs.select(order_id)
    n = ids.count()
    ranges = max(1, n // rows_in_range)
    at = [i / ranges for i in range(1, ranges)]
    cuts = sorted(set(ids.agg(F.percentile_approx(order_id, at, max(10_000, 20 * ranges))).first()[0] or [])) if at else []
    rows = docs.select(
        order_id, text_of().alias("text"), F.monotonically_increasing_id().alias("row")
    ).withColumn("range", _search(cuts, F.col(order_id)).cast("int"))
    # one row for each range
    firsts = ids.groupBy(_search(cuts, F.col(order_id)).cast("int").alias("range")).agg(F.min(order_id).alias("_first"))
    around = Window.orderBy("range")
    firsts = staged(spark, firsts.select("range", "_first", F.lag("range").over(around).alias("_before"), F.last("range").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_last")), "ranges")
    nulls = ids.filter(F.col(order_id).isNull()).limit(1).count() > 0
    first_id = F.when(F.lit(nulls) & (F.col("range") == 0), F.lit(None)).otherwise(F.col("_first"))
    marked = rows.join(F.broadcast(firsts), "range")
    border = F.when(F.col(order_id).eqNullSafe(first_id), F.coalesce("_before", "_last"))
    sent = marked.withColumn("_to", F.array_compact(F.array(
        F.struct(F.col("range"), F.lit(False).alias("border")),
        F.when(border.isNotNull(), F.struct(border.alias("range"), F.lit(True).alias("border"))),
    ))).select(order_id, "text", "row", F.inline("_to"))
    return sent.select(
        order_id, "text", "row", "range", "border", F.lead("text").over(in_order(order_id)).alias("next_text")
    )


def in_order(order_id: str) -> Window:
    return Window.partitionBy("range").orderBy("border", F.col(order_id).asc_nulls_first(), F.xxhash64("text"), "row")


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _keeps(hash_: Column, bits: Column) -> Column:
    """One hash in 2^bits."""
    return hash_.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1) == 0


def part_hashes(terms: Column, level: Column) -> Column:
    """ARRAY<STRUCT<near, far>>: the hash of each part of ``terms``, sorted, which keeps one term in 2^level, and of the half
    of it that one in 2^(level + 1) leaves; null for an empty one. Rates beyond 2^OWN_BITS come from a thinning that
    all parts share, so that a long document's terms are looked at once and not once for each part."""
    shared = lambda t, at: _keeps(F.xxhash64(t), F.greatest(at - OWN_BITS, F.lit(0)))
    own = lambda t, part, at: _keeps(F.xxhash64(t, part), F.least(at, F.lit(OWN_BITS)))
    hashed = lambda kept: F.when(F.size(kept) > 0, F.xxhash64(kept).bitwiseAND(0xFFFFFFFF))

    def both(kept: Column, part: Column) -> Column:
        half = F.filter(kept, lambda t: shared(t, level + 1) & own(t, part, level + 1))
        return F.struct(hashed(kept).alias("near"), _bound(half, hashed).alias("far"))

    def of_part(thinned: Column, part: Column) -> Column:
        return _bound(F.filter(thinned, lambda t: own(t, part, level)), lambda kept: both(kept, part))

    parts = F.array(*[F.lit(part) for part in range(PARTS)])
    thinned = F.sort_array(F.filter(terms, lambda t: shared(t, level)))
    return _bound(thinned, lambda kept: F.transform(parts, lambda part: of_part(kept, part)))


def piece_hashes(terms: Column, hashed: Column) -> Column:
    """The hashes of all terms, of long ones those of their runs of three characters."""

    def runs(term: Column) -> Column:
        return _bound(
            F.split(term, ""),
            lambda c: F.transform(F.sequence(F.lit(0), F.size(c) - 3), lambda i: F.xxhash64(F.concat(c[i], c[i + 1], c[i + 2]))),
        )

    long = lambda t: F.length(t) > LONG_TERM
    broken = F.array_distinct(F.flatten(F.transform(terms, lambda t: F.when(long(t), runs(t)).otherwise(F.array(F.xxhash64(t))))))
    return F.when(F.exists(terms, long), broken).otherwise(hashed)


def levelled(terms: Column) -> Column:
    """STRUCT<level, near, far> of distinct terms: hashes at their own rate and at the next lower one; null without terms."""

    def at_level(t: Column) -> Column:
        return _bound(
            part_hashes(t["terms"], t["level"]),
            lambda hashes: F.struct(t["level"].alias("level"), hashes["near"].alias("near"), hashes["far"].alias("far")),
        )

    def of_bound(own: Column) -> Column:
        level = F.floor(F.log2(F.greatest(F.size(own), F.lit(1)) / F.lit(0.75))).cast("int")
        return F.when(F.size(own) > 0, _bound(F.struct(own.alias("terms"), level.alias("level")), at_level))

    return _bound(terms, of_bound)


def fingerprint(terms: Column, everything: Column, n_terms: Column, whole: Column) -> Column:
    """STRUCT<band, everything, whole>: levelled() of the lexicon's terms, null if they are few, and of all terms, and the
    whole text's hash if it has none."""
    said = F.struct(terms.alias("terms"), everything.alias("everything"), n_terms.alias("n_terms"), whole.alias("whole"))
    # bound, as a plain struct would be worked out again for each of its fields that is read
    return _bound(
        said,
        lambda x: F.struct(
            F.when(F.size(x["terms"]) * FEW >= x["n_terms"], levelled(x["terms"])).alias("band"),
            x["everything"].alias("everything"),
            F.when(x["everything"].isNull(), x["whole"]).alias("whole"),
        ),
    )


def as_text(print_: Column) -> Column:
    shown = lambda hashes: F.array_join(F.transform(hashes, lambda h: F.coalesce(F.lower(F.hex(h)), F.lit("-"))), ".")
    parts = lambda p: F.concat_ws(":", p["level"].cast("string"), shown(p["near"]), shown(p["far"]))
    return (
        F.when(print_["band"].isNotNull(), parts(print_["band"]))
        .when(print_["everything"].isNotNull(), F.concat(F.lit("a:"), parts(print_["everything"])))
        .otherwise(F.concat(F.lit("w:"), F.lower(F.hex(print_["whole"]))))
    )


def likeness(a: Column, b: Column) -> Column:
    """The share of parts that agree at the rate which two fingerprints share; 0 if they share none. The lexicon's terms are
    compared if they are enough in both texts, all terms otherwise."""

    def agree(x: Column, y: Column) -> Column:
        both = F.arrays_zip(x.alias("x"), y.alias("y"))
        counted = F.size(F.filter(both, lambda p: p["x"].isNotNull() | p["y"].isNotNull()))
        equal = F.size(F.filter(both, lambda p: p["x"] == p["y"]))
        return F.when(counted > 0, equal / counted).otherwise(F.lit(1.0))

    def alike(x: Column, y: Column) -> Column:
        apart = y["level"] - x["level"]
        return (
            F.when(apart == 0, agree(x["near"], y["near"]))
            .when(apart == 1, agree(x["far"], y["near"]))
            .when(apart == -1, agree(x["near"], y["far"]))
            .otherwise(F.lit(0.0))
        )

    return (
        F.when(a["band"].isNotNull() & b["band"].isNotNull(), alike(a["band"], b["band"]))
        .when(a["everything"].isNotNull() & b["everything"].isNotNull(), alike(a["everything"], b["everything"]))
        .otherwise(F.coalesce(a["whole"] == b["whole"], F.lit(False)).cast("double"))
    )


def edit_fingerprints(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """Fingerprints of every document and of its edited text (its last quarter replaced by the next one's beginning), and
    their likeness; also the document's likeness to the next one."""
    words = lexicon(docs, band)
    known = words.unionByName(docs.sparkSession.range(1).select(F.xxhash64(F.lit(NO_TERM)).alias("term")))
    pairs = with_next(docs)
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.expr("substring(text, 1, n_chars - cast(floor(n_chars / 4) as int))"), F.expr("substring(next_text, 1, cast(floor(n_chars / 4) as int))"))
    sides = pairs.withColumn("n_chars", F.length("text")).withColumn("edited", edited).select(
        "range", "row", "doc_id", "border",
        F.col("n_chars").cast("bigint").alias("n_chars"),
        F.xxhash64("text").alias("text_hash"),
        F.xxhash64(lower_ascii(F.col("text"))).alias("whole"),
        F.xxhash64(lower_ascii(F.col("edited"))).alias("edited_whole"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.inline(F.array(
            F.struct(F.lit(0).alias("side"), F.col("text").alias("_text")),
            F.struct(F.lit(1).alias("side"), F.col("edited").alias("_text")),
        )),
    )
    own = F.xxhash64(F.lit(NO_TERM))
    hashed = lambda terms: F.transform(terms, lambda t: F.xxhash64(t))
    words_of = F.filter(terms_of(F.col("_text")), lambda t: t != "")
    # once for each side, with the row of NO_TERM: what is said of all its terms
    everything = _bound(
        _bound(words_of, lambda found: F.struct(found.alias("words"), hashed(found).alias("terms"))),
        lambda x: F.struct(
            x["terms"].alias("terms"), levelled(piece_hashes(x["words"], x["terms"])).alias("everything")
        ),
    )
    parted = sides.select(*[c for c in sides.columns if c != "_text"], everything.alias("_all"))
    terms = parted.select(
        *[c for c in parted.columns if c != "_all"],
        _bound(F.col("_all"), lambda x: F.array_append(
            F.transform(x["terms"], lambda t: F.struct(t.alias("term"), F.lit(None).cast(PRINT).alias("everything"), F.lit(0).alias("n_terms"))),
            F.struct(own.alias("term"), x["everything"].cast(PRINT).alias("everything"), F.size(x["terms"]).alias("n_terms")),
        )).alias("_terms"),
    ).select(*[c for c in parted.columns if c != "_all"], F.inline("_terms"))
    kept = terms.join(broadcast_within(known), "term")
    of = lambda side: F.collect_set(F.when((F.col("side") == side) & (F.col("term") != own), F.col("term")))
    said = lambda side, column: F.first(F.when((F.col("side") == side) & (F.col("term") == own), F.col(column)), ignorenulls=True)
    rest = ["doc_id", "n_chars", "text_hash", "whole", "edited_whole", "edited_sha256"]
    found = kept.groupBy("range", "border", "row").agg(*[F.first(c).alias(c) for c in rest], of(0).alias("t0"), of(1).alias("t1"),
        *[said(side, c).alias(f"{c}{side}") for side in (0, 1) for c in ("everything", "n_terms")])
    prints = found.select(
        "range", "border", "row", "doc_id", "n_chars", "text_hash", "edited_sha256",
        fingerprint(F.col("t0"), F.col("everything0"), F.col("n_terms0"), F.col("whole")).alias("own"),
        fingerprint(F.col("t1"), F.col("everything1"), F.col("n_terms1"), F.col("edited_whole")).alias("edited"),
    )
    after = Window.partitionBy("range").orderBy("border", F.col("doc_id").asc_nulls_first(), "text_hash", "row")
    return prints.withColumn("next", F.lead("own").over(after)).filter("NOT border").select(
        "doc_id", "n_chars", "edited_sha256",
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"),
    )


def op2_imatch(spark, sf_dir):
    from orestrata.llm.common import table

    return edit_fingerprints(table(spark, sf_dir, "documents"))
