"""Mix sources to target weights along a curriculum that changes with training time.

A source's weight is a schedule over training time t in [0, 1], w(t) = weight * (1 + slope * (2 t - 1)); its integral is
its weight, so it takes its target of words, and the slope only says whether early or late. Targets share a total by
weight and stop at ``most`` times a source's size; what is cut off goes to the others by weight until none is above.

Within a source, documents stand in a fixed pseudo-random stream; the mix takes the stream's first words up to the
target, going round again where the target is larger than the source. The last document is taken in part, so a source's
words are its target. Where a document's middle word falls in the stream is its cumulative demand; inverting the
integrated schedule there gives its training position, and the mix is range-sorted by position.

Prefix sums come from ranges of the stream, so a source with a third of all rows is spread like any other.

Defined results: null text has no words; a null source is a source of its own, last in order; documents without words
take nothing and have no position; repeated rows count once each; an empty table gives no rows. Other columns are
not looked at.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orestrata.llm.common import WORD, staged_in_order, text_of, with_rows
from orestrata.session import staged
from orestrata.sources.sizing import broadcast_within

WEIGHTS = (3, 1, 2)
#: By the same turn as the weights: more of it late, evenly, more of it early.
SLOPES = (0.5, 0.0, -0.5)
SHARE = 1.5
MOST = 2.0


def _turn(values: tuple, number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (number % len(values) + 1).cast("int"))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``sizes`` (source, source_size) with number, weight and target. A round adds up the capped sources and the others'
    weights; rounds end when no further source is capped, which is when none is above its limit."""
    spark = sizes.sparkSession
    numbered = sizes.withColumn("number", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    sources = staged(spark, numbered.withColumn("weight", _turn(weights, F.col("number"))), "sources")
    total = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    limit, level, capped = most * F.col("source_size"), 0.0, -1
    while True:
        above = F.lit(capped >= 0) & (F.col("weight") * F.lit(level) >= limit)
        now, taken, rest = sources.agg(
            F.count_if(above), F.coalesce(F.sum(F.when(above, limit)), F.lit(0.0)), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0))
        ).first()
        if now == capped or rest == 0:
            break
        level, capped = (total - taken) / rest, now
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), limit))


def position(part: Column, slope: Column) -> Column:
    """The training time at which a source with this slope has met ``part`` of its whole demand."""
    a = slope
    bent = (a - 1 + F.sqrt((1 - a) * (1 - a) + 4 * a * part)) / (2 * F.when(a != 0, a))
    return F.when(a == 0, part).otherwise(bent)


def placed_documents(
    docs: DataFrame, weights: tuple = WEIGHTS, slopes: tuple = SLOPES, share: float = SHARE, most: float = MOST, row: str | None = None
) -> DataFrame:
    """Stored, one row for each document: doc_id, source, size, source_size, target, taken (words, repeats counted),
    first_position and again_position (null where it isn't taken so often). If ``row`` names the column of with_rows(),
    also row."""
    spark = docs.sparkSession
    number = [F.col(row).alias("row")] if row else []
    sized = docs.select(
        *number,
        "doc_id",
        "source",
        F.regexp_count(text_of(), F.lit(WORD)).cast("bigint").alias("size"),
        # the stream's order: by a digest, so that neither ids nor input order favour anyone
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("turn"),
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("key"),
    )
    # the words are counted once, not again for the sort's sample
    sized = staged(spark, sized, "sizes")
    rows = staged_in_order(sized, [F.col("key"), F.col("turn"), F.col("doc_id"), F.col("size"), *[F.col("row") for _ in number]], "streams")
    parts = staged(spark, rows.groupBy("key", "source", "part").agg(F.sum("size").alias("words")), "stream-parts")
    targets = source_targets(parts.groupBy("key", "source").agg(F.sum("words").alias("source_size")), weights, share, most)
    targets = targets.withColumn("slope", _turn(slopes, F.col("number"))).drop("source")
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # at most one row for each range and one more for each source
    offsets = staged(
        spark,
        parts.withColumn("words_before", F.coalesce(F.sum("words").over(before), F.lit(0)))
        .join(broadcast_within(targets), "key")
        .select("key", "part", "words_before", "source_size", "target", "slope"),
        "stream-offsets",
    )
    inside = Window.partitionBy("part", "key").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    begin = F.col("words_before") + F.col("_to") - F.col("size")
    demand = F.floor(F.col("target") + 0.5)
    from_to = lambda start: F.greatest(F.lit(0), F.least(F.col("size"), demand - start))
    middle = lambda start, taken: position((start + taken / 2) / F.col("target"), F.col("slope"))
    placed = (
        rows.withColumn("_to", F.sum("size").over(inside))
        .join(broadcast_within(offsets), ["key", "part"])
        .withColumn("_start", begin)
        .withColumn("_first", from_to(F.col("_start")))
        .withColumn("_again", from_to(F.col("_start") + F.col("source_size")))
        .select(
            *[F.col("row") for _ in number],
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            (F.col("_first") + F.col("_again")).alias("taken"),
            F.when(F.col("_first") > 0, middle(F.col("_start"), F.col("_first"))).alias("first_position"),
            F.when(F.col("_again") > 0, middle(F.col("_start") + F.col("source_size"), F.col("_again"))).alias("again_position"),
        )
    )
    return staged(spark, placed, "mix")


def mix(docs: DataFrame, **options) -> DataFrame:
    """``placed_documents``, range-sorted by the first position."""
    order = [F.col("first_position").asc_nulls_last(), F.col("doc_id")]
    return placed_documents(docs, **options).repartitionByRange(*order).sortWithinPartitions(*order)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents with all their columns: as many copies of each as are nearest to its taken words, sorted by
    training position. Rows are told apart by a stored number, whatever their doc_id.

    The plan, some numbers for each copy, is sorted and cut into parts of equal words before any text is touched; texts move
    once, each to its part, as long as the plan is small enough to be broadcast, and twice beyond that."""
    spark = docs.sparkSession
    numbered, row = with_rows(docs)
    copies = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0).cast("int")
    again = F.coalesce(F.col("again_position"), F.col("first_position"))
    taken = placed_documents(numbered, **options, row=row).select("row", "size", F.slice(F.array("first_position", again), F.lit(1), copies).alias("at"))
    ordered = staged_in_order(taken.select("row", "size", F.posexplode("at").alias("nth", "position")), [F.col(c) for c in ("position", "row", "nth")], "training-order")
    sums = staged(spark, ordered.groupBy("part").agg(F.sum("size").alias("words")), "training-parts")
    total = sums.agg(F.sum("words")).first()[0] or 1
    # one row for each range of the sort
    before = sums.select("part", F.coalesce(F.sum("words").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    inside = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    begin = F.col("before") + F.sum("size").over(inside) - F.col("size")
    places = ordered.join(broadcast_within(before), "part").select(
        F.col("row").alias(row), F.col("position").alias("_position"), "nth", F.floor(begin * parts / F.lit(float(total))).cast("int").alias("_part")
    )
    places = staged(spark, places.withColumnRenamed("nth", "_nth"), "training-places")
    kept = [numbered[c] for c in docs.columns]
    placed = numbered.join(broadcast_within(places), row)
    order = [places["_position"], numbered[row], places["_nth"]]
    return placed.repartitionById(parts, places["_part"]).sortWithinPartitions(*order).select(*kept)


def op8_curriculum_mix(spark, sf_dir):
    from orestrata.llm.common import table

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP8_SQL = """
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS turn,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, CAST([3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS DOUBLE) AS weight FROM s
), o AS (
  SELECT *, source_size / weight AS full_at,
         coalesce(sum(2.0 * source_size) OVER b, 0) AS capped_before,
         sum(weight) OVER (ORDER BY source_size / weight DESC, source DESC NULLS FIRST ROWS UNBOUNDED PRECEDING) AS weight_from
  FROM w
  WINDOW b AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT arg_min((1.5 * (SELECT sum(source_size) FROM s) - capped_before) / weight_from, capped_before) AS level
  FROM o WHERE weight * (1.5 * (SELECT sum(source_size) FROM s) - capped_before) / weight_from <= 2.0 * source_size
), t AS (
  SELECT source, source_size, least(weight * level, 2.0 * source_size) AS target FROM w, l
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target + 0.5) AS demand,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY turn, doc_id, size ROWS UNBOUNDED PRECEDING) - d.size AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(greatest(0, least(size, demand - start)) + greatest(0, least(size, demand - start - source_size)) AS BIGINT) AS taken
FROM p
"""
