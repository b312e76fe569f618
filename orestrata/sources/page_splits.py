"""Paged JSON documents of any size, each read in splits by many tasks.

A document is cut behind every closing brace, wherever it stands. What a piece means depends on what is before it: whether a
text is open, and how many brackets are. So each piece is looked at for both cases, as a map from the state before it to the
one after it (texts turn outside into inside and back, brackets add to the depth). Such maps compose: along each split, and then,
one row a split, along the document, which gives every piece its true state. The elements of ``data`` are the pieces between two
places of depth two; those of one piece, which are nearly all, are parsed where they are, and only the pieces of nested ones meet
in a shuffle. What is left without the elements is a small document of its own, which is parsed as a whole.

No task holds more than one split, one element, or the part of a document outside its top-level arrays. Elements of other arrays
than ``data`` are not parsed; their brackets and quotes must match.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orestrata.session import staged
from orestrata.sources.contracts import PageContract
from orestrata.sources.delimited import number_rows
from orestrata.sources.json_pages import PAGE_SCHEMA, checked_fields, lacks_keys, page_problem
from orestrata.sources.sizing import broadcast_within

# Possessive, so that long texts are matched in a loop.
_BARE_TEXT = r'"[^"]*+(?:"|\z)'
_TOKEN = r'(?s)"(?:[^"\\]++|\\.)*+(?:"|\z)|[\[\]{}]|[^"\[\]{}]++'
_BEFORE_ELEMENT = r"\A\s*+,\s*+(?=\{)"
_BROKEN = "broken JSON"


def split_pages(spark: SparkSession, paths: str | Sequence[str], contract: PageContract) -> DataFrame:
    """(path, row_number, fields, problem) of files of one JSON document each: the elements of sound documents, and one row with
    its problem for each that isn't (broken JSON is a problem here, not an error)."""
    chunks = _states(spark, paths)
    borders, interior = _sections(spark, chunks)
    elements = _elements(spark, borders, interior)
    pages = staged(spark, _pages(borders, interior, elements, contract).join(_sound_brackets(chunks), "path", "left"), "pages")
    problem = F.when(F.col("_sound") & ~F.col("_broken"), F.col("problem")).otherwise(F.lit(_BROKEN))
    pages = staged(spark, pages.select("path", problem.alias("problem")), "page-problems")
    good = pages.filter(F.col("problem").isNull()).select("path")
    rows = number_rows(elements, "path").join(broadcast_within(good), "path")
    rows = rows.select("path", "row_number", checked_fields(contract).alias("fields"), F.lit(None).cast("string").alias("problem"))
    bad = pages.filter(F.col("problem").isNotNull())
    none = F.lit(None).cast("map<string,string>")
    return rows.unionByName(bad.select("path", F.lit(None).cast("bigint").alias("row_number"), none.alias("fields"), "problem"))


def _brackets(text: Column) -> Column:
    """The brackets of a piece that begins outside texts; without closing braces, at which pieces end."""
    return F.regexp_replace(F.regexp_replace(text, _BARE_TEXT, ""), r"[^\[\]{]++", "")


def _balance(brackets: Column) -> Column:
    return 2 * F.length(F.replace(brackets, F.lit("]"), F.lit(""))) - F.length(brackets)


def _states(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(path, size, block, seq, text, brackets, begins_in, ends_in, depth, after): the pieces with the states before and after
    them. The last piece counts as closed by a brace even if it is not."""
    raw = (
        spark.read.option("lineSep", "}").option("recursiveFileLookup", "true").text(paths)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("seq"),
            F.col("value").alias("text"),
        )
    )
    bare = F.regexp_replace("text", r"(?s)\\.", "")
    looked_at = raw.withColumn("_bare", bare).select(
        *raw.columns,
        ((F.length("_bare") - F.length(F.replace(F.col("_bare"), F.lit('"'), F.lit("")))) % 2).alias("turns"),
        _brackets(F.col("_bare")).alias("from_outside"),
        _brackets(F.concat(F.lit('"'), F.col("_bare"))).alias("from_inside"),
    )
    # numbered once, and read again below
    pieces = staged(spark, looked_at, "page-pieces")
    in_split = Window.partitionBy("path", "block").orderBy("seq")
    before = in_split.rowsBetween(Window.unboundedPreceding, -1)
    step_outside = _balance(F.col("from_outside")) - F.when(F.col("turns") == 0, 1).otherwise(0)
    step_inside = _balance(F.col("from_inside")) - F.when(F.col("turns") == 1, 1).otherwise(0)
    turned = pieces.withColumn("_turned", F.coalesce(F.sum("turns").over(before), F.lit(0)) % 2)
    # what a piece adds to the depth if its split begins outside texts, and if it begins inside one
    steps = turned.withColumn("_a", F.when(F.col("_turned") == 0, step_outside).otherwise(step_inside)).withColumn(
        "_b", F.when(F.col("_turned") == 0, step_inside).otherwise(step_outside)
    )
    maps = staged(
        spark,
        steps.withColumn("_a_before", F.coalesce(F.sum("_a").over(before), F.lit(0))).withColumn(
            "_b_before", F.coalesce(F.sum("_b").over(before), F.lit(0))
        ),
        "page-maps",
    )

    # one row for each split from here to ``begun``
    along = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = maps.groupBy("path", "block").agg(F.sum("turns").alias("_turns"), F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    begun = splits.withColumn("begin", F.coalesce(F.sum("_turns").over(along), F.lit(0)) % 2)
    step = F.when(F.col("begin") == 0, F.col("_a")).otherwise(F.col("_b"))
    begun = begun.withColumn("begin_depth", F.coalesce(F.sum(step).over(along), F.lit(0)))
    begun = staged(spark, begun.select("path", "block", "begin", "begin_depth"), "page-begins")

    chosen = lambda a, b: F.when(F.col("begin") == 0, F.col(a)).otherwise(F.col(b))
    known = maps.join(broadcast_within(begun), ["path", "block"]).withColumns(
        {
            "begins_in": (F.col("_turned") + F.col("begin")) % 2 == 1,
            "ends_in": (F.col("_turned") + F.col("begin") + F.col("turns")) % 2 == 1,
            "depth": F.col("begin_depth") + chosen("_a_before", "_b_before"),
            "_step": chosen("_a", "_b"),
        }
    )
    return known.select(
        "path", "size", "block", "seq", "text",
        F.when(F.col("begins_in"), F.col("from_inside")).otherwise(F.col("from_outside")).alias("brackets"),
        "begins_in", "ends_in", "depth", (F.col("depth") + F.col("_step")).alias("after"),
    )


def _sound_brackets(chunks: DataFrame) -> DataFrame:
    """(path, _sound): one document, closed, with nothing behind it."""
    outer = (F.col("depth") <= 0) & F.col("text").rlike(r"\S")
    per_file = chunks.groupBy("path").agg(
        # a mark of the byte order is three bytes that readers take away
        (F.max("size") - F.sum(F.octet_length("text")) - F.count(F.lit(1))).alias("_rest"),
        F.max_by("after", F.struct("block", "seq")).alias("_depth"),
        F.max_by("ends_in", F.struct("block", "seq")).alias("_open"),
        F.count_if(outer).alias("_roots"),
        F.count_if(outer & F.col("text").rlike(r"\A\s*+\{")).alias("_objects"),
    )
    closed = F.col("_rest").isin(0, 3) & (F.col("_depth") == 0) | F.col("_rest").isin(-1, 2) & (F.col("_depth") == -1)
    return per_file.select("path", (closed & ~F.col("_open") & (F.col("_roots") == 1) & (F.col("_objects") == 1)).alias("_sound"))


def _sections(spark: SparkSession, chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pieces that reach the top level, with what they open there, and all others, with the section they lie in: the kind
    of bracket and the key. A piece that opens an array is cut at the array's first element."""
    lowest = F.aggregate(
        F.regexp_extract_all("brackets", F.lit("."), F.lit(0)),
        F.struct(F.col("depth").alias("at"), F.col("depth").alias("low")),
        lambda acc, b: F.struct(
            (acc["at"] + F.when(b == "]", -1).otherwise(1)).alias("at"),
            F.least(acc["low"], acc["at"] + F.when(b == "]", -1).otherwise(1)).alias("low"),
        ),
        lambda acc: acc["low"],
    )
    reaches = F.when(F.col("depth") <= 1, True).when(F.col("brackets").contains("]"), lowest <= 1).otherwise(False)
    marked = chunks.withColumn("reaches", reaches)
    begun = F.when(F.col("begins_in"), F.lit('"')).otherwise(F.lit(""))
    none = F.lit(None).cast("string")

    def read(acc: Column, token: Column) -> Column:
        opens, closes = token.isin("{", "["), token == "]"
        depth = acc["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        to_section, to_element = opens & (acc["depth"] == 1), opens & (acc["depth"] == 2) & (acc["kind"] == "[")
        return F.struct(
            depth.alias("depth"),
            (acc["at"] + F.length(token)).alias("at"),
            F.when((acc["depth"] == 1) & token.startswith('"'), token).otherwise(acc["key"]).alias("key"),
            F.when(to_section, token).when(closes & (depth <= 1), none).otherwise(acc["kind"]).alias("kind"),
            F.when(to_section, acc["key"]).otherwise(acc["name"]).alias("name"),
            F.when(to_element, acc["at"]).when(closes & (depth <= 2) | to_section, F.lit(None)).otherwise(acc["cut"]).alias("cut"),
        )

    start = F.struct(
        F.col("depth").alias("depth"),
        (-F.length(begun)).cast("int").alias("at"),
        none.alias("key"),
        none.alias("kind"),
        none.alias("name"),
        F.lit(None).cast("int").alias("cut"),
    )
    tokens = F.regexp_extract_all(F.concat(begun, "text"), F.lit(_TOKEN), F.lit(0))
    borders = marked.filter("reaches").withColumn("_read", F.aggregate(tokens, start, read))
    opened = (F.col("after") >= 2) & F.col("_read.kind").isNotNull()
    borders = borders.withColumns(
        {
            "kind": F.when(opened, F.col("_read.kind")),
            "name": F.when(opened, F.col("_read.name")),
            "cut": F.when(opened, F.col("_read.cut")),
        }
    )
    borders = staged(spark, borders.drop("_read", "reaches", "brackets"), "page-borders")
    place = F.struct("block", "seq")
    until = F.lead(place).over(Window.partitionBy("path").orderBy("block", "seq"))
    spans = borders.select("path", F.struct(place.alias("from"), until.alias("to"), "kind", "name").alias("span"))
    spans = staged(spark, spans.groupBy("path").agg(F.collect_list("span").alias("spans")), "page-sections")
    within = F.filter("spans", lambda s: (s["from"] < place) & (s["to"].isNull() | (s["to"] > place)))
    inner = marked.filter(~F.col("reaches")).join(broadcast_within(spans), "path").withColumn("_span", F.get(within, F.lit(0)))
    return borders, inner.select("path", "block", "seq", "text", "begins_in", "ends_in", "depth", "after", "_span.kind", "_span.name")


def _elements(spark: SparkSession, borders: DataFrame, interior: DataFrame) -> DataFrame:
    """(path, block, seq, _row): the parsed elements of ``data``, ``seq`` counting up by one inside a split; NULL if broken."""
    is_data = (F.col("kind") == "[") & (F.col("name") == '"data"')
    first = borders.filter(is_data & F.col("cut").isNotNull()).select(
        "path", "block", "seq", F.expr("substring(text, cut + 1)").alias("text"), F.lit(True).alias("begins"), "after", "ends_in"
    )
    # without a comma before it, an element is broken
    headed = F.when(F.col("text").rlike(_BEFORE_ELEMENT), F.regexp_replace("text", _BEFORE_ELEMENT, "")).otherwise(F.lit("?"))
    begins = (F.col("depth") == 2) & ~F.col("begins_in")
    others = interior.filter(is_data).select(
        "path", "block", "seq", F.when(begins, headed).otherwise(F.col("text")).alias("text"), begins.alias("begins"), "after", "ends_in"
    )
    ends = (F.col("after") == 2) & ~F.col("ends_in")
    pieces = first.unionByName(others).select("path", "block", "seq", F.concat("text", F.lit("}")).alias("text"), "begins", ends.alias("ends"))
    single = pieces.filter("begins AND ends").select("path", "block", "seq", "text")
    several = staged(spark, pieces.filter("NOT (begins AND ends)"), "nested-elements")

    in_split = Window.partitionBy("path", "block").orderBy("seq")
    own = F.last(F.when(F.col("begins"), F.col("seq")), ignorenulls=True).over(in_split.rowsBetween(Window.unboundedPreceding, 0))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = several.groupBy("path", "block").agg(F.max(F.when(F.col("begins"), F.col("seq"))).alias("last"))
    start = F.when(F.col("last").isNotNull(), F.struct("block", F.col("last").alias("seq")))
    carried = staged(spark, starts.select("path", "block", F.last(start, ignorenulls=True).over(earlier).alias("carried")), "carried")
    placed = several.withColumn("_own", own).join(broadcast_within(carried), ["path", "block"])
    element = F.when(F.col("_own").isNotNull(), F.struct("block", F.col("_own").alias("seq"))).otherwise(F.col("carried"))
    parts = F.array_sort(F.collect_list(F.struct("block", "seq", "text")))
    whole = placed.groupBy("path", element.alias("element")).agg(F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text"))
    found = single.unionByName(whole.select("path", "element.block", "element.seq", "text"))
    found = found.withColumn("seq", F.row_number().over(in_split).cast("bigint"))
    return staged(spark, found.select("path", "block", "seq", F.from_json("text", "MAP<STRING, STRING>").alias("_row")), "page-elements")


def _pages(borders: DataFrame, interior: DataFrame, elements: DataFrame, contract: PageContract) -> DataFrame:
    """(path, _broken, problem) from what is left of each document without the elements of its arrays, and their counts."""
    kept = F.when((F.col("kind") == "[") & F.col("cut").isNotNull(), F.expr("substring(text, 1, cut)")).otherwise(F.concat("text", F.lit("}")))
    # what follows the document, white space if it is sound, is no part of it
    heads = borders.filter("after >= 0").select("path", "block", "seq", kept.alias("text"))
    inner = interior.filter("kind = '{'").select("path", "block", "seq", F.concat("text", F.lit("}")).alias("text"))
    parts = F.array_sort(F.collect_list(F.struct("block", "seq", "text")))
    rest = heads.unionByName(inner).groupBy("path").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("_rest"))
    counts = elements.groupBy("path").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("_row").isNull()).alias("_unread"),
        F.count_if(lacks_keys(F.col("_row"), contract)).alias("_lacking"),
    )
    read = F.from_json("_rest", f"{PAGE_SCHEMA}, _bad STRING", {"columnNameOfCorruptRecord": "_bad"})
    pages = rest.withColumn("_read", read).join(counts, "path", "left").na.fill(0, ["_n", "_unread", "_lacking"])
    left = F.coalesce(F.size("_read.data"), F.lit(0))
    n_rows = F.when(F.col("_read.data").isNotNull(), F.col("_n") + left)
    broken = F.coalesce(F.col("_read").isNull() | F.col("_read._bad").isNotNull() | (F.col("_unread") > 0), F.lit(True))
    return pages.select(
        "path", broken.alias("_broken"), page_problem(F.col("_read.page"), n_rows, (F.col("_lacking") > 0) | (left > 0)).alias("problem")
    )
