"""Delimited files with a header per file, under a column contract, read in splits."""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orestrata.functions.text import WHITESPACE, strip
from orestrata.session import staged
from orestrata.sources.contracts import FileContract, SchemaDrift, kind_of, told
from orestrata.sources.sizing import broadcast_within

# A character that text files do not use. A line that holds it anyway is still read whole, through
# the malformed-record column.
_NO_SEPARATOR = "\u0001"

#: A record of more characters is not put together; the cell limit of the standard library is far below.
RECORD_CHARS = 1 << 24

# Possessive, so that a cell with very many doubled quotes is matched in a loop, not by recursion.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'


OPEN_QUOTE = "open quote"


@dataclass(frozen=True)
class DelimitedRead:
    """``headers``: one row per file with its parsed header and ``problem``.
    ``lines``: one row per non-blank data line with ``fields`` or a ``problem``."""

    headers: DataFrame
    lines: DataFrame


def parsed_headers(inventory: DataFrame, contracts: Sequence[FileContract], separator: str = "\t") -> DataFrame:
    """(path, source_name, object_id, kind, columns, problem) for the files that have a contract."""
    first = F.regexp_replace(F.coalesce("header", F.lit("")), "^\ufeff", "")
    columns = F.transform(_cells(first, separator), lambda c: F.lower(strip(c)))
    kind = kind_of(F.col("source_name"), contracts)
    required = F.lit(None).cast("array<string>")
    for contract in contracts:
        names = F.array(*[F.lit(c) for c in contract.required])
        required = F.when(F.col("kind") == contract.kind, names).otherwise(required)
    return (
        inventory.withColumn("kind", kind)
        .filter(F.col("kind").isNotNull())
        .withColumn("columns", columns)
        .withColumn("_missing", F.array_except(required, F.col("columns")))
        .withColumn(
            "problem",
            F.when(strip(first).rlike(r"(?i)\A<(!doctype html|html)"), F.lit("HTML instead of data"))
            .when(~F.col("is_utf8"), F.lit("invalid UTF-8"))
            .when(F.size("_missing") > 0, F.concat(F.lit("missing columns: "), F.array_join("_missing", ", ")))
            .when(F.size(F.array_distinct("columns")) != F.size("columns"), F.lit("repeated column name")),
        )
        .select("path", "source_name", "object_id", "kind", "columns", "problem")
    )


def _cells(line: Column, separator: str) -> Column:
    """Split a line; a line with quotes honours them (separators inside, doubled quotes)."""
    plain = F.split(line, _literal(separator), -1)
    sep = _literal(separator)
    # a separator is put in front so that no match is empty
    pattern = rf'{sep}({_QUOTED}[^{sep}]*|[^{sep}]*)'
    raw = F.regexp_extract_all(F.concat(F.lit(separator), line), F.lit(pattern), F.lit(1))
    quoted = F.transform(
        raw,
        lambda c: F.when(
            c.startswith('"'),
            F.replace(F.regexp_replace(c, r'(?s)\A"([^"]*+(?:""[^"]*+)*+)"(.*)\z', "$1$2"), F.lit('""'), F.lit('"')),
        ).otherwise(c),
    )
    return F.when(line.contains('"'), quoted).otherwise(plain)


def _literal(separator: str) -> str:
    if len(separator) != 1:
        raise ValueError("the separator is one character")
    return {"\t": r"\t", "|": r"\|", "^": r"\^"}.get(separator, separator)


def _is_blank(line: Column, separator: str) -> Column:
    """Nothing but white space and separators; a quoted cell without content counts as nothing."""
    space = rf"[{WHITESPACE}&&[^{_literal(separator)}]]*+"
    cell = rf'(?:"[{WHITESPACE}]*+")?+{space}'
    hollow = line.rlike(rf"\A{cell}(?:{_literal(separator)}{cell})*+\z")
    return F.when(line.contains('"'), hollow).otherwise(F.btrim(line, F.lit(WHITESPACE + separator)) == "")


def data_lines(spark: SparkSession, paths: str | Sequence[str], separator: str = "\t") -> DataFrame:
    """(path, block, seq, line) of all non-blank lines below each file's first line.

    The CSV source is used as a line reader: it splits large files, skips blank lines and leaves out
    the first line of each file (in the split at offset 0) without any look at the other splits.
    """
    line = F.coalesce("_whole", "line")
    return (
        spark.read.schema("line STRING, _whole STRING")
        .option("header", "true")
        .option("enforceSchema", "true")
        .option("sep", _NO_SEPARATOR)
        .option("quote", "")
        .option("escape", "")
        .option("maxCharsPerColumn", "-1")
        .option("columnNameOfCorruptRecord", "_whole")
        .option("recursiveFileLookup", "true")
        .csv(paths)
        .select("*", "_metadata")
        .filter(~_is_blank(line, separator))
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("seq"),
            line.alias("line"),
        )
    )


def quoted_records(spark: SparkSession, paths: str | Sequence[str], separator: str = "\t") -> DataFrame:
    """(path, block, seq, line) as :func:`data_lines` gives them, for files whose quoted cells may hold line breaks.

    Whether a line begins inside a quoted cell depends on all lines before it, and splits are read apart. So each line is
    looked at for both cases: it is a function of the state (outside or inside a quoted cell) before it to the one after it,
    and such functions compose. Within a split, a running composition is the value at the last line that forgets the state
    before it, turned by the lines since that turn it. The splits' own compositions, one row each, are composed along the
    file, which gives every split its true beginning. Records of one line pass as they are; the lines of longer ones meet by
    the place where their record begins, which may lie in an earlier split.

    Line breaks within a cell are kept as they are. A record of more than ``RECORD_CHARS`` characters, or one that the file
    ends in, is given as its first line, whose quote is open.
    """
    line = F.col("line")
    raw = (
        spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(paths)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("seq"),
            F.col("value").alias("line"),
        )
    )
    # numbered once, and read again below
    lines = staged(spark, raw, "quoted-lines")
    in_split = Window.partitionBy("path", "block").orderBy("seq")
    nth = F.row_number().over(in_split)
    is_header = (F.col("block") == 0) & (nth == 1)
    from_outside = F.when(is_header, F.lit(False)).otherwise(_open_quote(line, separator))
    from_inside = F.when(line.contains('"'), _open_quote(F.concat(F.lit('"'), line), separator)).otherwise(True)
    so_far = in_split.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    looked_at = lines.withColumns({"is_header": is_header, "_a": from_outside.cast("int"), "_b": from_inside.cast("int")})
    turned = looked_at.withColumn("_turns", F.sum(F.when((F.col("_a") == 1) & (F.col("_b") == 0), 1).otherwise(0)).over(so_far))
    held = F.last(F.when(F.col("_a") == F.col("_b"), F.struct(F.col("_a").alias("state"), "_turns")), ignorenulls=True).over(so_far)
    composed = turned.withColumn("_held", held).select(
        "path", "block", "seq", "line", "is_header",
        F.struct(
            F.col("_held").isNotNull().alias("fixed"),
            ((F.coalesce("_held.state", F.lit(0)) + F.col("_turns") - F.coalesce("_held._turns", F.lit(0))) % 2).alias("state"),
        ).alias("after"),
    )
    marked = staged(spark, composed.withColumn("before", F.lag("after").over(in_split)), "quoted-states")

    # one row for each split from here to ``begun``
    splits = marked.groupBy("path", "block").agg(F.max_by("after", "seq").alias("after"))
    along = Window.partitionBy("path").orderBy("block")
    all_before = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turns = F.sum(F.when(F.col("after.fixed"), 0).otherwise(F.col("after.state"))).over(all_before)
    fixed = F.last(F.when(F.col("after.fixed"), F.struct(F.col("after.state").alias("state"), "_turns")), ignorenulls=True).over(all_before)
    scanned = splits.withColumn("_turns", turns).withColumn("_held", fixed)
    reached = (F.coalesce("_held.state", F.lit(0)) + F.col("_turns") - F.coalesce("_held._turns", F.lit(0))) % 2
    begun = staged(spark, scanned.select("path", "block", F.coalesce(F.lag(reached).over(along), F.lit(0)).alias("begin")), "split-states")

    state = lambda c: F.when(F.col(f"{c}.fixed"), F.col(f"{c}.state")).otherwise((F.coalesce(f"{c}.state", F.lit(0)) + F.col("begin")) % 2)
    known = marked.join(broadcast_within(begun), ["path", "block"]).withColumns({"inside": state("before"), "open": state("after")})
    known = known.filter(~F.col("is_header")).select("path", "block", "seq", "line", "inside", "open")
    single = known.filter("inside = 0 AND open = 0").select("path", "block", "seq", "line")
    several = staged(spark, known.filter("inside = 1 OR open = 1"), "broken-lines")
    own = F.last(F.when(F.col("inside") == 0, F.col("seq")), ignorenulls=True).over(so_far)
    last_start = several.filter("inside = 0").groupBy("path", "block").agg(F.max("seq").alias("last"))
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    start = F.when(F.col("last").isNotNull(), F.struct("block", F.col("last").alias("seq")))
    carried = begun.join(last_start, ["path", "block"], "left").select("path", "block", F.last(start, ignorenulls=True).over(earlier).alias("carried"))
    placed = several.withColumn("_own", own).join(broadcast_within(staged(spark, carried, "carried")), ["path", "block"])
    record = F.when(F.col("_own").isNotNull(), F.struct("block", F.col("_own").alias("seq"))).otherwise(F.col("carried"))
    placed = staged(spark, placed.select("path", record.alias("record"), "block", "seq", "line"), "broken-records")
    lengths = placed.groupBy("path", "record").agg(F.sum(F.length("line") + 1).alias("_chars"))
    # of a record that is too long only the first line is kept
    short = placed.join(lengths, ["path", "record"]).filter((F.col("_chars") <= RECORD_CHARS) | (F.struct("block", "seq") == F.col("record")))
    parts = F.array_sort(F.collect_list(F.struct("block", "seq", "line")))
    stitched = short.groupBy("path", "record").agg(F.array_join(F.transform(parts, lambda p: p["line"]), "\n").alias("line"))
    whole = single.unionByName(stitched.select("path", "record.block", "record.seq", "line"))
    whole = whole.withColumn("line", F.regexp_replace("line", r"\r\z", "")).filter(~_is_blank(line, separator))
    return whole.withColumn("seq", F.row_number().over(in_split).cast("bigint"))


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    inventory: DataFrame,
    contracts: Sequence[FileContract],
    separator: str = "\t",
    line_breaks: bool = False,
) -> DelimitedRead:
    """Parse the files of ``inventory`` (see ``content_inventory``) that have a contract.

    A line's header is found by its file's path: the headers are broadcast if they are counted and
    fit, else shuffled. Without ``line_breaks`` each line is a record, and an open quote is a problem; with it, quoted cells
    may hold line breaks, at the price of two shuffles of the lines.
    """
    headers = parsed_headers(inventory, contracts, separator)
    side = headers.filter(F.col("problem").isNull()).select("path", "source_name", "object_id", "kind", "columns")
    found = (quoted_records if line_breaks else data_lines)(spark, paths, separator)
    lines = found.join(broadcast_within(side), "path")
    width = F.size("columns")
    surplus = F.slice(F.col("_cells"), width + 1, F.greatest(F.size("_cells") - width, F.lit(0)))
    problem = (
        F.when(_open_quote(F.col("line"), separator), F.lit(OPEN_QUOTE))
        .when(F.size("_cells") < width, F.lit("wrong field count"))
        .when(F.exists(surplus, lambda c: c != ""), F.lit("wrong field count"))
    )
    fields = F.map_from_arrays("columns", F.transform(F.slice(F.col("_cells"), F.lit(1), width), strip))
    parsed = (
        lines.withColumn("_cells", _cells(F.col("line"), separator))
        .withColumn("problem", problem)
        .select(
            "object_id",
            "source_name",
            "kind",
            "block",
            "seq",
            F.when(F.col("problem").isNull(), fields).alias("fields"),
            F.when(F.col("problem").isNotNull(), F.col("line")).alias("bad_line"),
            "problem",
        )
    )
    return DelimitedRead(headers, parsed)


def _open_quote(line: Column, separator: str) -> Column:
    """A cell that starts with a quote and never closes it."""
    sep = _literal(separator)
    closed = F.regexp_replace(line, rf'(\A|{sep}){_QUOTED}', "$1")
    return line.contains('"') & closed.rlike(rf'(\A|{sep})"')


def require_lines(lines: DataFrame) -> None:
    """Raise if any line breaks its contract; ``lines`` should be stored."""
    bad = lines.filter(F.col("problem").isNotNull())
    if not bad.isEmpty():
        raise SchemaDrift(told("lines break their contract", bad, "source_name", "problem", "bad_line"), bad)


def require_headers(headers: DataFrame) -> None:
    """Raise on schema drift."""
    bad = headers.filter(F.col("problem").isNotNull())
    if not bad.isEmpty():
        raise SchemaDrift(told("headers break their contract", bad, "source_name", "problem"), bad)


def number_rows(df: DataFrame, file: str = "object_id", block: str = "block", seq: str = "seq") -> DataFrame:
    """Consecutive ``row_number`` from 1 within each file, in file order, without sorting any file.

    ``seq`` counts up by one inside a split, so a row's number is its distance from the split's first
    row plus the rows of the earlier splits. Only one record per split is windowed and, while that
    fits, broadcast, so the rows themselves are not shuffled. ``df`` must be stored: ``seq`` may not
    be drawn anew between the two reads.
    """
    starts = split_starts(df, file, block, seq).drop("n_rows")
    return (
        df.join(broadcast_within(starts), [file, block])
        .withColumn("row_number", F.col("before") + F.col(seq) - F.col("first") + 1)
        .drop("before", "first", block, seq)
    )


def split_starts(
    df: DataFrame, file: str = "object_id", block: str = "block", seq: str = "seq", more: Sequence[Column] = ()
) -> DataFrame:
    """(file, block, first, before, n_rows, more..): a split's first ``seq``, the rows of the file's earlier splits, and ``more``
    aggregates of the split's rows."""
    splits = df.groupBy(file, block).agg(F.min(seq).alias("first"), F.count(F.lit(1)).alias("n_rows"), *more)
    extra = [c for c in splits.columns if c not in (file, block, "first", "n_rows")]
    before = F.sum("n_rows").over(
        Window.partitionBy(file).orderBy(block).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ) - F.col("n_rows")
    return splits.select(file, block, "first", before.alias("before"), "n_rows", *extra)
