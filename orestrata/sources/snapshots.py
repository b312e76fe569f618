"""Snapshots of landed files: compare, store what is new, publish the inventory last.

Folder layout below ``store`` (all Parquet):

``records/batch=<id>/kind=<kind>``  parsed rows of the objects that were new in a batch, each with a hash of its content
``splits/batch=<id>``               where the rows of each split of a delimited file begin
``objects``                         one row per stored object: (batch, object_id, .., n_rows, checksum)
``verified``                        batches that were found damaged, with the number of rows they were found with
``inventory/snapshot_id=<id>``      one row per active source of a snapshot
``commits``                         one row per published snapshot; the last write of a run

Readers start from ``commits``, and rows count only once ``objects`` names their batch, which is written after the
landed files were found unchanged. A run that stops half-way leaves nothing visible.

An object's checksum is the number of its rows and the sum of their hashes. It doesn't depend on order or on how rows lie
in files, so it is added up from the pass that writes the rows, and anything that is lost, doubled, moved to another
object or altered changes it. Every ingest compares the rows of a batch as the file footers count them, and where that
number is not the one stated, the checksums of the batch's objects; ``verify`` compares all checksums. Objects that differ
are parsed again from their landed files.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orestrata.operators.quality import Rule, check
from orestrata.session import delete_folder, literal_rows, side_by_side, staged, time_ordered_id
from orestrata.sources.contracts import FileContract, PageContract, SchemaDrift, kind_of, told
from orestrata.sources.delimited import OPEN_QUOTE, DelimitedRead, read_delimited, require_headers, split_starts
from orestrata.sources.inventory import content_inventory, listing, path_batches
from orestrata.sources.json_pages import exploded_pages, page_documents
from orestrata.sources.page_splits import split_pages
from orestrata.sources.sizing import broadcast_within

INVENTORY_SCHEMA = (
    "source_name STRING, location STRING, sha256 STRING, object_id STRING, kind STRING, bytes BIGINT, "
    "modified TIMESTAMP, header STRING, is_utf8 BOOLEAN, status STRING, snapshot_id STRING"
)
OBJECTS_SCHEMA = "batch STRING, object_id STRING, source_name STRING, sha256 STRING, kind STRING, n_rows BIGINT, checksum DECIMAL(38,0)"
VERIFIED_SCHEMA = "batch STRING, n_rows BIGINT"
COMMITS_SCHEMA = (
    "snapshot_id STRING, committed_at STRING, files BIGINT, added BIGINT, changed BIGINT, unchanged BIGINT, deleted BIGINT"
)
RECORDS_SCHEMA = (
    "object_id STRING, source_name STRING, row_number BIGINT, block BIGINT, seq BIGINT, fields MAP<STRING, STRING>, "
    "row_hash BIGINT, batch STRING, kind STRING"
)
SPLITS_SCHEMA = "object_id STRING, block BIGINT, first BIGINT, before BIGINT, batch STRING"


class ImmutableObjectChanged(ValueError):
    """Other content under a key that is already stored; the second argument holds all such keys."""


class LandingChanged(RuntimeError):
    """Files changed between the inventory and the end of parsing."""


@dataclass(frozen=True)
class IngestResult:
    changed: bool
    snapshot_id: str | None
    counts: dict[str, int] = field(default_factory=dict)
    #: stored objects that were damaged and have been stored again
    repaired: int = 0


# --- operators on inventories -----------------------------------------------------------------


def diff_inventory(old: DataFrame, new: DataFrame, key: str = "source_name", digest: str = "sha256") -> DataFrame:
    """(key, status): added, changed, unchanged or deleted. Presence decides, not NULL payloads."""
    before = old.select(key, F.col(digest).alias("_old"), F.lit(True).alias("_was"))
    after = new.select(key, F.col(digest).alias("_new"), F.lit(True).alias("_is"))
    status = (
        F.when(F.col("_was").isNull(), "added")
        .when(F.col("_is").isNull(), "deleted")
        .when(F.col("_old").eqNullSafe(F.col("_new")), "unchanged")
        .otherwise("changed")
    )
    return before.join(after, key, "full_outer").select(key, status.alias("status"))


def unstored(candidates: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Candidates whose key is not stored yet; an identical rewrite is thereby a no-op."""
    return candidates.join(stored.select(key).distinct(), key, "left_anti")


def immutability_conflicts(candidates: DataFrame, stored: DataFrame, key: str, digest: str) -> DataFrame:
    """Keys that carry more than one digest among candidates and stored objects together."""
    both = candidates.select(key, digest).unionByName(stored.select(key, digest))
    spread = both.groupBy(key).agg(
        F.min(digest).alias("_low"), F.max(digest).alias("_high"), F.count_if(F.col(digest).isNull()).alias("_null")
    )
    odd = (F.col("_low") != F.col("_high")) | ((F.col("_null") > 0) & F.col("_low").isNotNull())
    return spread.filter(odd).select(key)


def write_once(candidates: DataFrame, stored: DataFrame, key: str, digest: str) -> DataFrame:
    """The rows to append, after making sure that no key changes its content."""
    bad = immutability_conflicts(candidates, stored, key, digest)
    if not bad.isEmpty():
        raise ImmutableObjectChanged(told("other content under stored keys", bad, key), bad)
    return unstored(candidates.dropDuplicates([key]), stored, key)


# --- the store ---------------------------------------------------------------------------------


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``, or an empty one before its first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return literal_rows(spark, [], schema)


def commits(spark: SparkSession, store: str) -> DataFrame:
    return _table(spark, f"{store}/commits", COMMITS_SCHEMA)


def latest_snapshot(spark: SparkSession, store: str) -> str | None:
    """The id of the newest published snapshot (ids sort by time)."""
    return commits(spark, store).agg(F.max("snapshot_id").alias("id")).first()["id"]


def inventory_at(spark: SparkSession, store: str, snapshot_id: str | None) -> DataFrame:
    """The active sources of a snapshot; a literal id prunes to one partition."""
    table = _table(spark, f"{store}/inventory", INVENTORY_SCHEMA)
    return table.filter((F.col("snapshot_id") == F.lit(snapshot_id)) & (F.col("status") != "deleted"))


def deleted_sources(spark: SparkSession, store: str, snapshot_id: str) -> DataFrame:
    """(source_name) of all files that were gone when a snapshot was published."""
    table = _table(spark, f"{store}/inventory", INVENTORY_SCHEMA)
    return table.filter((F.col("snapshot_id") == F.lit(snapshot_id)) & (F.col("status") == "deleted")).select("source_name")


def stored_objects(spark: SparkSession, store: str) -> DataFrame:
    """One row per object, pointing at the newest batch that holds its rows."""
    table = _table(spark, f"{store}/objects", OBJECTS_SCHEMA)
    rest = [c for c in table.columns if c not in ("batch", "object_id")]
    newest = F.max(F.struct("batch", *rest)).alias("_o")
    return table.groupBy("object_id").agg(newest).select("object_id", "_o.*")


def snapshot_records(spark: SparkSession, store: str, snapshot_id: str | None = None) -> DataFrame:
    """The record envelopes of a snapshot (default: the newest).

    Batches with an active object are picked by partition, then the objects in them that were
    replaced or deleted since are taken out. Both sides grow with the number of runs and of revised
    files, not with the data, so they stay small enough to be broadcast long after a list of all
    active objects would have forced a shuffle of the records.
    """
    snapshot_id = snapshot_id or latest_snapshot(spark, store)
    registry = _table(spark, f"{store}/objects", OBJECTS_SCHEMA).select("batch", "object_id")
    wanted = inventory_at(spark, store, snapshot_id).select("object_id", F.lit(True).alias("_wanted"))
    current = registry.groupBy("object_id").agg(F.max("batch").alias("_newest"))
    objects = (
        registry.join(current, "object_id")
        .join(wanted.distinct(), "object_id", "left")
        .select("batch", "object_id", (F.col("_wanted").isNotNull() & (F.col("batch") == F.col("_newest"))).alias("active"))
    )
    objects = staged(spark, objects, "objects")
    batches = objects.filter("active").select("batch").distinct()
    stale = objects.filter(~F.col("active")).join(batches, "batch", "left_semi").select("batch", "object_id").distinct()
    records = _table(spark, f"{store}/records", RECORDS_SCHEMA)
    active = records.join(broadcast_within(batches), "batch", "left_semi").join(
        broadcast_within(stale), ["batch", "object_id"], "left_anti"
    )
    # one row per split of a delimited file
    splits = staged(spark, _table(spark, f"{store}/splits", SPLITS_SCHEMA).join(batches, "batch", "left_semi"), "splits")
    number = F.coalesce(F.col("row_number"), F.col("before") + F.col("seq") - F.col("first") + 1)
    return active.join(broadcast_within(splits), ["batch", "object_id", "block"], "left").select(
        "object_id", "source_name", "kind", number.alias("row_number"), "fields"
    )


def row_hash() -> Column:
    """A hash of a stored row's content and place, the same whenever it is taken."""
    cells = F.to_json("fields", {"ignoreNullFields": "false"})
    return F.xxhash64("object_id", "source_name", "row_number", F.coalesce("block", F.lit(-1)), F.coalesce("seq", F.lit(-1)), cells)


def checksum(hashes: Column) -> Column:
    """The sum of hashes; wide enough for any number of rows."""
    return F.sum(hashes.cast("decimal(28,0)")).cast("decimal(38,0)")


def suspect_batches(spark: SparkSession, store: str, every: bool = False) -> DataFrame:
    """(batch, n_rows found) of batches whose rows, as file footers count them, are not those that the registry states, unless they
    were found with that number and mended before. ``every``: all batches."""
    stated = _table(spark, f"{store}/objects", OBJECTS_SCHEMA).groupBy("batch").agg(F.sum("n_rows").alias("_stated"))
    counted = _table(spark, f"{store}/records", RECORDS_SCHEMA).groupBy("batch").agg(F.count(F.lit(1)).alias("_found"))
    known = _table(spark, f"{store}/verified", VERIFIED_SCHEMA).select("batch", F.col("n_rows").alias("_found"), F.lit(True).alias("_known"))
    found = F.coalesce("_found", F.lit(0))
    both = stated.join(counted, "batch", "left").select("batch", "_stated", found.alias("_found"))
    odd = F.lit(True) if every else (F.col("_stated") != F.col("_found")) & F.col("_known").isNull()
    return both.join(known.distinct(), ["batch", "_found"], "left").filter(odd).select("batch", F.col("_found").alias("n_rows"))


def damaged_objects(spark: SparkSession, store: str, suspects: DataFrame) -> DataFrame:
    """The stored objects, in the batches ``suspects``, whose rows are not those that were written: other in number, content or
    place, or without the splits that number them."""
    batches = suspects.select("batch")
    rows = _table(spark, f"{store}/records", RECORDS_SCHEMA).join(broadcast_within(batches), "batch", "left_semi")
    found = rows.groupBy("batch", "object_id").agg(
        F.count(F.lit(1)).alias("_rows"), checksum(row_hash()).alias("_sum"), F.count("block").alias("_in_splits")
    )
    splits = _table(spark, f"{store}/splits", SPLITS_SCHEMA.replace("batch", "n_rows BIGINT, batch")).join(batches, "batch", "left_semi")
    numbered = splits.groupBy("batch", "object_id").agg(F.sum("n_rows").alias("_numbered"))
    stated = stored_objects(spark, store).join(batches, "batch", "left_semi")
    both = stated.join(found, ["batch", "object_id"], "left").join(numbered, ["batch", "object_id"], "left")
    zero = F.lit(0)
    # rows that were stored before there were checksums state none
    other_sum = F.col("checksum").isNotNull() & (F.col("checksum") != F.coalesce("_sum", zero))
    odd = (F.col("n_rows") != F.coalesce("_rows", zero)) | other_sum | (F.coalesce("_in_splits", zero) != F.coalesce("_numbered", zero))
    return both.filter(odd).select(*stated.columns)


# --- ingest -----------------------------------------------------------------------------------


def ingest(
    spark: SparkSession,
    landing: str,
    store: str,
    files: Sequence[FileContract],
    pages: Sequence[PageContract] = (),
    reread: bool = False,
    verify: bool = False,
) -> IngestResult:
    """Bring the store up to the landed files and publish a snapshot if anything changed.

    Files whose size and modification time are those of the previous snapshot are not read again. ``reread`` reads and
    hashes all of them, for stores that don't keep modification times apart. ``verify`` recomputes the checksums of all
    stored objects, not only of those in batches whose number of rows is wrong. A damaged object is stored again from its
    landed file; one whose file has gone is no longer part of the newest snapshot and stays as it is.
    """
    previous = latest_snapshot(spark, store)
    old = inventory_at(spark, store, previous)
    found = content_inventory(spark, landing, None if reread or previous is None else old).withColumn(
        "kind", kind_of(F.col("source_name"), [*files, *pages])
    )
    new = staged(spark, found, "inventory")
    one_per_name = Rule("one file per name", "copies = 1")
    _, status = side_by_side(
        spark,
        lambda: check(
            new.groupBy("source_name").agg(F.count(F.lit(1)).alias("copies")), [one_per_name], "landing"
        ),
        lambda: staged(spark, diff_inventory(old, new), "diff"),
    )

    def missing_objects() -> tuple[DataFrame, DataFrame | None, int]:
        known = stored_objects(spark, store)
        wanted = new.filter(F.col("kind").isNotNull())
        suspects = staged(spark, suspect_batches(spark, store, verify), "suspects")
        damaged, n = None, 0
        if not suspects.isEmpty():
            damaged = staged(spark, damaged_objects(spark, store, suspects), "damaged")
            n = damaged.join(wanted, "object_id", "left_semi").count()
            known = known.join(broadcast_within(damaged.select("object_id")), "object_id", "left_anti")
        return staged(spark, write_once(wanted, known, "object_id", "sha256"), "todo"), suspects, n

    per_status, (todo, suspects, repaired) = side_by_side(spark, lambda: status.groupBy("status").count().collect(), missing_objects)
    counts = dict.fromkeys(("added", "changed", "unchanged", "deleted"), 0)
    counts |= {r["status"]: r["count"] for r in per_status}
    if not sum(counts.values()) - counts["deleted"]:
        raise SchemaDrift("nothing has landed; refusing to read it as a mass deletion")

    batch = time_ordered_id()
    if not todo.isEmpty():
        rows = _store_rows(spark, store, batch, new, todo, files, pages)
        _require_unmoved(spark, landing, new)
        # from here on the rows count
        registry = todo.join(rows, "object_id", "left").select(
            F.lit(batch).alias("batch"),
            "object_id",
            "source_name",
            "sha256",
            "kind",
            F.coalesce("n_rows", F.lit(0).cast("bigint")).alias("n_rows"),
            F.coalesce("checksum", F.lit(0).cast("decimal(38,0)")).alias("checksum"),
        )
        registry.write.mode("append").parquet(f"{store}/objects")
    if suspects is not None and not verify:
        # what could be mended is; the batch is not looked into again unless its number of rows changes
        suspects.write.mode("append").parquet(f"{store}/verified")
    if not counts["added"] + counts["changed"] + counts["deleted"]:
        return IngestResult(False, previous, counts, repaired)

    gone = old.join(status.filter(F.col("status") == "deleted"), "source_name", "left_semi")
    columns = ["source_name", "location", "sha256", "object_id", "kind", "bytes", "modified", "header", "is_utf8", "status"]
    rows = (
        new.join(status, "source_name")
        .select(*columns)
        .unionByName(gone.withColumn("status", F.lit("deleted")).select(*columns))
    )
    rows.write.mode("overwrite").parquet(f"{store}/inventory/snapshot_id={batch}")
    commit = (batch, datetime.now(timezone.utc).isoformat(), sum(counts.values()) - counts["deleted"],
              counts["added"], counts["changed"], counts["unchanged"], counts["deleted"])
    literal_rows(spark, [commit], COMMITS_SCHEMA).write.mode("append").parquet(f"{store}/commits")
    return IngestResult(True, batch, counts, repaired)


def _store_rows(spark, store, batch, landed, todo, files, pages) -> DataFrame:
    """Parse the objects of ``todo`` under their contracts and write their rows -> (object_id, n_rows, checksum).

    Each object is parsed once, in the pass that writes its rows; problems are counted in that pass. Any error stops the
    run and takes the batch's rows away again; the frame of a broken contract's problems stays readable."""
    target = f"{store}/records/batch={batch}"
    try:
        parts = [_store_delimited(spark, store, batch, landed, todo, files)] if files else []
        parts += [_store_pages(spark, store, target, landed, todo.filter(F.col("kind") == c.kind), c) for c in pages]
    except BaseException:
        for folder in (target, f"{store}/splits/batch={batch}"):
            delete_folder(spark, folder)
        raise
    rows = literal_rows(spark, [], "object_id STRING, n_rows BIGINT, checksum DECIMAL(38,0)")
    for part in parts:
        rows = rows if part is None else rows.unionByName(part)
    return rows


def _require_rows(spark, store, landed, found, bare, contracts) -> None:
    """Raise for the objects ``bare``, which hold no row, unless they are parts of a table that has rows in other landed files:
    in those of this batch, ``found``, or in those that are stored already."""
    in_parts = F.col("kind").isin(*[c.kind for c in contracts if c.in_parts])
    known = found.select("object_id", "n_rows").unionByName(stored_objects(spark, store).select("object_id", "n_rows"))
    filled = landed.filter(in_parts).join(known.filter("n_rows > 0"), "object_id", "left_semi").select("kind").distinct()
    hollow = staged(spark, bare.join(filled, "kind", "left_anti"), "hollow")
    if not hollow.isEmpty():
        raise SchemaDrift(told("empty tables", hollow, "source_name"), hollow)


def _store_delimited(spark, store, batch, landed, todo, files) -> DataFrame | None:
    """Write the rows of delimited objects and the beginnings of their splits -> (object_id, n_rows, checksum)."""
    objects = todo.filter(F.col("kind").isin(*[c.kind for c in files]))
    target = f"{store}/records/batch={batch}"

    def stored(reads: list[DelimitedRead]) -> tuple[int, int]:
        n_bad = n_open = 0
        for read in reads:
            seen = Observation()
            bad, is_open = F.col("problem").isNotNull(), F.col("problem") == OPEN_QUOTE
            lines = read.lines.observe(seen, F.count_if(bad).alias("bad"), F.count_if(is_open).alias("open"))
            _append_rows(lines.withColumn("row_number", F.lit(None).cast("bigint")), target)
            n_bad, n_open = n_bad + seen.get.get("bad", 0), n_open + seen.get.get("open", 0)
        return n_bad, n_open

    # readers leave files without a byte out
    reads = [read_delimited(spark, paths, objects, files) for paths in path_batches(objects)]
    if not reads:
        return None
    require_headers(reads[0].headers)
    n_bad, n_open = stored(reads)
    if n_open:
        # lines are taken for records first, as nearly always they are; files where one is not are read again by states
        opened = reduce(DataFrame.unionByName, [r.lines for r in reads]).filter(F.col("problem") == OPEN_QUOTE)
        opened = staged(spark, opened.select("object_id").distinct(), "open-quotes")
        delete_folder(spark, target)
        plain, quoted = objects.join(opened, "object_id", "left_anti"), objects.join(opened, "object_id", "left_semi")
        reads = [read_delimited(spark, paths, plain, files) for paths in path_batches(plain)]
        reads += [read_delimited(spark, paths, quoted, files, line_breaks=True) for paths in path_batches(quoted)]
        n_bad, _ = stored(reads)
    if n_bad:
        bad = reduce(DataFrame.unionByName, [r.lines for r in reads]).filter(F.col("problem").isNotNull())
        bad = staged(spark, bad, "problems")
        raise SchemaDrift(told(f"{n_bad} lines break their contract", bad, "source_name", "problem", "bad_line"), bad)
    kinds = [c.kind for c in files]
    written = _table(spark, target, RECORDS_SCHEMA.replace("batch STRING, ", "")).filter(F.col("kind").isin(*kinds))
    starts = split_starts(written, more=[checksum(F.col("row_hash")).alias("checksum")])
    starts.write.mode("append").parquet(f"{store}/splits/batch={batch}")
    starts = spark.read.schema(SPLITS_SCHEMA.replace(", batch STRING", ", n_rows BIGINT, checksum DECIMAL(38,0)")).parquet(f"{store}/splits/batch={batch}")
    per_object = starts.groupBy("object_id").agg(F.sum("n_rows").alias("n_rows"), F.sum("checksum").cast("decimal(38,0)").alias("checksum"))
    filled = F.col("kind").isin(*[c.kind for c in files if not c.may_be_empty])
    bare = staged(spark, objects.filter(filled).join(per_object, "object_id", "left_anti"), "bare")
    if not bare.isEmpty():
        _require_rows(spark, store, landed, per_object, bare, files)
    return per_object


def _store_pages(spark, store, target, landed, objects, contract) -> DataFrame | None:
    """Write the rows of paged JSON objects -> (object_id, n_rows, checksum)."""
    ids = objects.select("path", "object_id", "source_name")

    def parsed(paths: list[str]) -> DataFrame:
        if contract.in_splits:
            return split_pages(spark, paths, contract).join(broadcast_within(ids), "path").drop("path")
        return exploded_pages(page_documents(spark, paths).join(broadcast_within(ids), "path"), contract, ("source_name", "object_id"))

    parts = [parsed(paths) for paths in path_batches(objects)]
    if not parts:
        return None
    _append_rows(reduce(DataFrame.unionByName, parts).withColumn("kind", F.lit(contract.kind)), target, "problem")
    written = _table(
        spark, f"{target}/kind={contract.kind}", "object_id STRING, source_name STRING, row_number BIGINT, row_hash BIGINT, problem STRING"
    )
    # stored aside: the rows of a batch that fails are deleted
    bad = staged(spark, written.filter(F.col("problem").isNotNull()), "problems")
    if not bad.isEmpty():
        raise SchemaDrift(told("pages break their contract", bad, "source_name", "problem"), bad)
    found = written.groupBy("object_id").agg(
        F.count(F.lit(1)).alias("n_rows"), checksum(F.col("row_hash")).alias("checksum"), F.count_if(F.col("row_number") == 1).alias("_documents")
    )
    found = staged(spark, found, "pages")
    hollow = (F.col("bytes") == 0) & F.lit(contract.in_parts)
    odd = objects.filter(~hollow).join(found, "object_id", "left").filter(F.coalesce("_documents", F.lit(0)) != 1)
    bare = objects.filter(hollow)
    if not bare.isEmpty():
        _require_rows(spark, store, landed, found, bare, [contract])
    if not odd.isEmpty():
        raise SchemaDrift(told("not one JSON document", odd, "source_name"), odd)
    return found.select("object_id", "n_rows", "checksum")


def _append_rows(rows: DataFrame, target: str, *more: str) -> None:
    names = ["object_id", "source_name", "kind", "row_number", "block", "seq", "fields", "row_hash", *more]
    rows = rows.withColumns({c: F.lit(None).cast("bigint") for c in ("block", "seq") if c not in rows.columns})
    rows = rows.withColumn("row_hash", row_hash())
    rows.select(*names).write.mode("append").partitionBy("kind").parquet(target)


def _require_unmoved(spark: SparkSession, landing: str, inventory: DataFrame) -> None:
    """A listing taken after parsing must equal the one the digests were taken from."""
    columns = ["path", "bytes", "modified"]
    now = listing(spark, landing).select(*columns)
    both = inventory.select(*columns).withColumn("_sign", F.lit(1)).unionByName(now.withColumn("_sign", F.lit(-1)))
    moved = both.groupBy(*columns).agg(F.sum("_sign").alias("_sign")).filter(F.col("_sign") != 0)
    if not moved.isEmpty():
        raise LandingChanged("landed files changed during the run; nothing was published")
