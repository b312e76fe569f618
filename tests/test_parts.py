"""Tables landed in part files, as tasks write them: single parts may be empty, not all of them."""
import os

import pytest

from __spark_entry__ import oracle_sql, queries
from oracle import compare, connect
from orestrata.sources.contracts import FileContract, PageContract, SchemaDrift
from orestrata.sources.snapshots import ingest, snapshot_records

FILES = (FileContract("points", r"points.*", ("key", "value"), in_parts=True),)
PAGES = (PageContract("pages", r"page.*\.json", ("Key",), (("key", ("Key",)),), in_parts=True),)


@pytest.mark.parametrize("name", ["ingested_orders", "ingested_pages", "quoted_orders"])
def test_ingests_of_tables_whose_first_task_has_no_rows(spark, sf_dir, name):
    # one row group in three splits: its rows are read where its middle lies
    third = os.path.getsize(f"{sf_dir}/orders.parquet") // 3 + 1
    settings = {
        "spark.sql.files.maxPartitionBytes": str(third),
        "spark.sql.files.openCostInBytes": "0",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        mine, theirs, differences = compare(queries()[name](spark, sf_dir), connect(sf_dir), oracle_sql()[name])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert not differences and mine == theirs > 0


def keys(spark, store):
    return sorted(r.fields["key"] for r in snapshot_records(spark, store).collect())


def test_parts_without_rows(spark, tmp_path):
    landing, store = tmp_path / "landing", str(tmp_path / "store")
    landing.mkdir()
    (landing / "points.0").write_text("key\tvalue\n")
    (landing / "page0.json").write_text("")
    for lacking in ("points.1", "page1.json"):
        with pytest.raises(SchemaDrift, match="empty tables") as error:
            ingest(spark, str(landing), store, FILES, PAGES)
        of_kind = {"points.1": "points.0", "page1.json": "page0.json"}
        assert {r.source_name for r in error.value.problems.collect()} == {of_kind[lacking]}
        assert not os.path.exists(f"{store}/commits")
        (landing / lacking).write_text("key\tvalue\na\t1\n" if lacking == "points.1" else '{"data": [{"Key": "b"}]}')
    ingest(spark, str(landing), store, FILES, PAGES)
    assert keys(spark, store) == ["a", "b"]
    # the rows of the table are stored already
    (landing / "points.2").write_text("key\tvalue\n")
    (landing / "page2.json").write_text("")
    assert ingest(spark, str(landing), store, FILES, PAGES).counts["added"] == 2
    assert keys(spark, store) == ["a", "b"]
    # what held the rows is withdrawn
    (landing / "points.1").unlink()
    (landing / "points.2").write_text("key\tvalue\n\n")
    with pytest.raises(SchemaDrift, match="empty tables"):
        ingest(spark, str(landing), store, FILES, PAGES)
    assert keys(spark, store) == ["a", "b"]


def test_files_that_are_tables_may_not_be_empty(spark, tmp_path):
    landing, store = tmp_path / "landing", str(tmp_path / "store")
    landing.mkdir()
    (landing / "points.0").write_text("key\tvalue\n")
    (landing / "points.1").write_text("key\tvalue\na\t1\n")
    with pytest.raises(SchemaDrift, match="empty tables: points.0"):
        ingest(spark, str(landing), store, (FileContract("points", r"points.*", ("key", "value")),))
