"""Stores that lose, double, mix up or alter rows are mended; errors leave nothing behind; quoted cells over several lines."""
import csv
import io
import os
import random
import shutil
from collections import Counter

import pytest

from orestrata.session import staged
from orestrata.sources.contracts import FileContract, PageContract, SchemaDrift
from orestrata.sources.delimited import number_rows, quoted_records, read_delimited
from orestrata.sources.inventory import content_inventory
from orestrata.sources.snapshots import ingest, snapshot_records, stored_objects

FILES = (FileContract("points", r"points.*", ("key", "value")),)
PAGES = (PageContract("pages", r"page.*\.json", ("Key",), (("key", ("Key",)),)),)


@pytest.fixture
def landed(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    for n in range(6):
        (landing / f"points.{n}").write_text("key\tvalue\n" + "".join(f"k{n}.{i}\t{i}\n" for i in range(50 + n)))
    (landing / "page.json").write_text('{"page": {"total": 3, "offset": 0}, "data": [{"Key": "a"}, {"Key": "b"}, {"Key": null}]}')
    store = str(tmp_path / "store")
    first = ingest(spark, str(landing), store, FILES, PAGES)
    return landing, store, first


def rows_of(spark, store):
    return Counter((r.source_name, r.row_number, tuple(sorted(r.fields.items()))) for r in snapshot_records(spark, store).collect())


def parts(store):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(f"{store}/records") for f in names if f.endswith(".parquet"))


def drop_checksum(path):
    folder, name = os.path.split(path)
    if os.path.exists(f"{folder}/.{name}.crc"):
        os.remove(f"{folder}/.{name}.crc")


def lose(spark, store):
    os.remove(parts(store)[0])


def double(spark, store):
    path = parts(store)[0]
    shutil.copy(path, path.replace("part-", "part-9"))


def rewrite(change):
    def damage(spark, store):
        import pyarrow.parquet as pq

        path = max(parts(store), key=os.path.getsize)
        table = pq.read_table(path)
        drop_checksum(path)
        pq.write_table(change(table), path)

    return damage


def swapped(table):
    """Two rows of different objects change places."""
    import pyarrow as pa

    rows = table.to_pylist()
    other = next(r for r in rows if r["object_id"] != rows[0]["object_id"]) if len({r["object_id"] for r in rows}) > 1 else None
    if other is None:
        rows[0]["object_id"] = "0" * 64
    else:
        rows[0]["object_id"], other["object_id"] = other["object_id"], rows[0]["object_id"]
    return pa.Table.from_pylist(rows, table.schema)


def altered(table):
    import pyarrow as pa

    rows = table.to_pylist()
    rows[0]["fields"] = [(k, "other" if k == "value" else v) for k, v in rows[0]["fields"]]
    return pa.Table.from_pylist(rows, table.schema)


@pytest.mark.parametrize(("damage", "verify"), [(lose, False), (double, False), (rewrite(swapped), True), (rewrite(altered), True)])
def test_damage_is_noticed_and_mended(spark, landed, damage, verify):
    landing, store, first = landed
    before = rows_of(spark, store)
    assert sum(before.values()) == sum(50 + n for n in range(6)) + 3
    damage(spark, store)
    assert rows_of(spark, store) != before
    again = ingest(spark, str(landing), store, FILES, PAGES, verify=verify)
    assert not again.changed and again.snapshot_id == first.snapshot_id and 0 < again.repaired <= 7
    assert rows_of(spark, store) == before
    batches = stored_objects(spark, store).select("batch").distinct().count()
    third = ingest(spark, str(landing), store, FILES, PAGES, verify=verify)
    assert third.repaired == 0 and stored_objects(spark, store).select("batch").distinct().count() == batches


def test_lost_splits_are_mended(spark, landed):
    landing, store, _ = landed
    before = rows_of(spark, store)
    shutil.rmtree(f"{store}/splits")
    assert ingest(spark, str(landing), store, FILES, PAGES, verify=True).repaired == 6
    assert rows_of(spark, store) == before


@pytest.mark.parametrize(
    ("name", "text", "n"),
    [
        ("points.x", "key\tvalue\na\t1\nshort\n", 1),
        ("points.x", 'key\tvalue\na\t"1\n', 1),
        ("points.x", "key\tvalue\n", 1),
        ("points.x", "key\tother\na\t1\n", 1),
        ("page.x.json", '{"page": {"total": 9}, "data": [{"Key": "a"}]}', 1),
        ("page.x.json", '{"data": [{"Kye": "a"}]}', 1),
        ("page.x.json", "", 1),
        ("page.x.json", '{"data": [', None),
    ],
)
def test_problems_stay_readable_and_nothing_is_left(spark, landed, name, text, n):
    landing, store, first = landed
    before, folders = rows_of(spark, store), {d for d, _, _ in os.walk(store)}
    (landing / name).write_text(text)
    with pytest.raises(Exception) as error:
        ingest(spark, str(landing), store, FILES, PAGES)
    if n is None:
        assert not isinstance(error.value, SchemaDrift)
    else:
        assert isinstance(error.value, SchemaDrift) and {r.source_name for r in error.value.problems.collect()} == {name}
    assert {d for d, _, _ in os.walk(store)} == folders
    assert rows_of(spark, store) == before


def quoted_file(chance):
    cell = lambda: "".join(chance.choice(["a", "b", " ", '""', "\n", "\t", "\r\n", "\n\n"]) for _ in range(chance.randint(0, 7)))
    plain = lambda: "".join(chance.choice("xy z") for _ in range(chance.randint(0, 4)))
    def one():
        kind = chance.randint(0, 5)
        return [plain(), plain(), f'p"{plain()}', f'"{cell()}"', f'"{cell()}"', f'"{cell()}"q{plain()}"'][kind]

    end = chance.choice(["\n", "\r\n"])
    rows = [f"{one()}\t{one()}" if chance.random() < 0.9 else "" for _ in range(chance.randint(0, 14))]
    return "key\tvalue" + end + end.join(rows) + (end if chance.random() < 0.7 else "")


def expected_rows(text):
    rows = list(csv.reader(io.StringIO(text, newline=""), delimiter="\t"))[1:]
    rows = [[c.strip() for c in r + [""] * (2 - len(r))] for r in rows if any(c.strip() for c in r)]
    return [tuple(r) for r in rows]


@pytest.mark.parametrize(("n", "split", "seed"), [(500, 1 << 27, 1), (8, 5, 2), (12, 23, 3), (25, 90, 4)])
def test_quoted_line_breaks_agree_with_the_standard_library(spark, tmp_path, n, split, seed):
    chance = random.Random(seed)
    folder = tmp_path / "landing"
    folder.mkdir()
    expected = {}
    for i in range(n):
        text = quoted_file(chance)
        (folder / f"points.{i}").write_bytes(text.encode())
        expected[f"points.{i}"] = expected_rows(text)
    inventory = staged(spark, content_inventory(spark, str(folder)), "inventory")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        read = read_delimited(spark, str(folder), inventory, FILES, line_breaks=True)
        lines = staged(spark, read.lines, "lines")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    bad = lines.filter("problem IS NOT NULL").collect()
    assert not bad, bad[:3]
    found = {name: {} for name in expected}
    for r in number_rows(lines).select("source_name", "row_number", "fields").collect():
        found[r.source_name][r.row_number] = (r.fields["key"], r.fields["value"])
    assert {k: [v for _, v in sorted(rows.items())] for k, rows in found.items()} == expected
    assert all(sorted(rows) == list(range(1, len(rows) + 1)) for rows in found.values())


def test_a_quote_that_never_closes_and_long_records(spark, tmp_path, monkeypatch):
    from orestrata.sources import delimited

    monkeypatch.setattr(delimited, "RECORD_CHARS", 100)
    path = tmp_path / "points.1"
    path.write_text('key\tvalue\na\t"x\ny"\nb\t"' + "long\n" * 30 + '"\nc\t1\nd\t"open\nfor\never\n')
    found = {r.line: r.seq for r in quoted_records(spark, str(path)).collect()}
    assert found == {'a\t"x\ny"': 1, 'b\t"long': 2, "c\t1": 3, 'd\t"open\nfor\never\n': 4} or found == {'a\t"x\ny"': 1, 'b\t"long': 2, "c\t1": 3, 'd\t"open\nfor\never': 4}


def test_files_with_line_breaks_are_taken_in_beside_others(spark, tmp_path):
    landing, store = tmp_path / "landing", str(tmp_path / "store")
    landing.mkdir()
    (landing / "points.1").write_text('key\tvalue\na\t"x\n\ny"\nb\t2\n')
    (landing / "points.2").write_text("key\tvalue\nc\t3\n")
    ingest(spark, str(landing), store, FILES)
    found = {(r.source_name, r.row_number): (r.fields["key"], r.fields["value"]) for r in snapshot_records(spark, store).collect()}
    assert found == {("points.1", 1): ("a", "x\n\ny"), ("points.1", 2): ("b", "2"), ("points.2", 1): ("c", "3")}
    assert ingest(spark, str(landing), store, FILES, verify=True).repaired == 0
