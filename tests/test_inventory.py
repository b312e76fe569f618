"""Identities of landed files, whole and in splits; row numbers across splits."""
import hashlib

import pytest
from pyspark.sql import functions as F

from orestrata.session import staged
from orestrata.sources import inventory
from orestrata.sources.contracts import FileContract
from orestrata.sources.delimited import number_rows, read_delimited
from orestrata.sources.inventory import content_inventory, listing

LINES = [f"k{i}\t{i % 7}\t" for i in range(4000)]
CONTRACT = (FileContract("points", r"points.*", ("key", "value")),)


def write(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(["key\tvalue\tnote", *lines]) + "\n")
    return str(folder)


@pytest.fixture
def small_splits(spark):
    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield use
    for name, value in before.items():
        spark.conf.set(name, value)


def test_digests_match_hashlib(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    bodies = {"a b.txt": b"", "é+x#?.txt": b"", "b c%.txt": "é\n".encode(), "raw.bin": bytes(range(256))}
    for name, body in bodies.items():
        (folder / name).write_bytes(body)
    found = {r.source_name: r for r in content_inventory(spark, str(folder)).collect()}
    assert found.keys() == bodies.keys()
    for name, body in bodies.items():
        assert found[name].sha256 == hashlib.sha256(body).hexdigest()
        assert found[name].object_id == hashlib.sha256(name.encode() + b"\0" + body).hexdigest()
        assert found[name].bytes == len(body)
        assert found[name].is_utf8 == (name != "raw.bin")
    assert {r.source_name for r in listing(spark, str(folder)).collect()} == set(bodies)


def test_equal_bytes_under_two_names_are_two_objects(spark, tmp_path):
    folder = write(tmp_path / "landing", "points.1", LINES[:5])
    write(tmp_path / "landing", "points.2", LINES[:5])
    rows = content_inventory(spark, folder).collect()
    assert len({r.sha256 for r in rows}) == 1 and len({r.object_id for r in rows}) == 2


@pytest.fixture
def streamed_above(monkeypatch):
    def use(size):
        monkeypatch.setattr(inventory, "STREAM_ABOVE", size)

    return use


@pytest.mark.parametrize("size", [1, inventory.PIECE - 1, inventory.PIECE, inventory.PIECE + 1, 3 * inventory.PIECE])
def test_identity_is_the_same_by_either_way(spark, tmp_path, small_splits, streamed_above, size):
    folder = tmp_path / "landing"
    (folder / "a b").mkdir(parents=True)
    body = (b"key\tv\xc3\xa4lue\r\n" + bytes(range(1, 120)) * (size // 119 + 1))[:size]
    (folder / "a b" / "x[1]%.tsv").write_bytes(body)
    streamed_above(1 << 30)
    whole = content_inventory(spark, str(folder)).first()
    streamed_above(0)
    small_splits(70_000)
    parts = content_inventory(spark, str(folder)).first()
    assert whole == parts
    name = "a b/x[1]%.tsv"
    assert (whole.source_name, whole.bytes, whole.sha256) == (name, size, hashlib.sha256(body).hexdigest())
    assert whole.object_id == hashlib.sha256(name.encode() + b"\0" + body).hexdigest()


def test_line_ends_count(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    for name, body in {"n": b"a\n2\n3", "r": b"a\n2\r3"}.items():
        (folder / name).write_bytes(body)
    assert len({r.sha256 for r in content_inventory(spark, str(folder)).collect()}) == 2


@pytest.mark.parametrize("above", [0, 10_000])
def test_invalid_text_is_noticed(spark, tmp_path, streamed_above, above):
    streamed_above(above)
    folder = write(tmp_path / "landing", "good", LINES[:50])
    (tmp_path / "landing" / "bad").write_bytes(b"key\tvalue\na\t1\nb\t\xff\n")
    (tmp_path / "landing" / "cut").write_bytes("key\n\u00e9".encode()[:-1])
    found = {r.source_name: r.is_utf8 for r in content_inventory(spark, folder).collect()}
    assert found == {"good": True, "bad": False, "cut": False}


def test_unchanged_files_are_not_read(spark, tmp_path, monkeypatch):
    folder = write(tmp_path / "landing", "points.1", LINES[:50])
    write(tmp_path / "landing" / "below", "points.1", LINES[:9])
    known = staged(spark, content_inventory(spark, folder), "known")
    monkeypatch.setattr(inventory, "path_batches", lambda files: iter([]) if files.isEmpty() else pytest.fail("read"))
    again = content_inventory(spark, folder, known)
    assert sorted(again.collect()) == sorted(known.collect())
    assert {r.source_name for r in again.collect()} == {"points.1", "below/points.1"}


def test_paths_go_in_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(inventory, "PATHS_AT_ONCE", 2)
    for i in range(5):
        folder = write(tmp_path / "landing", f"points{{{i}}}?*[a]", LINES[:i])
    found = content_inventory(spark, folder).collect()
    assert len({r.sha256 for r in found}) == 5 == len(found)


def content_splits(spark, folder):
    return spark.read.text(folder).select("_metadata.file_block_start").distinct().count()


def test_rows_are_numbered_across_splits(spark, tmp_path, small_splits):
    folder = write(tmp_path / "landing", "points.1", [*LINES[:1500], "", "  \t ", *LINES[1500:]])
    write(tmp_path / "landing", "points.2", LINES[:10])
    found = staged(spark, content_inventory(spark, folder), "inventory")
    small_splits(3000)
    lines = staged(spark, read_delimited(spark, folder, found, CONTRACT).lines, "lines")
    assert lines.select("block").distinct().count() > 4
    assert lines.filter(F.col("problem").isNotNull()).count() == 0
    rows = number_rows(lines).select("source_name", "row_number", F.col("fields")["key"].alias("key")).collect()
    numbers = {(r.source_name, r.row_number): r.key for r in rows}
    assert numbers == {("points.1", i + 1): f"k{i}" for i in range(4000)} | {
        ("points.2", i + 1): f"k{i}" for i in range(10)
    }
