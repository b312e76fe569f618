"""Landed files to answers, on a small copy of the published formats."""
import json

import pytest

from orestrata.operators.quality import ExpectationFailed
from orestrata.plans import productivity
from orestrata.plans.tables import current_release, read_table
from orestrata.sources.contracts import SchemaDrift
from orestrata.sources import inventory, snapshots
from orestrata.sources.snapshots import LandingChanged, deleted_sources, latest_snapshot, snapshot_records, stored_objects

HEADER = "series_id\tyear\tperiod\tvalue\tfootnote_codes\n"
SERIES_HEADER = (
    "series_id\tsector_code\tclass_code\tmeasure_code\tduration_code\tseasonal\tbase_year\t"
    "footnote_codes\tbegin_year\tbegin_period\tend_year\tend_period\n"
)
# National population by year.
POPULATION = {
    2013: 316128839, 2014: 318857056, 2015: 321418821, 2016: 323127515, 2017: 325719178, 2018: 327167439,
    2019: 328239523, 2021: 331893745, 2022: 333287562, 2023: 334914896, 2024: 340110990,
}


def population_page(total=None):
    rows = [
        {"Nation ID": "01000US", "Nation": "United States", "Year": y, "Population": float(p)}
        for y, p in POPULATION.items()
    ]
    return json.dumps({"data": rows, "page": {"offset": 0, "total": len(rows) if total is None else total}})


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    observations = [
        ("PRS30006032", 1995, "Q01", "0.0"), ("PRS30006032", 2012, "Q01", "2.5"), ("PRS30006032", 2013, "Q01", "0.5"),
        ("PRS30006032", 2013, "Q02", "2"), ("PRS30006032", 2013, "Q05", "99999"), ("PRS30006032", 2014, "Q01", "-0.1"),
        ("PRS30006032", 2014, "Q02", "-"), ("PRS30006033", 2013, "Q05", "10"),
    ]
    line = "{:<17}\t{}\t{}\t{:>12}\t\t\n"
    (folder / "pr.data.0.Current").write_text(HEADER + "".join(line.format(*o) for o in observations[1:]))
    (folder / "pr.data.1.AllData").write_text(HEADER + "\n" + "".join(line.format(*o) for o in observations))
    (folder / "pr.series").write_text(
        SERIES_HEADER
        + "PRS30006032\t3000\t6\t03\t2\tS\t-\t\t1988\tQ01\t2026\tQ01\n"
        + "PRS30006033\t3000\t6\t03\t2\tS\t2017\t\t1988\tQ01\t2026\tQ01\n"
        + "PRS30006034\t3000\t6\t03\t2\tS\t-\t\t1988\tQ01\t2026\tQ01\n"
    )
    (folder / "pr.sector").write_text("sector_code\tsector_name\n3000\tManufacturing\n")
    (folder / "pr.class").write_text("class_code\tclass_text\n6\tEmployees\n")
    (folder / "pr.measure").write_text("measure_code\tmeasure_text\n03\tHours worked\n")
    (folder / "pr.duration").write_text("duration_code\tduration_text\n2\t% change quarter ago\n")
    (folder / "pr.seasonal").write_text("\ufeffSeasonal_code\tSeasonal_text\nS\tSeasonally adjusted\n", encoding="utf-8")
    (folder / "pr.period").write_text("period\tperiod_abbr\tperiod_name\nQ01\tQTR1\t1st quarter\n")
    (folder / "pr.footnote").write_text("footnote_code\tfootnote_text\n")
    (folder / "pr.txt").write_bytes(b"documentation \xff\xfe kept as it is")
    (folder / "population.json").write_text(population_page())
    return folder


def test_end_to_end(spark, landing, tmp_path):
    store, out = str(tmp_path / "store"), str(tmp_path / "out")
    first = productivity.ingest_landed(spark, str(landing), store)
    assert first.changed and first.counts == {"added": 12, "changed": 0, "unchanged": 0, "deleted": 0}
    records = snapshot_records(spark, store)
    numbers = sorted(r.row_number for r in records.filter("source_name = 'pr.data.1.AllData'").collect())
    assert numbers == list(range(1, 9))
    productivity.refresh_tables(spark, store, out)

    stats = read_table(spark, out, "gold_population_stats").first()
    assert (stats.year_count, stats.start_year, stats.end_year) == (6, 2013, 2018)
    assert stats.mean_population == pytest.approx(322069808.0)
    assert stats.stddev_population == pytest.approx(3796119.936934378)
    assert stats.stddev_sample == pytest.approx(4158441.040908095)

    best = {r.series_id: r for r in read_table(spark, out, "gold_best_year").collect()}
    assert len(best) == 3
    # 2012 and 2013 tie at 2.5
    assert (best["PRS30006032"].best_year, str(best["PRS30006032"].summed_value)) == (2012, "2.500000")
    assert best["PRS30006033"].status == best["PRS30006034"].status == "no_quarterly_observations"
    base = "Manufacturing | Employees | Hours worked | % change quarter ago | Seasonally adjusted"
    assert best["PRS30006032"].series_label == base
    assert best["PRS30006033"].series_label == base + " | Index base: 2017"

    points = {r.year: (str(r.value), r.population) for r in read_table(spark, out, "gold_series_population").collect()}
    assert points == {
        1995: ("0.000000", None), 2012: ("2.500000", None), 2013: ("0.500000", 316128839), 2014: ("-0.100000", 318857056),
    }
    checks = {r.check: r.passed for r in productivity.validate(spark, out).collect()}
    assert len(checks) == 13 and all(checks.values()), checks

    target = tmp_path / "export"
    productivity.export(spark, store, out, str(target))
    exported = spark.read.option("header", True).csv(str(target / "gold_series_population"))
    assert exported.count() == 4
    summary = spark.read.json(str(target / "summary")).first()
    assert (summary.source_files, summary.silver_observations, summary.gold_best_year) == (12, 8, 3)
    assert spark.read.json(str(target / "provenance")).count() == 12
    metrics = {(r.dataset, r.rule): (r.total, r.failed) for r in read_table(spark, out, "quality_metrics").collect()}
    assert metrics["typed_observations", "series_key"] == metrics["typed_observations", "value_or_marker"] == (15, 0)


def test_rerun_change_delete_and_repair(spark, landing, tmp_path):
    store = str(tmp_path / "store")
    first = productivity.ingest_landed(spark, str(landing), store)
    again = productivity.ingest_landed(spark, str(landing), store)
    assert not again.changed and again.snapshot_id == first.snapshot_id == latest_snapshot(spark, store)
    assert stored_objects(spark, store).select("batch").distinct().count() == 1

    before = {(r.source_name, r.row_number): dict(r.fields) for r in snapshot_records(spark, store).collect()}
    current = landing / "pr.data.0.Current"
    current.write_text(current.read_text().replace("-0.1", "9.5"))
    (landing / "pr.contacts").write_text("new documentation")
    (landing / "pr.txt").unlink()
    third = productivity.ingest_landed(spark, str(landing), store)
    assert third.changed and deleted_sources(spark, store, third.snapshot_id).collect() == [("pr.txt",)]
    assert third.counts == {"added": 1, "changed": 1, "unchanged": 10, "deleted": 1}
    after = {(r.source_name, r.row_number): dict(r.fields) for r in snapshot_records(spark, store).collect()}
    assert before.keys() == after.keys()
    assert {k[0] for k in before if before[k] != after[k]} == {"pr.data.0.Current"}
    # the earlier snapshot can still be read
    old = {(r.source_name, r.row_number): dict(r.fields) for r in snapshot_records(spark, store, first.snapshot_id).collect()}
    assert old == before
    # conflicting overlap: nothing is released
    with pytest.raises(ExpectationFailed, match="consistent_overlap"):
        productivity.refresh_tables(spark, store, str(tmp_path / "out"))
    assert current_release(spark, str(tmp_path / "out")) is None

    # stored rows of one batch get lost: the next run restores them without a new snapshot
    import shutil

    shutil.rmtree(f"{store}/records/batch={third.snapshot_id}")
    repaired = productivity.ingest_landed(spark, str(landing), store)
    assert not repaired.changed and repaired.snapshot_id == third.snapshot_id
    restored = {(r.source_name, r.row_number): dict(r.fields) for r in snapshot_records(spark, store).collect()}
    assert restored == after


def test_a_change_between_hash_and_parse_leaves_nothing_behind(spark, landing, tmp_path, monkeypatch):
    store = str(tmp_path / "store")
    current = landing / "pr.data.0.Current"
    before, then = current.read_text(), current.read_text().replace("-0.1", "9.5 ")
    hashed = snapshots.content_inventory

    def meddled(*args):
        found = snapshots.staged(spark, hashed(*args), "meddled")
        current.write_text(then)
        return found

    monkeypatch.setattr(snapshots, "content_inventory", meddled)
    with pytest.raises(LandingChanged):
        productivity.ingest_landed(spark, str(landing), store)
    monkeypatch.undo()
    current.write_text(before)
    productivity.ingest_landed(spark, str(landing), store)
    values = {r.fields["value"] for r in snapshot_records(spark, store).filter("source_name = 'pr.data.0.Current'").collect()}
    assert "-0.1" in values and "9.5" not in values


def test_old_releases_and_scratch_expire(spark, landing, tmp_path, monkeypatch):
    from orestrata import session
    from orestrata.plans.tables import Tables, expire_releases

    store, out = str(tmp_path / "store"), str(tmp_path / "out")
    productivity.ingest_landed(spark, str(landing), store)
    runs = [productivity.refresh_tables(spark, store, out).name for _ in range(3)]
    assert expire_releases(spark, out, keep=1) == [f"release={name}" for name in runs[:2]]
    assert Tables(spark, out).release == runs[2] and read_table(spark, out, "gold_best_year").count() == 3

    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path / "scratch"))
    session.staged(spark, spark.range(3), "old")
    (tmp_path / "scratch" / "not ours").mkdir()
    assert session.expire_scratch(spark, 3600) == []
    (name,) = session.expire_scratch(spark, -1)
    assert name.startswith("old-") and [p.name for p in (tmp_path / "scratch").iterdir()] == ["not ours"]


def test_odd_names_folders_batches_and_many_deletions(spark, landing, tmp_path, monkeypatch):
    monkeypatch.setattr(inventory, "PATHS_AT_ONCE", 3)
    store = str(tmp_path / "store")
    (landing / "later").mkdir()
    copy = (landing / "pr.data.0.Current").read_text()
    (landing / "later" / "pr.data.0.Current").write_text(copy)
    (landing / "pr.data.x[1]").write_text(copy)
    (landing / "pr.data.x1").write_text(copy + copy.split("\n", 1)[1])
    for i in range(120):
        (landing / f"note.{i}").write_text("note")
    first = productivity.ingest_landed(spark, str(landing), store)
    sizes = {r.source_name: r["count"] for r in snapshot_records(spark, store).groupBy("source_name").count().collect()}
    assert sizes["later/pr.data.0.Current"] == sizes["pr.data.x[1]"] == 7 and sizes["pr.data.x1"] == 14
    assert sizes["population.json"] == len(POPULATION)
    for i in range(120):
        (landing / f"note.{i}").unlink()
    second = productivity.ingest_landed(spark, str(landing), store)
    assert (first.counts["added"], second.counts["deleted"]) == (135, 120)
    assert deleted_sources(spark, store, second.snapshot_id).count() == 120


@pytest.mark.parametrize(
    ("name", "text", "message"),
    [
        ("pr.data.2.New", "wrong\theader\nx\ty\n", "missing columns"),
        ("pr.data.2.New", "<!DOCTYPE html><html>denied</html>", "HTML"),
        ("pr.data.2.New", HEADER + "PRS30006032\t2013\tQ01\n", "wrong field count"),
        ("pr.data.2.New", HEADER + "PRS30006032\t2013\tQ01\t1\t\tmore\n", "wrong field count"),
        ("pr.data.2.New", HEADER, "empty table"),
        ("pr.data.0.Current", "", "missing columns"),
        ("pr.data.2.New", HEADER + 'PRS30006032\t2013\tQ01\t"1\t\n', "open quote"),
        ("pr.data.2.New", HEADER.replace("\n", "\tyear\n") + "a\t1\tb\tc\td\te\n", "repeated column"),
        ("population.json", population_page(total=99), "partial page"),
        ("population.json", "", "not one JSON document"),
        ("population.json", f"[{population_page()}, {population_page()}]", "not one JSON document"),
        ("population.json", json.dumps({"data": []}), "no data"),
        ("population.json", json.dumps({"data": [{"Year": 1}]}), "missing keys"),
    ],
)
def test_broken_file_publishes_nothing(spark, landing, tmp_path, name, text, message):
    store = str(tmp_path / "store")
    (landing / name).write_text(text)
    with pytest.raises(SchemaDrift, match=message):
        productivity.ingest_landed(spark, str(landing), store)
    assert latest_snapshot(spark, store) is None
