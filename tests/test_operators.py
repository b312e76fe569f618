"""Each operator on small hand-made tables, edge cases first."""
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orestrata.functions.text import joined_label, prefixed_unless_missing, strip
from orestrata.operators.answers import align_left, best_period, latest_per_key, period_stats
from orestrata.operators.collapse import (
    DICTIONARY, _collapse_with_sets, collapse_lookups, collapse_overlaps, duplicate_keys, evidence_dictionary, universe,
)
from orestrata.operators.compare import keyed_diff, row_diff
from orestrata.operators.conform import conform
from orestrata.operators.enrich import Link, enrich_dimension, lookup_table, with_versions
from orestrata.operators.quality import ExpectationFailed, Rule, check, keep_valid, measure, quarantine
from orestrata.plans import productivity
from orestrata.plans.medallion import collapse_observations, collapse_population, type_observations, type_population
from orestrata.plans.tables import Release, current_release, read_table
from orestrata.plans.twins import ANSWERS, dataframe_answer, parity, sql_answer
from orestrata.sources.records import active_records, latest_inventory, read_manifests, read_records
from orestrata.sources.snapshots import ImmutableObjectChanged, diff_inventory, write_once

RAW = "source_name STRING, object_id STRING, row_number BIGINT, kind STRING, fields MAP<STRING, STRING>"
SPEC = productivity.SPEC


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


def observation(source, value, series="PRS30006032", year="2013", period="Q01", **more):
    fields = {"series_id": series, "year": year, "period": period, "footnote_codes": "", **more}
    if value is not None:
        fields["value"] = value
    return (source, source, 1, "observations", fields)


def typed(frame, *points):
    return type_observations(frame(list(points), RAW), SPEC)


def valid(df):
    return keep_valid(df, SPEC.observation_rules)


def rejected(df):
    return quarantine(df, SPEC.observation_rules)


# --- typing and validity ---------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("text", "number", "missing"),
    [
        ("1.5", Decimal("1.500000"), False),
        (" 2 ", Decimal("2.000000"), False),
        ("", None, True),
        ("-", None, True),
        (None, None, True),  # the key is absent
        ("n/a", None, False),
        ("NaN", None, False),
        ("1.0000004", Decimal("1.000000"), False),
    ],
)
def test_value_typing(frame, text, number, missing):
    row = typed(frame, observation("a", text)).first()
    assert (row.value, row.missing_value) == (number, missing)


def test_validity_and_quarantine_are_complements(frame):
    points = [
        observation("padded", " 1 ", series=" PRS30006032 "),
        observation("missing", "-"),
        observation("bad number", "text"),
        observation("bad id", "1", series="PRX30006032"),
        observation("newline", "1", series="PRS30006032\n"),
        observation("early", "1", year="1899"),
        observation("no year", "1", year="soon"),
        observation("month", "1", period="M01"),
        observation("annual", "1", period="Q05"),
    ]
    df = typed(frame, *points)
    good = {r.source_name for r in valid(df).collect()}
    bad = {r.source_name for r in rejected(df).collect()}
    assert good == {"padded", "missing", "annual"}
    assert good | bad == {p[0] for p in points} and not good & bad


def test_population_must_be_integral(frame):
    def person(name, **fields):
        return (name, name, 1, "population", fields)

    df = type_population(
        frame(
            [
                person("whole", year="2013", nation="United States", nation_id="01000US", population="316128839.0"),
                person("broken", year="2013", nation="United States", nation_id="", population="12.5"),
                person("zero", year="2014", nation="United States", nation_id="", population="0"),
                person("nobody", year="2014", nation="United States", nation_id="", population=None),
                person("nowhere", year="2014", nation_id="", population="5"),
                person("elsewhere", year="2013", nation="Canada", nation_id="", population="7"),
            ],
            RAW,
        ),
        SPEC,
    )
    good = keep_valid(df, SPEC.population_rules)
    assert sorted(r.population for r in good.collect()) == [7, 316128839]
    assert rows(collapse_population(good, SPEC)) == [(2013, 316128839, 1)]


def test_conform_casts_never_fail(frame):
    from orestrata.operators.conform import Cast, Text

    df = frame([({"a": " 7 ", "b": "x"},), ({"a": "7.5"},), ({},)], "fields MAP<STRING, STRING>")
    out = conform(df, [Text("a"), Text("b", key="b"), Cast("n", of="a", to="int")])
    assert rows(out, "a", "n") == [("7", 7), ("7.5", None), (None, None)]


def test_strip_takes_every_white_space(spark):
    assert spark.range(1).select(strip(F.lit(" \t x y\r\n"))).first()[0] == "x y"


# --- rules -----------------------------------------------------------------------------------------


def test_null_counts_as_failed_and_fail_rules_raise(spark, frame):
    df = frame([(1,), (None,), (30,)], "k INT")
    rules = [Rule("small", "k < 10"), Rule("known", "k IS NOT NULL", "drop")]
    assert rows(measure(df, rules, "d")) == [("d", "known", "drop", 3, 1), ("d", "small", "fail", 3, 2)]
    with pytest.raises(ExpectationFailed, match="d.small: 2 of 3"):
        check(df, rules, "d")
    with pytest.raises(ValueError, match="unknown action"):
        Rule("x", "true", "warn")


def test_release_publishes_all_or_nothing(spark, frame, tmp_path):
    out = str(tmp_path / "out")
    first = Release(spark, out)
    first.save("t", frame([(1,)], "k INT"), [Rule("small", "k < 10")])
    assert current_release(spark, out) is None
    first.publish()
    second = Release(spark, out)
    second.save("t", frame([(2,)], "k INT"))
    with pytest.raises(ExpectationFailed):
        second.save("u", frame([(70,)], "k INT"), [Rule("small", "k < 10")])
    assert rows(read_table(spark, out, "t")) == [(1,)]
    assert rows(read_table(spark, out, "quality_metrics")) == [("t", "small", "fail", 1, 0)]
    empty = Release(spark, out)
    empty.save("t", frame([(1,)], "k INT").filter("false"), [Rule("small", "k < 10")])
    empty.publish()
    assert rows(read_table(spark, out, "quality_metrics")) == [("t", "small", "fail", 0, 0)]


# --- collapse --------------------------------------------------------------------------------------


def test_overlap_versions_and_evidence(frame):
    agree = [observation("b", " 1.0"), observation("a", "1.00", footnote_codes="R"), observation("a", "1")]
    other = [observation("c", "2"), observation("d", "-")]
    columns = ("value", "value_versions", "footnotes", "source_files")
    assert rows(collapse_observations(valid(typed(frame, *agree))), *columns) == [
        (Decimal("1.000000"), 1, ["", "R"], ["a", "b"])
    ]
    # NULL beside a number is a version of its own
    (row,) = collapse_observations(valid(typed(frame, *agree, *other))).collect()
    assert (row.value, row.value_versions) == (Decimal("2.000000"), 3)
    (row,) = collapse_observations(valid(typed(frame, other[1], observation("e", "")))).collect()
    assert (row.value, row.value_versions) == (None, 1)


def test_null_is_no_version_on_request(frame):
    df = frame([("a", 1), ("a", None), ("b", None)], "k STRING, v INT")
    out = collapse_overlaps(df, ["k"], "v", null_is_version=False)
    assert rows(out) == [("a", 1, 1), ("b", None, 0)]
    assert rows(collapse_overlaps(df, ["k"], "v")) == [("a", 1, 2), ("b", None, 1)]


def test_one_key_with_a_third_of_all_rows(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), (F.col("id") % 1000).alias("v")
    )
    out = {r.k: (r.v, r.value_versions) for r in collapse_overlaps(df, ["k"], "v").collect()}
    assert len(out) == 20_001 and out[0] == (999, 1000) and out[1] == (1, 1)


@pytest.mark.parametrize("different", [1, 3, 64, 65, 200, 300])
def test_evidence_as_bits_is_the_evidence_as_sets(spark, different):
    """One word of bits, its borders, several words, and more values than the dictionary takes; NULL evidence and values, a key
    without any evidence, evidence of two types."""
    n = F.col("id")
    df = spark.range(3000).select(
        F.when(n % 3 == 0, 0).when(n % 50 == 1, None).otherwise(n % 97).alias("k"),
        F.when(n % 11 == 0, None).otherwise((n * 7 % 13).cast("decimal(20,2)")).alias("v"),
        F.when((n % 97 != 5) & (n % 7 != 0), F.concat(F.lit("s"), (n * 31 % different).cast("string"))).alias("a"),
        F.when(n % 5 != 0, F.date_add(F.lit("2020-01-01").cast("date"), (n % 40).cast("int"))).alias("b"),
    ).filter("k IS NULL OR k <> 5 OR a IS NULL")
    evidence = {"names": "a", "days": "b", "again": "a"}
    assert (evidence_dictionary(df, ["a", "b"]) is None) == (different > DICTIONARY - 40)
    for null_is_version in (True, False):
        found = collapse_overlaps(df, ["k"], "v", evidence, "versions", null_is_version)
        sets = _collapse_with_sets(df, ["k"], "v", evidence, "versions", null_is_version)
        assert found.dtypes == sets.dtypes and rows(found) == rows(sets)
    wider = df.unionByName(spark.range(1).select(F.lit(1).alias("k"), F.lit(None).cast("decimal(20,2)").alias("v"), F.lit("zz").alias("a"), F.lit(None).cast("date").alias("b")))
    assert rows(collapse_overlaps(df, ["k"], "v", evidence, values_from=wider)) == rows(collapse_overlaps(df, ["k"], "v", evidence))
    assert collapse_overlaps(df.limit(0), ["k"], "v", evidence).collect() == []


def test_evidence_that_is_always_missing(frame):
    df = frame([("a", 1, None), ("a", 2, None)], "k STRING, v INT, e STRING")
    assert rows(collapse_overlaps(df, ["k"], "v", {"names": "e"})) == [("a", 2, 2, [])]


def test_lookups_and_sets(frame):
    df = frame([("1", "x"), ("1", "y"), ("1", "x"), ("2", None), ("2", "z")], "code STRING, label STRING")
    assert rows(collapse_lookups(df, ["code"], "label")) == [("1", "y", 2), ("2", "z", 2)]
    assert rows(duplicate_keys(df, ["code", "label"])) == [("1", "x", 2)]
    assert rows(universe("code", df, frame([("3",), (None,), ("1",)], "code STRING"))) == [
        ("1",), ("2",), ("3",), (None,)
    ]


def test_dimension_keeps_conflicts_and_gaps_visible(frame):
    entries = frame(
        [
            ("colour", {"c": "r", "t": "red"}),
            ("colour", {"c": "r", "t": "rouge"}),
            ("size", {"s": "1", "t": "small"}),
            ("other", {"c": "r", "t": "ignored"}),
        ],
        "kind STRING, fields MAP<STRING, STRING>",
    )
    lookups = lookup_table(entries, {"colour": ("c", "t"), "size": ("s", "t")})
    dimension = frame([("A", "r", "1", "2017"), ("B", "x", "1", "-"), ("A", "r", "1", "2017"), ("A", "r", "9", "-")],
                      "id STRING, colour STRING, size STRING, base STRING")
    label = joined_label(["colour_text", "size_text"], suffix=prefixed_unless_missing("base", "Base: "))
    links = [Link("colour", "colour", "colour_text"), Link("size", "size", "size_text")]
    out = enrich_dimension(with_versions(dimension, "id", "versions"), lookups, links, label, "label")
    assert rows(out, "id", "versions", "colour_versions", "size_versions", "label") == [
        ("A", 2, 2, 1, "rouge | small | Base: 2017"),
        ("A", 2, 2, None, "rouge"),
        ("B", 1, None, 1, "small"),
    ]


# --- answers ---------------------------------------------------------------------------------------

POINT = "series_id STRING, year INT, period STRING, value DECIMAL(24,6)"


@pytest.fixture
def answers(frame):
    frame(
        [
            ("tie", 2013, "Q01", 1), ("tie", 2013, "Q02", 2), ("tie", 2013, "Q05", 99999), ("tie", 2014, "Q01", 3),
            ("annual", 2013, "Q05", 10), ("empty", 2013, "Q01", None), ("gap", 2014, "Q01", None),
            ("gap", 2014, "Q02", 4), ("negative", 2013, "Q01", -3), ("negative", 2014, "Q01", -1),
            ("PRS30006032", 2012, "Q01", 5), ("PRS30006032", 2013, "Q01", 6), ("PRS30006032", 2013, "Q02", 7),
        ],
        POINT,
    ).createOrReplaceTempView("silver_observations")
    frame([(2013 + i, 100 + 10 * i) for i in range(6)] + [(2019, 900)], "year INT, population BIGINT").createOrReplaceTempView(
        "silver_population"
    )
    names = ["tie", "annual", "empty", "gap", "negative", "dimension only"]
    frame([(n, n.upper()) for n in names], "series_id STRING, series_label STRING").createOrReplaceTempView("silver_series")


def test_answers_and_their_sql_forms(spark, answers):
    for table in ANSWERS:
        assert parity(spark, table, SPEC).count() == 0
        assert sql_answer(spark, table, SPEC).columns == dataframe_answer(spark, table, SPEC).columns
    stats = dataframe_answer(spark, "gold_population_stats", SPEC).first()
    assert (stats.year_count, stats.start_year, stats.end_year, stats.mean_population) == (6, 2013, 2018, 125.0)
    assert stats.stddev_population == pytest.approx(17.0782512766)
    best = {r.series_id: r for r in dataframe_answer(spark, "gold_best_year", SPEC).collect()}
    assert set(best) == {"tie", "annual", "empty", "gap", "negative", "dimension only", "PRS30006032"}
    assert (best["tie"].best_year, best["tie"].summed_value, best["tie"].quarters_available) == (2013, 3, 2)
    assert (best["gap"].summed_value, best["gap"].quarters_available) == (4, 1)
    assert (best["negative"].best_year, best["negative"].summed_value) == (2014, -1)
    assert best["PRS30006032"].series_label is None and best["PRS30006032"].best_year == 2013
    for name in ("annual", "empty", "dimension only"):
        assert (best[name].best_year, best[name].summed_value, best[name].quarters_available) == (None, None, None)
        assert best[name].status == "no_quarterly_observations"
    aligned = rows(dataframe_answer(spark, "gold_series_population", SPEC), "year", "population")
    assert aligned == [(2012, None), (2013, 100)]


def test_best_period_against_brute_force(spark):
    facts = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 41) END AS series_id",
        "CAST(2000 + pmod(hash(id), 7) AS INT) AS year",
        "concat('Q0', 1 + pmod(hash(id, 1), 5)) AS period",
        "CASE WHEN id % 11 = 0 THEN NULL ELSE CAST(pmod(hash(id, 2), 9) - 4 AS DECIMAL(24,6)) END AS value",
    )
    dimension = spark.range(60).selectExpr("concat('s', id) AS series_id", "'x' AS series_label")
    out = best_period(facts, dimension, key="series_id", time="year", period="period", value="value",
                      periods=SPEC.quarters, label="series_label")
    sums = {}
    series = {r.series_id for r in dimension.collect()}
    for r in facts.collect():
        series.add(r.series_id)
        if r.period in SPEC.quarters and r.value is not None:
            total, n = sums.get((r.series_id, r.year), (0, 0))
            sums[r.series_id, r.year] = (total + r.value, n + 1)
    expected = {}
    for name in series:
        candidates = [(-t, y, n) for (s, y), (t, n) in sums.items() if s == name]
        low, year, n = min(candidates) if candidates else (None, None, None)
        expected[name] = (year, None if low is None else -low, n)
    assert {r.series_id: (r.best_year, r.summed_value, r.quarters_available) for r in out.collect()} == expected


def test_statistics_of_one_and_of_no_row(frame):
    df = frame([(2013, 5), (2020, 9)], "year INT, n BIGINT")
    one = period_stats(df, "year", "n", 2013, 2014).first()
    assert (one.year_count, one.mean_n, one.stddev_n, one.stddev_sample) == (1, 5.0, 0.0, None)
    none = period_stats(df, "year", "n", 1990, 1991).first()
    assert (none.year_count, none.start_year, none.mean_n, none.stddev_n) == (0, None, None, None)


def test_alignment_and_latest(frame):
    left = frame([("a", 1, "x"), ("b", 2, "x"), ("c", 1, "y")], "id STRING, k INT, scope STRING")
    right = frame([(1, "one", "?"), (3, "three", "?")], "k INT, word STRING, unused STRING")
    out = align_left(left, right, "k", F.col("scope") == "x", ["id", "k"], ["word"])
    assert rows(out) == [("a", 1, "one"), ("b", 2, None)]
    newest = latest_per_key(left, ["k"], [F.col("id").desc()])
    assert rows(newest, "k", "id") == [(1, "c"), (2, "b")]


# --- comparison ------------------------------------------------------------------------------------


def test_row_diff_counts_copies(frame):
    left = frame([(1, "a"), (1, "a"), (2, None), (3, "c")], "k INT, v STRING")
    right = frame([(1, "a"), (2, None), (4, "d"), (4, "d")], "k INT, v STRING")
    assert rows(row_diff(left, right)) == [(1, "a", 1), (3, "c", 1), (4, "d", -2)]


def test_keyed_diff_tolerates_only_noise(frame):
    schema = "k INT, x DOUBLE, t STRING"
    left = frame([(1, 1.0, "a"), (2, 1e9, "a"), (3, 1.0, "a"), (4, None, "a"), (5, None, "a"), (6, 1.0, "a"), (6, 1.0, "a"), (7, 0.0, None)], schema)
    right = frame([(1, 1.0 + 1e-10, "a"), (2, 1e9 + 0.5, "a"), (3, 1.01, "a"), (4, 0.0, "a"), (5, None, "a"), (6, 1.0, "a"), (8, 0.0, "a")], schema)
    assert rows(keyed_diff(left, right, ["k"])) == [
        (3, "values"), (4, "values"), (6, "copies"), (7, "only_left"), (8, "only_right")
    ]


def test_keyed_diff_compares_copies_and_maps(frame):
    schema = "k INT, m MAP<STRING, INT>"
    left = frame([(1, {"a": 1}), (1, {"b": 2}), (2, {"a": 1, "b": 2}), (3, None), (3, None)], schema)
    right = frame([(1, {"b": 2}), (1, {"a": 1}), (2, {"b": 2, "a": 1}), (3, None), (3, {"a": 1})], schema)
    assert rows(keyed_diff(left, right, ["k"])) == [(3, "values")]
    assert rows(keyed_diff(left, left.filter("k <> 3"), ["k"])) == [(3, "only_left")]


def paired(left, right, near):
    """Whether the rows can be paired one to one, by augmenting paths."""
    partner = {}

    def place(i, seen):
        for j, row in enumerate(right):
            if j not in seen and near(left[i], row):
                seen.add(j)
                if j not in partner or place(partner[j], seen):
                    partner[j] = i
                    return True
        return False

    return len(left) == len(right) and all(place(i, set()) for i in range(len(left)))


def compared_by_brute_force(left, right, near):
    found = []
    for k in sorted({r[0] for r in left + right}):
        a, b = ([r[1:] for r in side if r[0] == k] for side in (left, right))
        problem = "only_left" if not b else "only_right" if not a else "copies" if len(a) != len(b) else None if paired(a, b, near) else "values"
        found += [(k, problem)] if problem else []
    return found


def test_repeated_keys_are_paired_by_any_pairing_that_fits(frame):
    """Chains of numbers one tolerance apart, where neither cancelling equal rows nor taking the nearest one would do."""
    rng, schema = random.Random(7), "k INT, x DOUBLE, t STRING"
    left, right = [], []
    for k in range(250):
        rows_ = [(k, rng.randrange(6) * 0.75, rng.choice("ab")) for _ in range(rng.randrange(1, 6))]
        moved = [(k, x + rng.choice((-1, -0.5, 0, 0.5, 1)), t) for _, x, t in rows_]
        if k % 5 == 0:
            moved[0] = (k, moved[0][1] + 1.25, moved[0][2])
        left, right = left + rows_, right + rng.sample(moved, len(moved))
    near = lambda a, b: a[1] == b[1] and abs(a[0] - b[0]) <= 1 + 0.125 * abs(b[0])
    expected = compared_by_brute_force(left, right, near)
    assert 10 < len(expected) < 60
    assert rows(keyed_diff(frame(left, schema), frame(right, schema), ["k"], rtol=0.125, atol=1)) == sorted(expected, key=repr)


def test_noise_in_the_first_of_several_numbers_does_not_exchange_partners(frame):
    rng, schema = random.Random(3), "k INT, x DOUBLE, y DOUBLE"
    left = [(k, float(rng.randrange(3)), float(rng.randrange(3))) for k in range(60) for _ in range(4)]
    noise = lambda: rng.choice((-4e-7, 0, 4e-7))
    right = [(k, x + noise(), y + noise() + (k % 4 == 0) * rng.randrange(2)) for k, x, y in left]
    near = lambda a, b: all(abs(x - y) <= 1e-6 + 1e-9 * abs(y) for x, y in zip(a, b))
    expected = compared_by_brute_force(left, right, near)
    assert len(expected) > 5
    rng.shuffle(right)
    assert rows(keyed_diff(frame(left, schema), frame(right, schema), ["k"])) == sorted(expected, key=repr)


def test_numbers_that_are_not_finite_agree_with_themselves_only(spark):
    kinds = {"null": "NULL", "nan": "'NaN'", "inf": "'Infinity'", "minus": "'-Infinity'", "one": "1.0"}
    names = [(a, b) for a in kinds for b in kinds]
    side = lambda at: " UNION ALL ".join(f"SELECT '{p[0]} {p[1]}' AS k, CAST({kinds[p[at]]} AS DOUBLE) AS x" for p in names)
    found = {r.k for r in keyed_diff(spark.sql(side(0)), spark.sql(side(1)), ["k"]).collect()}
    assert found == {f"{a} {b}" for a, b in names if a != b}
    empty = spark.sql(side(0)).limit(0)
    assert keyed_diff(empty, empty, ["k"]).collect() == []


# --- inventories and records -----------------------------------------------------------------------


def test_diff_inventory(frame):
    schema = "source_name STRING, sha256 STRING"
    old = frame([("same", "1"), ("new text", "1"), ("gone", "1"), ("null both", None), ("null once", None)], schema)
    new = frame([("same", "1"), ("new text", "2"), ("fresh", "1"), ("null both", None), ("null once", "1")], schema)
    assert rows(diff_inventory(old, new)) == [
        ("fresh", "added"), ("gone", "deleted"), ("new text", "changed"), ("null both", "unchanged"),
        ("null once", "changed"), ("same", "unchanged"),
    ]


def test_write_once(frame):
    schema = "key STRING, digest STRING"
    stored = frame([("a", "1"), ("b", "2")], schema)
    assert rows(write_once(frame([("a", "1"), ("c", "3"), ("c", "3")], schema), stored, "key", "digest")) == [("c", "3")]
    with pytest.raises(ImmutableObjectChanged, match="a"):
        write_once(frame([("a", "9")], schema), stored, "key", "digest")
    with pytest.raises(ImmutableObjectChanged, match="c"):
        write_once(frame([("c", "3"), ("c", "4")], schema), stored, "key", "digest")


def test_latest_inventory_and_active_records(spark, tmp_path):
    manifests = tmp_path / "manifests"
    manifests.mkdir()
    for i, names in enumerate((["a", "b"], ["b", "c", "c"])):
        files = ", ".join(f'{{"source_name": "{n}", "object_id": "id-{n}", "bytes": 3}}' for n in names)
        (manifests / f"{i}.json").write_text(f'{{"snapshot_id": "s{i}", "committed_at": "t{i}", "deleted": [], "files": [{files}]}}\n')
    inventory = latest_inventory(read_manifests(spark, str(manifests)))
    assert rows(inventory, "snapshot_id", "committed_at", "source_name", "bytes") == [
        ("s1", "t1", "b", 3), ("s1", "t1", "c", 3), ("s1", "t1", "c", 3)
    ]
    path = tmp_path / "records.json"
    path.write_text("".join(f'{{"object_id": "id-{n}", "kind": "x", "row_number": 1, "fields": {{"k": "{n}"}}}}\n' for n in "abc"))
    active = active_records(read_records(spark, str(path)), inventory)
    assert rows(active, "object_id") == [("id-b",), ("id-c",)]
    path.write_text('{"object_id": "id-a", "row_number": "one"}\n')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_records(spark, str(path)).collect()
