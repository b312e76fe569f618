"""Exact dedup, fingerprints, mixing and shards against brute force."""
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from llm_rows import ROWS
from orestrata.llm.exact_dedup import exact_groups, without_copies
from orestrata.llm.fingerprints import PARTS, edit_fingerprints
from orestrata.llm.mixing import mix, mixed_documents, position, source_targets
from orestrata.llm.sharding import shard_plan, write_shards

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def groups(rows):
    out = defaultdict(list)
    for i, t in rows:
        out[(t or "").translate(LOWER)].append(-1 if i is None else i)
    return out


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_dedup(edge, copies, table, keep):
    for df, rows in ((edge, ROWS), (table(copies), copies)):
        own = groups(rows)
        found = exact_groups(df, keep).collect()
        assert len(found) == len(rows)
        kept = Counter()
        for r in found:
            digest = bytes(r.digest).hex()
            kept[digest] += r.kept
            text, ids = next((t, ids) for t, ids in own.items() if hashlib.sha256(t.encode()).hexdigest() == digest)
            best = (max if keep == "largest" else min)(ids)
            assert (r.group_size, -1 if r.keep_id is None else r.keep_id) == (len(ids), best)
        assert set(kept.values()) == {1} and len(kept) == len(own)


def test_exact_dedup_merges_many_runs(spark, copies, table):
    df = table(copies).repartition(70)
    assert exact_groups(df).filter("kept").count() == len(groups(copies))


def test_without_copies_keeps_columns(edge, none):
    left = without_copies(edge)
    assert left.columns == edge.columns and sorted(r.doc_id for r in left.collect() if r.doc_id in (3, 7, 10)) == [10]
    assert without_copies(none).count() == exact_groups(none).count() == 0


def test_without_copies_tells_rows_apart(table):
    # the keeper's id stands twice; a null id's copy goes while another null id's own text stays
    left = without_copies(table([(7, "T t"), (7, "t T"), (3, "t t"), (None, "A"), (5, "a"), (None, "B"), (5, "c"), (6, "C")]))
    assert sorted((r.doc_id or -1, r.text.lower()) for r in left.collect()) == [(-1, "b"), (5, "a"), (6, "c"), (7, "t t")]
    left = without_copies(table([(7, "T t"), (7, "t T"), (None, "A"), (None, "A")]), "smallest")
    assert sorted((r.doc_id or -1, r.text.lower()) for r in left.collect()) == [(-1, "a"), (7, "t t")]


def test_fingerprints(edge, copies, table):
    for df, rows in ((edge, ROWS), (table(copies), copies)):
        found = edit_fingerprints(df).collect()
        assert len(found) == len(rows)
        ordered = sorted(((-1 if i is None else i, t or "") for i, t in rows))
        by_id = defaultdict(list)
        for n, (i, t) in enumerate(ordered):
            after = ordered[(n + 1) % len(ordered)][1]
            q = len(t) // 4
            by_id[i].append((len(t), hashlib.sha256((t[: len(t) - q] + after[:q]).encode()).hexdigest()))
        mine = defaultdict(list)
        for r in found:
            mine[-1 if r.doc_id is None else r.doc_id].append((r.n_chars, r.edited_sha256))
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
            if r.fingerprint == r.edited_fingerprint:
                assert r.near_edited == 1
        assert {k: sorted(v) for k, v in mine.items()} == {k: sorted(v) for k, v in by_id.items()}
    prints = defaultdict(set)
    texts = dict(copies)
    for r in found:
        prints[texts[r.doc_id]].add(r.fingerprint)
        assert r.fingerprint.startswith("w:") or r.fingerprint.count(".") == 2 * (PARTS - 1)
    assert {len(v) for v in prints.values()} == {1}
    assert sum(r.near_edited for r in found) > sum(r.near_next for r in found)


def test_fingerprints_of_large_groups(table):
    import random

    chance = random.Random(3)
    draw = lambda names, n: [chance.choice(names) for _ in range(n)]
    common, hot, near = ([f"{c}{i}" for i in range(900)] for c in "uvw")
    hot, near = draw(hot, 120), draw(near, 120)
    rows = []
    for n in range(360):
        own = draw(common, 120)
        if n % 3 == 1:
            own = hot  # a third of the rows are one text
        if n % 9 == 2:
            own = [*near[:40], f"only{n}", *near[40:]]  # a ninth are near copies
        rows.append((n, " ".join(own)))
    rows += [(1000 + n, "".join(chr(0x4E00 + chance.randrange(3000)) for _ in range(400))) for n in range(20)]  # no separators
    likeness = defaultdict(list)
    for r in edit_fingerprints(table(rows)).collect():
        likeness["wide" if r.doc_id > 999 else r.doc_id % 3 if r.doc_id % 9 != 2 else "near"].append(r.near_edited)
    for kind in (0, 1, "near", "wide"):
        assert sum(likeness[kind]) / len(likeness[kind]) > 0.3, kind


def test_fingerprints_of_one_and_of_none(table, none):
    (only,) = edit_fingerprints(table([(1, "a single text stands next to itself")])).collect()
    assert only.near_next == 1
    assert edit_fingerprints(none).count() == 0


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_mix(edge, copies, table, spark):
    for df, rows in ((edge, ROWS), (table(copies, sources=("b", "b", "b", "a", None)), copies)):
        found = mix(df).collect()
        assert sorted(r.size for r in found) == sorted(words(t) for _, t in rows)
        total = sum(r.size for r in found)
        by_source = defaultdict(list)
        for r in found:
            by_source[r.source].append(r)
            assert 0 <= r.taken <= 2 * r.size and (r.first_position is None) == (r.taken == 0)
        order = sorted((s for s in by_source if s is not None)) + [None] * (None in by_source)
        weights = {s: (3, 1, 2)[n % 3] for n, s in enumerate(order)}
        sizes = {s: sum(r.size for r in own) for s, own in by_source.items()}
        low, high = 0.0, 2.0 * total + 1  # the level at which targets add up, by halving
        for _ in range(200):
            level = (low + high) / 2
            low, high = (level, high) if sum(min(weights[s] * level, 2 * sizes[s]) for s in sizes) < 1.5 * total else (low, level)
        for s, own in by_source.items():
            target = min(weights[s] * level, 2 * sizes[s])
            assert own[0].target == pytest.approx(target) and own[0].source_size == sizes[s]
            assert sum(r.taken for r in own) == pytest.approx(target, abs=1)
        positions = [r.first_position for r in found if r.first_position is not None]
        assert positions == sorted(positions) and all(0 <= p <= 1 for p in positions)
        assert sorted(map(str, mix(df).collect())) == sorted(map(str, found))


def test_mixed_documents(copies, table, none):
    df = table(copies, sources=("b", "b", "b", "a", None))
    plan = {r.doc_id: r for r in mix(df).collect()}
    out = mixed_documents(df)
    assert out.columns == df.columns
    counted = Counter(r.doc_id for r in out.collect())
    assert all(counted[i] == (int(r.taken / r.size + 0.5) if r.size else 0) for i, r in plan.items())
    assert mix(none).count() == mixed_documents(none).count() == 0


#: Repeated ids with different texts, and several null ids.
REPEATED = [(n % 3 if n % 4 else None, f"document {n} " + "word " * n) for n in range(24)]


def test_mixed_documents_counts_repeated_and_null_ids(table):
    df = table(REPEATED)
    # sizes are distinct, so a size says which row it is
    expected = Counter({r.size: int(r.taken / r.size + 0.5) for r in mix(df).collect()})
    assert Counter(words(r.text) for r in mixed_documents(df).collect()) == +expected


def test_write_shards_writes_each_row_once(table, spark, tmp_path):
    df = table(REPEATED)
    plan = write_shards(df, str(tmp_path / "shards"))
    assert plan.columns == shard_plan(df).columns
    stored = spark.read.parquet(str(tmp_path / "shards")).collect()
    assert Counter((r.doc_id, len(r.text) + 1, r._shard) for r in stored) == Counter((r.doc_id, r["size"], r.shard) for r in plan.collect())


def test_positions_invert_the_schedule(spark):
    for slope in (-1.0, -0.5, 0.0, 0.5, 1.0):
        times = spark.range(21).select((F.col("id") / 20).alias("t"))
        demand = F.col("t") + slope * (F.col("t") * F.col("t") - F.col("t"))
        apart = times.select(F.max(F.abs(position(demand, F.lit(slope)) - F.col("t")))).first()[0]
        assert apart < 1e-6


def test_targets_of_nothing(spark):
    sizes = spark.createDataFrame([("a", 0), (None, 0)], "source STRING, source_size LONG")
    assert [r.target for r in source_targets(sizes).collect()] == [0.0, 0.0]


def test_shards(edge, copies, table, none, spark, tmp_path):
    for df, rows in ((edge, ROWS), (table(copies), copies)):
        found = shard_plan(df).collect()
        size = lambda t: len(t.encode()) + 1 if t is not None else 1
        assert Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == Counter(
            (i, size(t), zlib.crc32((t or "").encode())) for i, t in rows
        )
        total, largest = sum(size(t) for _, t in rows), max(size(t) for _, t in rows)
        slots = defaultdict(list)
        for r in found:
            slots[r.shard].append(r)
        for shard, own in slots.items():
            assert sorted(r.slot for r in own) == list(range(len(own))) and 0 <= shard < 8
            assert abs(sum(r["size"] for r in own) - total / 8) <= largest
        inside = sorted(found, key=lambda r: (r.shard, r.slot))
        ids = [-1 if r.doc_id is None else r.doc_id for r in inside]
        assert ids == sorted(ids)
    assert shard_plan(none).count() == 0
    write_shards(df, str(tmp_path / "shards"))
    stored = spark.read.parquet(str(tmp_path / "shards"))
    assert {(r.doc_id, r._shard) for r in stored.collect()} == {(r.doc_id, r.shard) for r in found}
