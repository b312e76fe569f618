"""The quality classifier, personal data and the n-gram join; the whole pipeline."""
import hashlib
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from llm_rows import ROWS
from orestrata.llm import ngram_join, pii, quality
from orestrata.llm.mixing import mix


def test_em_weighs_labellers_by_what_they_find():
    counts = {"gggggg": 9000, "bggggg": 200, "gbgggg": 200, "ggbggg": 150, "bggbgg": 300, "gggg--": 50}
    good = quality.expectation_maximisation(counts)
    assert good["gggggg"] > 0.9 and good["gggg--"] > 0.5
    assert all(good[p] < 0.2 for p in counts if "b" in p)
    assert quality.expectation_maximisation({}) == {}


def test_held_out_accuracy(spark, sf_dir):
    judged = quality.classify(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    pairs = [(r.quality == 1, r.keep) for r in labels.join(judged, "doc_id").collect()]
    good = [k for q, k in pairs if q]
    bad = [k for q, k in pairs if not q]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_classifier_on_odd_rows(edge, none):
    judged = quality.classify(edge)
    assert judged.count() == len(ROWS) and quality.classify(none).count() == 0
    scores = defaultdict(set)
    for r in judged.collect():
        assert 0 <= r.score <= 1
        scores[r.doc_id].add(r.score)
    assert len(scores[7]) == 1 and scores[1] == scores[2]
    kept = quality.good_documents(edge)
    assert kept.columns == edge.columns and kept.count() == judged.filter("keep").count()


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m.group())) <= 19 and pii.luhn(digits(m.group()))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m.group())) <= 15]


@pytest.mark.parametrize("seed", range(6))
def test_base_spans_match_the_patterns(seed):
    import random

    chance = random.Random(seed)
    for _ in range(1500):
        text = "".join(chance.choice("ab1234.@+- ()%é9052.@") for _ in range(chance.randint(0, 60)))
        assert pii.base_spans(text) == plain_spans(text), text
    assert pii.base_spans("4111111111111111 4111-1111 1111-1111") == plain_spans("4111111111111111 4111-1111 1111-1111")


def test_patterns_are_linear():
    for text in ("1" * 200_000, "1." * 100_000, "a" * 200_000 + "@", "a@" * 100_000, "+1" + "(" * 200_000, "1 " * 100_000, "x1@" * 60_000):
        pii.base_spans(text)
        list(pii.windows(text))


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_field_adds_rewritten_data_and_leaves_the_rest():
    cases = [f"call me at +1 ({200 + i}) 555-{1000 + i} or mail ann{i}.lee@site{i}.example.com from 10.{i % 250}.3.{i % 99}, pay by 4111 1111 1111 1111 now" for i in range(120)]
    plain = [f"chapter {i} holds {i * 7} pages, version 3.{i % 10} of 20{i % 99:02d}" for i in range(120)]
    field = pii.train(cases + plain)
    find = lambda t: [(k, t[a:b]) for k, a, b in field.added(t, pii.base_spans(t))]
    assert ("email", "bob.ray[at]site9.example.com") in find("or mail bob.ray[at]site9.example.com from here")
    assert ("ip", "10[.]9[.]3[.]7") in find("from 10[.]9[.]3[.]7, pay")
    assert find("the year 1999 had 365 days and version 2.0 came out") == []
    assert find(cases[0]) == []


def test_field_has_no_limit_of_entities_or_long_tokens():
    cases = [f"call me at +1 ({200 + i}) 555-{1000 + i} or mail ann{i}.lee@site{i}.example.com from 10.{i % 250}.3.{i % 99}, pay by 4111 1111 1111 1111 now" for i in range(120)]
    plain = [f"chapter {i} holds {i * 7} pages, version 3.{i % 10} of 20{i % 99:02d}" for i in range(120)]
    field = pii.train(cases + plain)
    find = lambda t: {t[a:b] for _, a, b in field.added(t, pii.base_spans(t))}
    mails = [f"bob{i}.ray[at]site{i}.example.com" for i in range(40)]
    assert find("write to " + " ".join(mails)) == set(mails)
    packed = '{"kind":"user","note":"' + "x" * 90 + '","mail":"' + '","mail":"'.join(mails) + '"}'
    assert find("see " + packed) == set(mails) and len(packed.split()) == 1
    # an address that the patterns find is not found again
    text = "mail ann1.lee@site1.example.com or " + mails[0]
    assert find(text) == {mails[0]}
    # linear, also where every token is a candidate
    field.added("1 " * 20_000, [])
    list(pii.windows("1," * 100_000 + "[at]" * 50_000))


def test_personal_data(edge, none):
    found = {r.doc_id: r for r in pii.personal_data(edge).collect()}
    for i, text in ROWS:
        base = plain_spans(text or "")
        assert found[i].base_sha256 == hashlib.sha256(pii.span_text(base).encode()).hexdigest()
        assert set(pii.span_text(base).split(",")) <= set(found[i].spans.split(",")) | {""}
    twelve = found[12]
    assert (twelve.n_email, twelve.n_ip, twelve.n_card, twelve.n_phone) == (1, 1, 1, 1)
    assert pii.personal_data(none).count() == 0


def brute_components(rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(low))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and 100 * common >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    members = defaultdict(list)
    for n, (i, _) in enumerate(rows):
        members[root(n)].append(i)
    smallest = {r: min((i for i in own if i is not None), default=None) for r, own in members.items()}
    return [(i, len(sets[n]), smallest[root(n)]) for n, (i, _) in enumerate(rows)]


@pytest.mark.parametrize("frequent", [0, 40, 65_536])
def test_join_finds_every_component(copies, table, monkeypatch, frequent):
    before = ngram_join.frequent_tokens
    monkeypatch.setattr(ngram_join, "frequent_tokens", lambda rows: before(rows, frequent) if frequent else before(rows.limit(0)))
    found = ngram_join.near_components(table(copies)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == sorted(brute_components(copies))


def family(n, seed=11):
    """A third near copies of one text, a third around one common passage, a third of their own."""
    import random

    chance = random.Random(seed)
    word = lambda: f"w{chance.randrange(40_000)}"
    base, passage = [word() for _ in range(70)], [word() for _ in range(60)]
    rows = []
    for i in range(n):
        if i % 3 == 0:
            own = list(base)
            for _ in range(chance.randint(0, 3)):
                own[chance.randrange(len(own))] = word()
        elif i % 3 == 1:
            own = [word() for _ in range(chance.randint(0, 14))] + passage + [word() for _ in range(chance.randint(0, 6))]
        else:
            own = [word() for _ in range(40)]
        rows.append((i, " ".join(own)))
    return rows


def test_pairs_grow_with_the_rows_not_their_square(table):
    pairs = []
    for n in (600, 1200, 2400):
        tally, rows = [], family(n)
        found = ngram_join.near_components(table(rows), tally=tally).collect()
        if n == 600:
            assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == sorted(brute_components(rows))
        pairs.append(sum(c for _, c in tally))
        assert all(c <= 4 * n for _, c in tally), tally
    assert pairs[1] <= 2.3 * pairs[0] and pairs[2] <= 2.3 * pairs[1], pairs


def test_classes_that_share_a_hash_are_told_apart(copies, table, monkeypatch):
    described, seeds = ngram_join.described, []

    def clashing(docs, row=None, seed=0):
        seeds.append(seed)
        found = described(docs, row, seed)
        return found.withColumn("key", found["key"] % 5) if seed == 0 else found

    monkeypatch.setattr(ngram_join, "described", clashing)
    rows = copies[:120]
    found = ngram_join.near_components(table(rows)).collect()
    assert seeds == [0, 1]
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == sorted(brute_components(rows))


def test_join_on_odd_rows(edge, none, monkeypatch):
    monkeypatch.setattr(ngram_join, "CHUNK_CHARS", 50)
    found = ngram_join.near_components(edge).collect()
    rows = [(i, t if t is None or len(t) < 5000 else t) for i, t in ROWS]
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == sorted(brute_components(rows), key=str)
    assert ngram_join.near_components(none).count() == 0
    one = ngram_join.one_of_each(edge)
    assert one.columns == edge.columns and {r.doc_id for r in one.collect()} == {3, 1, 2, None, 4, 5, 8, 9, 12, 13}


def test_one_of_each_tells_rows_apart(table):
    texts = [" ".join(f"{c}{i}" for i in range(60)) for c in "abcde"]
    near = [t + " more" for t in texts]
    a, b, c, d, e = texts
    # 7 is a near copy on one row and unique on another; 1 stays once of its three rows; null ids go before others, not among themselves
    rows = [(2, a), (7, near[0]), (7, b), (1, c), (1, c), (1, near[2]), (None, near[2]), (None, d), (None, near[3]), (9, e), (None, ""), (None, "")]
    left = sorted((r.doc_id or -1, r.text) for r in ngram_join.one_of_each(table(rows)).collect())
    assert [r for r in left if r[0] > 1] == [(2, a), (7, b), (9, e)]
    assert [t in (c, near[2]) for i, t in left if i == 1] == [True]
    nameless = [t for i, t in left if i == -1]
    assert nameless[:2] == ["", ""] and len(nameless) == 3 and nameless[2] in (d, near[3])


def test_shared_rows_across_batches(spark):
    rows = [(t, k, (k + 9 << 32) + t) for t in range(40) for k in range(t % 4) for _ in range(1 + (t + k) % 3)]
    df = spark.createDataFrame(rows, "token LONG, key LONG, packed LONG")
    expected = Counter((t, k, k + 9, t) for t in range(40) if t % 4 > 1 for k in range(t % 4))
    for size in (1, 2, 3, 1000):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            assert Counter(tuple(r) for r in ngram_join.shared_rows(df).select("token", "key", "n", "at").collect()) == expected
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000 + i, 1000) for i in range(1, 200)] + [(5, 5)]
    df = spark.createDataFrame(edges, "u LONG, v LONG")
    found = {r.key: r.label for r in ngram_join.components(df).collect()}
    assert found == {**dict.fromkeys(range(301), 0), **dict.fromkeys(range(1000, 1200), 1000)}


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").cache()
    columns = docs.columns
    rows = {r.doc_id: r.text for r in docs.collect()}
    frame = docs
    for name, stage in corpus_pipeline.STAGES:
        before, frame = frame, stage(spark, frame, sf_dir).cache()
        ids = [r.doc_id for r in frame.select("doc_id").collect()]
        if name == "quality":
            assert set(ids) == {r.doc_id for r in quality.classify(docs).filter("keep").collect()}
        elif name == "exact dedup":
            had = {r.doc_id: r.text for r in before.collect()}
            latest = {t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")): i for i, t in sorted(had.items())}
            assert sorted(ids) == sorted(latest.values())
        elif name == "near dedup":
            had = sorted((r.doc_id, r.text) for r in before.collect())
            assert sorted(ids) == sorted({c for _, _, c in brute_components(had)})
        elif name == "mixing":
            # as many copies as the mix of the same rows asks for
            taken = {r.doc_id: int(r.taken / r.size + 0.5) if r.size else 0 for r in mix(before).collect()}
            assert Counter(ids) == +Counter(taken)
        elif name == "packing":
            assert set(ids) == {r.doc_id for r in before.collect()}
        assert name == "packing" or frame.columns == columns
    assert rows and len(ids) > 0
