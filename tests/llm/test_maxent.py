"""The maximum-entropy scorer: counts and scores against brute force, gradients by differences, probabilities that add up."""
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from llm_rows import ROWS
from orestrata.llm import maxent


def tokens_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", lowered)] + [maxent.END]


def is_held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def trained_counts(rows):
    return Counter(t for i, text in rows if not is_held(i) for t in tokens_of(text))


def brute_score(words, weights, counts, text):
    """One token at a time, by the definition."""
    place = {t: i for i, t in enumerate(words.tokens)}
    before, total = (maxent.START, maxent.START), 0.0
    for t in tokens_of(text):
        code = place.get(t, -1)
        head = 0 <= code < words.n_head
        group = code // maxent.WIDTH if head else maxent.HEAD_CLASSES + zlib.crc32(t[-2:]) % maxent.TAIL_CLASSES
        context = before[0] * maxent.CONTEXTS + before[1]

        def probability(table, features, chosen):
            logits = sum(table[int(f)].astype(float) for f in features[0])
            e = np.exp(logits - logits.max())
            return e[chosen] / e.sum()

        p = probability(weights[0], maxent.class_features(np.array([context])), group)
        if head:
            p *= probability(weights[1], maxent.member_features(np.array([context * maxent.WIDTH + group])), code % maxent.WIDTH)
        else:
            tail = group - maxent.HEAD_CLASSES
            p *= (counts[t] + 1) / (words.tail_n[tail] + words.tail_types[tail] + 1)
        total += math.log10(p)
        before = (code if head else maxent.HEAD_CLASSES * maxent.WIDTH + group - maxent.HEAD_CLASSES, before[0])
    return total


@pytest.fixture(scope="module")
def some_rows(copies):
    """Three quarters of the words stand in a fixed order, so that contexts say something."""
    chance = random.Random(3)
    made = []
    for n in range(300):
        at = chance.randrange(50)
        words = []
        for _ in range(chance.randint(0, 120)):
            at = (at + 1) % 50 if chance.random() < 0.75 else chance.randrange(50)
            words.append(f"w{at}" if chance.random() < 0.95 else f"rare{chance.randrange(10**6)}")
        made.append((1000 + n, chance.choice([" ", "\t", " \n"]).join(words)))
    return made + copies[:60] + ROWS


@pytest.mark.parametrize("chunk_bytes, chunk_tokens", [(3, 10**6), (40, 7), (10**6, 1)])
def test_chunks_of_a_text_go_on_where_the_last_one_ended(monkeypatch, some_rows, chunk_bytes, chunk_tokens):
    counts = trained_counts(some_rows)
    top = sorted(counts, key=lambda t: (-counts[t], t))[:40]
    tails = np.zeros(maxent.TAIL_CLASSES, np.int64)
    words = maxent.Vocabulary(top, np.array([counts[t] for t in top]), 0, 0, len(top), tails, tails)
    index = {t: i for i, t in enumerate(top)}
    texts = [t for _, t in some_rows[:80]] + [None, "", " \n", "x" * 100, "a  b " * 30]

    def all_of():
        found = [line for line in maxent.lines(words, index, texts)]
        return [np.concatenate([getattr(line, k) for line in found]).tolist() for k in ("doc", "code", "group", "place", "context")]

    whole = all_of()
    monkeypatch.setattr(maxent, "CHUNK_BYTES", chunk_bytes)
    monkeypatch.setattr(maxent, "CHUNK_TOKENS", chunk_tokens)
    assert all_of() == whole


@pytest.mark.parametrize("frequent", [maxent.FREQUENT, 30, 0])
def test_scores_against_brute_force(spark, table, some_rows, frequent):
    rows = [r for r in some_rows if len(r[1] or "") < 3000]
    docs = table(rows)
    training = docs.filter(~maxent.held_out())
    counts = maxent.token_counts(training)
    expected = trained_counts(rows)
    assert {bytes(r.token): r.n for r in counts.collect()} == dict(expected)
    words = maxent.vocabulary(counts, frequent)
    assert (words.n_tokens, words.n_types) == (sum(expected.values()), len(expected))
    assert len(words.tokens) <= frequent
    weights = maxent.trained(training, words)
    found = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 2)) for r in maxent.scored(docs, words, weights, counts).collect())
    n, v = sum(expected.values()), len(expected)
    brute = Counter()
    for i, text in rows:
        own = tokens_of(text)
        base = sum(math.log10((expected[t] + 1) / (n + v + 1)) for t in own)
        brute[i, is_held(i), len(own), sum(expected[t] > 0 for t in own), n, round(base, 6), round(brute_score(words, weights, expected, text), 2)] += 1
    near = lambda c: Counter((*k[:5], round(k[5], 4)) for k in c.elements())
    assert near(found) == near(brute)
    for a, b in zip(sorted(found.elements(), key=str), sorted(brute.elements(), key=str), strict=True):
        assert a[:5] == b[:5] and abs(a[6] - b[6]) <= 0.02 + 1e-5 * abs(b[6])


def test_probabilities_add_up(spark, table, some_rows):
    docs = table(some_rows).filter(~maxent.held_out())
    words = maxent.vocabulary(maxent.token_counts(docs))
    weights = maxent.trained(docs, words)
    context = np.array([maxent.START * maxent.CONTEXTS + maxent.START, 3 * maxent.CONTEXTS + 1])
    classes = np.exp([maxent.log_likelihood(weights[0], maxent.class_features(context), np.full(2, g)) for g in range(maxent.WIDTH)])
    assert np.allclose(classes.sum(0), 1, atol=1e-4)
    members = np.exp([maxent.log_likelihood(weights[1], maxent.member_features(context * maxent.WIDTH), np.full(2, m)) for m in range(maxent.WIDTH)])
    assert np.allclose(members.sum(0), 1, atol=1e-4)
    # a tail class: every counted token once more than counted, and one for all unseen ones
    assert (words.tail_types >= 0).all() and words.tail_n.sum() + words.counts[: words.n_head].sum() == words.n_tokens


def test_context_helps_on_held_out_texts(spark, table, some_rows):
    made = [r for r in some_rows if r[0] is not None and r[0] >= 1000]
    found = maxent.score_texts(table(made)).filter("held_out AND n_tokens > 20").collect()
    assert len(found) > 20
    assert sum(r.score for r in found) > 0.9 * sum(r.base_score for r in found)


def test_gradient_by_differences():
    rng = np.random.default_rng(0)
    weights = rng.normal(size=(maxent.ROWS, maxent.WIDTH))
    features = maxent.class_features(np.array([5 * maxent.CONTEXTS + 7]))
    counts = np.zeros((1, maxent.WIDTH))
    counts[0, 3], counts[0, 9] = 2, 1

    def value(w):
        return sum(counts[0, g] * maxent.log_likelihood(w, features, np.array([g]))[0] for g in (3, 9))

    gradient = maxent.gradient_of(weights, features, counts)
    for g in (0, 3, 9):
        moved = weights.copy()
        moved[int(features[0, 1]), g] += 1e-5
        assert abs((value(moved) - value(weights)) / 1e-5 - gradient[0, g]) < 1e-3


def test_sums_of_runs():
    rng = np.random.default_rng(1)
    rows = np.sort(rng.integers(0, 40, 900) ** 2 // 60)
    gradient, source = rng.normal(size=(300, 5)), rng.integers(0, 300, 900)
    begins, lengths = maxent._runs(rows)
    assert np.allclose(maxent.summed_by_row(gradient, source, begins, lengths), np.add.reduceat(gradient[source], begins, axis=0))


def test_no_documents_and_no_training(none, table):
    assert maxent.score_texts(none).count() == 0
    alone = next(i for i in range(100) if is_held(i))
    r = maxent.score_texts(table([(alone, "a b")])).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (True, 3, 0, 0, 0.0) and r.score < 0
