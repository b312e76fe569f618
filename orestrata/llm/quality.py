"""A quality classifier without labels: heuristics vote, EM weighs them, and their posterior trains a linear scorer.

Each of ``LABELLERS`` votes good, bad or nothing on every document. What the corpus says about them is how often each
pattern of votes occurs, counted over all documents (at most 3 ** len(LABELLERS) patterns, whatever the corpus). EM finds
from these counts how often each labeller casts each vote on good and on bad documents, and each pattern's posterior.

The posterior labels about ``SAMPLE_DOCS`` documents of at most ``SAMPLE_CHARS`` characters, chosen by a hash; on
those a logistic scorer is fitted over hashed byte n-grams and hashed buckets of the document's figures. Every whole
document is then scored; it is kept if the scorer gives it at least ``KEEP``.

Defined results: null text is empty; an empty or blank text has no votes and scores by the bias alone of what figures it
has; repeated rows score alike; an empty table gives no rows; if no document can be sampled, the posterior decides. Other
columns are not looked at.
"""
from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from orestrata.llm.common import sample_texts, text_of
from orestrata.session import in_arrow

#: Figure, bad from here on, good up to here: shares of letters, bytes or words. Between the two a labeller says nothing.
LABELLERS = (
    ("capitals", 0.50, 0.20),
    ("symbols", 0.05, 0.01),
    ("bars", 0.02, 0.002),
    ("calls", 0.02, 0.002),
    ("repeats", 0.15, 0.03),
    ("sameness", 0.80, 0.55),
)
GRAM = 4
BUCKETS = 1 << 16
#: Buckets of each figure, above those of the n-grams.
FIGURE_BUCKETS = 16
SAMPLE_DOCS, SAMPLE_CHARS = 4000, 30_000
EM_ROUNDS = 60
#: What is known beforehand: a labeller says bad of at most so many good documents, and of a hundred times as many bad ones.
#: Without it, labellers that find different faults would be taken for noise beside those that find the same.
FALSE_ALARM = 0.0005
FIT_ROUNDS = 150
KEEP = 0.5
#: Bytes of text whose n-grams are looked up at once.
CHUNK_BYTES = 1 << 20

UPPER = bytes(range(65, 91))
LETTERS = UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
SYMBOLS = b"#$%&*~^<>{}[]=+_\\@`"
BLANK = b" \t\n\r\x0b\x0c"
LOG_BASE = 1.6


def figures(text: str) -> list[float]:
    """One figure for each labeller; 0 where there is nothing to count."""
    raw = text.encode()
    count = lambda these: len(raw) - len(raw.translate(None, these))
    words = raw.split()
    n, size = len(words), max(1, len(raw) - count(BLANK))
    repeats = sum(map(eq, words, words[1:])) / max(1, n - 1)
    # long texts repeat more of their words: the expected number of distinct ones grows as a power of the length
    same = 1 - len(set(words)) / max(1.0, min(n, 2.0 * n**0.8)) if n >= 20 else 0.0
    return [
        count(UPPER) / max(1, count(LETTERS)), count(SYMBOLS) / size, count(b"|") / size, count(b"!") / size, repeats, same
    ]


def votes(values: list[float]) -> str:
    """A character for each labeller: b(ad), g(ood) or a hyphen."""
    return "".join("b" if v >= bad else "g" if v <= good else "-" for v, (_, bad, good) in zip(values, LABELLERS, strict=True))


def expectation_maximisation(counts: dict[str, int], rounds: int = EM_ROUNDS) -> dict[str, float]:
    """The probability of being good for each pattern of votes. Starts from "bad as soon as one labeller says so"."""
    patterns = sorted(counts)
    if not patterns:
        return {}
    n = np.array([counts[p] for p in patterns], float)
    cast = np.array([[["b", "-", "g"].index(v) for v in p] for p in patterns])
    good = np.array([0.1 if "b" in p else 0.9 for p in patterns])
    for _ in range(rounds):
        share = (n * good).sum() / n.sum()
        odds = np.log(np.clip(share, 1e-6, 1 - 1e-6)) - np.log(np.clip(1 - share, 1e-6, 1 - 1e-6))
        log_odds = np.full(len(patterns), odds)
        for labeller in range(cast.shape[1]):
            on_good = np.bincount(cast[:, labeller], n * good, 3) + 1
            on_bad = np.bincount(cast[:, labeller], n * (1 - good), 3) + 1
            on_good, on_bad = on_good / on_good.sum(), on_bad / on_bad.sum()
            on_good[0] = min(on_good[0], FALSE_ALARM)
            on_bad[0] = max(on_bad[0], 100 * FALSE_ALARM)
            ratio = np.log(on_good) - np.log(on_bad)
            log_odds += ratio[cast[:, labeller]]
        good = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
    return dict(zip(patterns, good.tolist(), strict=True))


def _grams(raw: np.ndarray) -> np.ndarray:
    """The bucket of the n-gram at each place of ``raw``."""
    wide = raw.astype(np.uint32)
    key = wide[: -GRAM + 1].copy()
    for i in range(1, GRAM):
        key |= wide[i : len(wide) - GRAM + 1 + i] << np.uint32(8 * i)
    key *= np.uint32(2654435761)
    return key >> np.uint32(16)


def _figure_buckets(values: list[float]) -> np.ndarray:
    """A bucket for each figure: its order of magnitude in steps of LOG_BASE, below 1."""
    steps = [0 if v <= 0 else int(np.clip(FIGURE_BUCKETS - 1 + np.log(min(v, 1.0)) / np.log(LOG_BASE), 1, FIGURE_BUCKETS - 1)) for v in values]
    return BUCKETS + np.arange(len(steps)) * FIGURE_BUCKETS + np.array(steps)


def score(texts: list[str], values: list[list[float]], weights: np.ndarray) -> np.ndarray:
    """Log-odds of being good: the mean weight of a text's n-grams, plus its figures' weights, plus the bias (last)."""
    out = np.full(len(texts), weights[-1], float)
    for i, value in enumerate(values):
        out[i] += weights[_figure_buckets(value)].sum()
    held: list[tuple[int, bytes]] = []

    def flush() -> None:
        for i, part in held:
            raw = np.frombuffer(part, np.uint8)
            total = 0.0
            for at in range(0, len(raw), CHUNK_BYTES):
                piece = raw[at : at + CHUNK_BYTES + GRAM - 1]
                if len(piece) >= GRAM:
                    total += float(weights[_grams(piece)].sum())
            out[i] += total / max(1, len(raw) - GRAM + 1)
        held.clear()

    for i, text in enumerate(texts):
        held.append((i, text.encode()))
        if len(held) == 256:
            flush()
    flush()
    return out


def fit(texts: list[str], values: list[list[float]], good: np.ndarray, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """Logistic regression on soft labels by gradient steps of adapted size (AdaGrad), classes weighed equally."""
    size = BUCKETS + len(LABELLERS) * FIGURE_BUCKETS + 1
    index, value, starts = [], [], [0]
    for text, own in zip(texts, values, strict=True):
        raw = np.frombuffer(text.encode(), np.uint8)
        found, n = np.unique(_grams(raw), return_counts=True) if len(raw) >= GRAM else (np.zeros(0, int), np.zeros(0))
        index.append(np.concatenate([found, _figure_buckets(own), [size - 1]]).astype(np.int64))
        value.append(np.concatenate([n / max(1, n.sum()), np.ones(len(own) + 1)]))
        starts.append(starts[-1] + len(index[-1]))
    flat, amount, lengths = np.concatenate(index), np.concatenate(value), np.diff(starts)
    weigh = np.where(good >= 0.5, 0.5 / max(1.0, (good >= 0.5).sum()), 0.5 / max(1.0, (good < 0.5).sum()))
    weights, seen = np.zeros(size), np.full(size, 1e-12)
    for _ in range(rounds):
        odds = np.add.reduceat(weights[flat] * amount, starts[:-1])
        error = weigh * (1 / (1 + np.exp(-np.clip(odds, -30, 30))) - good)
        slope = np.bincount(flat, np.repeat(error, lengths) * amount, size) + 1e-6 * weights
        seen += slope * slope
        weights -= 0.3 * slope / np.sqrt(seen)
    return weights


def learn(docs: DataFrame) -> tuple[dict[str, float], np.ndarray | None]:
    """The posterior of every pattern of votes in ``docs`` and the scorer's weights."""
    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([votes(figures(t)) for t in batch.column(0).to_pylist()], pa.string())], ["votes"])

    patterns = docs.select(text_of().alias("text")).transform(in_arrow, vote, "votes string").groupBy("votes").count()
    posterior = expectation_maximisation({r["votes"]: r["count"] for r in patterns.collect()})
    picked = sample_texts(docs, SAMPLE_DOCS, SAMPLE_CHARS, "text <> ''")
    own = [figures(t) for t in picked]
    return posterior, fit(picked, own, np.array([posterior[votes(v)] for v in own])) if picked else None


def _judged(texts: list[str | None], posterior: dict[str, float], weights: np.ndarray | None) -> tuple[list[str], np.ndarray, np.ndarray]:
    held = [t or "" for t in texts]
    values = [figures(t) for t in held]
    cast = [votes(v) for v in values]
    weak = np.array([posterior[c] for c in cast], float)
    odds = score(held, values, weights) if weights is not None else np.log(np.clip(weak, 1e-9, 1) / np.clip(1 - weak, 1e-9, 1))
    return cast, weak, 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def classify(docs: DataFrame, keep: float = KEEP) -> DataFrame:
    """doc_id, votes, weak (the posterior of its votes), score (the scorer's probability of being good) and keep."""
    posterior, weights = learn(docs)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cast, weak, good = _judged(batch.column(1).to_pylist(), posterior, weights)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cast, pa.string()), pa.array(weak), pa.array(good), pa.array(good >= keep)],
                ["doc_id", "votes", "weak", "score", "keep"],
            )

    return docs.select("doc_id", "text").transform(in_arrow, judge, "doc_id long, votes string, weak double, score double, keep boolean")


def good_documents(docs: DataFrame, keep: float = KEEP) -> DataFrame:
    """The rows that the classifier keeps, with all their columns; they pass by without a shuffle."""
    posterior, weights = learn(docs)
    at = docs.columns.index("text")

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, good = _judged(batch.column(at).to_pylist(), posterior, weights)
            yield batch.filter(pa.array(good >= keep))

    return docs.transform(in_arrow, sift, docs.schema)


def op5_quality(spark, sf_dir):
    from orestrata.llm.common import table

    return classify(table(spark, sf_dir, "documents"))
