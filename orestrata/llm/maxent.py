"""Scores of texts by a hashed maximum-entropy language model with a class-factored softmax.

Tokens are the words of a text, A-Z in lower case, and one end. P(token | context) is P(class | context) times P(token | class,
context), each a softmax over weights of hashed features of the two tokens before: the last one (an n-gram feature), the one before it (a
skip feature), the pair of them, and a bias.

* **Classes.** The ``HEAD_CLASSES`` * ``WIDTH`` most frequent tokens are the head, ``WIDTH`` of neighbouring rank to a class.
  All others belong to one of ``TAIL_CLASSES`` classes by a hash of their last two bytes; within such a class a token has the
  probability (c + 1) / (N + V + 1) of its count, the class's tokens and its distinct tokens. So every token has a
  probability, unseen ones too, and those of all tokens add up to one (all unseen tokens of a class share one).
* **Counts.** Tokens of all training documents are counted where they are read and added up by token. The tables that go to
  every task are bounded: at most ``FREQUENT`` counts, chosen by a threshold from a histogram of counts. All other tokens of
  a document meet their counts in a join, so counts are exact whatever the vocabulary's size.
* **Training.** In each of ``ROUNDS`` rounds every task goes once over its share of the round's documents, with gradient steps
  of the log-likelihood on its own copy of the weights; the changes, weighted by how often a row was used, are added up by
  row over all tasks and make the next round's weights. Every training document is used once.
* **Scoring.** Tokens are looked up in sparse NumPy batches: a row of indices for each token, whose weights are added.

Defined results: null text has only its end; a null doc_id is the empty text for the split, so it is trained on; repeated rows
count once each; without training documents, counts are 0 and classes are equally likely; an empty table gives no rows.
Other columns are not looked at.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orestrata.llm.common import text_of
from orestrata.session import in_arrow, staged

#: The contract's split.
FOLDS, HELD_FOLD = 7, 2
#: No word is a line break.
END = b"\n"
WIDTH = 64
HEAD_CLASSES = 48
TAIL_CLASSES = WIDTH - HEAD_CLASSES
#: Tokens whose counts go to every task.
FREQUENT = 200_000
#: Rows of weights of each of the two factors, at first for biases.
ROWS = 1 << 14
BIASES = WIDTH
ROUNDS = 3
RATE = 1.0
#: Contexts of a gradient step, bytes of a text and tokens of texts that are worked on at once, tokens that a task learns from
#: at once, distinct tokens that it counts at once.
STEP = 1024
CHUNK_BYTES = 1_000_000
CHUNK_TOKENS = 200_000
LEARNT_TOKENS = 1_200_000
HELD_TOKENS = 300_000
START = WIDTH * WIDTH


def held_out() -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == HELD_FOLD


def chunks(text: str | None) -> Iterator[list[bytes]]:
    """The tokens of a text, about ``CHUNK_BYTES`` at a time, the end with the last ones."""
    raw = (text or "").encode().lower()
    at = 0
    while len(raw) - at > CHUNK_BYTES:
        stop = at + CHUNK_BYTES
        # a chunk ends before white space, so that no word is cut
        word = raw[stop : stop + 1]
        while word and not word.isspace():
            stop += 1
            word = raw[stop : stop + 1]
        yield raw[at:stop].split()
        at = stop
    yield [*raw[at:].split(), END]


def token_counts(docs: DataFrame) -> DataFrame:
    """Stored: (token, n) over all ``docs``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        held: Counter = Counter()

        def passed_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held, pa.binary()), pa.array(held.values(), pa.int64())], ["token", "n"])

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for text in batch.column(0).slice(at, 64).to_pylist():
                    for tokens in chunks(text):
                        held.update(tokens)
                if len(held) > HELD_TOKENS:
                    yield passed_on()
                    held.clear()
        yield passed_on()

    counted = docs.select(text_of().alias("text")).transform(in_arrow, count, "token binary, n long")
    return staged(docs.sparkSession, counted.groupBy("token").agg(F.sum("n").alias("n")), "token-counts")


def tail_class(token: bytes) -> int:
    return zlib.crc32(token[-2:]) % TAIL_CLASSES


@dataclass
class Vocabulary:
    """Bounded tables of the counts: the frequent tokens, the head first, and what the tail classes hold."""

    tokens: list[bytes]
    counts: np.ndarray
    n_tokens: int
    n_types: int
    n_head: int
    tail_n: np.ndarray
    tail_types: np.ndarray

    def __post_init__(self) -> None:
        n, head = len(self.tokens), self.n_head
        self.group = np.zeros(n, np.int64)
        self.group[:head] = np.arange(head) // WIDTH
        self.group[head:] = [HEAD_CLASSES + tail_class(t) for t in self.tokens[head:]]
        self.place = np.where(np.arange(n) < head, np.arange(n) % WIDTH, -1)
        # what a token is as context: itself, or its class
        self.context = np.where(np.arange(n) < head, np.arange(n), HEAD_CLASSES * WIDTH + self.group - HEAD_CLASSES)
        self.log_count = np.log10(self.counts + 1.0)

    def class_totals(self) -> np.ndarray:
        head = np.bincount(self.group[: self.n_head], self.counts[: self.n_head], HEAD_CLASSES)
        return np.concatenate([head, self.tail_n])


def vocabulary(counts: DataFrame, frequent: int = FREQUENT) -> Vocabulary:
    """The tables of stored ``counts``. Those with at least as many occurrences as a threshold are frequent; a histogram over
    logarithms says which threshold keeps their number within the bound."""
    level = F.floor(F.log2("n") * 8).cast("int")
    histogram = sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True)
    taken, least = 0, None
    for r in histogram:
        if taken + r["count"] > frequent:
            break
        taken, least = taken + r["count"], r["level"]
    top = counts.filter(level >= least).toArrow() if taken else pa.table({"token": pa.array([], pa.binary()), "n": pa.array([], pa.int64())})
    ordered = sorted(zip(top["n"].to_pylist(), top["token"].to_pylist(), strict=True), key=lambda x: (-x[0], x[1]))
    head = min(len(ordered), HEAD_CLASSES * WIDTH)
    totals = {}
    group = F.pmod(F.crc32(F.substring("token", -2, 2)), F.lit(TAIL_CLASSES))
    for r in counts.groupBy(group.alias("g")).agg(F.sum("n").alias("n"), F.count("*").alias("types")).collect():
        totals[r["g"]] = (r["n"], r["types"])
    tail_n, tail_types = (np.array([totals.get(g, (0, 0))[i] for g in range(TAIL_CLASSES)], np.int64) for i in (0, 1))
    n_tokens, n_types = int(tail_n.sum()), int(tail_types.sum())
    for n, token in ordered[:head]:
        tail_n[tail_class(token)] -= n
        tail_types[tail_class(token)] -= 1
    return Vocabulary([t for _, t in ordered], np.array([n for n, _ in ordered], np.int64), n_tokens, n_types, head, tail_n, tail_types)


def first_weights(words: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Weights of class and member that give the counts' own probabilities, whatever the context."""
    by_class, by_member = np.zeros((ROWS, WIDTH), np.float32), np.zeros((ROWS, WIDTH), np.float32)
    by_class[0] = np.log(words.class_totals() + 1.0)
    head = np.arange(words.n_head)
    by_member[:HEAD_CLASSES] = -1e4  # classes may have fewer members than places
    by_member[head // WIDTH, head % WIDTH] = np.log(words.counts[: words.n_head] + 1.0)
    return by_class, by_member


def _hashed(*parts: np.ndarray | int) -> np.ndarray:
    h = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for p in parts:
            h = (np.asarray(p).astype(np.uint64) + h) * np.uint64(0xBF58476D1CE4E5B9)
            h = h ^ (h >> np.uint64(31))
    return (BIASES + (h >> np.uint64(20)) % np.uint64(ROWS - BIASES)).astype(np.uint16)


#: A context is two numbers below this; hashes of the single ones are looked up.
CONTEXTS = START + 1
_ONE, _TWO = (_hashed(salt, np.arange(CONTEXTS)) for salt in (1, 2))


def class_features(context: np.ndarray) -> np.ndarray:
    """Bias, last token, skip to the one before, both."""
    one, two = np.divmod(context, CONTEXTS)
    return np.stack([np.zeros(len(one), np.uint16), _ONE[one], _TWO[two], _hashed(3, context)], 1)


def member_features(context: np.ndarray) -> np.ndarray:
    """The same within a class, without the pair; the context holds the class as well."""
    both, group = np.divmod(context, WIDTH)
    one, two = np.divmod(both, CONTEXTS)
    return np.stack([group.astype(np.uint16), _hashed(5, one * WIDTH + group), _hashed(6, two * WIDTH + group)], 1)


class Lines:
    """A few texts as arrays: class, place within it and context of each token, and the document it belongs to."""

    def __init__(self, words: Vocabulary, index: dict[bytes, int], chunk: list[tuple[int, list[bytes], np.ndarray]]):
        flat = [t for _, tokens, _ in chunk for t in tokens]
        n = len(flat)
        sizes = np.array([len(tokens) for _, tokens, _ in chunk])
        self.doc = np.repeat([d for d, _, _ in chunk], sizes)
        self.code = np.fromiter(map(index.get, flat, repeat(-1)), np.int64, n)
        self.rare_at = rare = np.flatnonzero(self.code < 0)
        self.rare = [flat[i] for i in rare.tolist()]
        known = np.maximum(self.code, 0)
        if len(words.tokens):
            group, self.place, own = words.group[known], words.place[known], words.context[known]
        else:
            group, self.place, own = (np.zeros(n, np.int64) for _ in range(3))
        tail = np.array([tail_class(t) for t in self.rare], np.int64)
        group[rare], self.place[rare], own[rare] = HEAD_CLASSES + tail, -1, HEAD_CLASSES * WIDTH + tail
        self.group = group
        # two places of context before each piece of text
        before = np.arange(n) + 2 * np.repeat(np.arange(len(chunk)) + 1, sizes)
        line = np.full(n + 2 * len(chunk), START, np.int64)
        line[before] = own
        ends = np.cumsum(sizes + 2)
        for end, size, (_, _, carried) in zip(ends.tolist(), sizes.tolist(), chunk, strict=True):
            line[end - size - 2 : end - size] = carried
        self.carried = line[-2:].copy()
        self.context = line[before - 1] * CONTEXTS + line[before - 2]


def lines(words: Vocabulary, index: dict[bytes, int], texts: list[str | None]) -> Iterator[Lines]:
    """The tokens of all texts, about ``CHUNK_BYTES`` at a time; a longer text goes on with its last two tokens."""
    start = np.full(2, START, np.int64)
    held: list[tuple[int, list[bytes], np.ndarray]] = []
    size = 0
    for doc, text in enumerate(texts):
        carried = start
        for tokens in chunks(text):
            held.append((doc, tokens, carried))
            size += len(tokens)
            ended = tokens[-1:] == [END]
            if not ended or size > CHUNK_TOKENS:
                whole = Lines(words, index, held)
                held, size, carried = [], 0, whole.carried
                yield whole
    if held:
        yield Lines(words, index, held)


def logits_of(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    """The sums of the weights of each row of features, the largest of each row moved to 0."""
    logits = weights[features[:, 0]]
    for f in range(1, features.shape[1]):
        logits += weights[features[:, f]]
    return np.subtract(logits, logits.max(1, keepdims=True), out=logits)


def log_likelihood(weights: np.ndarray, features: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """ln P(chosen) of each row of features."""
    logits = logits_of(weights, features)
    own = logits[np.arange(len(logits)), chosen]
    return own - np.log(np.exp(logits, out=logits).sum(1))


def gradient_of(weights: np.ndarray, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The gradient, by the logits, of the log-likelihood of ``counts`` (how often each choice was taken) in each row."""
    p = np.exp(logits_of(weights, features))
    return counts - p * (counts.sum(1) / p.sum(1))[:, None]


def summed_by_row(gradient: np.ndarray, source: np.ndarray, begins: np.ndarray, lengths: np.ndarray, short: int = 8) -> np.ndarray:
    """The sums of ``gradient[source]`` over runs: short runs all at once, one member of each at a time, long ones alone."""
    sums = gradient[source[begins]]
    for k in range(1, short):
        at = np.flatnonzero((lengths > k) & (lengths <= short))
        sums[at] += gradient[source[begins[at] + k]]
    for i in np.flatnonzero(lengths > short):
        sums[i] = gradient[source[begins[i] : begins[i] + lengths[i]]].sum(0)
    return sums


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begins = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    return begins, np.diff(np.concatenate([begins, [len(values)]]))


class Trainer:
    """A task's own weights of one factor: steps along the gradient, shorter the longer a row has been moved."""

    def __init__(self, weights: np.ndarray, features, rate: float):
        self.first, self.weights, self.features, self.rate = weights, weights.copy(), features, rate
        self.moved = np.zeros(len(weights), np.float64)
        self.used = np.zeros(len(weights), np.int64)

    def step(self, features: np.ndarray, counts: np.ndarray) -> None:
        gradient = gradient_of(self.weights, features, counts)
        flat = features.ravel()
        order = np.argsort(flat, kind="stable")
        begins, lengths = _runs(flat[order])
        which = flat[order[begins]].astype(np.int64)
        g = summed_by_row(gradient, order // features.shape[1], begins, lengths)
        self.moved[which] += np.einsum("ij,ij->i", g, g, dtype=np.float64)
        self.used[which] += lengths
        self.weights[which] += (self.rate / np.sqrt(self.moved[which] + 1e-6)).astype(np.float32)[:, None] * g

    def learn(self, context: np.ndarray, chosen: np.ndarray, counts: np.ndarray) -> None:
        """Entries sorted by context: what was chosen there and how often. Contexts are met in a mixed, fixed order."""
        begins, lengths = _runs(context)
        order = np.random.default_rng(1).permutation(len(begins))
        for at in range(0, len(order), STEP):
            pick = order[at : at + STEP]
            n = lengths[pick]
            line = np.repeat(np.arange(len(pick)), n)
            entry = np.arange(len(line)) + np.repeat(begins[pick] - np.cumsum(n) + n, n)
            taken = np.zeros((len(pick), WIDTH), np.float32)
            np.add.at(taken, (line, chosen[entry]), counts[entry].astype(np.float32))
            self.step(self.features(context[begins[pick]]), taken)

    def changes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.used)
        return at, self.used[at], (self.weights[at] - self.first[at]).astype(np.float16)


def learn_all(classes: Trainer, members: Trainer, keys: list[np.ndarray]) -> None:
    """Both factors from the keys (context, class, place + 1) of many tokens; equal ones are counted and worked on once."""
    merged = np.sort(np.concatenate(keys))
    begins, counts = _runs(merged)
    both, place = np.divmod(merged[begins], WIDTH + 1)
    classes.learn(both // WIDTH, both % WIDTH, counts)
    head = place > 0
    members.learn(both[head], place[head] - 1, counts[head])


def trained(docs: DataFrame, words: Vocabulary, rounds: int = ROUNDS, rate: float = RATE) -> tuple[np.ndarray, np.ndarray]:
    """The two tables of weights after one pass over ``docs``."""
    weights = np.concatenate(first_weights(words))
    for r in range(rounds):

        def train(batches: Iterator[pa.RecordBatch], begin=weights) -> Iterator[pa.RecordBatch]:
            index = {t: i for i, t in enumerate(words.tokens)}
            classes, members = Trainer(begin[:ROWS], class_features, rate), Trainer(begin[ROWS:], member_features, rate)
            keys: list[np.ndarray] = []
            held = 0
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    for line in lines(words, index, batch.column(0).slice(at, 256).to_pylist()):
                        keys.append((line.context * WIDTH + line.group) * (WIDTH + 1) + line.place + 1)
                        held += len(line.context)
                        if held > LEARNT_TOKENS:
                            learn_all(classes, members, keys)
                            keys, held = [], 0
            if keys:
                learn_all(classes, members, keys)
            for first, own in ((0, classes), (ROWS, members)):
                rows, used, change = own.changes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows + first), pa.array(used), pa.array([c.tobytes() for c in change], pa.binary())], ["row", "used", "change"]
                )

        def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for row, used, change in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    own = np.frombuffer(change, np.float16).astype(np.float64) * used
                    if row in sums:
                        sums[row][0] += used
                        sums[row][1:] += own
                    else:
                        sums[row] = np.concatenate([[used], own])
            means = [(s[1:] / s[0]).astype(np.float32).tobytes() for s in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(means, pa.binary())], ["row", "mean"])

        own = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(rounds)) == r).select(text_of().alias("text"))
        changes = own.transform(in_arrow, train, "row long, used long, change binary")
        # 2 * ROWS rows at most, whatever the corpus
        means = changes.repartition("row").transform(in_arrow, add_up, "row long, mean binary").toArrow()
        if means.num_rows:
            weights = weights.copy()
            weights[means["row"].to_numpy()] += np.frombuffer(b"".join(means["mean"].to_pylist()), np.float32).reshape(-1, WIDTH)
    return weights[:ROWS], weights[ROWS:]


def scored(docs: DataFrame, words: Vocabulary, weights: tuple[np.ndarray, np.ndarray], counts: DataFrame) -> DataFrame:
    """One row for each document of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score."""
    spark = docs.sparkSession
    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "own", "token"]
    schema = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, own double, token binary"
    base_of_all = np.log10(float(words.n_tokens + words.n_types + 1))
    base_of_tail = np.log10(words.tail_n + words.tail_types + 1.0)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        index = {t: i for i, t in enumerate(words.tokens)}
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                n = batch.num_rows
                n_tokens, n_known = np.zeros(n, np.int64), np.zeros(n, np.int64)
                base, own = np.zeros(n), np.zeros(n)
                rare: Counter = Counter()
                for line in lines(words, index, batch.column(3).to_pylist()):
                    known = np.flatnonzero(line.code >= 0)
                    seen = words.log_count[line.code[known]]
                    # a context's class probabilities are worked out once for all its tokens in these texts
                    context, which = np.unique(line.context, return_inverse=True)
                    parts = np.empty(len(line.context))
                    order = np.argsort(which, kind="stable")
                    cuts = np.searchsorted(which[order], np.arange(0, len(context) + STEP, STEP))
                    for s in range(0, len(context), STEP):
                        logits = logits_of(weights[0], class_features(context[s : s + STEP]))
                        at = order[cuts[s // STEP] : cuts[s // STEP + 1]]
                        own_logit = logits[which[at] - s, line.group[at]]
                        parts[at] = own_logit - np.log(np.exp(logits, out=logits).sum(1))[which[at] - s]
                    head = np.flatnonzero(line.place >= 0)
                    for s in range(0, len(head), STEP):
                        at = head[s : s + STEP]
                        parts[at] += log_likelihood(weights[1], member_features(line.context[at] * WIDTH + line.group[at]), line.place[at])
                    parts /= np.log(10)
                    tail = np.flatnonzero(line.place < 0)
                    parts[tail] -= base_of_tail[line.group[tail] - HEAD_CLASSES]
                    in_tail = line.place[known] < 0
                    parts[known[in_tail]] += seen[in_tail]
                    n_tokens += np.bincount(line.doc, minlength=n)
                    n_known += np.bincount(line.doc[known], minlength=n)
                    base += np.bincount(line.doc[known], seen, n)
                    own += np.bincount(line.doc, parts, n)
                    rare.update(zip(line.doc[line.rare_at].tolist(), line.rare, strict=True))
                nothing = pa.nulls(n, pa.binary())
                kept = [pa.array(x) for x in (n_tokens, n_known, base - n_tokens * base_of_all, own)]
                yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(3)], *kept, nothing], names)
                if rare:
                    m = len(rare)
                    rows = batch.column(0).take(pa.array([d for d, _ in rare]))
                    yield pa.RecordBatch.from_arrays(
                        [rows, pa.nulls(m, pa.int64()), pa.nulls(m, pa.bool_()), pa.array(rare.values(), pa.int64()), pa.nulls(m, pa.int64()),
                         pa.nulls(m, pa.float64()), pa.nulls(m, pa.float64()), pa.array([t for _, t in rare], pa.binary())], names
                    )

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", held_out().alias("held_out"), text_of().alias("text"))
    rows = staged(spark, numbered.transform(in_arrow, score, schema), "scored")
    # tokens that are not in the tasks' tables meet their counts here; unseen ones add nothing
    rare = rows.filter("token IS NOT NULL").select("row", "token", F.col("n_tokens").alias("times")).join(counts, "token")
    more = rare.groupBy("row").agg(F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more"))
    more = staged(spark, more, "rare-tokens")
    found, extra = F.coalesce("more_known", F.lit(0)), F.coalesce("more", F.lit(0.0))
    return rows.filter("token IS NULL").join(more, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + found).alias("n_known"),
        F.lit(words.n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + extra).alias("base_score"),
        (F.col("own") + extra).alias("score"),
    )


def score_texts(docs: DataFrame, frequent: int = FREQUENT, rounds: int = ROUNDS, rate: float = RATE) -> DataFrame:
    """Scores of all ``docs`` by a model of those that are not held out."""
    training = docs.filter(~held_out())
    counts = token_counts(training)
    words = vocabulary(counts, frequent)
    return scored(docs, words, trained(training, words, rounds, rate), counts)


def op13_maxent_score(spark, sf_dir):
    from orestrata.llm.common import table

    return score_texts(table(spark, sf_dir, "documents"))
