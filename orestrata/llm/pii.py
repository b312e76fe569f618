"""Personal data: exact patterns, and a semi-Markov field, trained by averaged structured updates, for spans that they miss.

``base_spans`` finds what the contract's patterns find, in one linear pass each. The field looks at windows of neighbouring
white-space tokens that hold a digit or an at sign, however many; tokens of more than ``SEGMENT_CHARS`` characters (minified
JSON, URL parameters) are split at punctuation into tokens of their own. Its candidates are whole segments of up to ``SEGMENT_TOKENS`` tokens,
and features describe a segment as a whole: its shape, number of digits, check digit, the base patterns, the word before.
Dynamic programming over a window, with as many entities as its tokens hold, chooses all boundaries and types together.
What it finds beside the base spans is added if it beats "nothing" by ``MARGIN``; base spans always stay.

It is trained here, on about ``SAMPLE_DOCS`` documents that hold digits or an at sign, chosen by a hash: the base spans in their windows, the same
windows with the spans rewritten in ways that the patterns miss, and windows without any. It learns by averaged updates
towards the right segmentation. All documents are then searched whole.

Defined results: null text is empty and has no spans; positions are code points; a segment has ``SEGMENT_CHARS`` characters
at most, unbroken letters and digits beyond that are nothing to the field (the patterns have no limit); equal texts have equal spans; without training
windows nothing is added; an empty table gives no rows. Other columns are not looked at.
"""
from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from orestrata.llm.common import sample_texts, text_of
from orestrata.session import in_arrow

KINDS = ("email", "ip", "card", "phone")
SEGMENT_TOKENS, SEGMENT_CHARS = 4, 80
SAMPLE_DOCS, SAMPLE_CHARS = 4000, 50_000
ROUNDS = 6
MARGIN = 2.0

#: The contract's patterns. Possessive repeats keep them linear; they match the same.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_TAIL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

ANY = re.compile(r"[0-9@]")
TRIGGER = re.compile(r"[0-9@]|[(\[]at[)\]]")
TOKEN = re.compile(r"\S+")
#: What the tokens within a long token are, from coarse to fine; the finer are for what is still too long. Up to
#: SEGMENT_TOKENS of them make a segment together with what stands between them.
WITHIN = [re.compile(x) for x in (
    r"""[^"'<>{},;:&=?|\\]+""",
    r"(?:[(\[](?:at|\.)[)\]]|[^/()\[\]])+",
    r"(?:[(\[](?:at|\.)[)\]]|[^\W_]|[@.-])+",
    r"(?:[(\[]at[)\]]|[^\W_]|@)+",
)]
WORDLIKE = re.compile(r"[^\W_]")
Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Every match ends its local part at an at sign, so at signs are visited and the local part is read backwards."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        host = DOMAIN.match(text, at + 1) if start < at else None
        if host:
            yield "email", start, host.end()
            done = host.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """Spans by kind as listed, then by start."""
    spans = list(_emails(text)) if "@" in text else []
    if not ANY.search(text):
        return spans
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            spans.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m.group())) <= 15:
                spans.append(("phone", *m.span()))
    return spans


def within(text: str, start: int, end: int, level: int = 0) -> Iterator[tuple[int, int]]:
    """A token as it is or, if it is too long for a segment, the tokens within it."""
    if end - start <= SEGMENT_CHARS or level == len(WITHIN):
        yield start, end
        return
    for m in WITHIN[level].finditer(text, start, end):
        yield from within(text, m.start(), m.end(), level + 1)


def windows(text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs of neighbouring tokens that hold a trigger, with the token before the first (empty if none). Tokens are
    (start, end)."""
    run: list[tuple[int, int]] = []
    last, reached = (0, 0), 0
    for hit in TRIGGER.finditer(text):
        if hit.start() < reached:
            continue
        start = hit.start()
        while start > reached and not text[start - 1].isspace():
            start -= 1
        end = TOKEN.match(text, hit.start()).end()
        stop = start
        while stop > reached and text[stop - 1].isspace():
            stop -= 1
        head = stop
        while head > max(reached, stop - SEGMENT_CHARS) and not text[head - 1].isspace():
            head -= 1
        before, whole = (head, stop), True
        for a, b in within(text, start, end):
            if TRIGGER.search(text, a, b):
                between = text[last[1] : a]
                if run and (between.strip() if whole else WORDLIKE.search(between)):
                    yield run
                    run = []
                if not run:
                    run = [before]
                run.append((a, b))
                last, whole = (a, b), False
            before = (a, b)
        reached = end
    if run:
        yield run


def segment(text: str, run: list[tuple[int, int]], i: int, j: int) -> tuple[int, int]:
    """Tokens i to j of a window without the punctuation around them."""
    a, b = run[i][0], run[j][1]
    while a < b and text[a] in "\"'<[{,;:!?*#$%&":
        a += 1
    while b > a and text[b - 1] in "\"'>]}.,;:!?*#$%&":
        b -= 1
    return a, b


def _shape(part: str) -> str:
    return re.sub(r"[A-Za-z]+", "a", re.sub(r"[0-9]+", "9", part))[:24]


def features(text: str, a: int, b: int, before: str, n_tokens: int) -> list[str]:
    """What is said of a whole segment."""
    part = text[a:b]
    digits = re.sub(r"[^0-9]", "", part)
    groups = [len(g) for g in re.findall(r"[0-9]+", part)]
    found = {f"is {kind}" for kind, s, e in base_spans(part) if (s, e) == (0, len(part))}
    n = len(digits)
    size = 0 if n == 0 else 1 if n < 7 else 2 if n < 9 else 3 if n < 13 else 4 if n < 20 else 5
    ip_like = len(groups) == 4 and all(int(g) <= 255 for g in re.findall(r"[0-9]+", part) if len(g) <= 3) and max(groups) <= 3
    card_like = 13 <= n <= 19 and luhn(digits)
    out = ["bias", f"shape {_shape(part)}", f"digits {size}", f"tokens {n_tokens}", f"before {before}"]
    out += [f"groups {'-'.join(map(str, groups[:6]))}"] * bool(groups)
    out += ["at"] * ("@" in part) + ["at word"] * bool(re.search(r"[(\[]at[)\]]", part)) + ["plus"] * part.startswith("+")
    out += [f"four parts {ip_like}"] * (len(groups) == 4) + [f"card digits {card_like}"] * (size == 4)
    out += ["letters"] * bool(re.search(r"[A-Za-z]", part)) + ["dotted"] * ("." in part)
    return out + sorted(found)


class Field:
    """Weights by (kind, feature) and the search for the best segmentation of a window."""

    def __init__(self, weights: dict[tuple[str, str], float]):
        self.weights = weights

    def options(self, text: str, run: list[tuple[int, int]]) -> Iterator[tuple[tuple[int, int], list[str]]]:
        """All candidate segments of the tokens after the first, by their ends, with their features."""
        first = text[slice(*run[0])].strip(".,;:!?\"'").lower()
        for j in range(1, len(run)):
            for i in range(max(1, j - SEGMENT_TOKENS + 1), j + 1):
                a, b = segment(text, run, i, j)
                if 0 < b - a <= SEGMENT_CHARS:
                    yield (i, j), features(text, a, b, first if i == 1 else "number", j - i + 1)

    def best(self, options: Iterable[tuple[tuple[int, int], list[str]]], n: int) -> list[tuple[str, int, int, float]]:
        """(kind, first token, last token, score) of the best segmentation of tokens 1..n-1."""
        # of the tokens up to t: the best score, and its last step
        scores, steps = [0.0] * n, [None] * n
        done = 0
        for (i, j), found in options:
            while done < j:
                done += 1
                scores[done] = scores[done - 1]
            for kind in KINDS:
                value = sum(self.weights.get((kind, f), 0.0) for f in found)
                if value > 0 and scores[i - 1] + value > scores[j]:
                    scores[j], steps[j] = scores[i - 1] + value, (kind, i, value)
        t, out = n - 1, []
        while t > 0:
            if steps[t] is None:
                t -= 1
            else:
                kind, i, value = steps[t]
                out.append((kind, i, t, value))
                t = i - 1
        return out[::-1]

    def added(self, text: str, base: list[Span]) -> list[Span]:
        out, ordered = [], sorted((s, e) for _, s, e in base)
        starts, reach = [s for s, _ in ordered], [0, *accumulate((e for _, e in ordered), max)]
        for run in windows(text):
            for kind, i, j, value in self.best(self.options(text, run), len(run)):
                a, b = segment(text, run, i, j)
                if value >= MARGIN and reach[bisect_left(starts, b)] <= a:
                    out.append((kind, a, b))
        return out


def rewritten(kind: str, part: str) -> list[str]:
    """The same data as people write it to get past patterns."""
    if kind == "email":
        name, host = part.split("@", 1)
        return [f"{name}[at]{host}", f"{name}(at){host}"]
    if kind == "ip":
        return [part.replace(".", "[.]"), part.replace(".", "-")]
    if kind == "card":
        digits = re.sub(r"[^0-9]", "", part)
        return [sep.join(digits[i : i + 4] for i in range(0, len(digits), 4)) for sep in (".", "_", "/")]
    return [part.lstrip("+"), part.lstrip("+").split(" ", 1)[-1], re.sub(r"[^0-9]+", "-", part.lstrip("+"))]


def examples(text: str) -> list[tuple[str, list[Span]]]:
    """Windows of a text as small texts with their spans: as they are, and with every span rewritten."""
    out, base = [], base_spans(text)
    for run in windows(text):
        a, b = run[0][0], run[-1][1]
        own = sorted((s - a, e - a, kind) for kind, s, e in base if a <= s and e <= b)
        own = [o for n, o in enumerate(own) if n == 0 or o[0] >= own[n - 1][1]]
        part = text[a:b]
        out.append((part, [(kind, s, e) for s, e, kind in own]))
        for turn in range(3 if own else 0):
            made, spans, at = "", [], 0
            for s, e, kind in own:
                new = rewritten(kind, part[s:e])
                made += part[at:s]
                spans.append((kind, len(made), len(made) + len(new[turn % len(new)])))
                made, at = made + new[turn % len(new)], e
            out.append((made + part[at:], spans))
    return out


def train(texts: list[str], rounds: int = ROUNDS) -> Field:
    """Averaged updates: towards the right segmentation's features, away from those of the best wrong one."""
    cases = []
    blank = Field({})
    for text in texts:
        for part, spans in examples(text):
            for run in windows(part):
                if run[0] == (0, 0) or run[0][1] > 0:
                    options = dict(blank.options(part, run))
                    at: dict[tuple[int, int], tuple[int, int]] = {}
                    for ij in options:
                        at.setdefault(segment(part, run, *ij), ij)
                    right = {at[s, e]: kind for kind, s, e in spans if (s, e) in at}
                    cases.append((options, len(run), right))
    weights: dict[tuple[str, str], float] = defaultdict(float)
    total: dict[tuple[str, str], float] = defaultdict(float)
    step, field = 1, Field(weights)
    for _ in range(rounds):
        for options, n, right in cases:
            guess = {(i, j): kind for kind, i, j, _ in field.best(options.items(), n)}
            step += 1
            if guess == right:
                continue
            for chosen, sign in ((right, 1.0), (guess, -1.0)):
                for ij, kind in chosen.items():
                    for f in options[ij]:
                        weights[kind, f] += sign
                        total[kind, f] += sign * step
    return Field({k: w - total[k] / step for k, w in weights.items() if w or total[k]})


def span_text(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1])))


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans by kind, the SHA-256 of the base spans' list, and the list of all spans."""
    texts = docs.select("doc_id", text_of().alias("text"))
    weights = train(sample_texts(docs, SAMPLE_DOCS, SAMPLE_CHARS, "text RLIKE '[0-9@]'")).weights

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = Field(weights)
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            for text in batch.column(1).to_pylist():
                base = base_spans(text)
                for column, kind in zip(columns, KINDS):
                    column.append(sum(k == kind for k, _, _ in base))
                columns[4].append(hashlib.sha256(span_text(base).encode()).hexdigest())
                columns[5].append(span_text(base + (field.added(text, base) if base or TRIGGER.search(text) else [])))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"],
            )

    return texts.transform(in_arrow, 
        find, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    )


def op6_personal_data(spark, sf_dir):
    from orestrata.llm.common import table

    return personal_data(table(spark, sf_dir, "documents"))
