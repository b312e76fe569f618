"""Spelling variants and fill-in-the-middle texts against brute force."""
import hashlib
import random
import re
import zlib
from collections import Counter

import pytest

from llm_rows import ROWS
from orestrata.llm import fill_in_middle as fim
from orestrata.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def edits(a, b):
    """Whether exactly one inserted, deleted or replaced code point parts the two."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(rows, slip=199, least=6, least_count=5, often=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in map(lowered, RUN.findall(text or "")):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= least and n >= least_count}
    near = {w: [v for v in counts if edits(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= often * counts[w] else None
    found = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        found.add((w, counts[w], len(near[w]), form[w], counts.get(form[w]), root))
    return found


def rows_of_variants(seed=5):
    chance = random.Random(seed)
    letters = "abcdéà×z"
    stems = ["".join(chance.choice(letters) for _ in range(chance.randint(6, 12))) for _ in range(40)]
    stems += ["x" * 3000, "x" * 3001, "y" + "x" * 2999, "Àbcdefg", "àbcdefg"]
    rows = []
    for n in range(700):
        words = []
        for _ in range(12):
            w = chance.choice(stems)
            kind = chance.randint(0, 11)
            at = chance.randrange(len(w))
            if kind == 0:
                w = w[:at] + w[at + 1 :]
            elif kind == 1:
                w = w[:at] + chance.choice(letters) + w[at + 1 :]
            elif kind == 2:
                w = w[:at] + chance.choice(letters) + w[at:]
            elif kind == 3:
                w = w.upper() if w.isascii() else w
            words.append(w)
        rows.append((n if n % 9 else None, chance.choice([" ", "-", "1", "\n"]).join(words)))
    # a form that has a form itself
    rows += [(2000 + n, "chaained " * 19 + "chained " * 3 + "chainod" * (n < 5)) for n in range(10)]
    return rows + ROWS


@pytest.mark.parametrize("tile_words, tile_chars", [(1024, 1 << 20), (3, 1 << 20), (50, 40)])
def test_spelling_forms(spark, table, monkeypatch, tile_words, tile_chars):
    rows = rows_of_variants()
    monkeypatch.setattr(spelling.tiles_of, "__defaults__", (spelling.GROUPS, tile_words, tile_chars))
    found = spelling.spelling_forms(table(rows)).collect()
    expected = brute(rows)
    assert sum(r[3] is not None for r in expected) > 10 and any(r[3] != r[5] and r[3] for r in expected)
    assert {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in found} == expected
    assert len(found) == len(expected)


def test_long_words_are_compared_exactly():
    a = ["x" * 3001, "x" * 3000 + "z"]
    for b, expected in ((["x" * 3000, "x" * 2999 + "q"], [(0, 0), (1, 0)]), (a[:1], [(1, 0)])):
        i, j = spelling.near_in_tiles(a, b, False)
        assert list(zip(i.tolist(), j.tolist())) == expected


def test_swapped_letters_are_not_near():
    words = ["abcdef", "abcdfe", "abcdee", "bacdef", "abcdeg"]
    i, j = spelling.near_in_tiles(words, words, True)
    assert {(words[x], words[y]) for x, y in zip(i, j)} == {(words[x], words[y]) for x in range(5) for y in range(x + 1, 5) if edits(words[x], words[y])}


def test_no_words(none, edge):
    assert spelling.spelling_forms(none).count() == 0
    assert {tuple(r) for r in spelling.spelling_forms(edge).select("word", "n", "n_near", "form", "form_n", "root").collect()} == brute(ROWS)


MARKED = [(20, "has <P> in it\nand more"), (21, "<\n<P\n>S>\n"), (22, "\n"), (23, "a"), (24, "\n\n\n"), (25, "<P\n>\nS>"), (26, "one line 日本"),
          (27, "x" * 50_000), (28, ("y" * 700 + "\n") * 90), (29, "crlf\r\nline same line")]


def expected_fim(doc_id, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100:
        return doc_id, len(units), "plain", None, None, text
    if h4 % 100 < 50:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("piece_chars", [1, 7, fim.PIECE_CHARS])
def test_fill_in_middle(spark, table, piece_chars):
    rows = [r for r in ROWS + MARKED if piece_chars > 1 or len(r[1] or "") < 5000]
    docs = table(rows)
    expected = [expected_fim(i, t) for i, t in rows]
    got = Counter(tuple(r[c] for c in ("doc_id", "n", "form", "prefix_chars", "middle_chars", "text")) for r in fim.fill_in_middle(docs, piece_chars=piece_chars).collect())
    assert got == Counter(expected)
    assert {e[2] for e in expected} == {"plain", "psm", "spm"}
    names = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
    got = Counter(tuple(r[c] for c in names) for r in fim.digests(docs, piece_chars=piece_chars).collect())
    assert got == Counter((*e[:5], sha(e[5]), sha(t or "")) for e, (_, t) in zip(expected, rows))


def test_fill_in_middle_small_batches(spark, table, monkeypatch):
    monkeypatch.setattr(fim, "BATCH_CHARS", 10)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        got = {r.output_sha256 for r in fim.digests(table(ROWS), piece_chars=1000).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {sha(expected_fim(i, t)[5]) for i, t in ROWS}


def test_fill_in_middle_rate_and_empty_table(edge, none):
    assert {r.form for r in fim.digests(edge, rate=0).collect()} == {"plain"}
    assert fim.digests(none).count() == fim.fill_in_middle(none).count() == 0
