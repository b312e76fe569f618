"""Token ids, their files, packing and counts against the tokenizers library itself."""
import random
import zlib

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm_rows import ROWS
from orestrata.llm import token_counts as counting
from orestrata.llm import token_files as files
from orestrata.llm.common import new_folder
from orestrata.llm.packing import pack_documents, plan_slots
from orestrata.llm.tokens import Encoder

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def library(path, plain=False):
    """The library as it is loaded, or with the strings of special tokens as ordinary text."""
    tokenizer = Tokenizer.from_file(path)
    if plain:
        tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


ODD = ["", " ", "\n", "a ", " a", "a\n\n\nb", "a  b \n c", "it's HE'LL 3²½ x_y", "tab\tand\rreturn", "é é É", "ΑΣ ς", "\x1c\x85 ­",
       "<|endoftext|><|startoftext|>", "日本語 \U0001f600", "#$%!! ,.;: ''", "ªº", "İstanbul ŉ ǅ"]


@pytest.mark.parametrize("plain", [False, True])
@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_cached_words_give_the_library_s_ids(path, plain, copies):
    own, theirs = Encoder(path, plain), library(path, plain)
    chance = random.Random(3)
    made = ["".join(chance.choice("ab ,.'\n1Zé-") for _ in range(chance.randint(0, 60))) for _ in range(400)]
    texts = [t for _, t in ROWS if t is not None and len(t) < 5000] + ODD + made + [t for _, t in copies[:40]]
    for text in texts * 2:
        assert own.encode([text])[0].tolist() == theirs(text), repr(text)


def test_the_cache_may_start_anew(monkeypatch, copies):
    monkeypatch.setattr("orestrata.llm.tokens.CACHED_WORDS", 5)
    own, theirs = Encoder(BYTES), library(BYTES)
    assert all(own.encode([t])[0].tolist() == theirs(t) for _, t in copies[:20])


def test_token_files(spark, edge, none, tmp_path):
    folder = new_folder(spark, "tokens")
    manifest = files.write_token_files(edge, folder, BYTES)
    found = {(r.start, r.doc_id): r for r in files.read_token_files(manifest, folder).collect()}
    theirs, start = library(BYTES), 0
    for i, text in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array(theirs(text) + [0], "<u4")
        r = found.pop((start, i))
        assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not found
    readers = [files.TokenFile(folder, r.file) for r in manifest.collect()]
    got = [ids for ids in (reader.document(9) for reader in readers) if ids is not None]
    assert [ids.tolist() for ids in got] == [theirs("one two three") + [0]]
    assert all(reader.document(999) is None for reader in readers)
    empty = files.write_token_files(none, new_folder(spark, "tokens"), BYTES)
    assert empty.count() == files.read_token_files(empty, folder).count() == 0


def test_token_files_of_another_dictionary_are_refused(spark, edge, table):
    folder, other = new_folder(spark, "tokens"), new_folder(spark, "tokens")
    name = files.write_token_files(edge, folder, BYTES).first().file
    files.write_token_files(table([(1, "some other text")]), other, BYTES)
    store, root = files.store(other)
    with store.open_output_stream(f"{files.store(folder)[1]}/dictionary") as out, store.open_input_stream(f"{root}/dictionary") as source:
        out.write(source.read())
    with pytest.raises(ValueError, match="dictionary"):
        files.TokenFile(folder, name)


def test_special_strings_follow_the_library():
    assert Encoder(BYTES).encode(["a <|endoftext|> b"])[0].tolist() == [64, 220, 50256, 275]
    assert Encoder(WORDS).encode(["a <|endoftext|> b"])[0].tolist() == [320, 49407, 321]
    assert 50256 not in Encoder(BYTES, plain=True).encode(["a <|endoftext|> b"])[0]


def test_rows_without_an_id_fill_several_files(spark, table):
    rows = [(None, f"text {n} " * 40) for n in range(400)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = files.write_token_files(table(rows), new_folder(spark, "tokens"), BYTES)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert manifest.count() > 1 and max(r.n_docs for r in manifest.collect()) < 250


def check_plan(counts, capacity):
    slots, made = plan_slots(counts, capacity)
    seen = {n: [] for n in counts}
    bins = {}
    for length, a, b, per, first, offset in slots:
        seen[length].append((a, b))
        for i in range(b - a):
            bins.setdefault(first + i // per, []).append((offset + i % per * length, length))
    for n, c in counts.items():
        assert [x for a, b in sorted(seen[n]) for x in range(a, b)] == list(range(c))
    assert sorted(bins) == list(range(made))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return made


@pytest.mark.parametrize("seed", range(12))
def test_plans_are_whole_and_tight(seed):
    chance = random.Random(seed)
    capacity = chance.choice([7, 30, 100, 2048])
    counts = {chance.randint(1, capacity): chance.randint(1, 400) for _ in range(chance.randint(1, 60))}
    made = check_plan(counts, capacity)
    tokens = sum(n * c for n, c in counts.items())
    halves = sum(c for n, c in counts.items() if 2 * n > capacity)
    assert made <= 1.25 * max(tokens / capacity, halves) + 1


def test_plans_of_little():
    assert plan_slots({}) == ([], 0)
    assert check_plan({2048: 3}, 2048) == 3 and check_plan({1: 5000}, 2048) == 3 and check_plan({700: 4}, 2048) == 2


def test_packing(edge, none):
    theirs = library(WORDS)
    want = []
    for i, text in ROWS:
        ids = np.array(theirs(text) + [0], "<u4")
        want += [(i, n, at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes())) for n, at in enumerate(range(0, len(ids), 2048))]
    found = pack_documents(edge, WORDS, with_ids=True).collect()
    order = lambda rows: sorted(rows, key=str)
    assert order((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == order(want)
    assert all(len(r.ids) == 4 * r.length for r in found)
    places = {}
    for r in found:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in places.values():
        assert [o for o, _ in sorted(held)] == [sum(n for _, n in sorted(held)[:k]) for k in range(len(held))]
        assert sum(n for _, n in held) <= 2048
    assert pack_documents(none, WORDS).count() == 0


@pytest.mark.parametrize("block", [2, 14, 4096, 1 << 22])
def test_counts_are_found_over_any_blocks(spark, edge, block):
    folder = new_folder(spark, "flat")
    rows = edge.filter("length(text) < 1000 OR text IS NULL") if block < 100 else edge
    stored = counting.write_flat_files(rows, folder, WORDS)
    found = stored.join(counting.scan_flat_files(stored, folder, block_bytes=block), ["file", "ordinal"]).collect()
    theirs = library(WORDS, plain=True)
    want = [(i, len(theirs(t))) for i, t in ROWS if block >= 100 or len(t or "") < 1000]
    assert sorted(((r.doc_id, r.n_tokens) for r in found), key=str) == sorted(want, key=str)


def test_counts_of_nothing(spark, none):
    assert counting.token_counts(none, new_folder(spark, "flat"), WORDS).count() == 0


def test_counting_needs_no_index(spark, edge):
    folder = new_folder(spark, "flat")
    stored = counting.write_flat_files(edge, folder, WORDS)
    store, root = counting.store(folder)
    sizes = stored.select("file").distinct().withColumn("n", F.lit(0)).collect()
    total = sum(store.get_file_info(f"{root}/{r.file}").size for r in sizes)
    assert total == 2 * sum(len(library(WORDS, plain=True)(t)) + 1 for _, t in ROWS)
