"""Documents read in splits against the standard parser and the reader of whole documents."""
import json
import random

import pytest

from orestrata.sources.contracts import PageContract
from orestrata.sources.json_pages import exploded_pages, page_documents
from orestrata.sources.page_splits import split_pages

PAGE = PageContract("t", r".*", ("Key",), (("key", ("Key",)), ("text", ("Text", "text"))), (("text", ""),))
SPLITS = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
NASTY = ["}", "{", "[", "]", '"', "\\", ",", "a", "é", "😀", "\n", " ", "}{", '"}', '\\"', '"data":[{', ""]


@pytest.fixture
def split_at(spark):
    before = {name: spark.conf.get(name) for name in SPLITS}

    def cut(n_bytes):
        spark.conf.set(SPLITS[0], n_bytes)
        spark.conf.set(SPLITS[1], 1)

    yield cut
    for name, value in before.items():
        spark.conf.set(name, value)


def some_text(dice):
    return "".join(dice.choices(NASTY, k=dice.randint(0, 6)))


def some_value(dice, depth=0):
    kind = dice.randint(0, 7 if depth < 3 else 4)
    if kind < 3:
        return some_text(dice)
    if kind == 3:
        return dice.choice([None, True, 12, -3.5])
    if kind == 4:
        return []
    if kind == 5:
        return [some_value(dice, depth + 1) for _ in range(dice.randint(0, 3))]
    return {some_text(dice) or "k": some_value(dice, depth + 1) for _ in range(dice.randint(0, 3))}


def some_document(dice):
    rows = [{"Key": some_text(dice), "Text": some_text(dice)} for _ in range(dice.randint(1, 12))]
    for row in rows:
        for name in dice.sample(["p", "q", "r"], dice.randint(0, 2)):
            row[name] = some_value(dice)
    around = [("data", rows), ("page", {"total": len(rows), "offset": 0, "more": some_value(dice)})]
    around += [("note", some_text(dice)), ("source", [{"a": some_value(dice)} for _ in range(dice.randint(0, 3))]), ("facts", {"data": [{"Key": "no"}]})]
    dice.shuffle(around)
    return dict(around)


def read_back(spark, folder):
    found = {}
    for r in split_pages(spark, str(folder), PAGE).collect():
        found.setdefault(r["path"].rsplit("/", 1)[1], []).append((r["row_number"], r["fields"], r["problem"]))
    return {name: sorted(rows, key=lambda r: r[0] or 0) for name, rows in found.items()}


@pytest.mark.parametrize("n_bytes", [47, 1000, 1 << 20])
def test_random_documents_are_the_same_under_all_split_sizes(spark, tmp_path, split_at, n_bytes):
    dice = random.Random(n_bytes)
    wanted = {}
    for i in range(2 if n_bytes < 50 else 60):
        document = some_document(dice)
        text = json.dumps(document, ensure_ascii=dice.random() < 0.5, indent=dice.choice([None, None, 1]))
        text = dice.choice(["", "\n", " \n"]) + text + dice.choice(["", "\n", "\r\n \n"])
        (tmp_path / f"d{i}.json").write_bytes(text.encode())
        wanted[f"d{i}.json"] = [
            (n, {"key": row["Key"], "text": row["Text"]}, None) for n, row in enumerate(document["data"], 1)
        ]
    split_at(n_bytes)
    assert read_back(spark, tmp_path) == wanted


def test_rows_are_those_of_whole_documents(spark, tmp_path, split_at):
    dice = random.Random(5)
    for i in range(20):
        (tmp_path / f"d{i}.json").write_text(json.dumps(some_document(dice)))
    columns = ["path", "row_number", "fields", "problem"]
    whole = exploded_pages(page_documents(spark, str(tmp_path)), PAGE, ("path",)).select(*columns).collect()
    split_at(700)
    parts = split_pages(spark, str(tmp_path), PAGE).select(*columns).collect()
    assert sorted(map(repr, whole)) == sorted(map(repr, parts))


FAULTS = {
    "cut.json": ('{"data": [{"Key": 1}, {"Key": 2', "broken JSON"),
    "unclosed.json": ('{"data": [{"Key": 1}]', "broken JSON"),
    "open.json": ('{"data": [{"Key": "1}]}', "broken JSON"),
    "twice.json": ('{"data": [{"Key": 1}]}{"data": [{"Key": 2}]}', "broken JSON"),
    "behind.json": ('{"data": [{"Key": 1}]} x', "broken JSON"),
    "comma.json": ('{"data": [{"Key": 1}{"Key": 2}]}', "broken JSON"),
    "trailing.json": ('{"data": [{"Key": 1},]}', "broken JSON"),
    "word.json": ('{"data": [{"Key": 1}, {Key 2}]}', "broken JSON"),
    "bracket.json": ('{"data": [{"Key": 1}], "x": [1}', "broken JSON"),
    "list.json": ('[{"data": [{"Key": 1}]}]', "broken JSON"),
    "empty.json": ('{"data": []}', "no data"),
    "other.json": ('{"rows": [{"Key": 1}]}', "no data"),
    "null.json": ('{"data": null}', "no data"),
    "lacking.json": ('{"data": [{"Key": 1}, {"key": 2}]}', "missing keys"),
    "bare.json": ('{"data": [null]}', "missing keys"),
    "part.json": ('{"page": {"total": 3}, "data": [{"Key": 1}]}', "partial page"),
    "later.json": ('{"data": [{"Key": 1}], "page": {"offset": 5}}', "partial page"),
}


@pytest.mark.parametrize("n_bytes", [29, 1 << 20])
def test_each_fault_has_a_name_and_sound_documents_stay(spark, tmp_path, split_at, n_bytes):
    for name, (text, _) in FAULTS.items():
        (tmp_path / name).write_text(text)
    (tmp_path / "sound.json").write_bytes(b'\xef\xbb\xbf{"data": [{"Key": 1, "x": {"y": {}}}]}')
    split_at(n_bytes)
    found = read_back(spark, tmp_path)
    assert found.pop("sound.json") == [(1, {"key": "1", "text": ""}, None)]
    assert found == {name: [(None, None, problem)] for name, (_, problem) in FAULTS.items()}
