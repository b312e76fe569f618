"""Small tables with everything that documents may hold."""
import random

import pytest

from llm_rows import ROWS

SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"
#: Columns whose names the operators use themselves.
CLASHING = ("size", "shard", "slot", "keep", "kept", "key", "row", "run", "part", "at", "n", "length", "range", "border",
            "_id", "_copies", "_gone", "_row", "target", "taken", "position", "tokens", "votes", "score")
@pytest.fixture(scope="session")
def table(spark, tmp_path_factory):
    """(doc_id, text) rows as a documents table of several files, with clashing columns."""
    made = []

    def make(rows, sources=("a", "b", None)):
        folder = tmp_path_factory.mktemp("docs") / f"t{len(made)}"
        made.append(folder)
        full = [(i, t, "en", sources[n % len(sources)], len(t or "")) for n, (i, t) in enumerate(rows)]
        df = spark.createDataFrame(full, SCHEMA).repartition(3, "n_chars") if full else spark.createDataFrame([], SCHEMA)
        df.selectExpr("*", *[f"'x' AS `{c}`" for c in CLASHING]).write.parquet(str(folder))
        return spark.read.parquet(str(folder))

    return make


@pytest.fixture(scope="session")
def edge(table):
    return table(ROWS)


@pytest.fixture(scope="session")
def none(table):
    return table([])


@pytest.fixture(scope="session")
def copies():
    """Random texts with exact and near copies in large groups."""
    chance = random.Random(7)
    words = [f"word{i}" for i in range(3000)]
    base = [[chance.choice(words) for _ in range(chance.randint(3, 160))] for _ in range(60)]
    passage = [chance.choice(words) for _ in range(60)]
    rows = []
    for n in range(420):
        kind = n % 7
        own = list(base[0] if kind < 3 else chance.choice(base))
        if kind in (1, 2, 4):
            for _ in range(chance.randint(0, 1 + len(own) // 40)):
                own[chance.randrange(len(own))] = chance.choice(words)
        if kind == 5:
            own = own[: chance.randint(0, 40)] + passage
        text = " ".join(own)
        rows.append((n, text.upper() if kind == 0 else text))
    return rows
