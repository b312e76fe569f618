"""The order of the tokens in the n-gram join."""
import numpy as np

from orestrata.llm import ngram_join


def test_counts_do_not_depend_on_how_documents_are_dealt(copies, table):
    docs = table([(i, f"{t} only here {i}") for i, t in copies])
    found = [ngram_join.frequent_tokens(ngram_join.described(docs.repartition(n, "doc_id"))) for n in (1, 60)]
    assert np.array_equal(*found) and found[0].sum() == sum(len(s) for s in ngram_join.shingle_sets([r.text for r in docs.collect()]))


def test_members_are_compared_only_where_their_tokens_hit(spark):
    # class 1 has 40 tokens of which one is in each of 30 other groups: a row for each, not one for each token and group
    asks = [(t, 1, 70, t % 18, 1) for t in range(40)] + [(t, 100 + t, 70, 3, 100 + t) for t in range(30)]
    df = spark.createDataFrame(asks, "token LONG, key LONG, n INT, at INT, grp LONG")
    hits = ngram_join.hits_of(df, ngram_join.meetings(df))
    assert hits.filter("u = 1").count() <= 30 and hits.count() <= 60
    pairs = {tuple(r) for r in ngram_join.opened(hits, df).collect()}
    fits = lambda i, n, j, m: m <= n and 7 * j <= m and 7 * i <= 4 * n - 3 * m and 7 * j <= 4 * m - 3 * n
    brute = {(min(a[1], b[1]), max(a[1], b[1])) for a in asks for b in asks if a[0] == b[0] and a[4] != b[4] and fits(a[3], a[2], b[3], b[2])}
    assert pairs == brute
