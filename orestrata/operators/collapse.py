"""Collapse of overlapping records to one row per business key, with conflicts left visible."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Different values of all evidence columns together that are kept as bits; beyond it evidence is kept as sets.
DICTIONARY = 256
_CODED = {"string", "boolean", "tinyint", "smallint", "int", "bigint", "date"}


def evidence_dictionary(df: DataFrame, columns: Sequence[str], limit: int = DICTIONARY) -> dict[str, list] | None:
    """Column -> its different values without NULL, by one column-pruned job; None where there are more than ``limit`` of all
    columns together or a type whose values have several spellings. What comes to the driver is bounded by ``limit``."""
    kinds = dict(df.dtypes)
    if any(kinds[c] not in _CODED for c in columns):
        return None
    names = list(dict.fromkeys(columns))
    entry = [
        F.struct(F.lit(n).alias("_n"), *[(F.col(c) if c == own else F.lit(None).cast(kinds[c])).alias(f"_{i}") for i, c in enumerate(names)])
        for n, own in enumerate(names)
    ]
    found = df.select(F.inline(F.array(*entry))).distinct().limit(limit + len(names) + 1).collect()
    values: dict[str, list] = {c: [] for c in names}
    for row in found:
        if row[1 + row["_n"]] is not None:
            values[names[row["_n"]]].append(row[1 + row["_n"]])
    return values if sum(map(len, values.values())) <= limit else None


def _words(column: str, dictionary: Column, size: int) -> list[Column]:
    """Bit n of word w is set where the column holds the dictionary's entry 64 w + n."""
    code = F.array_position(dictionary, F.col(column)).cast("int") - 1
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), code.bitwiseAND(63))
    return [F.when((code >= 64 * w) & (code < 64 * w + 64), bit) for w in range((size + 63) // 64)]


def _named(words: list[str], dictionary: Column, kind: str) -> Column:
    """The dictionary's entries whose bits are set, in its order."""
    if not words:
        return F.array().cast(f"array<{kind}>")
    held = F.array(*[F.coalesce(F.col(w), F.lit(0)) for w in words])
    is_set = lambda _, i: F.call_function("shiftright", F.get(held, F.shiftright(i, 6)), i.bitwiseAND(63)).bitwiseAND(F.lit(1)) == 1
    return F.filter(dictionary, is_set)


def collapse_overlaps(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    evidence: Mapping[str, str] | None = None,
    versions: str = "value_versions",
    null_is_version: bool = True,
    values_from: DataFrame | None = None,
) -> DataFrame:
    """Per key: the largest value, the number of different values, and sorted sets of evidence.

    Versions are counted on the typed value, so 1.0 and 1.00 agree; with ``null_is_version`` a NULL
    beside a number is a conflict.

    Evidence of few different values (``DICTIONARY``) is dictionary-coded: a key's set is a few words of bits, combined by
    ``bit_or`` in fixed buffers. Everything is then one hash aggregation with one distinct count, which Spark deals by key
    and value first, so that a hot key is folded per task, spread over all reducers, and combined again before its rows meet. The
    dictionary is looked up by one job over the evidence columns of ``values_from``, which has the rows of ``df`` and perhaps more
    (rows from before a filter are cheaper to read), or of ``df``. Wide evidence is kept as sets, with the same result.
    """
    evidence = dict(evidence or {})
    values = evidence_dictionary(values_from or df, list(evidence.values())) if evidence else {}
    if values is None:
        return _collapse_with_sets(df, keys, value, evidence, versions, null_is_version)
    kinds = dict(df.dtypes)
    dictionaries = {
        c: F.sort_array(F.array(*[F.lit(v).cast(kinds[c]) for v in values[c]]).cast(f"array<{kinds[c]}>"))
        for c in set(evidence.values())
    }
    words = {name: _words(c, dictionaries[c], len(values[c])) for name, c in evidence.items()}
    named = {name: [f"_{i}_{w}" for w in range(len(words[name]))] for i, name in enumerate(evidence)}
    rows = df.select(*keys, value, *[w.alias(n) for name in evidence for w, n in zip(words[name], named[name], strict=True)])
    different = F.count_distinct(F.col(value))
    if null_is_version:
        different = different + F.max(F.col(value).isNull().cast("int"))
    return rows.groupBy(*keys).agg(
        F.max(value).alias(value),
        different.alias(versions),
        *[F.bit_or(n).alias(n) for name in evidence for n in named[name]],
    ).select(
        *keys, value, versions, *[_named(named[name], dictionaries[c], kinds[c]).alias(name) for name, c in evidence.items()]
    )


def _collapse_with_sets(
    df: DataFrame, keys: Sequence[str], value: str, evidence: Mapping[str, str], versions: str, null_is_version: bool
) -> DataFrame:
    """``df`` is read once. Distinct (key, value, evidence) rows are made first, by hash aggregation with map-side
    combining: the copies of a hot key are folded per task. They are dealt by key and value, so that a hot key's values are
    spread over all reducers; there the evidence of each value becomes a set, and only one row per value goes on to its
    key. Versions are a plain count of those rows, so no buffer ever holds a key's values; what a key's evidence
    set holds is its different sets of evidence, which the result has to name anyway.
    """
    version = F.lit(1) if null_is_version else F.when(F.col(value).isNotNull(), F.lit(1))
    names = list(evidence)
    rows = df.select(*keys, value, *[F.col(source).alias(name) for name, source in evidence.items()]).distinct()
    by_value = rows.groupBy(*keys, value).agg(
        F.first(version).alias("_version"), *[F.collect_set(name).alias(name) for name in names]
    )
    return by_value.groupBy(*keys).agg(
        F.max(value).alias(value),
        F.count("_version").alias(versions),
        *[F.sort_array(F.array_distinct(F.flatten(F.collect_set(F.sort_array(name))))).alias(name) for name in names],
    )


def collapse_lookups(df: DataFrame, keys: Sequence[str], label: str, versions: str = "label_versions") -> DataFrame:
    """Per code: the largest label and the number of label variants (an absent label is a variant)."""
    return (
        df.select(*keys, label)
        .distinct()
        .groupBy(*keys)
        .agg(F.max(label).alias(label), F.count(F.lit(1)).alias(versions))
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str], count: str = "copies") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).filter(F.col(count) > 1)


def universe(key: str, *frames: DataFrame) -> DataFrame:
    """Distinct keys of all frames together."""
    out = frames[0].select(key)
    for frame in frames[1:]:
        out = out.unionByName(frame.select(key))
    return out.distinct()
