"""Result comparison as jobs: the differences are a DataFrame, nothing is collected."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def row_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs: ``surplus`` > 0 on the left, < 0 on the right.

    One signed, map-side combined count replaces EXCEPT ALL in both directions; a row with very
    many copies is reduced to one record per task before the shuffle.
    """
    columns = left.columns
    signed = left.withColumn("_sign", F.lit(1)).unionByName(right.select(*columns).withColumn("_sign", F.lit(-1)))
    return signed.groupBy(*columns).agg(F.sum("_sign").alias("surplus")).filter(F.col("surplus") != 0)


def _comparable(column: str, kind: T.DataType) -> Column:
    """Maps as sorted entries, which can be ordered and compared."""
    cell = F.col(column)
    return F.sort_array(F.map_entries(cell)) if isinstance(kind, T.MapType) else cell


def _finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def _split_at_gaps(rows: DataFrame, group: list[str], numbers: list[str], rtol: float, atol: float) -> tuple[DataFrame, list[str]]:
    """Clusters such that rows which agree are always in one: neighbours in the order of a number part where they are further
    apart than any agreeing pair around them. Where several numbers are given, each splits what the others have split."""
    clusters: list[str] = []
    for name in numbers * (2 if len(numbers) > 1 else 1):
        order = Window.partitionBy(*group, *clusters).orderBy(name)
        x, before = F.col(name), F.lag(name).over(order)
        widest = (F.lit(atol) + F.lit(rtol) * F.greatest(F.abs(x), F.abs(before))) / (1 - rtol) * (1 + 1e-9)
        cluster = f"_cluster_{len(clusters)}"
        rows = rows.withColumn("_gap", F.coalesce((x - before > widest).cast("int"), F.lit(0)))
        rows = rows.withColumn(cluster, F.sum("_gap").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_gap")
        clusters.append(cluster)
    return rows, clusters


def keyed_diff(
    left: DataFrame, right: DataFrame, keys: Sequence[str], rtol: float = 1e-9, atol: float = 1e-6
) -> DataFrame:
    """Keys that do not agree -> (keys, problem).

    problem: ``only_left``, ``only_right``, ``copies`` (another number of rows) or ``values``. Two rows agree if each finite
    number x on the left has abs(x - y) <= atol + rtol * abs(y) (``rtol`` below 1) and all else is equal; NULL, NaN and
    the infinities agree with themselves only. A key's rows agree if they can be paired one to one. Columns may be of any type
    that can be ordered, and maps.

    Equal rows are counted before they travel. Rows are dealt by key *and* all exact columns and split into clusters at gaps
    wider than the tolerance. A cluster needs as many rows on the left as on the right; if its whole width is within the
    tolerance, nothing else is left to do. Otherwise it is a chain of rows each near the next. In a chain, running counts
    along each number say whether the n-th rows fit: at no point may there be more rows of the left than intervals of
    the right that have begun, nor fewer than those that have ended. With one number column this is exact. With several it is necessary
    for each of them, so that a chain that fits in each number but in no single pairing passes as agreeing.
    """
    kinds = {f.name: f.dataType for f in left.schema.fields}
    others = [c for c in left.columns if c not in keys]
    measured = [c for c in others if isinstance(kinds[c], (T.DoubleType, T.FloatType, T.DecimalType))]
    exact = [c for c in others if c not in measured]
    numbers = [f"_x_{i}" for i in range(len(measured))]

    def side(df: DataFrame, is_left: bool) -> DataFrame:
        values = [F.col(c).cast("double") for c in measured]
        return df.select(
            *keys,
            *[_comparable(c, kinds[c]).alias(f"_e_{i}") for i, c in enumerate(exact)],
            # what a number is apart from finite is compared exactly
            *[F.when(_finite(v), F.lit("finite")).otherwise(v.cast("string")).alias(f"_c_{i}") for i, v in enumerate(values)],
            *[F.when(_finite(v), v).alias(x) for x, v in zip(numbers, values, strict=True)],
            F.lit(is_left).alias("_left"),
        )

    both = side(left, True).unionByName(side(right, False))
    rows = both.groupBy(*both.columns).agg(F.count("*").alias("_n"))
    group = [c for c in both.columns if c not in (*numbers, "_left")]
    rows, clusters = _split_at_gaps(rows, group, numbers, rtol, atol)
    on_left, on_right = (F.when(F.col("_left") == side_, F.col("_n")).otherwise(F.lit(0)) for side_ in (True, False))
    cluster = Window.partitionBy(*group, *clusters)
    narrow = F.lit(True)
    for x in numbers:
        width = F.max(x).over(cluster) - F.min(x).over(cluster)
        least = F.min(F.when(~F.col("_left"), F.abs(F.col(x)))).over(cluster)
        narrow = narrow & F.coalesce(width <= F.lit(atol) + F.lit(rtol) * least, F.lit(True))
    rows = rows.withColumns({
        "_uneven": F.sum(F.when(F.col("_left"), F.col("_n")).otherwise(-F.col("_n"))).over(cluster) != 0,
        "_narrow": narrow,
    })

    def event(number: int, at: Column, left_: Column, begun: Column, ended: Column, first: bool = False) -> Column:
        none = F.lit(0).cast("bigint")
        cells = {"_number": F.lit(number), "_at": at.cast("double"), "_l": left_, "_begun": begun, "_ended": ended,
                 "_n_left": on_left if first else none, "_n_right": on_right if first else none}
        return F.struct(*[(v if k in ("_number", "_at") else v.cast("bigint")).alias(k) for k, v in cells.items()])

    none = F.lit(0)
    plain = event(-1, F.lit(None), none, none, none, first=True)
    along = [plain]
    for i, x in enumerate(numbers):
        reach = F.lit(atol) + F.lit(rtol) * F.abs(F.col(x))
        low = F.when(F.col("_left"), F.col(x)).otherwise(F.col(x) - reach)
        along += [event(i, low, on_left, on_right, none), event(i, F.col(x) + reach, none, none, on_right)]
    events = F.when(F.col("_narrow") | F.col("_uneven"), F.array(plain)).otherwise(F.array(*along))
    found = rows.select(*group, *clusters, "_uneven", F.inline(events))
    run = Window.partitionBy(*group, *clusters, "_number").orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    lefts, begun, ended = (F.sum(c).over(run) for c in ("_l", "_begun", "_ended"))
    found = found.withColumn("_misfit", F.col("_uneven") | (lefts > begun) | (ended > lefts))
    per_key = found.groupBy(*keys).agg(F.sum("_n_left").alias("_n_left"), F.sum("_n_right").alias("_n_right"), F.bool_or("_misfit").alias("_misfit"))
    problem = (
        F.when(F.col("_n_right") == 0, F.lit("only_left"))
        .when(F.col("_n_left") == 0, F.lit("only_right"))
        .when(F.col("_n_left") != F.col("_n_right"), F.lit("copies"))
        .when(F.col("_misfit"), F.lit("values"))
    )
    return per_key.select(*keys, problem.alias("problem")).filter(F.col("problem").isNotNull())
