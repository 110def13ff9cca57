"""Ordered prefix sums per group, without ever sorting a whole group in one task.

Most statistics here (rank AUC, precision-recall area, two-sample distances, exact quantiles) need,
for every distinct value of a group, the total weight of all smaller values.  A window ordered over
the group would put one hot group into one task.  Instead:

1. rows collapse to one row per (group, value) with summed integer weights (map-side combine);
2. values are cut into ordered buckets by splitters that depend only on exact counts, so a recomputed
   task always lands in the same bucket;
3. the running sum runs inside one bucket, and the totals of the earlier buckets, a table of a few
   rows per group, are added by a join.

Splitters are found level by level on an order-preserving 64-bit integer of the double (its bits).  A cell
is a sign and half a power of two; a cell with more values than a bucket may hold is cut into children
by the next bits, children next to each other are joined into buckets, and children that are overfull
themselves are counted again by their next bits, down to children that cannot be.  So no bucket holds more than
``bucket_values`` distinct values, wherever they crowd.  Levels that are not needed are empty tables, which
adaptive execution takes out of the plan.

What is sent around is a splitter for each ``bucket_values / 2`` distinct values at most (in arrays by cell), and only for
overfull cells; rows find their bucket by bisection.  The table of buckets is of that size, too, and how it is joined is left to Spark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A bucket holds at most this many distinct values.
BUCKET_VALUES = 250_000
# Bits of the ordered integer below a power of two, and below the children of each level.
_MANTISSA_BITS = 52
_LEVEL_BITS = (42, 16)
_CELL_SHIFT = 10_000


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join that also matches NULL keys; right-hand key columns are dropped."""
    if not keys:
        return left.crossJoin(right)
    renamed = right.select(
        *[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in set(keys)]
    )
    condition = None
    for k in keys:
        test = left[k].eqNullSafe(renamed[f"__r_{k}"])
        condition = test if condition is None else condition & test
    return left.join(renamed, condition, how).drop(*[f"__r_{k}" for k in keys])


# Order-preserving coarse cell: sign and half power of two.  Infinities have end cells of their own.
_CELL = f"""coalesce(bigint(CASE WHEN value = 0 THEN 0 WHEN abs(value) = double('Infinity') THEN sign(value) * {3 * _CELL_SHIFT}
    ELSE sign(value) * (floor(log2(abs(value)) * 2) + {_CELL_SHIFT}) END), 0L)"""

# The bits of a double as an integer of its magnitude with its sign.  A logarithm may be off by one beside a
# power of two; the quotient, which is exact, tells.  Written as text: a few expressions to parse, not some hundred calls.
_EXPONENT = "__e + CASE WHEN __q >= 2 THEN 1 WHEN __q < 1 THEN -1 ELSE 0 END"
_MANTISSA = "CASE WHEN __q >= 2 THEN __q / 2 WHEN __q < 1 THEN __q * 2 ELSE __q END"
_BITS = f"""CASE WHEN value < 0 THEN -1L ELSE 1L END * CASE WHEN abs(value) = double('Infinity') THEN {2047 << _MANTISSA_BITS}L
    WHEN abs(value) >= power(2.0D, -1022) THEN ({_EXPONENT} + 1023) * {1 << _MANTISSA_BITS}L + bigint(({_MANTISSA} - 1) * {1 << _MANTISSA_BITS}L)
    WHEN abs(value) > 0 THEN bigint(abs(value) * power(2.0D, 537) * power(2.0D, 537)) ELSE 0L END"""


def with_bits(rows: DataFrame) -> DataFrame:
    """``rows`` plus ``__bits``: a 64-bit integer in the order of ``value`` (double, neither NULL nor NaN).

    Declared as never NULL, as what is made of it joins: a join's test for NULL would go down to the scan, compute the bits of every
    raw row there and keep the branches of the plan from sharing one shuffle.
    """
    guessed = rows.selectExpr("*", "least(floor(log2(abs(value))), 1023) AS __e").selectExpr("*", "abs(value) / power(2.0D, __e) AS __q")
    return guessed.selectExpr(*rows.columns, f"coalesce({_BITS}, 0L) AS __bits")


def _splitters(rows: DataFrame, key: list[str], bucket_values: int) -> DataFrame:
    """(key, __starts): ascending first integers of the buckets of each overfull cell; ``rows`` has ``key`` (with the cell) and ``value``.

    Children up to half a bucket are joined until they pass a multiple of that half, so that a bucket stays below the whole; larger
    ones are open and cut at the next level.  A child of the last level cannot be larger than half a bucket.
    """
    half = max(bucket_values // 2, 1)
    levels = [b for b in _LEVEL_BITS if (1 << b) > half]
    levels.append(max((b for b in _LEVEL_BITS if (1 << b) <= half), default=0))
    # At most one open cell or child for each half bucket of distinct values.
    opened = rows.groupBy(*key).agg(F.count("*").alias("__n")).where(f"__n > {bucket_values}").drop("__n")
    found, on, by = None, key, ", ".join(key)
    for bits in levels:
        inside = with_bits(rows).selectExpr(*key, "__bits", *([f"shiftright(__bits, {above}) AS __opened"] if on != key else []))
        narrowed = inside.join(F.broadcast(opened), on, "left_semi")
        children = narrowed.selectExpr(*on, f"shiftright(__bits, {bits}) AS __child").groupBy(*on, "__child").agg(F.count("*").alias("__n"))
        ordered = f"(PARTITION BY {by} ORDER BY __child"
        split = children.selectExpr(
            *on,
            "__child",
            f"__n > {half} AS __open",
            f"floor(coalesce(sum(__n) OVER {ordered} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / {half}) AS __number",
        )
        starts = split.selectExpr(
            *key,
            f"shiftleft(__child, {bits}) AS __start",
            "__child AS __opened",
            "__open",
            f"__open OR coalesce(lag(__open) OVER {ordered}) OR lag(__number) OVER {ordered}) != __number, true) AS __first",
        )
        mine = starts.where("__first").select(*key, "__start")
        found = mine if found is None else found.unionByName(mine)
        opened, above = starts.where("__open").select(*key, "__opened"), bits
        on, by = [*key, "__opened"], ", ".join([*key, "__opened"])
    # Where an open child was cut, its start is there twice.
    return found.groupBy(*key).agg(F.expr("array_sort(collect_set(__start))").alias("__starts"))


# The last of ``__starts`` that is not above ``__bits``, by bisection; zero in a cell that is one bucket.  Never NULL, as it is joined.
_START = """CASE WHEN __starts IS NULL THEN 0L ELSE coalesce(aggregate(
    sequence(0, int(ceil(log2(size(__starts) + 1)))), struct(0 AS lo, size(__starts) AS hi),
    (s, step) -> CASE WHEN get(__starts, shiftright(s.lo + s.hi, 1)) <= __bits THEN struct(shiftright(s.lo + s.hi, 1) AS lo, s.hi AS hi)
                      ELSE struct(s.lo AS lo, shiftright(s.lo + s.hi, 1) AS hi) END,
    s -> get(__starts, s.lo)), 0L) END"""
_BUCKET = ["__cell", "__start"]


def bucketed(rows: DataFrame, key: Sequence[str], bucket_values: int = BUCKET_VALUES) -> DataFrame:
    """``rows`` (key, ``value``, others) plus ``__cell`` and ``__start``, which together name a bucket and order buckets as the values are.

    Rows of a key and bucket hold at most ``bucket_values`` values if values are distinct.  Where no cell is overfull, only the cell is computed.
    """
    placed = rows.selectExpr("*", f"{_CELL} AS __cell")
    key = [*key, "__cell"]
    cells = _splitters(placed.select(*key, "value"), key, bucket_values)
    return with_bits(placed.join(F.broadcast(cells), key, "left")).selectExpr(*placed.columns, f"{_START} AS __start")


def collapse(
    df: DataFrame, groups: Sequence[str], value: str, weights: dict[str, Column]
) -> DataFrame:
    """One row per (group, value); every weight is an integer total.  NULL and NaN values drop."""
    v = F.col(value).cast("double")
    return (
        df.where(v.isNotNull() & ~F.isnan(v))
        .groupBy(*groups, v.alias("value"))
        .agg(*[F.sum(w.cast("long")).alias(n) for n, w in weights.items()])
    )


def ordered_prefix(
    collapsed: DataFrame,
    groups: Sequence[str],
    weights: Sequence[str],
    bucket_values: int = BUCKET_VALUES,
    sums: Sequence[str] = (),
    latest: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Add to every collapsed row ``<w>_below``, ``<w>_total``, ``next_value`` and ``min_value``.

    ``<w>_below`` is the weight of strictly smaller values, ``next_value`` the next larger distinct
    value of the group (NULL for the largest).  Values that carry no weight are left out.  Columns in ``sums``
    (any numbers) get the same sums; those in ``latest``, which never fall as values rise and may be NULL, get ``<c>_latest``, the last one up to
    and with the row; those in ``keep`` are passed on.
    """
    groups = list(groups)
    # One struct key: NULL group values match each other and the joins below stay plain equalities,
    # so they reuse the partitioning of the windows.
    key = ["__g"] if groups else []
    added = [*weights, *sums]
    weight = sum((F.col(w) for w in weights), F.lit(0))
    chosen = ["value", *added, *latest, *keep]
    rows = collapsed.where(weight > 0).select(*([F.struct(*groups).alias("__g")] if groups else []), *chosen)
    split = bucketed(rows, key, bucket_values)
    bucket = _BUCKET
    in_group = Window.partitionBy(*key).orderBy(*bucket)
    before = in_group.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*key)
    totals = split.groupBy(*key, *bucket).agg(
        *[F.sum(w).alias(f"__t_{w}") for w in added], *[F.max(c).alias(f"__m_{c}") for c in latest], F.min("value").alias("__first")
    )
    offsets = totals.select(
        *key,
        *bucket,
        *[F.coalesce(F.sum(f"__t_{w}").over(before), F.lit(0)).alias(f"__o_{w}") for w in added],
        *[F.sum(f"__t_{w}").over(whole).alias(f"{w}_total") for w in added],
        *[F.max(f"__m_{c}").over(before).alias(f"__b_{c}") for c in latest],
        F.lead("__first").over(in_group).alias("__next_first"),
        F.min("__first").over(whole).alias("min_value"),
    )

    in_bucket = Window.partitionBy(*key, *bucket).orderBy("value")
    running = in_bucket.rowsBetween(Window.unboundedPreceding, -1)
    # Spread by the full bucket key: by the group alone, a hot group would be one task.
    local = split.repartition(*key, *bucket).select(
        *key,
        *bucket,
        *chosen,
        *[F.coalesce(F.sum(w).over(running), F.lit(0)).alias(f"__l_{w}") for w in added],
        *[F.max(c).over(in_bucket.rowsBetween(Window.unboundedPreceding, 0)).alias(f"__u_{c}") for c in latest],
        F.lead("value").over(in_bucket).alias("__next_local"),
    )
    return local.join(offsets, [*key, *bucket]).select(
        *[F.col(f"__g.{g}").alias(g) for g in groups],
        *chosen,
        *[(F.col(f"__l_{w}") + F.col(f"__o_{w}")).alias(f"{w}_below") for w in added],
        *[F.col(f"{w}_total") for w in added],
        *[F.greatest(f"__u_{c}", f"__b_{c}").alias(f"{c}_latest") for c in latest],
        F.coalesce("__next_local", "__next_first").alias("next_value"),
        "min_value",
    )


def weighted_quantiles(
    collapsed: DataFrame,
    groups: Sequence[str],
    weight: str,
    probabilities: Sequence[float],
) -> DataFrame:
    """Exact quantiles with linear interpolation: one row per group, array ``quantiles``.

    ``collapsed`` holds one row per (group, value) with an integer ``weight``.  Order statistics are
    read off the prefix counts, so no reducer holds a whole group.
    """
    groups = list(groups)
    pre = ordered_prefix(collapsed, groups, [weight])
    below, total = F.col(f"{weight}_below"), F.col(f"{weight}_total")
    upto = below + F.col(weight)
    wanted = F.array(
        *[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(probabilities)]
    )
    hits = F.filter(
        wanted,
        lambda q: (F.floor((total - 1) * q["p"]) >= below) & (F.floor((total - 1) * q["p"]) < upto),
    )
    # The cheap test first: almost no row holds a wanted rank, and only those build arrays.
    any_hit = F.lit(False)
    for p in probabilities:
        place = F.floor((total - 1) * float(p))
        any_hit = any_hit | ((place >= below) & (place < upto))
    picked = pre.where(any_hit).select(
        *groups, "value", "next_value", total.alias("__total"), upto.alias("__upto"), F.explode(hits).alias("q")
    )
    rank = (F.col("__total") - 1) * F.col("q.p")
    low = F.floor(rank)
    above = F.when(low + 1 < F.col("__upto"), F.col("value")).otherwise(F.coalesce("next_value", "value"))
    # Without the test, neighbours that are both infinite would give NaN.
    estimate = F.when((rank == low) | (above == F.col("value")), F.col("value")).otherwise(F.col("value") + (rank - low) * (above - F.col("value")))
    ordered = F.array_sort(F.collect_list(F.struct(F.col("q.i").alias("i"), estimate.alias("v"))))
    return picked.groupBy(*groups).agg(F.transform(ordered, lambda s: s["v"]).alias("quantiles"))


def exact_quantiles(
    df: DataFrame, groups: Sequence[str], value: str, probabilities: Sequence[float]
) -> DataFrame:
    """Exact quantiles of a row-level column, see :func:`weighted_quantiles`."""
    counted = collapse(df, groups, value, {"n": F.lit(1)})
    return weighted_quantiles(counted, groups, "n", probabilities)
