"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is wanted ``target / source size`` times. The whole part is taken; the fractional
parts are rounded in pairs: mass (fraction times size) moves at random from one to the other until one fraction
is 0 or 1, so the sum of taken sizes stays exactly where it was and each document keeps its expectation. A source is
cut into blocks of bounded size; every block leaves at most one fraction, the left-over fractions of
``FAN_IN`` blocks are rounded against each other, and so on up a tree to one per source, which is
drawn. What a source misses is less than one document. Large documents come first: each meets many smaller ones
until it is settled, so that the one left over is small.

Random draws are hashes of rows and block numbers, and blocks are read in a fixed order: reruns and retries agree.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType
from pyspark.sql.window import Window

from tidewatch.llm.common import ASIDE, attach, cut_lineage

WEIGHTS = (5, 2, 1)
SHARE, CEILING = 1.5, 2.0
BLOCK_ROWS = 2_000
FAN_IN = 256


def source_targets(rows: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, ceiling: float = CEILING) -> DataFrame:
    """``source, n, source_size, target`` from rows of ``source, size``.

    Sources by code point, NULL last, weigh ``weights`` in turn. ``share`` of all sizes is dealt by weight; no
    source gets more than ``ceiling`` times its size, and the excess goes to the others by weight. The sources that
    stop are those with the least room for their weight, so one ordered pass over the table of sources finds the level.
    """
    sources = rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    # Windows over one row per source, not per document.
    placed = sources.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.array(*[F.lit(float(w)) for w in weights])[(F.col("place") % len(weights)).cast("int")]
    by_room = Window.orderBy("room", "place")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_room.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    levels = (
        placed.withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * F.lit(float(ceiling)))
        .withColumn("room", F.col("most") / F.col("weight"))
        .withColumn("level", level)
        # The first source with room for the level ends the filling; if none has, all stop.
        .withColumn("level", F.first(F.when(F.col("room") >= F.col("level"), F.col("level")), True).over(everything))
    )
    target = F.least(F.col("most"), F.coalesce(F.col("level") * F.col("weight"), F.col("most")))
    return levels.select("source", "n", "source_size", target.alias("target"))


def _draw(*of: Column) -> Column:
    """Uniform in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*of), 11).cast("double") * F.lit(2.0**-53)


def _pivot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One pass over rows ordered by ``__group``: sets ``__up`` to 0 or 1, or leaves one row a group with its ``__left``.

    A row whose fraction is still open is held back as a batch of one row; memory is one batch.
    """
    held: pa.RecordBatch | None = None
    group, f, s = None, 0.0, 0.0

    def told(batch: pa.RecordBatch, up: list, left: list) -> pa.RecordBatch:
        names = [n for n in batch.schema.names if n not in ("__frac", "__mass", "__draw")]
        batch = batch.select(names)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(up, pa.int32()), pa.array(left, pa.float64())], [*names, "__up", "__left"])

    for batch in batches:
        n = batch.num_rows
        groups, fracs, sizes, draws = (batch.column(x).to_pylist() for x in ("__group", "__frac", "__mass", "__draw"))
        up: list[int | None] = [None] * n
        left: list[float | None] = [None] * n
        at = -1  # where the open row is; -1: in ``held``
        for i in range(n):
            if groups[i] != group:
                if held is not None:
                    yield told(held, [None], [f])
                    held = None
                elif group is not None and at >= 0:
                    left[at] = f
                group, at, f = groups[i], i, None
            g, t, u = fracs[i], sizes[i], draws[i]
            if t <= 0.0 or g <= 0.0 or g >= 1.0:  # nothing to move
                up[i] = int(u < g) if t <= 0.0 else int(g >= 1.0)
                if f is None:
                    at = -1
                continue
            if f is None:
                at, f, s = i, g, t
                continue
            to_open, to_new = min((1.0 - f) * s, g * t), min(f * s, (1.0 - g) * t)
            if u * (to_open + to_new) < to_new:
                full, f2, g2 = (1.0 - f) * s <= g * t, f + to_open / s, g - to_open / t
                open_done, value = full, 1
            else:
                open_done, f2, g2 = f * s <= (1.0 - g) * t, f - to_new / s, g + to_new / t
                value = 0
            if open_done:  # the open row is settled, the new one is open
                if held is not None:
                    yield told(held, [value], [None])
                    held = None
                else:
                    up[at] = value
                at, f, s = i, g2, t
            else:
                up[i] = 1 - value
                f = f2
            if f <= 0.0 or f >= 1.0:  # both settled at once
                if held is not None:
                    yield told(held, [int(f >= 1.0)], [None])
                    held = None
                else:
                    up[at] = int(f >= 1.0)
                at, f = -1, None
        if f is not None and at >= 0:
            if n > 1:
                rest = [i for i in range(n) if i != at]
                yield told(batch.take(pa.array(rest)), [up[i] for i in rest], [left[i] for i in rest])
            held = batch.slice(at, 1)
        elif n:
            yield told(batch, up, left)
    if held is not None:
        yield told(held, [None], [f])


def _rounded(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """``rows`` with ``__up`` (0 or 1) or, for one row per ``keys`` at most, NULL and the fraction ``__left``."""
    dealt = rows.withColumn("__group", F.to_json(F.struct(*keys))).repartition("__group").sortWithinPartitions("__group", *order)
    kept = [f for f in dealt.schema.fields if f.name not in ("__frac", "__mass", "__draw")]
    schema = StructType([*kept, StructField("__up", IntegerType()), StructField("__left", DoubleType())])
    return dealt.mapInArrow(_pivot, schema).drop("__group")


def copies(docs: DataFrame, size: Column, order: Sequence[Column], weights: Sequence[float] = WEIGHTS, share: float = SHARE,
           ceiling: float = CEILING, seed: int = 7) -> DataFrame:
    """``docs`` (with ``source``) plus ``mix_size``, ``mix_source_size``, ``mix_target`` and ``mix_copies``.

    ``order`` makes rows distinct for draws and order; equal rows are interchangeable. NULL is a source like
    any other. A document of size 0 weighs nothing and is drawn by itself; a source of size 0 is not taken.
    An empty table gives an empty result. Columns of ``docs`` with other names are kept, whatever their names.
    """
    results = {"mix_size": "long", "mix_source_size": "long", "mix_target": "double", "mix_copies": "int"}
    kept = [c for c in docs.columns if c not in results]
    if docs.isEmpty():
        return docs.select(*[F.col(f"`{c}`") for c in kept], *[F.lit(None).cast(t).alias(n) for n, t in results.items()])
    carried = F.struct(*[F.col(f"`{c}`") for c in kept]).alias(ASIDE)
    sized = docs.select(carried, "source", size.alias("mix_size"), *[o.alias(f"__o{i}") for i, o in enumerate(order)])
    order = [F.col(f"__o{i}") for i in range(len(order))]
    targets = cut_lineage(source_targets(sized.select("source", F.col("mix_size").alias("size")), weights, share, ceiling), "targets")
    wanted = F.when(F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size")).otherwise(F.lit(0.0))
    named = targets.select("source", F.col("n").alias("__n"), F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"))
    rows = (
        attach(sized.withColumn("__id", F.xxhash64(*order, F.lit(seed))), named, ["source"], F.col("__id"))
        .withColumn("__whole", F.floor(wanted).cast("int"))
        .withColumn("__frac", wanted - F.floor(wanted))
        .withColumn("__mass", F.col("mix_size").cast("double"))
        .withColumn("__draw", _draw(F.col("__id"), F.lit(1)))
        .withColumn("__block", F.pmod(F.xxhash64("__id", F.lit(2)), F.ceil(F.col("__n") / BLOCK_ROWS)).cast("long"))
        .drop("__n")
    )
    leaves = cut_lineage(_rounded(rows, ["source", "__block"], [F.col("__mass").desc(), F.col("__id"), *order]), "mix-leaves")
    open_rows = leaves.where("__left IS NOT NULL").select(
        "source", F.col("__block").alias("leaf"), F.col("__block").alias("node"), F.col("__left").alias("__frac"), F.col("mix_size").cast("double").alias("__mass")
    )
    settled: list[DataFrame] = []
    blocks = int(targets.agg(F.max("n")).first()[0] / BLOCK_ROWS) + 1
    level = 0
    while blocks > 1:
        level += 1
        blocks = -(-blocks // FAN_IN)
        up = open_rows.withColumn("node", F.floor(F.col("node") / FAN_IN)).withColumn("__draw", _draw(F.col("source"), F.col("leaf"), F.lit(seed + 10 * level)))
        done = cut_lineage(_rounded(up.withColumn("mass", F.col("__mass")), ["source", "node"], [F.col("__mass").desc(), F.col("leaf")]), "mix-level")
        settled.append(done.where("__up IS NOT NULL").select("source", "leaf", F.col("__up").alias("late")))
        open_rows = done.where("__left IS NOT NULL").select("source", "leaf", "node", F.col("__left").alias("__frac"), F.col("mass").alias("__mass"))
    last = open_rows.select("source", "leaf", (_draw(F.col("source"), F.col("leaf"), F.lit(seed)) < F.col("__frac")).cast("int").alias("late"))
    for part in settled:
        last = last.unionByName(part)
    # One decision per block; only its open row needs it.
    decided = attach(
        leaves.where("__left IS NOT NULL").withColumn("leaf", F.col("__block")), last, ["source", "leaf"], F.col("__id")
    ).select(*[c for c in leaves.columns if c != "__up"], F.col("late").alias("__up"))
    rounded = leaves.where("__left IS NULL").unionByName(decided)
    mixed = rounded.withColumn("mix_copies", F.col("__whole") + F.col("__up"))
    return mixed.select(*[F.col(f"{ASIDE}.`{c}`").alias(c) for c in kept], *results)
