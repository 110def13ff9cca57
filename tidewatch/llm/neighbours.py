"""Approximate nearest neighbours: a graph by NN-descent, queries by greedy search on it.

Equal vectors are one node, so a vector that many rows share neither crowds the lists nor cuts the graph. Lists start
from blocks of nodes that lie together on a random line. Then each round joins neighbours of neighbours: a node's list and a
bounded sample of the nodes that list it meet, and whoever is closer to a member than the last of its list is offered to it. Pairs
that met before are skipped. Rounds end when few lists change. Vectors are compared as doubles with one common scale
while the graph is built and walked, so that near copies are told apart; results are measured on the vectors themselves.

A search keeps the ``BEAM`` nearest nodes of each query, opens the nearest unopened ones and joins their neighbours, until all of the
beam is open. Every step is a join on node ids; a task holds lists, never all vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType
from pyspark.sql.window import Window

from tidewatch.llm.common import attach, cut_lineage, is_few

#: Neighbours in a list, and most nodes of those that list a node which take part in a round.
LIST = 24
#: Nodes of a starting block, and how many lines are drawn.
BLOCK, LINES = 256, 2
#: Partners that one meeting offers to a member at most, rounds, and the share of changed entries that ends them.
OFFERS, ROUNDS, SETTLED = 8, 7, 0.02
#: Nodes that a search keeps, opens in a step, and most steps.
BEAM, OPENED, STEPS = 320, 100, 30
#: Nodes that every search also starts from.
ENTRIES = 8


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Distinct ``id, vec`` that take part: with an id, of the most common length (the smaller one of a tie), not zero, all parts finite."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast(ArrayType(DoubleType())).alias("vec")).where(
        F.col("id").isNotNull()
        & (F.size("vec") > 0)
        & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vec", lambda x: x != 0.0)
    )
    sizes = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vec") == (sizes["n"] if sizes else 0)).dropDuplicates(["id", "vec"])


def _encode(exponent: int):
    """Bytes of each vector, divided by the same power of two (which changes no digit), and its places on the random lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.ldexp(np.array(batch.column("vec").to_pylist(), dtype=np.float64), -exponent)
            lines = np.random.default_rng(11).standard_normal((x.shape[1], LINES))
            places = (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), np.finfo(np.float64).tiny)) @ lines
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([row.tobytes() for row in x], pa.binary()), *[pa.array(places[:, i]) for i in range(LINES)]],
                ["node", "code", *[f"line{i}" for i in range(LINES)]],
            )

    return run


def _decode(codes: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(codes.to_pylist()), np.float64).reshape(len(codes), -1)


def _distances(x: np.ndarray) -> np.ndarray:
    """Squared distances within each group of ``x`` (group, member, part).

    They come from differences to the member of median norm: close ones keep their digits, and so do all others beside a very long vector.
    """
    order = np.argsort((x * x).sum(axis=-1), axis=-1)
    x = x - np.take_along_axis(x, order[..., order.shape[-1] // 2, None, None], axis=-2)
    square = (x * x).sum(axis=-1)
    return np.maximum(square[..., :, None] + square[..., None, :] - 2 * (x @ np.swapaxes(x, -1, -2)), 0)


def _edges(src: np.ndarray, dst: np.ndarray, d: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64()), pa.array(d, pa.float64())], ["src", "dst", "d"])


def _start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nearest members within blocks of consecutive rows."""
    for batch in batches:
        node, x = batch.column("node").to_numpy(), _decode(batch.column("code")) if batch.num_rows else None
        for at in range(0, batch.num_rows, BLOCK):
            # The last block takes in what is too short for one of its own.
            if batch.num_rows - at < BLOCK and at:
                at = batch.num_rows - BLOCK
            ids, d = node[at : at + BLOCK], _distances(x[at : at + BLOCK])
            np.fill_diagonal(d, np.inf)
            k = min(LIST, len(ids) - 1)
            if k < 1:
                continue
            near = np.argpartition(d, k - 1, axis=1)[:, :k]
            yield _edges(np.repeat(ids, k), ids[near.ravel()], np.take_along_axis(d, near, 1).ravel())


def _best(src: np.ndarray, dst: np.ndarray, d: np.ndarray) -> pa.RecordBatch | None:
    """The nearest ``LIST`` distinct offers to each node of what one batch has found."""
    if not len(src):
        return None
    order = np.lexsort((dst, d, src))
    src, dst, d = src[order], dst[order], d[order]
    fresh = np.ones(len(src), bool)
    fresh[1:] = (src[1:] != src[:-1]) | (dst[1:] != dst[:-1])
    src, dst, d = src[fresh], dst[fresh], d[fresh]
    first = np.flatnonzero(np.concatenate([[True], src[1:] != src[:-1]]))
    rank = np.arange(len(src)) - np.repeat(first, np.diff(np.append(first, len(src))))
    keep = rank < LIST
    return _edges(src[keep], dst[keep], d[keep])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Offers between the members that meet at a node, from rows ordered by ``src, dst``."""

    def offers(table: pa.Table) -> pa.RecordBatch | None:
        batch = table.combine_chunks().to_batches()[0]
        src, dst = batch.column("src").to_numpy(), batch.column("dst").to_numpy()
        new = batch.column("new").to_numpy(zero_copy_only=False)
        reach, x = batch.column("reach").to_numpy(), _decode(batch.column("code"))
        # A member listed both ways stands there twice; the later row is skipped, and knows if either was new.
        twice = np.zeros(len(src), bool)
        twice[1:] = (src[1:] == src[:-1]) & (dst[1:] == dst[:-1])
        new[:-1] |= twice[1:] & new[1:]
        src, dst, new, reach, x = (a[~twice] for a in (src, dst, new, reach, x))
        first = np.flatnonzero(np.concatenate([[True], src[1:] != src[:-1]]))
        sizes = np.diff(np.append(first, len(src)))
        found: list[list[np.ndarray]] = [[], [], []]
        for at in range(0, len(first), 512):
            lo, n = first[at : at + 512], sizes[at : at + 512]
            width = int(n.max())
            index = np.minimum(lo[:, None] + np.arange(width), len(src) - 1)
            there = np.arange(width) < n[:, None]
            d = _distances(x[index])
            fresh = there & new[index]
            bad = ~(there[:, :, None] & there[:, None, :] & (fresh[:, :, None] | fresh[:, None, :])) | np.eye(width, dtype=bool) | (d >= reach[index][:, :, None])
            d[bad] = np.inf
            k = min(OFFERS, width)
            near = np.argpartition(d, k - 1, axis=2)[:, :, :k]
            value = np.take_along_axis(d, near, 2)
            g, i, j = np.nonzero(np.isfinite(value))
            found[0].append(dst[index[g, i]])
            found[1].append(dst[index[g, near[g, i, j]]])
            found[2].append(value[g, i, j])
        return _best(*[np.concatenate(f) for f in found]) if found[0] else None

    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        src = table.column("src").to_numpy()
        other = np.flatnonzero(src != src[-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut and (out := offers(table.slice(0, cut))):
            yield out
        held = table.slice(cut)
    if held is not None and (out := offers(held)):
        yield out


EDGES = "src long, dst long, d double"


def _top(edges: DataFrame) -> DataFrame:
    """The ``LIST`` nearest of each ``src``; a pair that was there before stays old."""
    pairs = edges.repartition("src").groupBy("src", "dst").agg(F.min("d").alias("d"), F.min("new").alias("new"))
    rank = F.row_number().over(Window.partitionBy("src").orderBy("d", "dst"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= LIST).drop("rank")


def _listing(graph: DataFrame, seed: int) -> DataFrame:
    """For each node up to ``LIST`` nodes that list it, by hash."""
    order = F.xxhash64("src", "dst", F.lit(seed))
    back = graph.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "new").withColumn("rank", F.row_number().over(Window.partitionBy("src").orderBy(order, "dst")))
    return back.where(F.col("rank") <= LIST).drop("rank")


def encoded(nodes: DataFrame) -> DataFrame:
    """``node, code, line0, ..`` of ``nodes`` (``node``, ``vec``)."""
    schema = "node long, code binary, " + ", ".join(f"line{i} double" for i in range(LINES))
    largest = nodes.agg(F.max(F.array_max(F.transform("vec", F.abs)))).first()[0]
    return cut_lineage(nodes.mapInArrow(_encode(math.frexp(largest or 1.0)[1]), schema), "codes")


def build(codes: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Neighbour graph ``src, dst, d, new`` over ``codes`` by NN-descent."""
    starts = None
    for i in range(LINES):
        part = codes.repartitionByRange(f"line{i}", "node").sortWithinPartitions(f"line{i}", "node").select("node", "code").mapInArrow(_start, EDGES)
        starts = part if starts is None else starts.unionByName(part)
    graph = cut_lineage(_top(starts.withColumn("new", F.lit(True))), "graph")
    for i in range(rounds):
        reach = graph.groupBy("src").agg(F.max("d").alias("reach"), F.count("*").alias("n")).select(
            F.col("src").alias("node"), F.when(F.col("n") < LIST, F.lit(float("inf"))).otherwise(F.col("reach")).alias("reach")
        )
        members = codes.select("node", "code").join(reach, "node")
        meeting = graph.select("src", "dst", "new").unionByName(_listing(graph, i))
        rows = meeting.join(members, meeting["dst"] == members["node"]).select("src", "dst", "new", "reach", "code")
        offers = rows.repartition("src").sortWithinPartitions("src", "dst").mapInArrow(_meet, EDGES).withColumn("new", F.lit(True))
        graph = cut_lineage(_top(graph.withColumn("new", F.lit(False)).unionByName(offers)), "graph")
        changed = graph.agg(F.avg(F.col("new").cast("int"))).first()[0]
        if changed is None or changed < SETTLED:
            break
    return graph


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            d = _decode(batch.column("code")) - _decode(batch.column("query_code"))
            yield pa.RecordBatch.from_arrays([batch.column("q"), batch.column("node"), pa.array((d * d).sum(axis=1), pa.float64())], ["q", "node", "d"])


def search(queries: DataFrame, codes: DataFrame, graph: DataFrame) -> DataFrame:
    """``q, node`` of the ``BEAM`` nearest nodes that greedy search finds for each node ``q`` of ``queries``.

    A query is a node of the graph: its search starts at its own neighbours and at ``ENTRIES`` nodes common to all.
    """
    around = graph.select("src", "dst").unionByName(_listing(graph, -1).select("src", "dst"))
    around = cut_lineage(around.groupBy("src").agg(F.collect_set("dst").alias("near")), "adjacency")
    entries = [r["node"] for r in codes.select("node").orderBy(F.xxhash64("node"), "node").limit(ENTRIES).collect()]
    asked = cut_lineage(codes.select(F.col("node").alias("q"), F.col("code").alias("query_code")).join(queries.select("q").distinct(), "q"), "asked")
    few = is_few(asked)
    by_distance = Window.partitionBy("q").orderBy("d", "node")
    fresh = queries.select("q").distinct().join(around, F.col("q") == F.col("src"), "left").select(
        "q", F.explode(F.array_union(F.coalesce("near", F.array().cast("array<long>")), F.array(*[F.lit(e).cast("long") for e in entries]))).alias("node")
    )
    beam = None
    for _ in range(STEPS):
        fresh = fresh.where("q <> node").distinct()
        rows = attach(fresh.join(codes.select("node", "code"), "node"), asked, ["q"], F.col("node"), few=few).select("q", "node", "code", "query_code")
        found = rows.mapInArrow(_measure, "q long, node long, d double").withColumn("open", F.lit(False))
        if beam is not None:
            found = found.unionByName(beam)
        found = found.repartition("q").groupBy("q", "node").agg(F.min("d").alias("d"), F.max("open").alias("open"))
        beam = found.withColumn("rank", F.row_number().over(by_distance)).where(F.col("rank") <= BEAM).drop("rank")
        turn = F.row_number().over(Window.partitionBy("q").orderBy("open", "d", "node"))  # the unopened come first
        beam = cut_lineage(beam.withColumn("next", ~F.col("open") & (turn <= OPENED)), "beam")
        ahead = beam.where("next")
        if ahead.isEmpty():
            break
        fresh = ahead.select("q", F.col("node").alias("src")).join(around, "src").select("q", F.explode("near").alias("node"))
        beam = beam.select("q", "node", "d", (F.col("open") | F.col("next")).alias("open"))
    return beam.select("q", "node")


def euclidean(a: Column, b: Column) -> Column:
    """Distance of two arrays of doubles."""
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for each row where ``is_query`` (of column ``id``) holds.

    Rows that take part: see ``usable``. A row given twice is one, and no query gets its own id. Ties go to the smaller id; with
    fewer than ``k`` others all are returned. Without usable rows the result is empty.
    """
    rows = cut_lineage(usable(vectors, key, vector), "vectors")
    # Numbers are fixed once the table is stored.
    nodes = cut_lineage(rows.select("vec").distinct().withColumn("node", F.monotonically_increasing_id()), "nodes")
    placed = rows.join(nodes.select("vec", "node"), "vec").select("id", "node")
    # No result can hold more than the k + 1 smallest ids of one vector.
    members = placed.withColumn("rank", F.row_number().over(Window.partitionBy("node").orderBy("id"))).where(F.col("rank") <= k + 1).drop("rank")
    members = cut_lineage(members, "members")
    queries = cut_lineage(placed.where(is_query), "queries")
    codes = encoded(nodes.select("node", "vec"))
    asked = queries.select(F.col("node").alias("q")).distinct()
    found = search(asked, codes, build(codes)).unionByName(asked.select("q", F.col("q").alias("node")))
    vec = nodes.select("node", "vec")
    measured = found.join(vec, "node").join(vec.select(F.col("node").alias("q"), F.col("vec").alias("query_vec")), "q")
    scored = measured.select("q", "node", euclidean(F.col("vec"), F.col("query_vec")).alias("score"))
    order = Window.partitionBy("q").orderBy("score", "id")
    listed = scored.join(members, "node").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k + 1).select("q", "id", "score")
    mine = Window.partitionBy("query_id").orderBy("score", "vec_id")
    named = queries.select(F.col("id").alias("query_id"), F.col("node").alias("q")).join(listed.withColumnRenamed("id", "vec_id"), "q")
    return (
        named.where("query_id <> vec_id").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
        .withColumn("rank", F.row_number().over(mine)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
