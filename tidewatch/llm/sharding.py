"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Keys and the virtual nodes of shards are hashed to ``RING`` slots. A key belongs to the first virtual node
clockwise; if that shard holds its quota already, the key goes on clockwise to the next shard with room. Quotas
are the even split of the rows, so counts are at most one apart, and only what overflows moves away from its own arc.

Only counts per ring slot reach the driver (at most ``RING`` of them, whatever the input); they decide which ranks
of a slot go to which shard. Ranks are taken within slots, so no task ever orders a whole shard, and
positions in a shard are running sums over slots.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

RING_BITS = 16
RING = 1 << RING_BITS
VIRTUAL_NODES = 128


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """(slot, shard) of every virtual node, clockwise."""
    return sorted((xxhash.xxh64_intdigest(f"shard {s} node {v}") >> (64 - RING_BITS), s) for s in range(shards) for v in range(virtual_nodes))


def slot_of(*key: Column) -> Column:
    """Ring slot of a key."""
    return F.shiftrightunsigned(F.xxhash64(*key), 64 - RING_BITS).cast("int")


def allot(counts: dict[int, int], shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(slot, first rank, last rank + 1, shard, position of the first)`` for the rows of each slot.

    Slots come in a hashed order, so that no side of the ring is always the one that overflows. There are at most
    as many pieces as slots and shards together: a slot is split only where it fills a shard.
    """
    nodes = ring(shards, virtual_nodes)
    at = [slot for slot, _ in nodes]
    whole, odd = divmod(sum(counts.values()), shards)
    room = [whole + (s < odd) for s in range(shards)]
    placed = [0] * shards
    pieces = []
    for slot in sorted(counts, key=lambda c: (xxhash.xxh64_intdigest(str(c)), c)):
        rest, first, node = counts[slot], 0, bisect_left(at, slot)
        while rest:
            shard = nodes[node % len(nodes)][1]
            if take := min(rest, room[shard]):
                pieces.append((slot, first, first + take, shard, placed[shard]))
                room[shard] -= take
                placed[shard] += take
                first += take
                rest -= take
            node += 1
    return pieces


def assign(rows: DataFrame, key: Sequence[Column], shards: int, virtual_nodes: int = VIRTUAL_NODES) -> DataFrame:
    """``rows`` plus ``shard`` (int) and ``slot`` (long, gapless from 0 within a shard).

    ``key`` should tell rows apart; rows with equal keys share a ring slot and are interchangeable. NULLs in
    keys are values like others. Fewer rows than shards leave the last shards empty; an empty table stays empty. A column
    of ``rows`` named like a result column is replaced.
    """
    spark = rows.sparkSession
    kept = rows.drop("shard", "slot").withColumn("__at", slot_of(*key))
    counts = {r["__at"]: r["count"] for r in kept.groupBy("__at").count().collect()}
    schema = "__slot int, __first long, __end long, shard int, __place long"
    pieces = F.broadcast(spark.createDataFrame(allot(counts, shards, virtual_nodes), schema))  # at most RING + shards rows
    ranked = kept.withColumn("__rank", F.row_number().over(Window.partitionBy("__at").orderBy(F.xxhash64(*key), *key)) - 1)
    mine = (F.col("__at") == F.col("__slot")) & (F.col("__rank") >= F.col("__first")) & (F.col("__rank") < F.col("__end"))
    return ranked.join(pieces, mine).withColumn("slot", F.col("__place") + F.col("__rank") - F.col("__first")).drop(
        "__at", "__rank", "__slot", "__first", "__end", "__place"
    )


def moved_share(counts: dict[int, int], shards: int, virtual_nodes: int = VIRTUAL_NODES) -> float:
    """Share of rows that change their shard when one more shard joins."""
    spots = []
    for n in (shards, shards + 1):
        owner: dict[int, list[tuple[int, int, int]]] = {}
        for slot, first, end, shard, _ in allot(counts, n, virtual_nodes):
            owner.setdefault(slot, []).append((first, end, shard))
        spots.append(owner)
    stay = sum(max(0, min(e, e2) - max(f, f2)) for slot, old in spots[0].items() for f, e, s in old for f2, e2, s2 in spots[1][slot] if s == s2)
    total = sum(counts.values())
    return 1 - stay / total if total else 0.0


def slot_counts(rows: DataFrame, key: Sequence[Column]) -> dict[int, int]:
    """Rows per ring slot."""
    return {r["at"]: r["count"] for r in rows.groupBy(slot_of(*key).alias("at")).count().collect()}
