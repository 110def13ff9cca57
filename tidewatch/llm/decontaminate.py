"""Benchmark decontamination by greedy string tiling.

A text and a benchmark item that share enough runs of ``SEED`` tokens are compared: the longest common run of unmarked
tokens is found by running Karp-Rabin hashes, all runs of that length are marked as tiles from left to right, and so on until no run of
``SEED`` tokens is left. Tiles may lie in any order, so a passage whose sentences were moved is covered like one that was copied; a
text is contaminated if tiles cover ``COVERAGE`` of an item's tokens. An item with fewer tokens than a seed is in a text that holds all
its tokens in a row; one of fewer than ``SHORT`` tokens, which any text may hold by chance, in a text that has no other tokens.

Texts are scanned once. Seeds that are in no item are turned away by a bit array of fixed size; the others meet the items' seeds in a
join, so the number of items is not bounded by memory. A text must share ``needed`` seeds with an item, so all but that many of the item's
seeds, those that most items have, propose no pairs: a line that many items and texts share makes no pairs of them by itself.
Equal texts are scanned once per task and compared once. Tiling needs only the places of shared seeds: two runs of tokens are
equal if their seeds are. Its time is that of one sort for each length of a tile and each halving of the lengths looked at.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import bitmap, cut_lineage, in_bitmap, text_or_empty
from tidewatch.llm.rolling import PIECE, between, mix, prefix

#: Tokens of a seed and least length of a tile; least tokens of an item that is looked for inside of texts.
SEED, SHORT = 5, 3
#: Share of an item's tokens that tiles cover in a contaminated text.
COVERAGE = 0.5
_TOKEN = np.array([chr(c).isalnum() if c < 128 else True for c in range(256)])
_BASE = 0x5851F42D4C957F2D
#: First and last characters of scripts that are written without spaces (fixed values): Thai, Lao, Myanmar, Khmer, kana, Han.
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF))


_BREAK, _ALONE, _SLICE = 1, 2, 1 << 20


def _kinds() -> np.ndarray:
    """What each character beyond ASCII does: punctuation, symbols, spaces and controls end a token, unspaced scripts are cut into characters."""
    kinds = np.zeros(0x110000, np.uint8)
    for c in range(128, 0x20000):
        kind = unicodedata.category(chr(c))
        if kind[0] in "PSZ" or kind == "Cc":
            kinds[c] = _BREAK
    for first, last in UNSPACED:
        part = kinds[first : last + 1]
        part[part != _BREAK] = _ALONE
    return kinds


_KINDS = _kinds()


def _spaced(text: str) -> str:
    """``text`` with a space for each break and around each character that is a token."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).copy()
    kinds = _KINDS[points]
    points[kinds == _BREAK] = 32
    alone = kinds == _ALONE
    if alone.any():
        counts = np.where(alone, 3, 1)
        at = (np.cumsum(counts) - counts)[alone]
        points = np.repeat(points, counts)
        points[at] = points[at + 2] = 32
    return points.tobytes().decode("utf-32-le")


def token_hashes(text: str) -> np.ndarray:
    """Hashes of the tokens of a text: lower-cased runs of letters, digits and their marks; characters of scripts without spaces one by one."""
    text = text.lower()
    if not text.isascii():
        text = "".join(_spaced(text[i : i + _SLICE]) for i in range(0, len(text), _SLICE))
    data = text.encode()
    found, at = [], 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        if end < len(data):
            cut = end
            while cut > at and _TOKEN[data[cut - 1]]:
                cut -= 1
            end = cut if cut > at else end
        part = np.frombuffer(data, np.uint8, end - at, at)
        inside = np.zeros(len(part) + 2, np.int8)
        inside[1:-1] = _TOKEN[part]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        if len(edges):
            found.append(between(prefix(part), edges[::2], edges[1::2]) ^ mix((edges[1::2] - edges[::2]).astype(np.uint64)))
        at = end
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def seeds(tokens: np.ndarray, size: int = SEED) -> np.ndarray:
    """Hash of each run of ``size`` tokens."""
    n = len(tokens) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, SEED - size, np.uint64)
    for i in range(size):
        total = mix(total + tokens[i : i + n])
    return total


def needed(n_tokens: Column, coverage: float) -> Column:
    """Places of an item's seeds that a text must share: a tile of n tokens has n - SEED + 1, at least one for each SEED tokens."""
    return F.greatest(F.lit(1), F.ceil(F.ceil(n_tokens * F.lit(coverage) - 1e-9) / SEED))


def _whole(tokens: np.ndarray) -> np.ndarray:
    """Hash of a whole text of fewer than ``SHORT`` tokens."""
    return mix(seeds(tokens, len(tokens)) + np.uint64(1)) if 0 < len(tokens) < SHORT else np.zeros(0, np.uint64)


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
            tokens = token_hashes(text)
            found = _whole(tokens) if len(tokens) < SHORT else seeds(tokens, min(len(tokens), SEED))
            n = len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([key] * n, pa.binary()), pa.array([len(tokens)] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array(found.view(np.int64))],
                ["item", "n_tokens", "at", "seed"],
            )


def _scan(bits, short: list[int]):
    """Places of seeds that may be an item's; ``short``: numbers of tokens that items shorter than a seed have."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[bytes] = set()  # texts of this task
        for batch in batches:
            keys, places, hits = [], [], []
            for key, text in zip(batch.column("digest").to_pylist(), batch.column("text"), strict=True):
                if key in done:
                    continue
                done.add(key)
                tokens = token_hashes(text.as_py())
                found = seeds(tokens)
                place = np.arange(len(found))
                for size in short:  # these are looked for, not tiled: one place is enough
                    extra = _whole(tokens) if size < SHORT and len(tokens) == size else seeds(tokens, size) if size >= SHORT else found[:0]
                    extra = np.unique(extra)
                    found, place = np.concatenate([found, extra]), np.concatenate([place, np.full(len(extra), -1)])
                at = np.flatnonzero(in_bitmap(bits.value, found))
                keys.extend([key] * len(at))
                places.append(place[at])
                hits.append(found[at])
            if keys:
                columns = [pa.array(keys, pa.binary()), pa.array(np.concatenate(places).astype(np.int32)), pa.array(np.concatenate(hits).view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["digest", "at", "seed"])

    return run


class _Side:
    """Seeds of one text by place, with marks on its tokens. Stretches without seeds are cut to what keeps seeds apart."""

    def __init__(self, places: np.ndarray, found: np.ndarray) -> None:
        steps = np.minimum(np.diff(places), SEED)
        self.seeds, self.places = found, np.concatenate([[0], np.cumsum(steps)]).astype(np.int64)
        self.marked = np.zeros(int(self.places[-1]) + SEED, np.int8)
        power = np.full(len(found) + 1, _BASE, np.uint64)
        power[0] = 1
        self.power = np.multiply.accumulate(power)
        self.sums = np.zeros(len(found) + 1, np.uint64)
        np.cumsum(found * self.power[:-1], out=self.sums[1:])
        self.refresh()

    def refresh(self) -> None:
        """Count the marks before each token."""
        self.marks = np.concatenate([[0], np.cumsum(self.marked, dtype=np.int64)])

    def windows(self, length: int, power: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and running hash of unmarked windows of ``length`` tokens; ``power`` is as long for both sides."""
        m = length - SEED + 1
        i = np.arange(max(0, len(self.seeds) - m + 1))
        start = self.places[i]
        i = i[(self.places[i + m - 1] - start == m - 1) & (self.marks[start + length] == self.marks[start])] if len(i) else i
        return i, (self.sums[i + m] - self.sums[i]) * power[len(power) - 1 - i]

    def free(self, i: int, length: int) -> bool:
        """Whether tiles of the same length left window ``i`` unmarked: they cover an end of what they meet."""
        place = self.places[i]
        return not (self.marked[place] or self.marked[place + length - 1])

    def mark(self, i: int, length: int) -> None:
        self.marked[self.places[i] : self.places[i] + length] = 1


def tile(text: tuple[np.ndarray, np.ndarray], item: tuple[np.ndarray, np.ndarray]) -> tuple[int, int]:
    """Covered tokens of the item and number of tiles. Both sides: places in order, and the seed at each place."""
    keep = [np.isin(text[1], item[1]), np.isin(item[1], text[1])]
    if not keep[0].any():
        return 0, 0
    a, b = (_Side(places[k], found[k]) for (places, found), k in zip((text, item), keep, strict=True))
    power = max(a.power, b.power, key=len)

    def common(length: int) -> tuple[np.ndarray, ...]:
        (i, x), (j, y) = a.windows(length, power), b.windows(length, power)
        left, right = np.isin(x, y), np.isin(y, x)
        return i[left], x[left], j[right], y[right]

    tiles, high = 0, min(len(a.seeds), len(b.seeds)) + SEED - 1
    while high >= SEED:
        # The longest common run: where there is one of a length, there is one of each smaller length.
        found, length, low = None, 0, SEED
        while low <= high:
            middle = (low + high + 1) // 2 if found else low
            runs = common(middle)
            if len(runs[0]):
                found, length, low = runs, middle, middle + 1
            else:
                high = middle - 1
        if found is None:
            break
        i, x, j, y = found
        places: dict[int, list[int]] = {}
        for k, h in zip(j[::-1].tolist(), y[::-1].tolist(), strict=True):
            places.setdefault(h, []).append(k)
        m = length - SEED + 1
        for p, h in zip(i.tolist(), x.tolist(), strict=True):
            there = places[h]
            if a.free(p, length):
                while there and not b.free(there[-1], length):
                    there.pop()  # taken, and will stay so
                if there and np.array_equal(a.seeds[p : p + m], b.seeds[there[-1] : there[-1] + m]):
                    a.mark(p, length)
                    b.mark(there.pop(), length)
                    tiles += 1
        a.refresh()
        b.refresh()
        high = length - 1
    return int(b.marked.sum()), tiles


def _places(found: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    at = np.array([x["at"] for x in found], np.int64)
    order = np.argsort(at)
    return at[order], np.array([x["seed"] for x in found], np.int64).view(np.uint64)[order]


def _tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            # An item shorter than a seed is there as a whole.
            covered, tiles = (row["n_tokens"], 1) if row["n_tokens"] < SEED else tile(_places(row["hits"]), _places(row["item_seeds"]))
            out.append((row["digest"], row["item"], row["n_tokens"], covered, tiles))
        if out:
            kinds = [pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int32()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["digest", "item", "n_tokens", "covered", "tiles"])


def with_digest(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus ``digest`` of the text (NULL: empty)."""
    return docs.withColumn("digest", F.unhex(F.md5(text_or_empty(text))))


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """``digest, item, n_tokens, covered, tiles, coverage`` of every distinct text and item whose tiles reach ``coverage``.

    ``docs`` and ``benchmark`` have ``text``; NULL and empty texts match nothing, and equal texts or items are one. An
    empty benchmark finds nothing.
    """
    items = with_digest(benchmark.select("text")).select(F.col("digest").alias("item"), text_or_empty().alias("text")).dropDuplicates(["item"])
    known = cut_lineage(items.mapInArrow(_item_seeds, "item binary, n_tokens int, at int, seed long"), "item-seeds")
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(known, "seed"))
    short = sorted(r["n_tokens"] for r in known.where(F.col("n_tokens") < SEED).select("n_tokens").distinct().collect())  # fewer than SEED
    texts = with_digest(docs.select("text")).select("digest", text_or_empty().alias("text"))
    hits = cut_lineage(texts.mapInArrow(_scan(bits, short), "digest binary, at int, seed long"), "seed-hits").distinct()
    held_by = known.groupBy("seed").agg(F.countDistinct("item").alias("n_items"))
    each = Window.partitionBy("item")  # the seeds of one item
    ranked = known.join(held_by, "seed").withColumn("rank", F.row_number().over(each.orderBy("n_items", "seed", "at"))).withColumn("n_seeds", F.count("*").over(each))
    rare = ranked.where(F.col("rank") <= F.col("n_seeds") - needed(F.col("n_tokens"), coverage) + 1).select("seed", "item").distinct()
    pairs = hits.select("digest", "seed").distinct().join(rare, "seed").select("digest", "item").distinct()
    shared = pairs.join(known.select("item", "seed").distinct(), "item").join(hits, ["digest", "seed"])
    shared = shared.groupBy("digest", "item").agg(F.collect_list(F.struct("at", "seed")).alias("hits"))
    whole = known.groupBy("item").agg(F.first("n_tokens").alias("n_tokens"), F.collect_list(F.struct("at", "seed")).alias("item_seeds"))
    found = shared.join(whole, "item").mapInArrow(_tiled, "digest binary, item binary, n_tokens int, covered int, tiles int")
    return cut_lineage(found.withColumn("coverage", F.col("covered") / F.col("n_tokens")).where(F.col("coverage") >= coverage), "contaminated")
