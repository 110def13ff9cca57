"""Ranked lexical search: term-at-a-time over short lists, document-at-a-time over long ones.

Documents are read once and become an inverted index in blocks of at most ``BLOCK_DOCS`` documents, stored as a table: one row per block with
the lists of the terms that some item asks for. Counts of the whole corpus (documents, terms, documents of each term) are sums over its rows.
Then each task goes through its blocks and answers all items on each: lists of at most a ``SHORT``-th of the block are added up into
accumulators, which then are one more iterator with one bound, the largest accumulator, beside the long lists, whose bounds are their largest
contributions. Iterators whose bounds together stay below the score of the item's last place so far cannot bring a document up by themselves; only documents
of the others are candidates. They are taken in document order, ``STEP`` at a time; a list is searched only for candidates that could still
reach the last place, and what they reach raises it for all that follow. Places are merged in two steps, so that no task sees the places of all tasks of an item.

Items are the stated query set: they are read in blocks of at most ``ITEM_TERMS`` terms, and one block is what every task is sent. More items are more
passes, not more memory.

A NULL text has no terms, in documents and items; an item without terms that documents hold has no rows. Every row is a document or an item of its own,
whatever its id; a NULL doc_id ranks after all others of its score. Ties of equal ids are alike in all they return. Empty tables give an empty
result. Texts of any length are read in pieces. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.llm.common import scratch_path

#: Documents and list entries from which a block is closed.
BLOCK_DOCS, BLOCK_ENTRIES = 8_192, 1 << 18
#: Blocks in one file of the index, and blocks that one task answers: its time must not grow with the index.
FILE_BLOCKS, TASK_BLOCKS = 32, 8
#: Lists of at most this part of a block's documents are short.
SHORT = 16
#: Candidates that are looked up in the long lists at once.
STEP = 512
#: Terms of the items that one pass answers.
ITEM_TERMS = 1_000_000
#: Parts into which the places of an item are dealt before they are merged.
MERGES = 256
#: Bytes of a text that are cut into terms at once.
PIECE = 1 << 20

#: Fixed by the contract: what is left of a byte inside a term (letters in lower case), and a blank for all others.
_FOLD = bytes(c if c >= 0x80 else ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(256))


def terms(data: bytes) -> Iterator[list[bytes]]:
    """Terms of a text in UTF-8, piece by piece: runs of ASCII letters (A-Z in lower case) and digits and of all beyond ASCII."""
    tail: list[bytes] = []
    for at in range(0, len(data), PIECE):
        folded = data[at : at + PIECE].translate(_FOLD)
        if at + PIECE < len(data):
            cut = folded.rfind(b" ") + 1
            if not cut:  # one term goes on through the whole piece
                tail.append(folded)
                continue
            whole, rest = folded[:cut], folded[cut:]
        else:
            whole, rest = folded, b""
        yield b"".join([*tail, whole]).split()
        tail = [rest]
    if tail and tail != [b""]:
        yield b"".join(tail).split()


@dataclass(frozen=True)
class Items:
    """A block of the query set: ids, numbers of the terms of all, and each item's (term numbers, repeats)."""

    ids: list
    number: dict[bytes, int]
    asked: list[tuple[np.ndarray, np.ndarray]]


def item_blocks(items: DataFrame, key: str, text: str) -> Iterator[Items]:
    """Items in blocks of at most ``ITEM_TERMS`` terms (one longer item is a block of its own)."""
    block, size = Items([], {}, []), 0
    for row in items.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias("text")).toLocalIterator():
        counts = Counter(t for some in terms((row["text"] or "").encode()) for t in some)
        if not counts:
            continue
        if size and size + len(counts) > ITEM_TERMS:
            yield block
            block, size = Items([], {}, []), 0
        size += len(counts)
        numbers = np.array([block.number.setdefault(t, len(block.number)) for t in counts], np.int64)
        block.ids.append(row[key])
        block.asked.append((numbers, np.array(list(counts.values()), np.int64)))
    if size:
        yield block


# --- index ---

_INDEX = "ids array<long>, lengths array<long>, terms array<int>, starts array<int>, docs array<int>, tfs array<long>"


def _closed(ids: list, lengths: list[int], found: list[np.ndarray], owner: list[int]) -> pa.RecordBatch:
    """One block as a row: documents, and the entries of each term in document order."""
    n = len(ids)
    sizes = np.array([len(f) for f in found], np.int64)
    entries = np.concatenate(found) if found else np.zeros(0, np.int64)
    keys, tfs = np.unique(entries * n + np.repeat(np.array(owner, np.int64), sizes), return_counts=True)
    held, starts = np.unique(keys // n, return_index=True)
    columns = [
        pa.array([ids], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())), pa.array([held.astype(np.int32)], pa.list_(pa.int32())),
        pa.array([starts.astype(np.int32)], pa.list_(pa.int32())), pa.array([(keys % n).astype(np.int32)], pa.list_(pa.int32())), pa.array([tfs.astype(np.int64)], pa.list_(pa.int64())),
    ]
    return pa.RecordBatch.from_arrays(columns, ["ids", "lengths", "terms", "starts", "docs", "tfs"])


def _indexing(number):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = number.value
        ids, lengths, found, owner, entries = [], [], [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text").cast(pa.binary()), strict=True):
                length = 0
                for some in terms(text.as_py() or b""):
                    length += len(some)
                    hits = [t for t in map(known.get, some) if t is not None]
                    if hits:
                        found.append(np.array(hits, np.int64))
                        owner.append(len(ids))
                        entries += len(hits)
                if not length:
                    continue
                ids.append(doc_id)
                lengths.append(length)
                if len(ids) >= BLOCK_DOCS or entries >= BLOCK_ENTRIES:
                    yield _closed(ids, lengths, found, owner)
                    ids, lengths, found, owner, entries = [], [], [], [], 0
        if ids:
            yield _closed(ids, lengths, found, owner)

    return run


# --- search ---


class Places:
    """The best ``k`` documents of one item so far: score downward, then id upward, NULL last."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids, self.absent = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        self.least = 1

    def offer(self, scores: np.ndarray, ids: np.ndarray, absent: np.ndarray) -> None:
        s, i, a = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids]), np.concatenate([self.absent, absent])
        best = np.lexsort((i, a, -s))[: self.k]
        self.scores, self.ids, self.absent = s[best], i[best], a[best]
        if len(best) == self.k:
            self.least = max(self.least, int(self.scores[-1]))


def search_block(lists: list[tuple[np.ndarray, np.ndarray]], n: int, ids: np.ndarray, absent: np.ndarray, places: Places) -> None:
    """Offer the documents of a block that may reach ``places``; a list holds (documents upward, contributions above 0)."""
    short = [x for x in lists if len(x[0]) * SHORT <= n]
    long = sorted((x for x in lists if len(x[0]) * SHORT > n), key=lambda x: (int(x[1].max()), len(x[0])))
    held = np.zeros(n, np.int64)
    for docs, gain in short:
        held[docs] += gain
    bound = int(held.max(initial=0))
    bounds = [int(gain.max()) for _, gain in long]
    if bound + sum(bounds) < places.least:
        return
    if short:  # the k-th accumulator is a score that k documents reach at least
        touched = np.flatnonzero(held)
        if len(touched) >= places.k:
            floor = int(np.partition(held[touched], len(touched) - places.k)[len(touched) - places.k])
            places.least = max(places.least, floor)
    # Iterators by bound; those that together stay below the last place bring no candidates.
    order = sorted([(b, i) for i, b in enumerate(bounds)] + ([(bound, -1)] if bound else []))
    reach = 0
    marked = np.zeros(n, bool)
    for b, i in order:
        reach += b
        if reach >= places.least:
            if i < 0:
                marked |= held > 0
            else:
                marked[long[i][0]] = True
    candidates = np.flatnonzero(marked)
    rest = sum(bounds)
    for at in range(0, len(candidates), STEP):
        docs = candidates[at : at + STEP]
        score, left = held[docs], rest
        for (listed, gain), b in zip(reversed(long), reversed(bounds), strict=True):
            able = score + left >= places.least
            if not able.all():
                docs, score = docs[able], score[able]
            if not len(docs):
                break
            spot = np.searchsorted(listed, docs)
            spot[spot == len(listed)] = 0
            score = score + np.where(listed[spot] == docs, gain[spot], 0)
            left -= b
        able = score >= places.least
        if able.any():
            docs = docs[able]
            places.offer(score[able], ids[docs], absent[docs])


@dataclass(frozen=True)
class Corpus:
    """Documents with a term, all their terms, and the weight of every term of a block of items."""

    documents: int
    length: int
    weights: np.ndarray


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def gains(tfs: np.ndarray, lengths: np.ndarray, corpus: Corpus) -> np.ndarray:
    """What an entry brings before its term's weight, in 64-bit integers."""
    m = 100 - 25 + (25 * lengths * corpus.documents) // corpus.length
    return (1_000_000_000 * tfs) // (1000 * tfs + 12 * m)


_PLACES = "item int, doc_id long, score long"


def _searching(asked, corpus: Corpus, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = asked.value
        best = [Places(k) for _ in queries]
        for batch in batches:
            for row in range(batch.num_rows):
                one = {name: batch.column(name)[row].values for name in batch.schema.names}
                ids, absent = one["ids"].fill_null(0).to_numpy(zero_copy_only=False), one["ids"].is_null().to_numpy(zero_copy_only=False)
                lengths, held, starts, docs, tfs = (one[c].to_numpy(zero_copy_only=False) for c in ("lengths", "terms", "starts", "docs", "tfs"))
                gain = gains(tfs, lengths[docs], corpus)
                ends = np.append(starts[1:], len(docs))
                for (numbers, times), places in zip(queries, best, strict=True):
                    spot = np.searchsorted(held, numbers)
                    spot[spot == len(held)] = 0
                    lists = []
                    for s, factor in zip(spot.tolist(), (np.where(held[spot] == numbers, times * corpus.weights[numbers], 0) if len(held) else times * 0).tolist(), strict=True):
                        if factor:
                            lists.append((docs[starts[s] : ends[s]], factor * gain[starts[s] : ends[s]]))
                    if lists:
                        search_block(lists, len(ids), ids, absent, places)
        for item, places in enumerate(best):
            if len(places.scores):
                found = pa.array(places.ids, pa.int64(), mask=places.absent)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), item, np.int32)), found, pa.array(places.scores)], ["item", "doc_id", "score"])

    return run


def _merged(places: DataFrame, k: int) -> DataFrame:
    """``rank`` of the best ``k`` of each item: first within parts of its places, then of what they leave."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    dealt = places.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(MERGES)))
    some = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).where(F.col("rank") <= k)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k).drop("part")


def _answer(docs: DataFrame, block: Items, k: int) -> DataFrame:
    spark = docs.sparkSession
    context = spark.sparkContext
    path = scratch_path(spark, "index")
    docs.mapInArrow(_indexing(context.broadcast(block.number)), _INDEX).write.option("maxRecordsPerFile", FILE_BLOCKS).parquet(path)
    index = spark.read.schema(_INDEX).parquet(path)
    total = index.agg(F.count("*").alias("blocks"), F.sum(F.size("ids")).alias("n"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("l")).first()
    # Entries of a term in a block are its documents there; at most ITEM_TERMS totals reach the driver.
    sizes = F.transform("starts", lambda s, i: F.when(i + 1 < F.size("starts"), F.get("starts", i + 1)).otherwise(F.size("docs")) - s)
    each = index.select(F.explode(F.arrays_zip(F.col("terms"), sizes.alias("size"))).alias("e")).select("e.terms", F.col("e.size").cast("long").alias("size"))
    weights = np.zeros(len(block.number), np.int64)
    for r in each.groupBy("terms").agg(F.sum("size").alias("df")).collect():
        weights[r["terms"]] = weight(total["n"], r["df"])
    corpus = Corpus(total["n"] or 0, total["l"] or 0, weights)
    dealt = index.repartition(-(-total["blocks"] // TASK_BLOCKS) or 1)
    places = _merged(dealt.mapInArrow(_searching(context.broadcast(block.asked), corpus, k), _PLACES), k)
    names = spark.createDataFrame(list(enumerate(block.ids)), "item int, item_id long")
    return places.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")  # one row per item of a block


def ranked(docs: DataFrame, items: DataFrame, k: int = 20, key: str = "doc_id", item: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every item with a score above 0."""
    spark = docs.sparkSession
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    answers = [_answer(texts, block, k) for block in item_blocks(items, item, text)]
    return reduce(DataFrame.unionAll, answers) if answers else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
