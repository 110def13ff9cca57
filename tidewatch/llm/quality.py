"""Quality classifier: histogram gradient-boosted trees over statistics of whole texts.

Statistics are computed where texts are read. The model is fitted on at most ``TRAIN_ROWS`` labelled rows (a sample by
key hash, the same in every run); every other number covers all rows. Statistics are cut into quantile bins once, trees
grow level by level from histograms of gradients, and the forest is stored as complete trees in flat arrays, which all rows
of a batch walk down together in numpy.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from tidewatch.llm.simhash import PIECE, word_pieces

#: Most labelled rows that a model is fitted on.
TRAIN_ROWS = 20_000

_ASCII = bytes(range(256))
_CLASSES = (
    lambda c: 65 <= c <= 90,
    lambda c: 97 <= c <= 122,
    lambda c: 48 <= c <= 57,
    lambda c: c in b".,;:?",
    lambda c: c in b"!",
    lambda c: c in b"#$%&*+=@^_~\\/",
    lambda c: c in b"|<>{}[]",
    lambda c: c in b"\"'()-",
    lambda c: c in b" \t\r\x0b\x0c",
    lambda c: c == 10,
    lambda c: c >= 128,
)
_BYTE_CLASS = np.array([[float(f(c)) for f in _CLASSES] for c in _ASCII])
_STOP = np.array([c in b".,;:?!" for c in _ASCII])
_SPACE = np.array([c in b" \t\n\x0b\x0c\r" for c in _ASCII])
_UPPER = _BYTE_CLASS[:, 0] > 0

STATISTICS = (
    "log_bytes", "log_words", "word_length", "word_length_spread", "distinct_words", "top_word", "second_word", "repeated_next",
    "short_words", "long_words", "lines", "line_length", "repeated_lines", "repeated_line_bytes", "stop_before_space", "upper_pairs",
    "upper", "lower", "digits", "stops", "exclamations", "symbols", "bars", "quotes", "blanks", "newlines", "other_bytes",
)


def statistics(data: bytes) -> list[float]:
    """``STATISTICS`` of one text as UTF-8; all zero for an empty one. Long texts are read in pieces."""
    size = len(data)
    if not size:
        return [0.0] * len(STATISTICS)
    counts = np.zeros(256)
    stops = uppers = 0
    for at in range(0, size, PIECE):
        part = np.frombuffer(data, np.uint8, min(PIECE, size - at), at)
        counts += np.bincount(part, minlength=256)
        stops += int(np.count_nonzero(_STOP[part[:-1]] & _SPACE[part[1:]]))
        up = _UPPER[part]
        uppers += int(np.count_nonzero(up[:-1] & up[1:]))
    n, length, square, short, long, same = 0, 0, 0, 0, 0, 0
    seen: Counter[bytes] = Counter()
    for words in word_pieces(data, 1):
        fresh = words[1:] if n else words
        same += sum(map(bytes.__eq__, words, words[1:]))
        sizes = np.fromiter(map(len, fresh), np.int64, len(fresh))
        n += len(fresh)
        length += int(sizes.sum())
        square += int((sizes * sizes).sum())
        short += int(np.count_nonzero(sizes <= 3))
        long += int(np.count_nonzero(sizes >= 13))
        seen.update(fresh)
    lines = data.split(b"\n")
    distinct = set(lines)
    per_word = 1.0 / max(n, 1)
    mean = length * per_word
    top = [c for _, c in seen.most_common(2)] + [0, 0]
    return [
        np.log1p(size), np.log1p(n), mean, max(square * per_word - mean * mean, 0.0) ** 0.5, len(seen) * per_word, top[0] * per_word, top[1] * per_word,
        same * per_word, short * per_word, long * per_word, np.log1p(len(lines)), size / len(lines), 1 - len(distinct) / len(lines),
        1 - sum(map(len, distinct)) / size, stops * per_word, uppers / size, *(counts @ _BYTE_CLASS / size).tolist(),
    ]


@dataclass(frozen=True)
class Forest:
    """Complete trees of one depth: ``feature`` and ``threshold`` by (tree, inner node), ``leaf`` by (tree, leaf)."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for every row of ``x``."""
        trees = np.arange(self.leaf.shape[0])
        node = np.zeros((len(x), len(trees)), np.int64)
        inner = self.feature.shape[1]
        rows = np.arange(len(x))[:, None]
        while len(trees) and node[0, 0] < inner if len(x) else False:
            node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.threshold[trees, node])
        raw = self.base + (self.leaf[trees, node - inner].sum(axis=1) if len(trees) else 0.0)
        return 1.0 / (1.0 + np.exp(-np.clip(raw, -30, 30))) * np.ones(len(x))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 1.0, least: float = 2.0) -> Forest:
    """Boosted trees for 0/1 labels ``y``. One class only, or no rows, gives a forest without trees."""
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    base = float(np.log(share / (1 - share)))
    inner = (1 << depth) - 1
    if not len(y) or y.min() == y.max():
        return Forest(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    width = x.shape[1]
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(width)], axis=1)
    offsets = np.arange(width) * bins
    feature = np.zeros((trees, inner), np.int64)
    threshold = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, inner + 1))
    raw = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, nodes = (1 << level) - 1, 1 << level
            at = ((node - first) * (width * bins))[:, None] + offsets + binned
            flat = at.ravel()
            size = nodes * width * bins
            left_g = np.bincount(flat, np.repeat(g, width), size).reshape(nodes, width, bins).cumsum(axis=2)
            left_h = np.bincount(flat, np.repeat(h, width), size).reshape(nodes, width, bins).cumsum(axis=2)
            all_g, all_h = left_g[:, :1, -1:], left_h[:, :1, -1:]
            right_g, right_h = all_g - left_g, all_h - left_h
            gain = left_g**2 / (left_h + ridge) + right_g**2 / (right_h + ridge) - all_g**2 / (all_h + ridge)
            gain[(left_h < least) | (right_h < least)] = -np.inf
            best = gain.reshape(nodes, -1).argmax(axis=1)
            for i, b in enumerate(best):
                j, cut = divmod(int(b), bins)
                if gain[i, j, cut] > 1e-9 and cut < len(cuts[j]):
                    feature[t, first + i], threshold[t, first + i] = j, cuts[j][cut]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > threshold[t, node])
        at = node - inner
        leaf[t] = -rate * np.bincount(at, g, inner + 1) / (np.bincount(at, h, inner + 1) + ridge)
        raw += leaf[t, at]
    return Forest(base, feature, threshold, leaf)


def _batches(text: str, add, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t.as_py() or b"") for t in batch.column(text).cast(pa.binary())]).reshape(-1, len(STATISTICS))
            name, values = add(x)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], values], [*kept, name])

    return run


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without ``text`` plus ``statistics``."""
    kept = [f for f in docs.schema.fields if f.name != text]

    def add(x: np.ndarray):
        return "statistics", pa.array(x.tolist(), pa.list_(pa.float64()))

    schema = StructType([*kept, StructField("statistics", ArrayType(DoubleType()))])
    return docs.withColumn(text, F.col(text).cast("string")).mapInArrow(_batches(text, add, [f.name for f in kept]), schema)


def is_held_out(doc_id: Column) -> Column:
    """Remainder 1 of the checksum of the id as text by 3; never for a NULL id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> Forest:
    """Model from ``labels`` (``doc_id, quality``) that are not held out, on at most ``most`` rows.

    NULL labels are left out; an id labelled both ways counts by the majority, ties as 1.
    """
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    usable = labels.select("doc_id", "quality").where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~is_held_out(F.col("doc_id")))
    chosen = usable.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label")).orderBy(*order).limit(most)
    # ``chosen`` has at most ``most`` rows of two numbers.
    rows = with_statistics(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))
    taken = rows.select("doc_id", "label", "statistics").orderBy(*order, "statistics").limit(most).toPandas()
    x = np.array(taken["statistics"].tolist(), dtype=float).reshape(-1, len(STATISTICS))
    return fit(x, taken["label"].to_numpy(dtype=float))


def with_score(docs: DataFrame, forest: Forest, text: str = "text", keep_text: bool = False, score: str = "quality_score") -> DataFrame:
    """``docs`` plus ``score``; NULL text is scored as an empty one. A column of that name is replaced."""
    kept = [f for f in docs.schema.fields if f.name != score and (keep_text or f.name != text)]

    def add(x: np.ndarray):
        return score, pa.array(forest.score(x), pa.float64())

    schema = StructType([*kept, StructField(score, DoubleType())])
    return docs.mapInArrow(_batches(text, add, [f.name for f in kept]), schema)
