"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint bit is the majority of that bit over the hashes of all word shingles. Two fingerprints within
``radius`` bits are found without comparing all: bit position i stands for a non-zero vector of ``radius + 1`` bits, and
table v keeps the bits whose vector has an odd product with v. The vectors of at most ``radius`` differing bits have a
common orthogonal v, so in that table both have the same key: no pair within the radius is missed.

Equal fingerprints are one node. Within a bucket two ways lead to links:

* ``links_within`` (a small radius of 2, exact): members differ only in the bits that the mask left out. Each member is
  listed under itself and under each of its one-bit changes of those bits; whoever shares an entry is at most two bits
  apart, and whoever is at most two bits apart shares one. A star per entry gives all links with work linear in the
  members, however large a bucket.
* ``candidates`` (wide fingerprints cut into blocks): a pair whose distance is at most
  ``blocks * (radius + 1) - 1`` is within the radius in some block. Small buckets are compared whole, in larger ones each
  member meets only the bucket's leaders (members that no earlier leader is near to).

What ``candidates`` does not propose is found by ``rare_pairs``, which is exact. In any one order of all shingles the first one
that two similar sets share stands early in both: with sizes n and m and ``least`` shared ones needed, at most n - ``least`` and
m - ``least`` come before it. So sets are listed under their first shingles only, rare ones first (by a table of counts of fixed
size, which decides only how much is listed), and sets that a link has already put together are not compared again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from tidewatch.llm.common import ASIDE, aside, cut_lineage, text_or_empty, texts_of
from tidewatch.llm.components import components

SEED = 42
#: Bytes of a text that are cut into words at once; a longer text is read in pieces that end at white space.
PIECE = 1 << 20
SPACES = b" \t\n\x0b\x0c\r"
#: Buckets up to this size are compared whole.
SMALL_BUCKET = 8
#: Slots of the table of shingle counts, and slots in one of its rows.
COUNT_SLOTS, COUNT_PART = 1 << 21, 1 << 15
#: Longs of a parity sketch, and members of a list that are compared with all others at once.
PARITY, AT_ONCE = 8, 512


def word_pieces(data: bytes, overlap: int) -> Iterator[list[bytes]]:
    """Words of ``data`` (A-Z lower-cased) in pieces, each with the last ``overlap`` words of the one before."""
    at, carried = 0, []
    while at < len(data):
        end = at + PIECE
        while end < len(data) and data[end] not in SPACES:
            end += 1
        words = carried + data[at:end].lower().split()
        yield words
        carried = words[-overlap:] if overlap else []
        at = end


def shingles(data: bytes, k: int) -> Iterator[list[bytes]]:
    """``k``-word shingles, repeats included; the whole sequence if there are fewer words; nothing without words."""
    any_whole = False
    last: list[bytes] = []
    for words in word_pieces(data, k - 1):
        last = words
        if len(words) < k:
            continue
        any_whole = True
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - k + 1].tolist()
        yield [joined[a:b] for a, b in zip(starts, ends[k - 1 :].tolist(), strict=True)]
    if not any_whole and last:
        yield [b" ".join(last)]


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set. Bits are added as bytes, 255 rows at a time, eight bytes in one word."""
    lanes = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").view(np.uint64)
    sums = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)
    return sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)


def fingerprint(data: bytes, k: int, lanes: int = 1) -> list[int]:
    """``lanes`` fingerprints of 64 bits (signed), each from its own hash seed; zeros without words."""
    counts, total = np.zeros((lanes, 64), np.int64), 0
    for some in shingles(data, k):
        total += len(some)
        for lane in range(lanes):
            counts[lane] += bit_counts(np.fromiter((xxhash.xxh64_intdigest(s, SEED + lane) for s in some), np.uint64, len(some)))
    return np.packbits(counts * 2 > total, axis=1, bitorder="little").view(np.int64).ravel().tolist()


def with_fingerprints(docs: DataFrame, k: int, lanes: int = 1, text: str = "text") -> DataFrame:
    """``docs`` without ``text`` plus ``fp0`` .. as longs. NULL text has no words; texts are read whole."""
    kept = [f for f in docs.schema.fields if f.name != text]
    names = [f"fp{i}" for i in range(lanes)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).cast(pa.binary())
            found = [fingerprint(t.as_py() or b"", k, lanes) for t in texts]
            columns = [batch.column(f.name) for f in kept] + [pa.array([f[i] for f in found], pa.int64()) for i in range(lanes)]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in kept] + names)

    return docs.withColumn(text, F.col(text).cast("string")).mapInArrow(run, StructType([*kept, *[StructField(n, LongType()) for n in names]]))


def covering_masks(width: int, radius: int) -> list[int]:
    """One mask of ``width`` bits for each non-zero vector of ``radius + 1`` bits."""
    vectors = (1 << (radius + 1)) - 1
    return [sum(1 << i for i in range(width) if ((i % vectors + 1) & v).bit_count() % 2) for v in range(1, vectors + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def links_within(prints: DataFrame) -> DataFrame:
    """``u, v`` that connect the distinct ``fp0`` of ``prints`` exactly as all pairs within two bits would."""
    tables = [
        F.struct(
            F.lit(t).alias("t"), F.col("fp0").bitwiseAND(F.lit(_signed(mask))).alias("bucket"), F.lit(_signed(~mask & (1 << 64) - 1)).alias("free")
        )
        for t, mask in enumerate(covering_masks(64, 2))
    ]
    listed = prints.select("fp0").distinct().select("fp0", F.inline(F.array(*tables)))
    shared = listed.groupBy("t", "bucket").count().where("count > 1").select("t", "bucket")
    members = listed.join(shared, ["t", "bucket"])
    bits = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)) for i in range(64)])
    entries = members.withColumn("bit", F.explode(bits)).where("bit & free = bit").select("t", "bucket", F.col("fp0").bitwiseXOR(F.col("bit")).alias("entry"), "fp0")
    # An entry has at most one member per free bit and itself. A member keeps only the smallest of each entry.
    by_entry = entries.groupBy("t", "bucket", "entry").agg(F.min("fp0").alias("v"), F.collect_set("fp0").alias("all")).where(F.size("all") > 1)
    return by_entry.select("v", F.explode("all").alias("u")).where("u <> v").select("u", "v").distinct()


def block_keys(lanes: int, width: int, radius: int) -> Column:
    """Array of ``table`` and ``key`` structs over the blocks of ``width`` bits of all lanes."""
    found = []
    for lane in range(lanes):
        for block in range(64 // width):
            part = F.shiftrightunsigned(F.col(f"fp{lane}"), block * width)
            for mask in covering_masks(width, radius):
                found.append(F.struct(F.lit(len(found)).alias("t"), part.bitwiseAND(F.lit(_signed(mask))).alias("key")))
    return F.array(*found)


def _near(lanes: int, limit: int):
    """Pairs of one bucket within ``limit`` bits, from rows ordered by ``t, key``."""

    def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count((a ^ b).view(np.uint64)).sum(axis=-1, dtype=np.int32)  # of signed words it would count the absolute value

    def bucket_pairs(prints: np.ndarray) -> tuple[list[int], list[int]]:
        leaders: list[int] = []
        us, vs = [], []
        held = np.empty_like(prints)
        for i in range(len(prints)):
            d = distance(held[: len(leaders)], prints[i])
            best = int(d.argmin()) if len(d) else -1
            if best >= 0 and d[best] <= limit:
                us.append(i)
                vs.append(leaders[best])
            else:
                held[len(leaders)] = prints[i]
                leaders.append(i)
        return us, vs

    def pairs(t: np.ndarray, key: np.ndarray, node: np.ndarray, prints: np.ndarray) -> pa.RecordBatch | None:
        n = len(t)
        new = np.ones(n, bool)
        new[1:] = (t[1:] != t[:-1]) | (key[1:] != key[:-1])
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, n))
        size_of = np.repeat(sizes, sizes)
        group = np.repeat(np.arange(len(starts)), sizes)
        us, vs = [], []
        for shift in range(1, SMALL_BUCKET):
            if shift >= n:
                break
            i = np.flatnonzero((group[shift:] == group[:-shift]) & (size_of[shift:] <= SMALL_BUCKET))
            i = i[distance(prints[i], prints[i + shift]) <= limit]
            us.append(i + shift)
            vs.append(i)
        for g in np.flatnonzero(sizes > SMALL_BUCKET):
            a = starts[g]
            u, v = bucket_pairs(prints[a : a + sizes[g]])
            us.append(np.array(u, np.int64) + a)
            vs.append(np.array(v, np.int64) + a)
        u, v = np.concatenate(us or [[]]).astype(np.int64), np.concatenate(vs or [[]]).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(node[u], pa.int64()), pa.array(node[v], pa.int64())], ["u", "v"]) if len(u) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("t", "key", "node")]
            columns.append(np.stack([batch.column(f"fp{i}").to_numpy() for i in range(lanes)], axis=1))
            if held is not None:
                columns = [np.concatenate([a, b]) for a, b in zip(held, columns, strict=True)]
            t, key = columns[0], columns[1]
            if not len(t):
                continue
            # The last bucket may go on in the next batch.
            same = (t == t[-1]) & (key == key[-1])
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if cut and (out := pairs(*[c[:cut] for c in columns])):
                yield out
            held = [c[cut:] for c in columns]
        if held is not None and (out := pairs(*held)):
            yield out

    return run


def candidates(nodes: DataFrame, lanes: int, width: int, radius: int, limit: int) -> DataFrame:
    """Distinct ``u, v`` of ``nodes`` (``node`` long, ``fp0`` ..) that share a covering bucket and are within ``limit`` bits."""
    prints = [f"fp{i}" for i in range(lanes)]
    rows = nodes.select("node", *prints, F.inline(block_keys(lanes, width, radius)))
    dealt = rows.repartition("t", "key").sortWithinPartitions("t", "key", "node")
    return cut_lineage(dealt.mapInArrow(_near(lanes, limit), "u long, v long").distinct(), "simhash-pairs")


def _alike(k: int, similarity: float):
    """Pairs whose sets of shingles have at least that Jaccard similarity, from rows ordered by ``v``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, frozenset()

        def shingle_set(data: bytes) -> frozenset[int]:
            return frozenset(xxhash.xxh64_intdigest(s, SEED) for some in shingles(data, k) for s in some)

        for batch in batches:
            us, vs = [], []
            columns = (batch.column("u"), batch.column("v"), batch.column("text_u").cast(pa.binary()), batch.column("text_v").cast(pa.binary()))
            for u, v, text_u, text_v in zip(*columns, strict=True):
                if v != last:
                    last, held = v, shingle_set(text_v.as_py())
                own = shingle_set(text_u.as_py())
                both = len(own & held)
                if both >= similarity * (len(own) + len(held) - both):
                    us.append(u.as_py())
                    vs.append(v.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

    return run


def shingle_hashes(data: bytes, k: int) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles."""
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(s, SEED) for some in shingles(data, k) for s in some), np.uint64))


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(COUNT_SLOTS - 1)).astype(np.int64)


def shingle_counts(texts: DataFrame, k: int) -> bytes:
    """Table of ``COUNT_SLOTS`` counts (int32): how many rows of ``text`` hold a shingle with that end of the hash."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNT_SLOTS, np.int32)
        for batch in batches:
            for t in batch.column("text").cast(pa.binary()):
                np.add.at(counts, _slots(shingle_hashes(t.as_py() or b"", k)), 1)
        if counts.any():
            parts = counts.reshape(-1, COUNT_PART)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts"), strict=True):
                sums[part] = sums.get(part, 0) + np.frombuffer(counts.as_py(), np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([c.tobytes() for c in sums.values()], pa.binary())], ["part", "counts"])

    schema = "part int, counts binary"
    table = np.zeros((COUNT_SLOTS // COUNT_PART, COUNT_PART), np.int32)
    for row in texts.select("text").mapInArrow(count, schema).repartition("part").mapInArrow(add, schema).collect():
        table[row["part"]] = np.frombuffer(row["counts"], np.int32)
    return table.tobytes()


def _least(total: np.ndarray, similarity: float) -> np.ndarray:
    """Shared members that two sets of ``total`` members together need."""
    return np.ceil(similarity / (1 + similarity) * total - 1e-6).astype(np.int64)


def _first_shingles(counts, k: int, similarity: float):
    """Rows ``token, d0, d1, n, before`` for the first shingles of each text, rare ones first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(counts.value, np.int32)
        for batch in batches:
            d0, d1 = batch.column("d0").to_numpy(), batch.column("d1").to_numpy()
            tokens, sizes, firsts = [], [], []
            for t in batch.column("text").cast(pa.binary()):
                found = shingle_hashes(t.as_py() or b"", k)
                n = len(found)
                first = n - int(np.ceil(similarity * n - 1e-6)) + 1 if n else 0
                tokens.append(found[np.lexsort((found, table[_slots(found)]))[:first]])
                sizes.append(n)
                firsts.append(len(tokens[-1]))
            if sum(firsts):
                columns = [np.concatenate(tokens).view(np.int64), np.repeat(d0, firsts), np.repeat(d1, firsts), np.repeat(sizes, firsts), np.concatenate([np.arange(f) for f in firsts])]
                columns = [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.int32()] * 2, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["token", "d0", "d1", "n", "before"])

    return run


def _by_token(work, names: list[str]):
    """``work`` on the numpy columns ``names`` of rows ordered by ``token``; a token is never cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
            if held is not None:
                columns = [np.concatenate([a, b]) for a, b in zip(held, columns, strict=True)]
            other = np.flatnonzero(columns[0] != columns[0][-1])
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield from work([c[:cut] for c in columns])
            held = [c[cut:] for c in columns]
        if held is not None:
            yield from work(held)

    return run


def _groups(token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    return starts, np.diff(np.append(starts, len(token)))


def _shared(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows of tokens that several texts have, each text once."""
    token, d0, d1 = columns[:3]
    once = np.ones(len(token), bool)
    once[1:] = (token[1:] != token[:-1]) | (d0[1:] != d0[:-1]) | (d1[1:] != d1[:-1])
    columns = [c[once] for c in columns]
    sizes = _groups(columns[0])[1]
    keep = np.repeat(sizes > 1, sizes)
    if keep.any():
        yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in columns], ["token", "d0", "d1", "n", "before"])


def _open(similarity: float, root: np.ndarray, n: np.ndarray, before: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Members ``i < j`` of one token that may be similar, have this token as their first shared one, and are not linked yet."""
    for at in range(0, len(n), AT_ONCE):
        i = slice(at, at + AT_ONCE)
        least = _least(n[i, None] + n[None, at:], similarity)
        fits = (np.minimum((n - before)[i, None], (n - before)[None, at:]) >= least) & (root[i, None] != root[None, at:])
        u, v = np.nonzero(np.triu(fits, 1))
        yield u + at, v + at


def _alive(similarity: float):
    """Rows that have a partner under their token."""

    def work(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        token, node, root, n, before = columns
        n, before = n.astype(np.int64), before.astype(np.int64)
        keep = np.zeros(len(token), bool)
        for a, size in zip(*_groups(token), strict=True):
            b = a + size
            if (root[a:b] == root[a]).all():
                continue
            for u, v in _open(similarity, root[a:b], n[a:b], before[a:b]):
                keep[a + u] = keep[a + v] = True
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in columns], ["token", "node", "root", "n", "before"])

    return work


def _parity(k: int):
    """``node`` and a parity sketch: bit i is odd if an odd number of shingles falls on it.

    Bits that differ between two sketches are at most as many as shingles that only one of two sets has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for t in batch.column("text").cast(pa.binary()):
                at = (shingle_hashes(t.as_py(), k) >> np.uint64(32)).astype(np.int64) % (64 * PARITY)
                found.append(np.packbits(np.bincount(at, minlength=64 * PARITY) % 2 == 1).view(np.int64))
            sketches = np.array(found, np.int64).reshape(-1, PARITY)
            yield pa.RecordBatch.from_arrays([batch.column("node"), *[pa.array(sketches[:, i]) for i in range(PARITY)]], ["node", *[f"p{i}" for i in range(PARITY)]])

    return run


def _meetings(similarity: float):
    """``u, v`` of one token whose sketches leave it open whether they are similar."""

    def work(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        token, node, root, n, before = columns[:5]
        n, before = n.astype(np.int64), before.astype(np.int64)
        sketches = np.stack(columns[5:], axis=1).view(np.uint64)
        for a, size in zip(*_groups(token), strict=True):
            b = a + size
            for u, v in _open(similarity, root[a:b], n[a:b], before[a:b]):
                u, v = u + a, v + a
                total = n[u] + n[v]
                near = np.concatenate([np.zeros(0, bool), *[
                    np.bitwise_count(sketches[u[c : c + 65536]] ^ sketches[v[c : c + 65536]]).sum(axis=1, dtype=np.int64) <= (total - 2 * _least(total, similarity))[c : c + 65536]
                    for c in range(0, len(u), 65536)
                ]])
                if near.any():
                    x, y = node[u[near]], node[v[near]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.maximum(x, y)), pa.array(np.minimum(x, y))], ["u", "v"])

    return work


def rare_pairs(held: DataFrame, nodes: DataFrame, k: int, similarity: float) -> DataFrame:
    """Distinct ``u, v`` of all ``nodes`` of different ``root`` that can have a Jaccard similarity of ``similarity`` or more.

    ``held`` has ``doc_id, tid, text``; ``nodes`` has ``node, root, digest, tid, at``, one row per text.
    """
    counts = held.sparkSession.sparkContext.broadcast(shingle_counts(held, k))
    marks = lambda digest: (F.xxhash64(digest).alias("d0"), F.xxhash64(F.lit(1), digest).alias("d1"))
    listed = held.select(*marks(F.unhex(F.md5("text"))), "text").mapInArrow(_first_shingles(counts, k, similarity), "token long, d0 long, d1 long, n int, before int")
    dealt = listed.repartition("token").sortWithinPartitions("token", "d0", "d1")
    shared = dealt.mapInArrow(_by_token(_shared, ["token", "d0", "d1", "n", "before"]), listed.schema)
    named = shared.join(nodes.select("node", "root", *marks(F.col("digest"))), ["d0", "d1"])
    names = ["token", "node", "root", "n", "before"]
    rows = named.select(names).repartition("token").sortWithinPartitions("token", "node")
    alive = cut_lineage(rows.mapInArrow(_by_token(_alive(similarity), names), "token long, node long, root long, n int, before int"), "rare-shingles")
    wanted = cut_lineage(nodes.select("node", "tid", "at").join(alive.select("node").distinct(), "node"), "sketched")
    sketched = [f"p{i}" for i in range(PARITY)]
    sketches = texts_of(held, wanted).select("node", "text").mapInArrow(_parity(k), "node long, " + ", ".join(f"{p} long" for p in sketched))
    met = alive.join(sketches, "node").select(*names, *sketched).repartition("token").sortWithinPartitions("token", "node")
    return cut_lineage(met.mapInArrow(_by_token(_meetings(similarity), [*names, *sketched]), "u long, v long").distinct(), "rare-pairs")


def _links(held: DataFrame, nodes: DataFrame, pairs: DataFrame, k: int, similarity: float) -> DataFrame:
    """Those of ``pairs`` that are similar."""
    met = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
    wanted = cut_lineage(nodes.select("node", "tid", "at").join(met, "node"), "compared")
    whole = cut_lineage(texts_of(held, wanted).select("node", "text"), "compared-texts")
    rows = pairs.join(whole.select(F.col("node").alias("u"), F.col("text").alias("text_u")), "u").join(
        whole.select(F.col("node").alias("v"), F.col("text").alias("text_v")), "v"
    )
    return cut_lineage(rows.sortWithinPartitions("v").mapInArrow(_alike(k, similarity), "u long, v long"), "links")


def keep_one(
    docs: DataFrame, k: int = 5, similarity: float = 0.8, print_k: int = 2, lanes: int = 2, width: int = 32, radius: int = 3, limit: int = 24
) -> DataFrame:
    """``docs`` (with ``doc_id``, ``text``) with one row for each group of equal or similar texts: that of the smallest id.

    Texts are linked if their sets of ``k``-word shingles have a Jaccard similarity of ``similarity`` or more; a group is what
    links connect. First pairs to compare come from fingerprints of ``64 * lanes`` bits that are within ``limit`` bits and share a covering
    bucket of some block; ``rare_pairs`` adds all others that can be similar, so every group is whole. The fingerprints are of ``print_k``-word shingles, of which a changed word touches fewer: texts that are similar in longer
    shingles are then some ten bits of 128 apart. NULL text is empty; texts without words are equal to each other only if they are the same. All columns are
    kept, whatever their names; of rows with the same id and text the first by its other columns stays, in every run.
    """
    whole, back = aside(docs, ["doc_id", "text"])
    held = docs.select("doc_id", text_or_empty().alias("text")).withColumn("tid", F.xxhash64("text"))
    prints = [f"fp{i}" for i in range(lanes)]
    digest = F.unhex(F.md5("text")).alias("digest")
    marks = cut_lineage(with_fingerprints(held.select("doc_id", "tid", digest, "text"), print_k, lanes), "fingerprints")
    texts = marks.groupBy("digest").agg(F.min("doc_id").alias("at"), F.first("tid").alias("tid"), *[F.first(p).alias(p) for p in prints])
    # Ids follow from the texts, so that every run picks the same leaders: 56 bits of a hash, and the rank among texts that share them.
    high = F.xxhash64("digest").bitwiseAND(F.lit(~255))
    rank = F.row_number().over(Window.partitionBy("__high").orderBy("digest")) - 1
    nodes = cut_lineage(texts.withColumn("__high", high).withColumn("node", F.col("__high") + rank).drop("__high"), "nodes")
    near = _links(held, nodes, candidates(nodes, lanes, width, radius, limit), k, similarity)
    known = nodes.select("node", "digest", "tid", "at").join(components(near), "node", "left").withColumn("root", F.coalesce("root", "node"))
    known = cut_lineage(known, "linked")
    rest = _links(held, nodes, rare_pairs(held, known, k, similarity), k, similarity)
    roots = components(near.unionByName(rest))
    placed = nodes.select("node", "at", "digest").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = placed.groupBy("root").agg(F.min(F.struct(F.col("at").isNull().alias("none"), "at", "digest")).alias("one")).select("one.at", F.col("one.digest").alias("kept"))
    mine = whole.withColumn("__digest", F.unhex(F.md5(text_or_empty())))
    chosen = mine.join(first.hint("shuffle_hash"), (F.col("__digest") == F.col("kept")) & F.col("doc_id").eqNullSafe(F.col("at"))).drop("at", "kept")
    others = F.to_json(ASIDE) if ASIDE in whole.columns else F.lit("")
    order = Window.partitionBy("__digest", "doc_id").orderBy(others)
    return back(chosen.withColumn("__row", F.row_number().over(order)).where("__row = 1"))
