"""Removal of every byte that a repeated string of ``LENGTH`` bytes covers, by minimiser buckets and direct hashing.

This stands in for bucket-pointer refinement: no identifiers of buckets at later offsets are used, and the rest of ``LENGTH``
bytes is hashed directly. Not every suffix is listed: of the q-grams inside a string of ``LENGTH`` bytes
the one with the least hash stands for it, so equal strings meet in that q-gram's bucket at the same offset, and neighbouring strings
that chose the same q-gram form one run. Buckets with one run are done: nothing in them is repeated. The
others are refined, a run at a time, by the identifier of all bytes that its strings reach: runs that stay together
are repeated as a whole. Only where a bucket splits are single strings refined, one run for each of its parts, and what the parts
share is passed back to their runs.

Texts are compared once, however many copies there are; a copied text of ``LENGTH`` bytes or more is covered whole. Long texts are
hashed in overlapping pieces. Identifiers are 64-bit hashes within a bucket that is itself one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import cut_lineage, text_or_empty, texts_of
from tidewatch.llm.rolling import PIECE, between, mix, prefix, sliding_min, windows

LENGTH, GRAM = 200, 64
#: Parts of a bucket that one task refines; the strings of a larger bucket are dealt out by their own identifiers.
HOT_PARTS = 5_000
#: Runs that are cut out of texts, or refined, in one piece (a bucket is never divided for that).
RUNS_AT_ONCE = 4_000
_LOW = np.uint64(PIECE - 1)


def _runs(data: bytes) -> Iterator[tuple[np.ndarray, ...]]:
    """Bucket, identifier, first and last start of the runs of ``data``."""
    step = PIECE - LENGTH
    for at in range(0, len(data) - LENGTH + 1, step):
        part = np.frombuffer(data, np.uint8, min(step + LENGTH - 1, len(data) - at), at)
        sums = prefix(part)
        grams = windows(sums, GRAM)
        # High bits of the hash, then the place: the leftmost of equal q-grams is chosen.
        least = sliding_min((grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64), LENGTH - GRAM + 1)
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        last = np.append(first[1:], len(least)) - 1
        bucket = grams[(least[first] & _LOW).astype(np.int64)]
        yield bucket, between(sums, first, last + LENGTH) ^ mix((last - first).astype(np.uint64)), first + at, last + at


def _all_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["bucket", "part", "tid", "first", "last"]
    seen: set[int] = set()  # texts of this task

    def out(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        columns = [np.concatenate(x) for x in zip(*found, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c, pa.int64()) for c in columns], names)

    for batch in batches:
        found, rows = [], 0
        for tid, text in zip(batch.column("tid").to_pylist(), batch.column("text").cast(pa.binary()), strict=True):
            if tid in seen:
                continue
            seen.add(tid)
            for bucket, part, first, last in _runs(text.as_py()):
                found.append((bucket, part, np.full(len(first), tid, np.int64), first, last))
                rows += len(first)
            if rows > 200_000:
                yield out(found)
                found, rows = [], 0
        if found:
            yield out(found)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each listed run, some thousand runs at a time."""
    for batch in batches:
        runs = batch.column("runs")
        listed, ends = runs.flatten(), np.cumsum(runs.value_lengths().to_numpy())
        tids = pa.array(np.repeat(batch.column("tid").to_numpy(), np.diff(ends, prepend=0)))
        firsts, lasts = listed.field("first").to_numpy(), listed.field("last").to_numpy()
        begin, at, cut = 0, 0, []
        for text, end in zip(batch.column("text").cast(pa.binary()), ends.tolist(), strict=True):
            data = text.as_py()
            cut.extend(data[f : t + LENGTH] for f, t in zip(firsts[at:end].tolist(), lasts[at:end].tolist(), strict=True))
            at = end
            if len(cut) >= RUNS_AT_ONCE or end == ends[-1]:
                part = [listed.field(n).slice(begin, len(cut)) for n in ("bucket", "first", "alone", "hot")]
                columns = [part[0], tids.slice(begin, len(cut)), *part[1:], pa.array(cut, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "tid", "first", "alone", "hot", "bytes"])
                begin, cut = end, []


def _strings(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and identifier of every string of ``LENGTH`` bytes in the rows of ``batch``."""
    rows, starts, ids = [], [], []
    buckets, firsts = batch.column("bucket").to_numpy().view(np.uint64), batch.column("first").to_numpy()
    held: list[bytes] = []
    at: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal held, at, size
        if not at:
            return
        sums = prefix(np.frombuffer(b"".join(held), np.uint8))
        lengths = np.array([len(h) for h in held])
        begins = np.cumsum(lengths) - lengths
        counts = lengths - LENGTH + 1
        inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        s = np.repeat(begins, counts) + inner
        row = np.repeat(np.array(at), counts)
        rows.append(row)
        starts.append(firsts[row] + inner)
        ids.append(between(sums, s, s + LENGTH) ^ mix(buckets[row]))
        held, at, size = [], [], 0

    for i, data in enumerate(batch.column("bytes")):
        data = data.as_py()
        if size + len(data) > PIECE:
            flush()
        held.append(data)
        at.append(i)
        size += len(data)
    flush()
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(rows), np.concatenate(starts), np.concatenate(ids)


def _spans(tids: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    """Consecutive starts of a text as one span of covered bytes."""
    order = np.lexsort((starts, tids))
    tids, starts = tids[order], starts[order]
    new = np.concatenate([[True], (tids[1:] != tids[:-1]) | (starts[1:] > starts[:-1] + 1)])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(tids)) - 1
    return pa.RecordBatch.from_arrays([pa.array(tids[first]), pa.array(starts[first]), pa.array(starts[last] + LENGTH)], ["tid", "begin", "end"])


def _refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans that the parts of a bucket share, from rows ordered by bucket."""
    held: pa.Table | None = None

    def shared(table: pa.Table) -> pa.RecordBatch | None:
        batch = table.combine_chunks().to_batches()[0]
        row, start, ids = _strings(batch)
        _, inverse, counts = np.unique(ids, return_inverse=True, return_counts=True)
        hit = (counts[inverse] > 1) & batch.column("alone").to_numpy(zero_copy_only=False)[row]
        return _spans(batch.column("tid").to_numpy()[row[hit]], start[hit]) if hit.any() else None

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        buckets = table.column("bucket").to_numpy()
        borders = np.flatnonzero(buckets[1:] != buckets[:-1]) + 1  # where another bucket begins
        at = 0
        for i, border in enumerate(borders.tolist()):
            if i + 1 == len(borders) or borders[i + 1] - at > RUNS_AT_ONCE:
                if out := shared(table.slice(at, border - at)):
                    yield out
                at = border
        held = table.slice(at)
    if held is not None and (out := shared(held)):
        yield out


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Single strings of the runs of large buckets."""
    for batch in batches:
        row, start, ids = _strings(batch)
        alone = batch.column("alone").to_numpy(zero_copy_only=False)[row]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids.view(np.int64)), pa.array(batch.column("tid").to_numpy()[row]), pa.array(start), pa.array(alone)], ["id", "tid", "start", "alone"]
        )


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, spans in zip(batch.column("text").cast(pa.binary()), batch.column("spans"), strict=True):
            data, kept, removed, runs, at = text.as_py(), hashlib.sha256(), 0, 0, 0
            merged: list[list[int]] = []
            for s in sorted((x["begin"], x["end"]) for x in spans.as_py()):
                if merged and s[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s[1])
                else:
                    merged.append([*s])
            for begin, end in merged:
                kept.update(data[at:begin])
                removed += end - begin
                runs += 1
                at = end
            kept.update(data[at:])
            out.append((removed, runs, kept.hexdigest()))
        columns = [batch.column("tid"), *[pa.array(x) for x in zip(*out, strict=True)]] if out else []
        if out:
            yield pa.RecordBatch.from_arrays(columns, ["tid", "removed", "runs", "sha"])


def removed_bytes(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row of ``docs`` (``doc_id``, ``text``).

    NULL text is empty; a text shorter than ``LENGTH`` loses nothing; rows with equal texts have equal results.
    """
    held = docs.select("doc_id", text_or_empty().alias("text")).withColumn("tid", F.xxhash64("text"))
    marks = cut_lineage(
        held.select(
            "doc_id", "tid", F.unhex(F.md5("text")).alias("digest"), F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha_all")
        ),
        "texts",
    )
    texts = marks.groupBy("digest", "tid", "n_bytes", "sha_all").agg(F.count("*").alias("copies"), F.min("doc_id").alias("at"))
    long_texts = held.where(F.octet_length("text") >= LENGTH)
    runs = cut_lineage(long_texts.select("tid", "text").mapInArrow(_all_runs, "bucket long, part long, tid long, first long, last long"), "runs")
    # Both sides of this join are stored tables, and so is its result: Spark can cut a bucket that copies have filled.
    more = cut_lineage(runs.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket"), "open-buckets")
    open_runs = cut_lineage(cut_lineage(runs.join(more, "bucket"), "open-runs").distinct(), "open-runs")
    parts = open_runs.groupBy("bucket", "part").agg(F.count("*").alias("members"), F.min(F.struct("tid", "first", "last")).alias("one"))
    per_bucket = parts.groupBy("bucket").agg(F.count("*").alias("parts"))
    # Stored for the same reason: a short text that repeats itself can be most of one part.
    alike = cut_lineage(parts.where("members > 1").select("bucket", "part"), "alike-parts")
    together = (
        open_runs.join(alike, ["bucket", "part"])
        .select("tid", F.col("first").alias("begin"), (F.col("last") + LENGTH).alias("end"))
    )
    split = parts.join(per_bucket.where("parts > 1"), "bucket").select(
        "one.tid", F.struct("bucket", "one.first", "one.last", (F.col("members") == 1).alias("alone"), (F.col("parts") > HOT_PARTS).alias("hot")).alias("run")
    )
    holders = marks.groupBy("tid").agg(F.min("doc_id").alias("at"))
    wanted = cut_lineage(split.groupBy("tid").agg(F.collect_list("run").alias("runs")).join(holders, "tid"), "split-runs")
    schema = "bucket long, tid long, first long, alone boolean, hot boolean, bytes binary"
    cut = cut_lineage(texts_of(long_texts, wanted).mapInArrow(_cut, schema), "run-bytes")
    spans = "tid long, begin long, end long"
    shared = cut.where("NOT hot").repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_refine, spans)
    strings = cut.where("hot").mapInArrow(_listed, "id long, tid long, start long, alone boolean")
    twice = strings.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")
    hot = strings.join(twice, "id").where("alone").select("tid", F.col("start").alias("begin"), (F.col("start") + LENGTH).alias("end"))
    # A text of several copies is covered whole; only the others need their spans.
    single = texts.where("copies = 1").select(F.col("tid").alias("t"), F.col("at"))
    covered = together.unionByName(shared).unionByName(hot).groupBy("tid").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    covered = cut_lineage(covered.join(single, F.col("tid") == F.col("t")).drop("t"), "spans")
    results = texts_of(long_texts, covered).select("tid", "text", "spans").mapInArrow(_kept, "tid long, removed long, runs long, sha string")
    results = cut_lineage(results, "kept")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    told = texts.join(results, "tid", "left").select(
        "digest",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("runs", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("sha", "sha_all")).alias("kept_sha256"),
    )
    return marks.join(told, "digest").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
