"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import cut_lineage, scratch_path

__all__ = ["aside", "attach", "bitmap", "cut_lineage", "in_bitmap", "is_few", "read_table", "scratch_path", "ship", "text_or_empty", "texts_of", "words", "WORD"]

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows up to which a side of a join is broadcast; its rows are counted first.
BROADCAST_ROWS = 50_000
#: Copies of the small side in the salted join beyond that.
SALTS = 32


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, as ``--py-files`` would; once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{os.path.basename(root)}.zip")
    with zipfile.ZipFile(path, "w") as held:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    held.write(full := os.path.join(folder, name), os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words(column: str = "text") -> Column:
    """Number of words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


#: Name of the column that carries columns an operator has no use for.
ASIDE = "__aside"


def aside(rows: DataFrame, needed: Sequence[str]) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """(``rows`` with ``needed`` and all other columns in one struct, so that no name can clash with an operator's own; the way back).

    The way back takes a frame that still has both, and columns to add.
    """
    others = [c for c in rows.columns if c not in needed]
    held = [F.struct(*[F.col(f"`{c}`") for c in others]).alias(ASIDE)] if others else []

    def back(df: DataFrame, *added: Column | str) -> DataFrame:
        return df.select(*[F.col(f"{ASIDE}.`{c}`").alias(c) if c in others else F.col(f"`{c}`") for c in rows.columns], *added)

    return rows.select(*needed, *held), back


def is_few(rows: DataFrame) -> bool:
    """Whether ``rows`` are so few that they may be broadcast; counts them."""
    return rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def attach(rows: DataFrame, small: DataFrame, keys: Sequence[str], spread: Column, how: str = "inner", few: bool | None = None) -> DataFrame:
    """``rows`` with the columns of ``small``, which has one row per ``keys`` (NULL equals NULL).

    ``small`` is broadcast only after a count shows that it is small (``few``: the outcome of an earlier count). Beyond that
    it is repeated ``SALTS`` times and ``rows`` are dealt over (keys, salt of ``spread``), so one hot key is never one task.
    """
    few = is_few(small) if few is None else few
    names = [f"__k{i}" for i in range(len(keys))]
    right = small.withColumnsRenamed(dict(zip(keys, names, strict=True)))
    on = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names, strict=True)]
    if few:
        return rows.join(F.broadcast(right), on, how).drop(*names)
    left = rows.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    right = right.withColumn("__salt_r", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(right, [*on, F.col("__salt") == F.col("__salt_r")], how).drop(*names, "__salt", "__salt_r")


#: Bits of a ``bitmap``; its size does not depend on the rows.
BITMAP_BITS = 24


def bitmap(rows: DataFrame, column: str) -> bytes:
    """Bit array of ``2 ** BITMAP_BITS`` bits (2 MB) with the bits of the hashes in ``column`` (long) set.

    A filter in front of an exact join: what is not in it is in no row; how full it gets decides only how many rows it spares.
    """
    slot = F.col(column).bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
    word = F.shiftright(slot, 5).cast("int")
    bit = F.expr(f"shiftleft(1L, cast({column} & 31L as int))")
    words = rows.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).collect()
    held = np.zeros(1 << (BITMAP_BITS - 5), np.uint32)
    held[[r["word"] for r in words]] = [r["bits"] for r in words]
    return held.tobytes()


def in_bitmap(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    """Which of ``hashes`` (uint64) may be in the bitmap."""
    h = hashes.astype(np.uint64)
    words = np.frombuffer(bits, np.uint32)[((h & np.uint64((1 << BITMAP_BITS) - 1)) >> np.uint64(5)).astype(np.int64)]
    return (words >> (h & np.uint64(31)).astype(np.uint32)) & np.uint32(1) > 0


def _known(bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = in_bitmap(bits.value, batch.column("tid").to_numpy().view(np.uint64))
            if keep.any():
                yield batch.filter(pa.array(keep))

    return run


def texts_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (one row per ``tid``, with ``at`` as the id of a row that holds the text) plus ``text``.

    ``texts`` has ``doc_id``, ``tid`` (hash of the text) and ``text``. Most texts that are not wanted are turned away by a bit array before the
    join; the join is on text and row, so that a text of many copies is moved once, and it hashes the side without texts.
    """
    bits = texts.sparkSession.sparkContext.broadcast(bitmap(wanted, "tid"))
    near = texts.mapInArrow(_known(bits), texts.schema)
    wanted = wanted.withColumnRenamed("tid", "wanted").hint("shuffle_hash")
    return near.join(wanted, (F.col("tid") == F.col("wanted")) & F.col("doc_id").eqNullSafe(F.col("at"))).drop("wanted", "doc_id", "at")
