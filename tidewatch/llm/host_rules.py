"""Host-level quality rules: failures are added up by host, rates are shrunk, and a host's verdict goes back to its documents.

Texts are read once, where they are scanned, for the numbers the rules judge. What is added up are counts: documents and failures of each rule
by host. A rate on few documents says little, so each rule gets a beta prior fitted to the rates of all hosts (moments of the beta-binomial:
the more hosts differ beyond chance, the weaker the prior), and a host is judged by the mean of its posterior,
``(failures + a) / (documents + a + b)``. A host that breaks one rule in ``LIMIT`` of its documents or more is rejected, with all its documents.

Hosts are as many as the data brings: their verdicts are a table that is joined back, broadcast only if a count shows that it is small, else
salted, so that a host with a third of all documents is many tasks. Sums for the prior are decimals, so that no order of adding changes a verdict.

NULL texts are empty: no words, which fails the first rule. Documents without a host (NULL) are judged on their own only. Ids may be NULL or repeat: every
row is a document. An empty table gives an empty result. Columns that are named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidewatch.llm.common import attach, cut_lineage

#: Shrunk rate of failures from which a host is rejected.
LIMIT = 0.5
#: Digits behind the point in the sums of the prior.
DIGITS = 12

_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_BLANKS = np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8)

NUMBERS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


@dataclass(frozen=True)
class Rule:
    """A name and a condition (SQL) on ``NUMBERS`` that a failing document fulfils. ``base``: such a document goes whatever its host is."""

    name: str
    fails: str
    base: bool = False


RULES = (
    Rule("few_words", "n_words < 50", base=True),
    Rule("repeats", "100 * n_repeat_words > 50 * n_words", base=True),
    Rule("word_length", "word_chars < 3 * n_words OR word_chars > 10 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("dup_lines", "10 * n_dup_lines > 3 * n_lines"),
)


def repeated_words(ids: np.ndarray) -> int:
    """How many words lie in a window of three that occurs twice or more; ``ids`` are numbers from 0 that tell words apart."""
    if len(ids) < 4:
        return 0
    top = int(ids.max()) + 1
    pairs = ids[:-1] * top + ids[1:]
    if top >= 1 << 21:  # the number of a triple would not fit 64 bits: number the pairs first
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    _, place, times = np.unique(pairs[:-1] * top + ids[2:], return_inverse=True, return_counts=True)
    hit = times[place] > 1
    covered = np.zeros(len(ids), bool)
    for shift in range(3):
        covered[shift : shift + len(hit)] |= hit
    return int(covered.sum())


def numbers(data: bytes) -> tuple[int, ...]:
    """``NUMBERS`` of a text in UTF-8. Lines are split at newlines and count if they hold a word."""
    bytes_of = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    chars = int(bytes_of.sum() - bytes_of[0x80:0xC0].sum() - bytes_of[_BLANKS].sum())
    number: dict[bytes, int] = {}
    ids: list[int] = []
    seen: set[bytes] = set()
    lines = 0
    for line in data.split(b"\n"):
        words = line.split()  # bytes split at ASCII white space only
        if words:
            lines += 1
            seen.add(line)
            ids += [number.setdefault(w, len(number)) for w in words]
    return len(ids), chars, int(bytes_of[_SYMBOLS].sum()), lines - len(seen), repeated_words(np.array(ids, np.int64)), lines


def _scanning(text: str, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([numbers(t.as_py() or b"") for t in batch.column(text).cast(pa.binary())], np.int64).reshape(-1, len(NUMBERS))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *map(pa.array, found.T)], [*kept, *NUMBERS])

    return run


def with_numbers(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without ``text`` plus ``NUMBERS`` (long)."""
    kept = [f for f in docs.schema.fields if f.name not in (text, *NUMBERS)]
    schema = StructType([*kept, *[StructField(n, LongType()) for n in NUMBERS]])
    return docs.withColumn(text, F.col(text).cast("string")).mapInArrow(_scanning(text, [f.name for f in kept]), schema)


def host_counts(judged: DataFrame, host: str, rules: tuple[Rule, ...]) -> DataFrame:
    """``host, documents`` and failures by rule, for every host but NULL; added up before anything moves."""
    failures = [F.sum(F.expr(r.fails).cast("long")).alias(r.name) for r in rules]
    return judged.where(F.col(host).isNotNull()).groupBy(F.col(host).alias("host")).agg(F.count("*").alias("documents"), *failures)


def moments(hosts: DataFrame, rules: tuple[Rule, ...]) -> list[Column]:
    """Aggregates over ``hosts`` from which ``strength`` takes priors; hosts weigh alike, so that a very large one does not set its own prior."""
    kind = f"decimal({DIGITS + 1},{DIGITS})"
    n = F.col("documents").cast("decimal(19,0)")
    rates = {r.name: (F.col(r.name).cast("decimal(19,0)") / n).cast(kind) for r in rules}
    sums = [F.sum(x).alias(f"{r}_1") for r, x in rates.items()] + [F.sum(x * x).alias(f"{r}_2") for r, x in rates.items()]
    return [F.count("*").alias("hosts"), F.sum((F.lit(1).cast("decimal(19,0)") / n).cast(kind)).alias("inverse"), *sums]


def strength(hosts: int, inverse: float, rates: float, squares: float) -> tuple[float, float]:
    """(mean, a + b) of the beta prior from sums over hosts: 1 / documents, rates, rates^2.

    A rate spreads by ``mean (1 - mean) (1 / n + (1 - 1 / n) rho)`` with ``rho = 1 / (a + b + 1)``. a + b is infinite if hosts differ by no more
    than chance does, or if there is one only.
    """
    if not hosts:
        return 0.0, float("inf")
    mean, chance = rates / hosts, inverse / hosts
    within = mean * (1 - mean)
    if hosts < 2 or within <= 0 or chance >= 1:
        return mean, float("inf")
    spread = (squares - hosts * mean * mean) / (hosts - 1)
    rho = (spread / within - chance) / (1 - chance)
    return mean, max(1 / min(rho, 1.0) - 1, 0.0) if rho > 0 else float("inf")


def verdicts(hosts: DataFrame, rules: tuple[Rule, ...] = RULES, limit: float = LIMIT) -> DataFrame:
    """``host_counts`` plus the shrunk rate ``<rule>_rate`` of each rule and ``host_rejected``."""
    total = hosts.agg(*moments(hosts, rules)).first()
    rates = []
    for r in rules:
        mean, weight = strength(total["hosts"], *[float(total[c] or 0) for c in ("inverse", f"{r.name}_1", f"{r.name}_2")])
        pooled = F.lit(mean) if weight == float("inf") else (F.col(r.name) + F.lit(mean * weight)) / (F.col("documents") + F.lit(weight))
        rates.append(pooled.alias(f"{r.name}_rate"))
    judged = hosts.select("*", *rates)
    return judged.withColumn("host_rejected", F.greatest(*[F.col(f"{r.name}_rate") for r in rules], F.lit(0.0)) >= limit)


def judge(docs: DataFrame, host: str = "source", text: str = "text", rules: tuple[Rule, ...] = RULES, limit: float = LIMIT) -> DataFrame:
    """``docs`` without ``text`` plus ``NUMBERS``, ``base_failed``, ``host_rejected`` and ``kept``."""
    plain = docs.drop(*[c for c in ("base_failed", "host_rejected", "kept") if c not in (host, text)])
    scanned = cut_lineage(with_numbers(plain, text), "rule-numbers")
    found = verdicts(host_counts(scanned, host, rules), rules, limit).select(F.col("host").alias("__host"), "host_rejected")
    bad = cut_lineage(found.where("host_rejected"), "rejected-hosts")
    own = F.lit(False)
    for r in rules:
        own = own | F.expr(r.fails) if r.base else own
    keyed = scanned.withColumn("__host", F.col(host))
    joined = attach(keyed, bad, ["__host"], F.struct(*[F.col(n) for n in NUMBERS]), "left").drop("__host")
    rejected = F.coalesce("host_rejected", F.lit(False))
    return joined.withColumn("host_rejected", rejected).withColumn("base_failed", own).withColumn("kept", ~F.col("base_failed") & ~rejected)
