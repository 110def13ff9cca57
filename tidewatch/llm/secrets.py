"""Secret scanning with an incremental ledger of content-addressed blobs.

Every version of a text is addressed by its SHA-256. The ledger is a Parquet table with one row for each
(blob, rule version) that was scanned, found spans or not; a run scans only pairs that are not in it, so
a copy, a moved file or an unchanged version costs nothing, and a changed rule is run alone over old blobs.
Findings are joined back to every row that holds the blob. Each blob is read from one of its rows: the
join that picks it is on the row's key and the address, so a blob held by a third of the rows moves once.

Built-in functions only. Spans come from the pieces between matches and the matches themselves: the pattern
splits the text, and running sums of both lengths are the offsets.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import cut_lineage, text_or_empty


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds; a match counts if ``group`` of it has ``least`` characters or more."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: Fixed by the contract. A run that is bounded by the characters of its own class can take its least length
#: into the pattern: what is shorter fails as a whole, wherever it begins.
BASE_RULES = (
    Rule("assign", 1, r"""((?i)(?:password|passwd|secret|token|api_?key)(?-i)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"(AKIA[A-Z0-9]{16,})", 0, 20),
    Rule("hex", 1, r"([0-9a-f]{24,})", 0, 24),
)

SPANS = "array<struct<start:int,end:int>>"
#: Matches whose offsets are summed by themselves before their place in the text is added: appending to one long array would
#: cost the square of the matches.
CHUNK = 128


def spans(text: Column, rule: Rule) -> Column:
    """Half-open code point ranges of the matches of ``rule``, leftmost and non-overlapping."""
    pattern = F.lit(rule.pattern)
    pieces = F.transform(F.split(text, rule.pattern, -1), F.length)
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    judged = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length) if rule.group else whole
    none = F.array().cast(SPANS)
    start = F.struct(F.lit(0).alias("at"), none.alias("found"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + x["gap"]
        end = begin + x["whole"]
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(x["judged"] >= rule.least, F.concat(state["found"], span)).otherwise(state["found"]).alias("found"))

    # The piece after the last match has no match beside it.
    matches = F.filter(F.arrays_zip(pieces.alias("gap"), whole.alias("whole"), judged.alias("judged")), lambda x: x["whole"].isNotNull())

    def chunks(held: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(held), F.lit(CHUNK)), lambda first: F.aggregate(F.slice(held, first, F.lit(CHUNK)), start, step))

    # An array of one element binds the matches to a name: they are found once, not once a chunk.
    summed = F.get(F.transform(F.array(matches), chunks), 0)

    def place(state: Column, chunk: Column) -> Column:
        moved = F.transform(chunk["found"], lambda s: F.struct((s["start"] + state["at"]).alias("start"), (s["end"] + state["at"]).alias("end")))
        return F.struct((state["at"] + chunk["at"]).alias("at"), F.concat(state["found"], F.array(moved)).alias("found"))

    whole_text = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPANS}>").alias("found"))
    return F.when(text.rlike(rule.pattern), F.aggregate(summed, whole_text, place, lambda s: F.flatten(s["found"]))).otherwise(none)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """What was scanned so far: blob, rule, spans."""
    schema = f"blob binary, rule string, spans {SPANS}"
    return spark.read.schema(schema).parquet(path).dropDuplicates(["blob", "rule"])


def scan(versions: DataFrame, ledger: str, rules: Sequence[Rule] = BASE_RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Scan what ``ledger`` has not seen, append it, and return ``key`` and ``blob`` of every row.

    NULL text is empty. An empty table leaves the ledger as it is. A run that dies before its append is
    committed leaves no rows behind and the next one scans them.
    """
    spark = versions.sparkSession
    held = versions.select(F.col(key).alias("key"), text_or_empty(text).alias("text"))
    address = F.unhex(F.sha2(F.col("text"), 256))
    rows = cut_lineage(held.select("key", address.alias("blob")), "versions")
    once = rows.groupBy("blob").agg(F.min("key").alias("key"))
    spark.createDataFrame([], f"blob binary, rule string, spans {SPANS}").write.mode("append").parquet(ledger)
    seen = read_ledger(spark, ledger).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    todo = once.join(seen, "blob", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
    todo = todo.where(F.size(F.array_except(F.array(*[F.lit(r.key) for r in rules]), "seen")) > 0)
    todo = todo.select(F.col("key").alias("at"), F.col("blob").alias("todo"), "seen")
    # The side without texts is hashed; texts are moved once and never sorted.
    texts = held.withColumn("blob", address).join(
        todo.hint("shuffle_hash"), F.col("key").eqNullSafe(F.col("at")) & (F.col("blob") == F.col("todo"))
    )
    each = [F.when(~F.array_contains("seen", r.key), F.struct(F.lit(r.key).alias("rule"), spans(F.col("text"), r).alias("spans"))) for r in rules]
    found = texts.select("blob", F.explode(F.filter(F.array(*each), lambda x: x.isNotNull())).alias("x"))
    found.select("blob", "x.rule", "x.spans").write.mode("append").parquet(ledger)
    return rows.withColumnRenamed("key", key)


def findings(rows: DataFrame, ledger: str, rules: Sequence[Rule] = BASE_RULES, key: str = "doc_id") -> DataFrame:
    """Every row of ``rows`` (``key``, ``blob``) with one array of spans per rule, named by its kind."""
    known = read_ledger(rows.sparkSession, ledger).where(F.col("rule").isin([r.key for r in rules]) & (F.size("spans") > 0))
    by_blob = known.groupBy("blob").agg(*[F.first(F.when(F.col("rule") == r.key, F.col("spans")), True).alias(r.kind) for r in rules])
    none = F.array().cast(SPANS)
    return rows.join(by_blob, "blob", "left").select(key, "blob", *[F.coalesce(r.kind, none).alias(r.kind) for r in rules])


def joined_spans(rules: Sequence[Rule]) -> Column:
    """``kind:start:end`` of all spans by start, then kind as listed, joined by commas."""

    def placed(i: int, r: Rule) -> Column:
        return F.transform(r.kind, lambda s: F.struct(s["start"].alias("start"), F.lit(i).alias("at"), s["end"].alias("end"), F.lit(r.kind).alias("kind")))

    parts = [placed(i, r) for i, r in enumerate(rules)]
    ordered = F.array_sort(F.concat(*parts))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
