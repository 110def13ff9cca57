"""Entity-history features: rolling counts and amounts, time since the previous event, velocity.

A plain range window per entity would sort one hot entity in one task and re-scan the frame for
every row.  Two things avoid that:

* events of an entity in the same second collapse first, so a hot entity shrinks to its seconds;
* a window of W seconds is answered from blocks of W + 1 seconds: everything from the start of the
  row's block up to the row, plus the tail of the block before.  Both parts are running aggregates
  over one block, so work is linear and a hot entity spreads over its blocks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.columns import great_circle_km
from tidewatch.functions.stats import safe_ratio

DAY = 86_400


def epoch_seconds(ts: Column | str) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_seconds(c.cast("timestamp"))


def rolling_by_second(df: DataFrame, entity: str, ts: str, amount: str, spans: Mapping[str, int]) -> DataFrame:
    """(entity, second, <name>_count, <name>_sum, <name>_max) over ``[second - span, second]``.

    One row per entity and second; ``spans`` maps a name to its length in seconds.
    """
    per_second = (
        df.select(F.col(entity).alias("entity"), epoch_seconds(ts).alias("second"), F.col(amount).cast("double").alias("amount"))
        .groupBy("entity", "second")
        .agg(F.count("*").alias("n"), F.sum("amount").alias("total"), F.max("amount").alias("top"))
    )
    span = F.explode(F.array(*[F.struct(F.lit(i).alias("id"), F.lit(int(w)).alias("w")) for i, w in enumerate(spans.values())]))
    spread = per_second.select("*", span.alias("s"))
    length = F.col("s.w") + 1
    block = F.floor(F.col("second") / length)
    own = F.struct(
        block.alias("block"), F.col("second").alias("at"), F.lit(False).alias("probe"),
        F.col("n"), F.col("total"), F.col("top"),
    )
    # A probe sits in the block before and asks for everything from (second - span) on.
    probe = F.struct(
        (block - 1).alias("block"), (F.col("second") - F.col("s.w")).alias("at"), F.lit(True).alias("probe"),
        F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("total"), F.lit(None).cast("double").alias("top"),
    )
    rows = spread.select("entity", F.col("s.id").alias("span"), "second", F.explode(F.array(own, probe)).alias("e")).select(
        "entity", "span", "second", "e.*"
    )
    keys = ["entity", "span", "block"]
    forward = Window.partitionBy(*keys).orderBy("at", "probe").rowsBetween(Window.unboundedPreceding, 0)
    backward = Window.partitionBy(*keys).orderBy(F.desc("at"), F.asc("probe")).rowsBetween(Window.unboundedPreceding, 0)

    def pick(agg, column: str) -> Column:
        return F.when(F.col("probe"), agg(column).over(backward)).otherwise(agg(column).over(forward))

    parts = rows.select(
        "entity", "span", "second",
        pick(F.sum, "n").alias("n"), pick(F.sum, "total").alias("total"), pick(F.max, "top").alias("top"),
    )
    here = lambda i, c: F.when(F.col("span") == i, F.col(c))
    out = []
    for i, name in enumerate(spans):
        out += [
            F.sum(here(i, "n")).alias(f"{name}_count"),
            F.sum(here(i, "total")).alias(f"{name}_sum"),
            F.max(here(i, "top")).alias(f"{name}_max"),
        ]
    return parts.groupBy("entity", "second").agg(*out)


def entity_history(df: DataFrame, entity: str, ts: str, amount: str) -> DataFrame:
    """Rows plus 24-hour and 7-day counts, 30-day mean and maximum amount, and velocity score.

    Velocity is the 24-hour rate over the 7-day rate (our formula; 1.0 means steady activity).  A row
    without entity or time has no history: it is kept, with NULLs.
    """
    known = df.where(F.col(entity).isNotNull() & F.col(ts).isNotNull())
    rolled = rolling_by_second(known, entity, ts, amount, {"d1": DAY, "d7": 7 * DAY, "d30": 30 * DAY}).select(
        F.col("entity").alias("__e"),
        F.col("second").alias("__s"),
        F.col("d1_count").alias("num_transactions_24h"),
        F.col("d7_count").alias("num_transactions_7days"),
        (F.col("d30_sum") / F.col("d30_count")).alias("avg_transaction_amount_30days"),
        F.col("d30_max").alias("max_transaction_amount_30days"),
        safe_ratio(F.col("d1_count"), F.col("d7_count") / 7.0).alias("velocity_score"),
    )
    keyed = df.withColumn("__second", epoch_seconds(ts))
    matched = (keyed[entity] == rolled["__e"]) & (keyed["__second"] == rolled["__s"])
    return keyed.join(rolled, matched, "left").drop("__second", "__e", "__s")


def previous_in_entity(
    df: DataFrame, entity: str, ts: str, tie: str, columns: list[str], block_seconds: int = 3600
) -> DataFrame:
    """Add ``prev_<column>`` of the entity's previous event (by time, then ``tie``).

    The window runs inside an entity's time block; only the first event of a block looks up the last
    event of the entity's block before, from a table with one row per entity and block.  A row without
    entity or time has no previous event and is nobody's.
    """
    unknown = F.col(entity).isNull() | F.col(ts).isNull()
    kinds = {f.name: f.dataType for f in df.schema.fields}
    aside = df.where(unknown).select(*df.columns, *[F.lit(None).cast(kinds[c]).alias(f"prev_{c}") for c in columns])
    blocked = df.where(~unknown).withColumn("__block", F.floor(epoch_seconds(ts) / block_seconds))
    inside = Window.partitionBy(entity, "__block").orderBy(ts, tie)
    payload = F.struct(*columns)
    local = blocked.withColumn("__prev", F.lag(payload).over(inside))
    last = blocked.groupBy(entity, "__block").agg(F.max_by(payload, F.struct(ts, tie)).alias("__last"))
    across = Window.partitionBy(entity).orderBy("__block")
    carried = last.select(
        F.col(entity).alias("__e"), F.col("__block").alias("__b"), F.lag("__last").over(across).alias("__carried")
    )
    joined = local.join(carried, (local[entity] == carried["__e"]) & (local["__block"] == carried["__b"]), "left")
    previous = F.coalesce("__prev", "__carried")
    found = joined.select(*df.columns, *[previous.getField(c).alias(f"prev_{c}") for c in columns])
    return found.unionByName(aside)


def minutes_since_previous(df: DataFrame, entity: str, ts: str, tie: str) -> DataFrame:
    prior = previous_in_entity(df, entity, ts, tie, [ts])
    gap = (epoch_seconds(ts) - epoch_seconds(f"prev_{ts}")) / 60.0
    return prior.withColumn("time_since_last_transaction_min", gap).drop(f"prev_{ts}")


def calendar_features(df: DataFrame, ts: str, account_start: str | None = None) -> DataFrame:
    """Hour, ISO day of week (Monday = 1), and days and months since ``account_start``."""
    out = df.withColumn("transaction_hour", F.hour(ts)).withColumn(
        "transaction_day_of_week", F.weekday(ts) + 1
    )
    if account_start:
        age = F.datediff(F.to_date(F.col(ts)), F.to_date(F.col(account_start)))
        out = out.withColumn("account_age_days", age).withColumn("customer_tenure_months", F.floor(age / 30).cast("int"))
    return out


def travel_features(
    df: DataFrame, entity: str, ts: str, tie: str, lat: str, lon: str, home_lat: str, home_lon: str
) -> DataFrame:
    """Distance from home and from the entity's previous event, in km."""
    prior = previous_in_entity(df, entity, ts, tie, [lat, lon])
    c = F.col
    return prior.select(
        *df.columns,
        great_circle_km(c(lat), c(lon), c(home_lat), c(home_lon)).alias("distance_from_home_km"),
        great_circle_km(c(lat), c(lon), c(f"prev_{lat}"), c(f"prev_{lon}")).alias("distance_from_last_transaction_km"),
    )
