"""Deterministic sampling and splitting by hash of a key: the same rows on every run and retry."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.columns import hash_bucket
from tidewatch.operators import windows


def sample_order(key: str, seed: int = 0) -> Column:
    """Pseudo-random order of rows that depends only on key and seed."""
    return F.md5(F.concat_ws("-", F.lit(str(seed)), F.col(key).cast("string")))


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """A random-looking sample of n rows: the n smallest key hashes (a top-n, no global sort)."""
    return df.orderBy(sample_order(key, seed), key).limit(n)


def newest(df: DataFrame, ts: str, n: int, tie: str) -> DataFrame:
    return df.orderBy(F.desc(ts), tie).limit(n)


def top_k(df: DataFrame, metric: str, k: int, tie: str) -> DataFrame:
    return df.orderBy(F.desc(metric), tie).limit(k)


def with_split(df: DataFrame, key: Column | str, train_ratio: float = 0.8, buckets: int = 10) -> DataFrame:
    """Add ``split`` = train / eval by hash bucket of the key."""
    return df.withColumn(
        "split", F.when(hash_bucket(key, buckets) < round(train_ratio * buckets), "train").otherwise("eval")
    )


def stratified_split(df: DataFrame, key: Column | str, label: str, test_ratio: float = 0.2) -> DataFrame:
    """Add ``split``; the hash is salted with the label so each class is cut on its own."""
    k = F.concat_ws("-", F.col(label).cast("string"), F.col(key).cast("string") if isinstance(key, str) else key.cast("string"))
    return df.withColumn("split", F.when(hash_bucket(k, 1000) < round(test_ratio * 1000), "test").otherwise("train"))


def stratified_pull(df: DataFrame, key: str, label: str, n: int, minimum: int = 100, seed: int = 0) -> DataFrame:
    """Half positives, half negatives (each at least minimum / 2), by hash order."""
    half = max(minimum // 2, n // 2)
    positives = hash_sample(df.where(F.col(label).cast("int") == 1), key, half, seed)
    negatives = hash_sample(df.where(F.col(label).cast("int") == 0), key, half, seed)
    return positives.unionByName(negatives)


def stratified_fraction(df: DataFrame, key: str, label: str, fractions: dict, seed: int = 42) -> DataFrame:
    """Sample with one fraction per class by hash of the key; classes without a fraction are left out."""
    place = hash_bucket(F.concat_ws("-", F.lit(str(seed)), F.col(key).cast("string")), 10_000)
    limit = F.lit(0)
    for value, fraction in fractions.items():
        limit = F.when(F.col(label) == F.lit(value), round(fraction * 10_000)).otherwise(limit)
    return df.where(place < limit)


#: Leading hexadecimal digits of the key hash that are counted to find where a class is cut.
CUT_DIGITS = 4


def stratified_sample(df: DataFrame, key: str, label: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all, if fewer) in which classes have their shares: those of least key hash in each class.

    Shares are rounded by largest remainder, ties by the label; NULL is a class like any other.  Keys should tell rows apart.  A class
    is cut by counts of its hashes' leading digits, and only rows of the one cell that the cut falls in are ranked, so no
    class is ever sorted.  What is sent around is a row per class.
    """
    cell = F.substring(sample_order(key, seed), 1, CUT_DIGITS)
    marked = df.withColumn("__cell", cell).withColumn("__class", F.struct(F.col(label).alias("label")))
    counts = marked.groupBy("__class", "__cell").agg(F.count("*").alias("__n"))
    per_class = Window.partitionBy("__class")
    summed = counts.select(
        "__class", "__cell", "__n", F.sum("__n").over(per_class).alias("__size"),
        F.coalesce(F.sum("__n").over(per_class.orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"),
    )
    classes = counts.groupBy("__class").agg(F.sum("__n").alias("__size"))
    total = F.sum("__size").over(Window.partitionBy())
    wanted = F.least(total, F.lit(n))
    whole = F.floor(F.col("__size") * wanted / total)
    rest = F.pmod(F.col("__size") * wanted, total)
    shared = classes.select("__class", whole.alias("__whole"), rest.alias("__rest"), wanted.alias("__wanted"))
    by_rest = F.row_number().over(Window.partitionBy().orderBy(F.desc("__rest"), "__class"))
    missing = F.col("__wanted") - F.sum("__whole").over(Window.partitionBy())
    quotas = shared.select("__class", (F.col("__whole") + F.when(by_rest <= missing, 1).otherwise(0)).alias("__quota"))
    cut = summed.join(quotas, "__class").where("__before < __quota AND __before + __n >= __quota").select(
        "__class", F.col("__cell").alias("__cut"), (F.col("__quota") - F.col("__before")).alias("__take")
    )
    near = marked.join(F.broadcast(cut), "__class").where("__cell <= __cut")
    below = near.where("__cell < __cut").select(df.columns)
    ranked = near.where("__cell = __cut").withColumn("__rank", F.row_number().over(per_class.orderBy(sample_order(key, seed), key)))
    return below.unionByName(ranked.where("__rank <= __take").select(df.columns))


def split_statistics(df: DataFrame, label: str) -> DataFrame:
    """(split, class, n)."""
    return df.groupBy("split", F.col(label).cast("string").alias("class")).agg(F.count("*").alias("n"))


def since_last_run(df: DataFrame, ts: str, runs: DataFrame, endpoint: str, as_of: datetime | str, cold_start_hours: int = 24) -> DataFrame:
    """Rows of an endpoint newer than its last monitoring run, up to ``as_of``.

    Without an earlier run the last ``cold_start_hours`` are taken.  The boundary is a scalar subquery: it is known before the
    log is opened, so that it prunes days.
    """
    upper = F.lit(str(as_of)).cast("timestamp_ntz")
    last = runs.where(F.col("endpoint_name") == endpoint).where(F.col("monitoring_timestamp") < upper)
    bound = last.agg(
        F.coalesce(
            F.max("monitoring_timestamp").cast("timestamp_ntz"),
            upper - F.make_dt_interval(F.lit(0), F.lit(cold_start_hours)),
        ).alias("__after")
    )
    after = bound.scalar()
    rows = windows.until(df.where(F.col("endpoint_name") == endpoint), ts, upper)
    return rows.where(windows.days_between(df, ts, after, None) & (F.col(ts) > after))
