"""Feature preparation: casts, encoders, payload parsing, projections, perturbation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.config import FeatureSchema
from tidewatch.functions.columns import FALSE_TOKENS, TRUE_TOKENS, hash_bucket, number_or_null, typed

# Columns that are never model inputs.
NON_FEATURES = (
    "transaction_id", "transaction_timestamp", "customer_id", "merchant_id", "card_number", "cvv", "expiry_date",
    "transaction_date", "year", "timestamp", "id", "data_version", "created_at", "updated_at", "fraud_prediction",
    "fraud_probability",
)
MAX_CATEGORIES = 10
PROBE_ROWS = 1000


def typed_table(staged: DataFrame, schema: FeatureSchema, strict: bool = True) -> DataFrame:
    """All-text rows to typed columns in canonical order."""
    return staged.select(*[typed(c, schema.type_of(c), strict) for c in schema.column_order()])


# -- encoders -------------------------------------------------------------------------------------


def category_profile(df: DataFrame, columns: Sequence[str], max_categories: int = MAX_CATEGORIES) -> DataFrame:
    """(column, n_categories, categories) of the string columns with at most ``max_categories`` values.

    The distinct pairs are counted first; only columns under the limit have their values listed, so
    the arrays are bounded by the limit.
    """
    lowered = df.select(*[F.lower(F.col(c)).alias(c) for c in columns])
    pairs = lowered.unpivot([], list(columns), "column", "category").where("category is not null").distinct()
    sizes = pairs.groupBy("column").agg(F.count("*").alias("n_categories"))
    few = sizes.where(F.col("n_categories") <= max_categories)
    # One row per column of the table: bounded by the schema.
    listed = pairs.join(F.broadcast(few), "column").groupBy("column", "n_categories").agg(
        F.sort_array(F.collect_list("category")).alias("categories")
    )
    return listed.select(
        "column",
        "n_categories",
        "categories",
        F.when(
            (F.col("n_categories") <= 2)
            & (F.size(F.array_except("categories", F.array(*map(F.lit, TRUE_TOKENS + FALSE_TOKENS)))) == 0),
            "boolean",
        )
        .otherwise("category")
        .alias("kind"),
    )


@dataclass(frozen=True)
class Encoders:
    """Fitted mapping per column; columns over the category limit are listed in ``skipped``."""

    booleans: tuple[str, ...] = ()
    categories: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    skipped: tuple[str, ...] = ()

    def column(self, name: str) -> Column:
        value = F.lower(F.col(name).cast("string"))
        if name in self.booleans:
            return F.when(value.isin(*TRUE_TOKENS), 1).otherwise(0)
        if name in self.categories:
            return self._code(value, self.categories[name])
        return F.col(name)

    @staticmethod
    def _code(value: Column, categories: Sequence[str]) -> Column:
        if not categories:
            return F.lit(-1)
        codes = F.create_map(*[F.lit(x) for i, c in enumerate(categories) for x in (c, i)])
        return F.coalesce(F.element_at(codes, value), F.lit(-1))

    def code(self, name: str, value: Column) -> Column:
        """Code of an already extracted text value of column ``name``."""
        return self._code(F.lower(value), self.categories[name])

    def transform(self, df: DataFrame) -> DataFrame:
        """Encode fitted columns, turn native booleans into 0/1, leave the rest."""
        kinds = dict(df.dtypes)
        return df.select(
            *[
                F.col(c).cast("int").alias(c) if kinds[c] == "boolean" else self.column(c).alias(c)
                for c in df.columns
            ]
        )


def fit_encoders(df: DataFrame, columns: Sequence[str] | None = None, max_categories: int = MAX_CATEGORIES) -> Encoders:
    """Fit on the training side only; the same object then encodes evaluation and live data.

    Collects at most (string columns x max_categories) short texts.
    """
    names = list(columns) if columns is not None else [c for c, t in df.dtypes if t == "string"]
    if not names:
        return Encoders()
    # A column with too many values among a few rows has too many in the table: no need to shuffle it.
    few = df.limit(PROBE_ROWS).agg(*[F.countDistinct(F.lower(F.col(n))).alias(n) for n in names]).first()
    kept = [n for n in names if few[n] <= max_categories]
    rows = category_profile(df, kept, max_categories).collect() if kept else []
    found = {r["column"]: r for r in rows}
    return Encoders(
        booleans=tuple(c for c in names if c in found and found[c]["kind"] == "boolean"),
        categories={c: tuple(found[c]["categories"]) for c in names if c in found and found[c]["kind"] == "category"},
        skipped=tuple(c for c in names if c not in found),
    )


def encode_baseline(df: DataFrame, schema: FeatureSchema, encoders: Encoders) -> DataFrame:
    """Model features as numbers: fitted codes for categories, numeric parse (or NULL) for the rest.

    A text feature that has no code (``encoders.skipped``: too many values) is parsed like a number too, so
    it is NULL where it is text and drops out of checks that need values.
    """
    coded = {*encoders.booleans, *encoders.categories}
    return df.select(*[(encoders.column(n).cast("double") if n in coded else number_or_null(n)).cast("double").alias(n) for n, _ in schema.features])


# -- JSON payloads --------------------------------------------------------------------------------


def payload_features(df: DataFrame, payload: str, features: Sequence[str], keep: Sequence[str] = (), flag: str | None = None) -> DataFrame:
    """Declared features out of a JSON object column.

    Unknown keys drop, missing keys become NULL.  A row with a present but unparseable value, without
    any declared feature, or with malformed JSON is left out; with ``flag`` it stays, and that column
    tells whether the row is valid.
    """
    parsed = df.select(*keep, F.from_json(payload, "map<string,string>").alias("__m"))
    m = F.col("__m")
    # JSON true/false count as 1/0.
    raw = {f: F.element_at(m, F.lit(f)) for f in features}
    value = {
        f: F.when(v == "true", F.lit(1.0)).when(v == "false", F.lit(0.0)).otherwise(v.try_cast("double"))
        for f, v in raw.items()
    }
    present = [F.map_contains_key(m, F.lit(f)) for f in features]
    any_present = F.array_contains(F.array(*present), True)
    bad = F.array_contains(F.array(*[p & value[f].isNull() for f, p in zip(features, present)]), True)
    valid = F.coalesce(m.isNotNull() & any_present & ~bad, F.lit(False))
    if flag is not None:
        return parsed.select(*keep, *[value[f].alias(f) for f in features], valid.alias(flag))
    return parsed.where(valid).select(*keep, *[value[f].alias(f) for f in features])


def payload_numbers(
    df: DataFrame, payload: str, features: Sequence[str], encoders: Encoders, keep: Sequence[str] = ()
) -> DataFrame:
    """Scoring input from a JSON payload: numbers parse, known categories take their fitted code.

    Nested values and everything else become NULL; no row is dropped.
    """
    parsed = df.select(*keep, F.from_json(payload, "map<string,string>").alias("__m"))
    out = []
    for f in features:
        text = F.element_at("__m", F.lit(f))
        number = text.try_cast("double")
        if f in encoders.categories:
            nested = text.startswith("{") | text.startswith("[")
            code = F.when(text.isNotNull() & ~nested, encoders.code(f, text)).cast("double")
            number = F.coalesce(number, code)
        out.append(number.alias(f))
    return parsed.select(*keep, *out)


def pack_features(df: DataFrame, features: Sequence[str], into: str = "input_features") -> DataFrame:
    """Feature columns packed into one JSON text column."""
    return df.withColumn(into, F.to_json(F.struct(*features)))


# -- projections ----------------------------------------------------------------------------------


def training_projection(df: DataFrame, target: str, exclude: Sequence[str] = NON_FEATURES) -> DataFrame:
    """Target first, then all numeric columns that may be features; NULL becomes 0."""
    numeric = (T.NumericType, T.BooleanType)
    names = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, numeric) and f.name != target and f.name not in set(exclude)
    ]
    target_type = df.schema[target].dataType
    y = F.col(target) if isinstance(target_type, numeric) else F.col(target).cast("int")
    as_number = lambda c: F.col(c).cast("int") if isinstance(df.schema[c].dataType, T.BooleanType) else F.col(c)
    if isinstance(target_type, T.BooleanType):
        y = y.cast("int")
    return df.select(y.alias(target), *[as_number(c).alias(c) for c in names]).fillna(0)


def model_input(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Model features in model order; features the table lacks are 0.0."""
    have = set(df.columns)
    return df.select(*[F.col(f) if f in have else F.lit(0.0).alias(f) for f in features])


def rename_source(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def fill_missing(df: DataFrame, columns: Sequence[str], how: str = "zero") -> DataFrame:
    """Fill NULLs with 0, or with the mean or median of the column."""
    if how == "zero":
        return df.fillna(0, subset=list(columns))
    if how not in ("mean", "median"):
        raise ValueError(f"unknown fill {how!r}")
    from pyspark.ml.feature import Imputer

    doubles = df.withColumns({c: F.col(c).cast("double") for c in columns})
    return Imputer(inputCols=list(columns), outputCols=list(columns), strategy=how).fit(doubles).transform(doubles)


def non_null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n) of non-NULL values, one pass for all columns."""
    return df.agg(*[F.count(c).alias(c) for c in columns]).unpivot([], list(columns), "column", "n")


def drop_empty(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Drop features without any value, then rows without any feature."""
    counts = {r["column"]: r["n"] for r in non_null_counts(df, features).collect()}
    kept = [f for f in features if counts[f]]
    others = [c for c in df.columns if c not in set(features)]
    return df.select(*others, *kept).dropna("all", subset=kept)


# -- perturbation for detector back-tests ---------------------------------------------------------


def perturb(
    df: DataFrame,
    changes: Mapping[str, Mapping],
    seed: int = 42,
    non_negative: Sequence[str] = (),
    rounded: Sequence[str] = (),
    key: str | None = None,
) -> DataFrame:
    """Shift feature distributions: multiplicative ``factor`` or additive ``shift`` with uniform noise.

    The kind follows from the keys unless ``type`` names it; features the table lacks are skipped.  Noise is
    a hash of ``key`` and ``seed``, so it is the same on every run and retry.
    """
    out = df
    for i, (feature, change) in enumerate(changes.items()):
        if feature not in df.columns:
            continue
        kind = change.get("type") or ("multiplicative" if "factor" in change else "additive" if "shift" in change else None)
        if kind is None:
            continue
        noise = float(change.get("noise", 0))
        if noise and key is None:
            raise ValueError("noise needs a key to be drawn from")
        drawn = hash_bucket(F.concat_ws("-", F.lit(str(seed + i)), F.col(key).cast("string")), 1 << 20) if noise else F.lit(0)
        spread = drawn.cast("double") / (1 << 19) - 1 if noise else F.lit(0.0)
        x = F.col(feature)
        if kind == "multiplicative":
            factor = float(change.get("factor", 1.0))
            new = x * (F.lit(factor) + spread * (noise * factor))
        elif kind == "additive":
            new = x + (F.lit(float(change.get("shift", 0))) + spread * noise)
        else:
            raise ValueError(f"unknown drift type {kind!r}")
        if feature in non_negative:
            new = F.greatest(new, F.lit(0.0))
        if feature in rounded:
            new = F.bround(new)
        out = out.withColumn(feature, new)
    return out


def mean_shift(before: DataFrame, after: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, original_mean, drifted_mean, pct_change)."""
    def means(df: DataFrame, name: str) -> DataFrame:
        return df.agg(*[F.avg(f).alias(f) for f in features]).unpivot([], list(features), "feature", name)

    joined = means(before, "original_mean").join(means(after, "drifted_mean"), "feature")
    change = (F.col("drifted_mean") - F.col("original_mean")) / F.nullif(F.col("original_mean"), F.lit(0.0)) * 100
    return joined.select("*", F.coalesce(change, F.lit(0.0)).alias("pct_change"))
