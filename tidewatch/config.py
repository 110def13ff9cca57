"""Schema configuration: which column plays which role."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field

from pyspark.sql import types as T

# The type names a schema document may use (timestamp_ntz: internal log tables).
TYPE_NAMES = {
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def spark_type(name: str) -> T.DataType:
    try:
        return TYPE_NAMES[name]
    except KeyError:
        raise ValueError(f"unsupported column type {name!r}; expected one of {sorted(TYPE_NAMES)}") from None


@dataclass(frozen=True)
class FeatureSchema:
    """Roles and types of a labelled feature table.

    ``features`` and ``auxiliary`` are ordered ``(name, type name)`` pairs; the order is the
    model's order and nothing else may re-derive it.
    """

    identifier: str
    target: str
    features: tuple[tuple[str, str], ...]
    timestamp: str | None = None
    target_type: str = "boolean"
    auxiliary: tuple[tuple[str, str], ...] = ()
    split_strategy: str = "deterministic_hash"
    train_ratio: float = 0.8
    split_column: str | None = None
    _types: dict[str, str] = field(init=False, repr=False, compare=False, hash=False)

    def __post_init__(self) -> None:
        types = {self.identifier: "string", **dict(self.features), **dict(self.auxiliary), self.target: self.target_type}
        for name in types.values():
            spark_type(name)
        object.__setattr__(self, "_types", types)

    @property
    def feature_names(self) -> list[str]:
        return [n for n, _ in self.features]

    @property
    def numeric_features(self) -> list[str]:
        return [n for n, t in self.features if t != "string"]

    @property
    def categorical_features(self) -> list[str]:
        return [n for n, t in self.features if t == "string"]

    @property
    def hash_column(self) -> str:
        return self.split_column or self.identifier

    def column_order(self) -> list[str]:
        """Canonical order: identifier, features, auxiliary, target."""
        return [self.identifier, *self.feature_names, *(n for n, _ in self.auxiliary), self.target]

    def type_of(self, column: str) -> str:
        return self._types[column]

    def struct(self, columns: list[str] | None = None) -> T.StructType:
        return T.StructType([T.StructField(c, spark_type(self._types[c])) for c in columns or self.column_order()])

    def string_struct(self) -> T.StructType:
        """All-text staging layout in canonical order."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.column_order()])


def schema_from_dict(document: dict) -> FeatureSchema:
    if "dataset" not in document:
        raise ValueError("schema document has no 'dataset' section")
    d = document["dataset"]
    split = d.get("split") or {}

    def pairs(items):
        return tuple((i["name"], i["type"]) for i in items or [])

    return FeatureSchema(
        identifier=d["identifier_column"],
        timestamp=d.get("timestamp_column"),
        target=d["target_column"],
        target_type=d.get("target_type", "boolean"),
        features=pairs(d["features"]),
        auxiliary=pairs(d.get("auxiliary_columns")),
        split_strategy=split.get("strategy", "deterministic_hash"),
        train_ratio=float(split.get("train_ratio", 0.8)),
        split_column=split.get("hash_column"),
    )


def load_schema(path: str) -> FeatureSchema:
    """Read a schema document (JSON, or YAML where a YAML reader is installed)."""
    if not os.path.exists(path):
        raise FileNotFoundError(path)
    with open(path, encoding="utf-8") as handle:
        text = handle.read()
    if path.endswith(".json"):
        return schema_from_dict(json.loads(text))
    try:
        import yaml
    except ImportError as exc:  # pragma: no cover - depends on the environment
        raise RuntimeError("reading a YAML schema needs a YAML reader; use JSON instead") from exc
    return schema_from_dict(yaml.safe_load(text) or {})
