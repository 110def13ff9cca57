"""Schema document rules."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import types as T

from tidewatch.config import FeatureSchema, load_schema, schema_from_dict

DOCUMENT = {
    "dataset": {
        "identifier_column": "id", "timestamp_column": "ts", "target_column": "y",
        "auxiliary_columns": [{"name": "aux", "type": "double"}],
        "features": [{"name": "b", "type": "double"}, {"name": "a", "type": "string"}, {"name": "n", "type": "int"}],
        "split": {"strategy": "deterministic_hash", "train_ratio": 0.7, "hash_column": "other"},
    }
}


def test_order_and_types():
    s = schema_from_dict(DOCUMENT)
    assert s.column_order() == ["id", "b", "a", "n", "aux", "y"]
    assert s.numeric_features == ["b", "n"] and s.categorical_features == ["a"]
    assert s.target_type == "boolean" and s.train_ratio == 0.7 and s.hash_column == "other"
    assert [f.dataType for f in s.struct().fields] == [
        T.StringType(), T.DoubleType(), T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
    ]


def test_defaults():
    d = {"dataset": {k: v for k, v in DOCUMENT["dataset"].items() if k not in ("auxiliary_columns", "split")}}
    s = schema_from_dict(d)
    assert s.auxiliary == () and s.train_ratio == 0.8 and s.hash_column == "id" and s.split_strategy == "deterministic_hash"


def test_errors(tmp_path):
    with pytest.raises(FileNotFoundError):
        load_schema(str(tmp_path / "missing.json"))
    path = tmp_path / "s.json"
    path.write_text(json.dumps({"other": 1}))
    with pytest.raises(ValueError, match="dataset"):
        load_schema(str(path))
    with pytest.raises(ValueError, match="unsupported column type"):
        FeatureSchema("id", "y", (("x", "decimal"),))


def test_json_and_yaml_agree(tmp_path):
    yaml = pytest.importorskip("yaml")
    j, y = tmp_path / "s.json", tmp_path / "s.yaml"
    j.write_text(json.dumps(DOCUMENT))
    y.write_text(yaml.safe_dump(DOCUMENT))
    assert load_schema(str(j)) == load_schema(str(y))
