from __future__ import annotations

import pytest

from tidewatch.llm.common import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def documents(spark, sf_dir) -> list[tuple[int, str]]:
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return [(r["doc_id"], r["text"]) for r in rows]


@pytest.fixture(scope="session")
def make(spark, tmp_path_factory):
    """A stored documents table with all its columns, and one that clashes, from (doc_id, text, source)."""

    def build(rows, folder=None):
        path = folder or str(tmp_path_factory.mktemp("docs"))
        full = [(d, t, "en", s, None, "x", 1, 2) for d, t, s in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, shard string, size int, fp0 int"
        spark.createDataFrame(full, schema).write.mode("overwrite").parquet(f"{path}/documents.parquet")
        return path

    return build
