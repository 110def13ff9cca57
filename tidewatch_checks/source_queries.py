"""Sources, sinks, catalog and lake state (A), each as a round trip over the given tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidewatch.operators import lineage, prep, sampling
from tidewatch.plans.scoring import with_scores
from tidewatch.session import scratch_path
from tidewatch.sources import catalog, lake, readers, writers
from tidewatch_checks.prep_queries import SPLIT
from tidewatch_checks.registry import check
from tidewatch_checks.tables import AS_OF, LINE_SCHEMA, NUMERIC, Tables


@check(
    "a1_table_read",
    "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 10",
    "l_quantity",
)
def table_read(t: Tables):
    return readers.read_table(t.spark, f"{t.sf_dir}/lineitem.parquet", ["l_orderkey", "l_quantity"], "l_returnflag = 'R' AND l_quantity > 10")


@check(
    "a1_log_window",
    """SELECT inference_id, request_timestamp, prediction, probability_fraud FROM pred
       WHERE request_timestamp >= TIMESTAMP '2024-01-10 06:00:00' AND request_timestamp < TIMESTAMP '2024-01-12' AND endpoint_name = 'ep-a'""",
    "probability_fraud",
)
def log_window(t: Tables):
    """Two of the log's days and one endpoint, out of its folders."""
    columns = ["inference_id", "request_timestamp", "prediction", "probability_fraud"]
    return readers.read_log(t.spark, t.by_day(t.pred, "log"), "2024-01-10 06:00:00", "2024-01-12 00:00:00", "ep-a", columns)


@check("a2_csv_read", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders", "o_totalprice")
def csv_read(t: Tables):
    path = scratch_path(t.spark, "orders-csv")
    orders = t.raw("orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    writers.export(orders, path, "csv")
    return readers.read_csv(t.spark, path, orders.schema)


@check("a3_staged_csv", "SELECT * FROM line_rows", " ".join(NUMERIC))
def staged_csv(t: Tables):
    path = scratch_path(t.spark, "staged-csv")
    writers.export(t.line_rows.select(*LINE_SCHEMA.column_order()), path, "csv")
    return prep.typed_table(readers.read_csv_staging(t.spark, path, LINE_SCHEMA), LINE_SCHEMA)


TRAIN_COLUMNS = ["is_returned", *NUMERIC, "l_linenumber"]


@check("a4_training_csv", "SELECT CAST(is_returned AS INTEGER) AS is_returned, l_quantity, l_extendedprice, l_discount, l_tax, l_linenumber FROM line_rows", " ".join(NUMERIC))
def training_csv(t: Tables):
    path = scratch_path(t.spark, "training-csv")
    rows = prep.training_projection(t.line_rows, "is_returned")
    order = writers.write_training_csv(t.line_rows, path, "is_returned")
    if order != TRAIN_COLUMNS[1:]:
        raise AssertionError(order)
    return readers.read_csv(t.spark, path, rows.schema, header=False)


@check(
    "a5_feature_metadata",
    """SELECT 'is_returned' AS target_column, 'l_quantity,l_extendedprice,l_discount,l_tax,l_linenumber' AS feature_names, 5 AS num_features, count(*) AS n FROM lineitem""",
)
def feature_metadata(t: Tables):
    path = scratch_path(t.spark, "metadata")
    writers.write_feature_metadata(t.spark, path, "is_returned", prep.training_projection(t.line_rows, "is_returned").columns[1:])
    meta = t.spark.read.json(path).select("target_column", F.array_join("feature_names", ",").alias("feature_names"), F.col("num_features"))
    return meta.crossJoin(t.line_rows.agg(F.count("*").alias("n")))


@check("a6_scoring_export", "SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus, l_linenumber FROM line_rows", " ".join(NUMERIC))
def scoring_export(t: Tables):
    path = scratch_path(t.spark, "scoring-jsonl")
    rows = t.line_rows.withColumnRenamed("row_id", "transaction_id")
    writers.export_for_scoring(rows, path, "is_returned")
    return t.spark.read.schema(writers.scoring_rows(rows, "is_returned").schema).json(path)


@check(
    "a7_exports",
    """SELECT format, l_returnflag, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem CROSS JOIN (VALUES ('parquet'), ('csv'), ('json')) f(format) GROUP BY ALL""",
    "quantity",
)
def exports(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_quantity", "l_returnflag")
    out = None
    for fmt in writers.FORMATS:
        path = scratch_path(t.spark, f"export-{fmt}")
        writers.export(rows, path, fmt, ["l_returnflag"])
        back = t.spark.read.schema(rows.schema).format(fmt).option("header", True).load(path)
        part = back.groupBy(F.lit(fmt).alias("format"), "l_returnflag").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))
        out = part if out is None else out.unionByName(part)
    return out


@check(
    "a8_time_slice",
    """SELECT event_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-15'""",
    "value",
)
def time_slice(t: Tables):
    return writers.time_slice(t.events, "ts", "2024-01-10 00:00:00", "2024-01-15 00:00:00", ["event_id", "value"])


@check(
    "a8_time_slice_text",
    """SELECT event_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-15'""",
    "value",
)
def time_slice_text(t: Tables):
    """The slice written as comma text and read back."""
    path = scratch_path(t.spark, "slice")
    writers.export_slice(t.events, "ts", "2024-01-10 00:00:00", "2024-01-15 00:00:00", ["event_id", "value"], path)
    return t.spark.read.schema("event_id long, value double").csv(path)


@check(
    "a9_append_and_overwrite",
    """SELECT endpoint_name, CAST(request_timestamp AS DATE) AS request_date, count(*) * 2 AS n, 0 AS replaced FROM pred
       WHERE CAST(request_timestamp AS DATE) < DATE '2024-01-15' GROUP BY ALL
       UNION ALL SELECT endpoint_name, CAST(request_timestamp AS DATE), count(*), 1 FROM pred WHERE CAST(request_timestamp AS DATE) >= DATE '2024-01-15' GROUP BY ALL""",
)
def append_and_overwrite(t: Tables):
    path = scratch_path(t.spark, "log")
    rows = t.pred.select(
        "inference_id", "prediction", "endpoint_name", F.to_date("request_timestamp").alias("request_date"), F.lit(0).alias("replaced")
    )
    keys = ["request_date", "endpoint_name"]
    writers.write_table(rows, path, "append", keys)
    writers.write_table(rows, path, "append", keys)
    late = rows.where(F.col("request_date") >= "2024-01-15").withColumn("replaced", F.lit(1))
    writers.write_table(late, path, "overwrite", keys)
    back = t.spark.read.parquet(path)
    return back.groupBy("endpoint_name", "request_date", "replaced").agg(F.count("*").alias("n"))


@check(
    "a10_created_tables",
    """SELECT 'training_data' AS "table", true AS present, count(*) AS n FROM training
       UNION ALL SELECT 'evaluation_data', true, 0 UNION ALL SELECT 'ground_truth', true, 0 UNION ALL SELECT 'drifted_data', true, 0
       UNION ALL SELECT 'inference_responses', true, count(*) FROM pred UNION ALL SELECT 'ground_truth_updates', true, count(*) FROM upd
       UNION ALL SELECT 'monitoring_responses', true, count(*) FROM runs""",
)
def created_tables(t: Tables):
    from tidewatch_checks.tables import PAYLOAD_SCHEMA

    location = scratch_path(t.spark, "warehouse")
    database = "tidewatch_" + location.rsplit("-", 1)[-1][:12]
    t.spark.sql(f"CREATE DATABASE {database} LOCATION '{location}'")
    catalog.create_all_tables(t.spark, database, PAYLOAD_SCHEMA, location)
    definitions = catalog.table_definitions(PAYLOAD_SCHEMA)
    dated = {
        "training_data": t.training,
        "inference_responses": t.pred.withColumn("request_date", F.to_date("request_timestamp")),
        "ground_truth_updates": t.upd.withColumn("confirmation_date", F.to_date("confirmation_timestamp")),
        "monitoring_responses": t.runs.withColumn("monitoring_date", F.to_date("monitoring_timestamp")),
    }
    for name, rows in dated.items():
        columns, partitions = definitions[name]
        have = set(rows.columns)
        shaped = rows.select(
            *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in columns.fields]
        )
        writers.write_table(shaped, f"{location}/{name}", "append", partitions)
        if partitions:
            t.spark.sql(f"MSCK REPAIR TABLE {database}.{name}")
        else:
            t.spark.catalog.refreshTable(f"{database}.{name}")
    return catalog.verify_tables(t.spark, database, PAYLOAD_SCHEMA)


@check(
    "a11_table_stats",
    """SELECT 'events' AS "table", count(*) AS n, 6 AS n_columns, min(ts) AS first, max(ts) AS last FROM events
       UNION ALL SELECT 'lineitem', count(*), 11, min(l_shipdate), max(l_shipdate) FROM lineitem
       UNION ALL SELECT 'orders', count(*), 6, min(o_orderdate), max(o_orderdate) FROM orders""",
)
def table_stats(t: Tables):
    parts = [catalog.table_stats(t.raw(n), n, ts) for n, ts in (("events", "ts"), ("lineitem", "l_shipdate"), ("orders", "o_orderdate"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@check(
    "a12_compaction",
    """SELECT endpoint_name, count(*) AS n, true AS fewer_files FROM pred GROUP BY 1""",
)
def compaction(t: Tables):
    path = scratch_path(t.spark, "small-files")
    rows = t.pred.select("inference_id", "request_timestamp", "endpoint_name")
    rows.repartition(8).write.partitionBy("endpoint_name").parquet(path)
    files = lambda: {r["endpoint_name"]: r["n"] for r in t.spark.read.parquet(path).groupBy("endpoint_name").agg(F.countDistinct("_metadata.file_path").alias("n")).collect()}
    before = files()
    lake.compact(t.spark, path, ["endpoint_name"])
    after = files()
    fewer = all(after[k] < before[k] for k in before)
    return t.spark.read.parquet(path).groupBy("endpoint_name").agg(F.count("*").alias("n"), F.lit(fewer).alias("fewer_files"))


@check(
    "a12_snapshot_expiry",
    "SELECT count(*) AS n, 1 AS expired, 1 AS orphans, 2 AS left_over FROM events",
)
def snapshot_expiry(t: Tables):
    root = scratch_path(t.spark, "lake")
    pinned = lake.snapshot(t.events, root, "events", "2024-01-01 00:00:00")
    lake.snapshot(t.events, root, "events", "2024-01-02 00:00:00")
    lake.snapshot(t.events, root, "events", "2024-01-30 00:00:00")
    t.events.write.parquet(f"{root}/events/snapshots/unlogged")
    expired = lake.expire_snapshots(t.spark, root, "events", datetime(2024, 1, 31), 7, [pinned])
    orphans = lake.vacuum(t.spark, root, "events")
    left = lake.child_folders(t.spark, f"{root}/events/snapshots")
    return lake.read_snapshot(t.spark, root, "events").agg(
        F.count("*").alias("n"), F.lit(len(expired)).alias("expired"), F.lit(len(orphans)).alias("orphans"), F.lit(len(left)).alias("left_over")
    )


@check(
    "a13_pinned_snapshot",
    """SELECT 'pinned' AS which, count(*) AS n, sum(l_quantity) AS quantity FROM base_side
       UNION ALL SELECT 'latest', count(*), sum(l_quantity) FROM both_sides""",
    "quantity",
)
def pinned_snapshot(t: Tables):
    root = scratch_path(t.spark, "lake")
    first = lake.snapshot(t.base_side, root, "training_data", "2024-01-01 00:00:00")
    lake.snapshot(t.base_side.unionByName(t.current_side), root, "training_data", "2024-01-02 00:00:00")
    stats = lambda which, df: df.agg(F.lit(which).alias("which"), F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))
    return stats("pinned", lake.read_snapshot(t.spark, root, "training_data", first)).unionByName(
        stats("latest", lake.read_snapshot(t.spark, root, "training_data"))
    )


def _responses(t: Tables, rows):
    return rows.select(
        F.col("inference_id").alias("row_key"),
        F.array("prediction").alias("predictions"),
        F.struct(F.array("probability_non_fraud").alias("non_fraud"), F.array("probability_fraud").alias("fraud")).alias("probabilities"),
        F.struct("model_version", "mlflow_run_id", "endpoint_name").alias("metadata"),
    )


@check(
    "a14_u3_batch_results",
    """SELECT inference_id, customer_id, prediction, probability_fraud, probability_non_fraud, model_version, mlflow_run_id, endpoint_name FROM pred""",
    "probability_fraud probability_non_fraud",
)
def batch_results(t: Tables):
    """Two result files, read together and attached by key."""
    paths = [scratch_path(t.spark, f"responses-{e}") for e in ("a", "b")]
    for endpoint, path in zip(("ep-a", "ep-b"), paths):
        _responses(t, t.pred.where(F.col("endpoint_name") == endpoint)).write.json(path)
    return readers.attach_responses(t.pred.select("inference_id", "customer_id"), readers.read_responses(t.spark, *paths), "inference_id")


@check(
    "a14_response_mismatch",
    """SELECT count(*) FILTER (endpoint_name = 'ep-b') AS inputs_without_response, 0 AS responses_without_input FROM pred""",
)
def response_mismatch(t: Tables):
    path = scratch_path(t.spark, "responses")
    _responses(t, t.pred.where(F.col("endpoint_name") == "ep-a")).write.json(path)
    return readers.response_mismatch(t.pred, readers.read_responses(t.spark, path), "inference_id")


@check(
    "a15_batch_log_rows",
    f"""SELECT md5('ep-a|{AS_OF}|' || inference_id) AS inference_id, TIMESTAMP '{AS_OF}' AS request_timestamp, 'ep-a-batch' AS endpoint_name, 'v2' AS model_version,
               'batch' AS inference_mode, prediction, probability_fraud, confidence_score, prediction_bucket,
               CAST(json_object('customer_id', customer_id) AS VARCHAR) AS input_features FROM pred""",
    "probability_fraud confidence_score",
)
def batch_log(t: Tables):
    scored = with_scores(t.pred.select("inference_id", "customer_id", "probability_fraud"))
    rows = writers.batch_log_rows(scored, ["customer_id"], "ep-a", "v2", "run-v2", AS_OF, key="inference_id")
    return rows.select(
        "inference_id", "request_timestamp", "endpoint_name", "model_version", "inference_mode", "prediction", "probability_fraud",
        "confidence_score", "prediction_bucket", "input_features",
    )


@check(
    "a16_appended_verdicts",
    """SELECT monitoring_run_id, endpoint_name, drifted_columns_share, current_roc_auc, data_drift_detected, CAST(monitoring_timestamp AS DATE) AS monitoring_date FROM runs""",
    "drifted_columns_share current_roc_auc",
)
def appended_verdicts(t: Tables):
    path = scratch_path(t.spark, "verdicts")
    writers.append_verdict(t.runs.where("endpoint_name = 'ep-a'"), path)
    writers.append_verdict(t.runs.where("endpoint_name <> 'ep-a'"), path)
    return t.spark.read.parquet(path).select(
        "monitoring_run_id", "endpoint_name", "drifted_columns_share", "current_roc_auc", "data_drift_detected", "monitoring_date"
    )


@check(
    "a17_seeding",
    f"""SELECT split, first, second, count(*) AS n FROM (SELECT *, {SPLIT} AS split, 'seeded' AS first, 'skipped' AS second FROM line_rows) GROUP BY ALL""",
)
def seeding(t: Tables):
    root = scratch_path(t.spark, "seed")
    rows = sampling.with_split(t.line_rows, "row_id")
    first = lake.seed_split(rows, root, "is_returned", "2024-01-01 00:00:00")
    second = lake.seed_split(rows, root, "is_returned", "2024-01-02 00:00:00")
    parts = [
        lake.read_snapshot(t.spark, root, name).agg(F.lit(split).alias("split"), F.lit(first).alias("first"), F.lit(second).alias("second"), F.count("*").alias("n"))
        for name, split in (("training_data", "train"), ("evaluation_data", "eval"))
    ]
    return parts[0].unionByName(parts[1])


@check(
    "c2_partition_rewrite",
    """SELECT inference_id, ground_truth, ground_truth_timestamp, endpoint_name, (SELECT count(*) FROM lab) AS changed FROM lpred""",
)
def partition_rewrite(t: Tables):
    path = scratch_path(t.spark, "log")
    rows = t.pred.withColumn("request_date", F.to_date("request_timestamp"))
    writers.write_table(rows, path, "append", ["request_date", "endpoint_name"])
    changed = lake.merge_labels_into(t.spark, path, t.known)
    return t.spark.read.parquet(path).select(
        "inference_id", "ground_truth", "ground_truth_timestamp", "endpoint_name", F.lit(changed).cast("bigint").alias("changed")
    )


@check("c5_run_membership", "SELECT inference_id, monitoring_run_id FROM tagged")
def run_membership(t: Tables):
    """Tags kept as an append-only table of windows and applied on read."""
    path = scratch_path(t.spark, "membership")
    lake.append_run_membership(lineage.run_windows(t.runs), path)
    return lineage.tag_runs(t.lpred, t.spark.read.parquet(path)).select("inference_id", "monitoring_run_id")
