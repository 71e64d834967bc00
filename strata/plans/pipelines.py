"""End-to-end pipelines: API ingest, file ingest, training (one call each)."""

from __future__ import annotations

import hashlib
import json
import uuid
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import ml
from strata.operators.tables import append_run, drop_table, ensure_schema_of, upsert, write_full, write_observed
from strata.session import scratch_dir
from strata.sources.fetch import NOT_FOUND, fetch_all
from strata.sources.ids import cap_ids, check_cap
from strata.sources.files import read_files, read_table, with_provenance
from strata.sources.transport import Transport


#: Of an object's versions: an answer (a body, or that it does not exist) before a failed attempt, then the newest.
BRONZE_ORDER = [f"coalesce(http_status = 200 AND raw_json IS NOT NULL OR error_message = '{NOT_FOUND}', false)", "ingested_at"]


def run_api_ingest(spark: SparkSession, ids: DataFrame, transport: Transport, table: str,
                   rate_per_sec: float | None = None, partitions: int | None = None, key_type: str = "bigint",
                   runs_table: str | None = None, run_name: str = "api_ingest", sleep=None,
                   max_objects: int | None = None, min_success_ratio: float | None = None,
                   mode: str = "overwrite") -> dict:
    """ids -> (cap) -> fetch -> Bronze table, counts observed during the fetch's single write.

    ``mode="overwrite"`` replaces Bronze (a full pull). ``mode="upsert"``
    merges the fetched rows into Bronze on ``object_id`` (incremental pulls):
    the newest answer wins, and a failed attempt replaces only an older one. No ids: the table is left
    untouched and the run is recorded as skipped (W7). With
    ``min_success_ratio`` Bronze changes only if enough rows succeeded.

    List calls and fetches are remote calls, so either runs in exactly one
    action: the ids are written to the shared folder first, and the fetch is
    either the direct Bronze write or a write to a stage table of this run's
    own that later steps (gate, upsert) read as often as they need.
    """
    if mode not in ("overwrite", "upsert"):
        raise ValueError("mode must be 'overwrite' or 'upsert'")
    check_cap(max_objects)
    listed = scratch_dir(spark, "ids")
    ids.write.parquet(listed)
    ids = cap_ids(spark.read.schema(ids.schema).parquet(listed), max_objects)
    if ids.isEmpty():
        rec = {"rows": 0, "skipped": True, "table": table}
    else:
        ensure_schema_of(spark, table)
        bronze = fetch_all(ids, transport, rate_per_sec, partitions, key_type=key_type, sleep=sleep)
        ok = F.col("http_status") == 200
        if min_success_ratio is None and mode == "overwrite":
            rec = write_observed(bronze, table, ok_expr=ok)
        else:
            stage = f"{table}__fetched_{uuid.uuid4().hex[:12]}"
            rec = write_observed(bronze, stage, ok_expr=ok)      # the only action that fetches
            rec["table"] = table
            ratio = rec["success"] / rec["rows"] if rec["rows"] else 0.0
            if min_success_ratio is not None:
                rec["success_ratio"] = ratio
            try:
                if min_success_ratio is not None and ratio < min_success_ratio:
                    rec["gated"] = True
                elif mode == "overwrite":
                    write_full(spark.table(stage), table)
                else:
                    upsert(spark, spark.table(stage), table, ["object_id"], BRONZE_ORDER)
            finally:
                drop_table(spark, stage)
    if runs_table:
        append_run(spark, runs_table, run_name, rec)
    return rec


def run_configured_ingest(spark: SparkSession, cfg, ids: DataFrame, transport: Transport | None = None,
                          sleep=None) -> dict:
    """``run_api_ingest`` driven by an ``IngestConfig`` (HTTP transport by default)."""
    from strata.sources.transport import HttpTransport

    t = transport or HttpTransport(cfg.detail_url, cfg.list_url, cfg.headers)
    return run_api_ingest(spark, ids, t, cfg.table, cfg.rate_per_sec, cfg.partitions, cfg.key_type,
                          cfg.runs_table, cfg.name, sleep, cfg.max_objects, cfg.min_success_ratio)


def run_file_ingest(spark: SparkSession, prefix: str, table: str, pattern: str = "*.csv", fmt: str = "csv",
                    options: dict | None = None, schema=None, max_files: int | None = None,
                    runs_table: str | None = None) -> dict:
    """Files -> provenance columns -> optional file cap -> Bronze table."""
    df = with_provenance(read_files(spark, prefix, pattern, fmt, options, schema, max_files))
    ensure_schema_of(spark, table)
    rec = write_observed(df, table)
    rec["source"] = f"{prefix.rstrip('/')}/{pattern}"
    if runs_table:
        append_run(spark, runs_table, "file_ingest", rec)
    return rec


def run_id_for(*parts) -> str:
    """Deterministic run id from the run's inputs (same inputs, same id)."""
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()[:32]


def run_training(spark: SparkSession, source: DataFrame | str, label: str, keys: Sequence[str],
                 features: Sequence[str] | None = None, test_size: float = 0.2, seed: int = 42,
                 max_rows: int | None = None, predictions_table: str | None = None,
                 runs_table: str | None = None, model_path: str | None = None, name: str | None = None) -> dict:
    """Split -> fit -> score test rows -> metrics -> predictions table and run record."""
    df = read_table(spark, source, max_rows, order_by=list(keys)) if isinstance(source, str) else source
    feats = list(features) if features else ml.split_label(df, label, exclude=keys)
    train_df, test_df = ml.split(df, keys, test_size, seed)
    model = ml.train(train_df, feats, label)
    name = name or (source if isinstance(source, str) else "frame")
    run_id = run_id_for(name, feats, label, test_size, seed, max_rows)
    pred = ml.score(model, test_df, feats, label, keep=keys, run_id=run_id)
    if predictions_table:      # scored once, by this write; the metrics read what it wrote
        ensure_schema_of(spark, predictions_table)
        write_full(pred.select("predicted", "actual", "run_id", *keys), predictions_table)
        pred = spark.table(predictions_table)
    m = ml.regression_metrics(pred).first()
    number = lambda x: None if x is None else float(x)  # noqa: E731  no test row has both values
    rec = {"run_id": run_id, "rmse": number(m["rmse"]), "r2": number(m["r2"]), "n_test": int(m["n"]),
           "n_unscored": int(m["n_unscored"]), "n_train": model.n_rows, "n_train_dropped": model.n_dropped,
           "features": feats, "label": label, "coefficients": [float(c) for c in model.coefficients],
           "intercept": float(model.intercept)}
    if predictions_table:
        rec["predictions_table"] = predictions_table
    if model_path:
        ml.save_model(model, model_path)
        rec["model_path"] = model_path
    if runs_table:
        append_run(spark, runs_table, "training", {"table": predictions_table, **rec}, run_id=run_id)
    return rec
