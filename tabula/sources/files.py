"""Sources and sinks (O-01..O-04, O-07): CSV/TSV tables, fitted-parameter tables, models.

Paths are folders on shared storage; scratch output for tests and bindings goes
under ``spark.checkpoint.dir`` (the cluster's shared folder), never a
machine-local temporary folder.
"""

from __future__ import annotations

import json

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def csv_scan(spark: SparkSession, path: str, schema: T.StructType | str | None = None, sep: str = ",") -> DataFrame:
    """O-01: header CSV → table. With a schema, the header is checked against it
    (``enforceSchema=false``); without, types are inferred (a full extra pass)."""
    r = spark.read.option("header", True).option("sep", sep)
    if schema is not None:
        return r.schema(schema).option("enforceSchema", False).csv(path)
    return r.option("inferSchema", True).csv(path)


def csv_sink(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> str:
    """O-02: write a header CSV folder (one file per partition, no index column)."""
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)
    return path


def tsv_sink(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """O-03: tab-separated output."""
    return csv_sink(df, path, sep="\t", mode=mode)


def params_sink(params: DataFrame, path: str, fmt: str = "parquet") -> str:
    """O-04: persist a long fitted-parameter table (fold, column, stat/value columns)."""
    params.write.mode("overwrite").format(fmt).save(path)
    return path


def params_source(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None) -> DataFrame:
    """O-04: load a fitted-parameter table back."""
    r = spark.read.format(fmt)
    if schema:
        r = r.schema(schema)
    return r.load(path)


def fitted_sink(spark: SparkSession, fitted: dict, path: str) -> str:
    """O-04: persist everything a preprocessing fit returns, as a long table (section, position, key, value as JSON).

    Sections are lists (their order is kept) or dicts by column; sizes are bounded as the fit's literals are.
    """
    rows = []
    for section, content in fitted.items():
        kind = "list" if isinstance(content, list) else "dict"
        items = enumerate(content) if kind == "list" else content.items()
        rows.append((section, kind, -1, "", ""))  # keeps empty sections
        rows += [(section, kind, i, str(k), json.dumps(v)) for i, (k, v) in enumerate(items)]
    table = spark.createDataFrame(rows, "section string, kind string, position int, key string, value string")
    table.coalesce(1).write.mode("overwrite").parquet(path)
    return path


def fitted_source(spark: SparkSession, path: str) -> dict:
    """O-04: the fit that :func:`fitted_sink` has stored."""
    out: dict = {}
    for r in spark.read.parquet(path).orderBy("section", "position").collect():
        content = out.setdefault(r["section"], [] if r["kind"] == "list" else {})
        if r["position"] < 0:
            continue
        if r["kind"] == "list":
            content.append(json.loads(r["value"]))
        else:
            content[r["key"]] = json.loads(r["value"])
    return out


def model_save(model, path: str) -> str:
    """O-07: save a fitted ``PipelineModel`` (or any MLWritable)."""
    model.write().overwrite().save(path)
    return path


def model_load(path: str):
    """O-07: load a saved ``PipelineModel``."""
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)
