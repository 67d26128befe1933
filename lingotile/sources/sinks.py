"""Sinks: vocabularies, tables, run summaries, models."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lingotile.operators.vocab import VOCAB_SCHEMA


def write_vocab(vocab: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Vocabulary table as parquet (range-partitioned by id: sorted files)."""
    vocab.repartitionByRange("id").sortWithinPartitions("id").write.mode(mode).parquet(path)


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(VOCAB_SCHEMA).parquet(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True).option("escape", '"')
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_run_summary(spark: SparkSession, path: str, args: dict, pipeline_info: dict,
                      history: DataFrame, evaluation: DataFrame | dict) -> None:
    """One JSON document: args, pipeline info, training history (lists per
    metric, epoch order) and evaluation.  Written as a single-row table; the
    history is tiny (one row per epoch)."""
    hist = history.orderBy("epoch").agg(
        F.collect_list("train_loss").alias("train_losses"),
        F.collect_list("val_loss").alias("val_losses"),
        F.collect_list("train_accuracy").alias("train_accuracies"),
        F.collect_list("val_accuracy").alias("val_accuracies"))
    ev = evaluation if isinstance(evaluation, DataFrame) else spark.createDataFrame([evaluation])
    meta = spark.createDataFrame([(json.dumps(args, default=str), json.dumps(pipeline_info, default=str))],
                                 "args string, pipeline_info string")
    row = (meta.crossJoin(F.broadcast(hist.select(F.struct("*").alias("training_history"))))
           .crossJoin(F.broadcast(ev.select(F.struct("*").alias("evaluation")))))
    out = row.select(F.from_json("args", "map<string,string>").alias("args"),
                     F.from_json("pipeline_info", "map<string,string>").alias("pipeline_info"),
                     "training_history", "evaluation")
    out.coalesce(1).write.mode("overwrite").json(path)
