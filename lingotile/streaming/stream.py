"""Structured Streaming entry points.

Tokenizers, fixed-vocabulary lookups with small vocabularies and the
fitted classifier are row-wise and run on streaming DataFrames unchanged.
Operators that regroup rows (encode with a table-sized vocabulary, growing
a vocabulary) run per micro-batch in ``foreachBatch``, where each batch is
an ordinary DataFrame.  Vocabulary growth appends to a log of segments
(``vocab_log``) and skips batches already written, so a restarted query is
idempotent; micro-batches of one query never run concurrently, which keeps
the id order deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lingotile.operators import encode as en
from lingotile.operators import vocab as vb
from lingotile.streaming import vocab_log


def read_table_stream(spark: SparkSession, directory: str, file_name: str,
                      max_files_per_trigger: int | None = 1) -> DataFrame:
    """Stream a parquet table: the part files of the folder ``file_name``, or
    the files of that name (glob) if it is no folder.  A micro-batch takes
    ``max_files_per_trigger`` files; None (for row-wise work, whose rows do not
    depend on the batches): as many as there are cores, so that all have work."""
    if max_files_per_trigger is None:
        max_files_per_trigger = max(1, spark.sparkContext.defaultParallelism)
    path = f"{directory.rstrip('/')}/{file_name}"
    reader = (spark.readStream.schema(spark.read.parquet(path).schema)
              .option("maxFilesPerTrigger", max_files_per_trigger))
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).isDirectory(p):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", file_name).parquet(directory)


def encode_batches(stream: DataFrame, tokens_fn, vocab: DataFrame, out_path: str,
                   checkpoint: str, key: str = "doc_id", keep: list[str] | None = None):
    """Encode each micro-batch with a frozen vocabulary and write it to
    ``<out_path>/batch=<id>``; a batch that is retried replaces its folder."""
    keep = keep or []

    def handle(batch: DataFrame, batch_id: int) -> None:
        enc = en.encode(batch, tokens_fn(batch), vocab, key=key, keep=keep)
        enc.select(key, *keep, "ids").write.mode("overwrite").parquet(
            f"{out_path.rstrip('/')}/batch={batch_id}")

    return (stream.writeStream.foreachBatch(handle)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def grow_vocab_batches(stream: DataFrame, tokens_fn, root: str, checkpoint: str,
                       n_special: int = 2, order_col: str = "doc_ord"):
    """Growing vocabulary over a stream: batch ``b`` appends its unseen tokens
    and its counts to the log below ``root`` (see ``vocab_log``)."""
    from lingotile.functions.text import SPECIALS_WORD

    def handle(batch: DataFrame, batch_id: int) -> None:
        vocab_log.add_batch(vb.token_rows(batch, tokens_fn(batch), order_col), root, batch_id,
                            SPECIALS_WORD[:n_special])

    return (stream.writeStream.foreachBatch(handle)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def predict_stream(model, stream: DataFrame, language_map: dict | None = None) -> DataFrame:
    """Language prediction on a stream (the fitted pipeline is row-wise)."""
    from lingotile.operators.classifier import predict_language

    return predict_language(model, stream, language_map)


def tokens_stream(stream: DataFrame, spec, text_col: str = "text", lang_col: str | None = "lang",
                  out: str = "tokens") -> DataFrame:
    """Stateless tokenisation of a stream."""
    return stream.withColumn(out, spec.tokens(text_col, lang_col))


def vocab_from_versions(spark: SparkSession, root: str) -> DataFrame:
    """The vocabulary of all batches written below ``root`` so far."""
    return vocab_log.read(spark, root)
