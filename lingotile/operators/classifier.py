"""Language classifier: a tokenizer stage and a network stage in one ``PipelineModel``.

Tokenising is a persistable stage (any named tokenizer, see ``tokens``), the
network is trained in distributed rounds (see ``network``): hidden layers with
ReLU and dropout, mean-pooled or flattened embeddings, Adam with clipping and
weight decay, a step size halved on a plateau, early stopping, the best round
kept.  Every token counts: none is outside a vocabulary.  The fitted
``PipelineModel`` scores batch and streaming DataFrames alike and saves with
``write().save``.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lingotile.operators import network
from lingotile.operators.nn import evaluate_predictions, evaluation_summary
from lingotile.operators.split import DEFAULT_LANGUAGE_MAP, assign_batches, decode_label
from lingotile.operators.tokens import Tokens
from lingotile.operators.vocab import materialize

MODES = ("mean", "flatten")


@dataclass
class TrainConfig:
    """Training job configuration (defaults follow the reference job).
    ``slots`` hashed embedding rows and ``embedding_dim`` give the model's
    size; ``shards`` None lets the number of training rows decide."""
    max_length: int = 100
    batch_size: int = 16
    train_ratio: float = 0.8
    seed: int = 42
    shuffle: bool = True
    stratify: bool = True
    vocab_scope: str = "all"
    tokenizer: str = "edgegram"
    ngram: int = 3
    tokenizer_options: dict = field(default_factory=dict)
    mode: str = "mean"
    slots: int = 1 << 16
    shards: int | None = None
    embedding_dim: int = 64
    hidden_dim: int = 128
    num_layers: int = 2
    dropout: float = 0.3
    epochs: int = 20
    early_stopping: int = 5
    lr: float = 1e-3
    weight_decay: float = 1e-5
    lr_patience: int = 3
    lr_factor: float = 0.5
    sample_multiplier: int = 10
    language_map: dict = field(default_factory=lambda: dict(DEFAULT_LANGUAGE_MAP))


def tokens_stage(cfg: TrainConfig, vocab: DataFrame | None = None, limit: int = 0) -> Tokens:
    """The configured tokenizer; ``vocab`` is a WordPiece vocabulary, ``limit``
    the tokens that the network takes of a text (0: all)."""
    options = {"n": cfg.ngram, **cfg.tokenizer_options} if cfg.tokenizer == "edgegram" else cfg.tokenizer_options
    return Tokens(tokenizer=cfg.tokenizer, options=json.dumps(options), limit=limit, vocab=vocab)


def features(rows: DataFrame, stage: Tokens, cfg: TrainConfig) -> DataFrame:
    """``(doc_id, label, ids)``: a slot for each of the first ``max_length``
    tokens; ``doc_ord`` is kept.  Rows with ids in place of a text stay."""
    label, kept = F.col("label").cast("int").alias("label"), [c for c in ("doc_ord",) if c in rows.columns]
    if "ids" in rows.columns and stage.getInputCol() not in rows.columns:
        return rows.select("doc_id", *kept, label, "ids")
    made = stage.transform(rows)
    ids = network.slot_ids(F.col(stage.getOutputCol()), cfg.slots, cfg.max_length)
    return made.select("doc_id", *kept, label, ids.alias("ids"))


def train_with_history(train: DataFrame, val: DataFrame, cfg: TrainConfig, n_train: int | None = None,
                       n_val: int | None = None, wordpiece_vocab: DataFrame | None = None,
                       rounds_dir: str | None = None) -> tuple[PipelineModel, DataFrame]:
    """Rounds with history and early stopping; returns the best model and
    ``history(epoch, train_loss, val_loss, train_accuracy, val_accuracy,
    step_size)``.  A run over a ``rounds_dir`` with finished rounds goes on
    after them.  Both parts are texts, or ``features`` of them."""
    if cfg.mode not in MODES:
        raise ValueError(f"the mode is one of {MODES}, not {cfg.mode!r}")
    n_train = train.count() if n_train is None else n_train
    if n_train == 0:
        raise ValueError("train set is empty")
    if (n_val == 0) if n_val is not None else val.isEmpty():
        raise ValueError("validation set is empty")
    stage = tokens_stage(cfg, wordpiece_vocab, cfg.max_length)
    order = "doc_ord" if "doc_ord" in val.columns else "doc_id"
    keys = assign_batches(val.select(*dict.fromkeys(["doc_id", order])), cfg.batch_size, order_col=order)
    tr = materialize(features(train, stage, cfg))
    va = materialize(features(val, stage, cfg).drop("doc_ord").join(keys.select("doc_id", "batch_id"), "doc_id"))
    settings = {k: v for k, v in asdict(cfg).items() if k not in ("language_map", "tokenizer_options")}
    weights, history = network.fit_rounds(tr, va, settings, n_train, len(cfg.language_map), rounds_dir)
    scoring = {k: settings[k] for k in ("slots", "max_length", "mode")}
    return PipelineModel([stage, network.NetworkModel(weights, scoring, stage.getOutputCol())]), history


def fit_baseline(train: DataFrame, cfg: TrainConfig) -> PipelineModel:
    """Multinomial logistic regression on hashed token shares of whole texts
    (weight decay as L2 ``regParam``)."""
    stage = tokens_stage(cfg)
    counts = HashingTF(numFeatures=cfg.slots, inputCol=stage.getOutputCol(), outputCol="_counts")
    shares = Normalizer(p=1.0, inputCol="_counts", outputCol="features")
    lr = LogisticRegression(family="multinomial", regParam=cfg.weight_decay, maxIter=100,
                            labelCol="label", featuresCol="features")
    return Pipeline(stages=[stage, counts, shares, lr]).fit(train)


def predict_language(model: PipelineModel, df: DataFrame,
                     language_map: dict[str, int] | None = None) -> DataFrame:
    """Adds ``pred`` (int), ``proba`` (array) and ``predicted_language``;
    works on streaming DataFrames too (all stages are row-wise)."""
    out = model.transform(df)
    if "prediction" in out.columns:  # the baseline's names
        out = out.withColumn("pred", F.col("prediction").cast("int")).withColumn("proba", vector_to_array("probability"))
    out = decode_label(out, language_map or DEFAULT_LANGUAGE_MAP, "pred", "predicted_language")
    return out.drop("_tokens", "_counts", "features", "rawPrediction", "probability", "prediction")


def evaluate_model(model: PipelineModel, df: DataFrame,
                   language_map: dict[str, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """Per-language accuracy table and the one-row summary."""
    m = language_map or DEFAULT_LANGUAGE_MAP
    scored = predict_language(model, df, m)
    per = evaluate_predictions(scored, m, "label", "pred")
    return per, evaluation_summary(per)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def config_dict(cfg: TrainConfig) -> dict:
    return asdict(cfg)
