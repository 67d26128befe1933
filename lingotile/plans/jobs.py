"""End-to-end jobs: tokenizer comparison and classifier training."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lingotile.functions import text as tx
from lingotile.operators import classifier as clf
from lingotile.operators import compare as cmp
from lingotile.operators import encode as en
from lingotile.operators import split as sp
from lingotile.operators import vocab as vb
from lingotile.sources import readers as rd
from lingotile.sources import sinks as sk

CHAR_VOCAB_SIZE = 141


def run_comparison(spark: SparkSession, corpus: DataFrame, languages: list[str] | None = None,
                   wordpiece_vocab: DataFrame | None = None, max_samples: int = 1,
                   batch_lang: str | None = None, batch_size: int = 4,
                   shuffle_seed: int | None = 42) -> dict[str, DataFrame]:
    """Tokenizer comparison on a corpus ``(doc_id, doc_ord, lang, text)``:
    summary per language x tokenizer, examples, and a padded batch table
    for one language built with a case-kept word vocabulary."""
    word_lower = vb.word_vocab(corpus, lowercase=True)
    available = {"wordpiece_vocab": wordpiece_vocab} if wordpiece_vocab is not None else {}
    specs = tx.default_tokenizers(available)
    sizes = {"char": CHAR_VOCAB_SIZE, "word": vb.vocab_size(word_lower)}
    if wordpiece_vocab is not None:
        sizes["wordpiece"] = vb.vocab_size(wordpiece_vocab)
    summary = cmp.summarize_tokenizers(corpus, specs, languages=languages, vocab_sizes=sizes)

    simple = [s for s in specs if s.prepare is None]
    vocabs = {"char": vb.char_vocab(spark), "word": word_lower}
    for s in simple:
        if s.name not in vocabs:
            vocabs[s.name] = vb.build_vocab(vb.counted(corpus, s), specials=tx.SPECIALS_WORD[:s.n_special])
    examples = cmp.collect_examples(corpus, simple, vocabs, max_samples=max_samples)

    words_vocab = vb.build_vocab(vb.counted(corpus, tx.word_spec()))
    part = corpus if batch_lang is None else corpus.where(F.col("lang") == batch_lang)
    if batch_lang is not None and part.isEmpty():
        raise ValueError(f"the corpus has no text in language {batch_lang!r}")
    # Ids are ranked, not texts; of rows that share an id, the first batch holds them.
    b = sp.alternate_label(part.select("doc_id", "doc_ord"), "doc_ord", None, "label")
    b = sp.assign_batches(b, batch_size, shuffle_seed=shuffle_seed)
    b = b.groupBy(F.col("doc_id").alias("_of")).agg(F.min(F.struct("batch_id", "label")).alias("_b")).select("_of", "_b.*")
    e = en.encode(part, tx.words("text"), words_vocab, keep=[])
    e = e.join(b, e["doc_id"].eqNullSafe(b["_of"])).drop("_of").withColumn("ids", en.add_bos_eos("ids"))
    batches = sp.pad_batches(e, "ids", "batch_id").select("batch_id", "doc_id", "ids", "label")
    return {"summary": summary, "examples": examples, "batches": batches,
            "word_vocab": words_vocab, "word_vocab_lower": word_lower}


def pipeline_info(cfg: clf.TrainConfig, vocab_size: int, n_train: int, n_val: int) -> dict:
    return {"vocab_size": vocab_size, "max_length": cfg.max_length, "batch_size": cfg.batch_size,
            "train_ratio": cfg.train_ratio, "shuffle": cfg.shuffle, "stratify_split": cfg.stratify,
            "language_map": cfg.language_map, "train_samples": n_train, "val_samples": n_val,
            "vocab_built": True, "seed": cfg.seed}


def split_corpus(df: DataFrame, cfg: clf.TrainConfig) -> DataFrame:
    """Stratified when possible, else the clamped random split; without
    ``shuffle`` a cut in corpus order."""
    if cfg.stratify and cfg.shuffle:
        ok = sp.can_stratify(df).first()
        if ok is not None and ok.can_stratify:
            return sp.stratified_split(df, cfg.train_ratio, cfg.seed)
    return sp.random_split(df, cfg.train_ratio, cfg.seed, clamp=True, shuffle=cfg.shuffle)


def prepare_training(corpus: DataFrame, cfg: clf.TrainConfig, wordpiece_vocab: DataFrame | None = None) -> dict:
    """Split and vocabulary of a labelled corpus ``(doc_id, doc_ord, text,
    label, ...)`` and what is known before training.  Only ids, labels and
    parts are written; texts are read again from the corpus."""
    keys = corpus.select("doc_id", "doc_ord", "label")
    parts = vb.materialize(split_corpus(keys, cfg).select("doc_id", "split"))
    split = corpus.join(parts, "doc_id")
    if cfg.vocab_scope not in ("all", "train"):
        raise ValueError(f"the vocabulary's scope is 'all' or 'train', not {cfg.vocab_scope!r}")
    scope = corpus if cfg.vocab_scope == "all" else split.where(F.col("split") == "train")
    if wordpiece_vocab is not None:
        vocab = wordpiece_vocab
    else:
        spec = clf.tokens_stage(cfg).spec()
        lang = "lang" if "lang" in scope.columns else None
        vocab = vb.build_vocab(vb.counted(scope, spec, lang_col=lang), specials=tx.SPECIALS_SHORT)
    sizes = {r["split"]: r["n"] for r in parts.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    info = pipeline_info(cfg, vb.vocab_size(vocab), sizes.get("train", 0), sizes.get("val", 0))
    return {"vocab": vocab, "split": split, "parts": parts, "pipeline_info": info}


def run_training(spark: SparkSession, cfg: clf.TrainConfig | None = None,
                 corpus: DataFrame | None = None, csv_path: str | None = None,
                 data_dir: str | None = None, txt_files: dict | None = None,
                 csv_text_col: str = "text", csv_language_col: str = "language",
                 csv_label_col: str | None = None, artifacts_dir: str | None = None,
                 wordpiece_vocab: DataFrame | None = None, rounds_dir: str | None = None) -> dict:
    """Load (or take) a labelled corpus, build the vocabulary, split, train
    with history and early stopping, evaluate on the validation part, and
    optionally write the model and a JSON run summary under
    ``artifacts_dir``.  The tokenizer, the mode and all else are in ``cfg``;
    ``rounds_dir`` makes the training resumable."""
    cfg = cfg or clf.TrainConfig()
    source = "given"
    if corpus is None:
        corpus, source = rd.load_auto(spark, csv_path, data_dir, txt_files, csv_text_col,
                                      csv_language_col, csv_label_col, cfg.sample_multiplier,
                                      cfg.language_map)
    if corpus.isEmpty():
        raise ValueError("the corpus is empty: nothing to train on")
    if "doc_id" not in corpus.columns:
        raise ValueError("the corpus has no doc_id: splits need ids that do not depend on partitioning")
    if "doc_ord" not in corpus.columns:
        corpus = corpus.withColumn("doc_ord", F.col("doc_id"))
    ready = prepare_training(corpus, cfg, wordpiece_vocab)
    info, split = ready["pipeline_info"], ready["split"]
    val = split.where(F.col("split") == "val")
    rows = split
    if wordpiece_vocab is None:   # features are smaller than texts: they are made once and meet their part
        stage = clf.tokens_stage(cfg, limit=cfg.max_length)
        rows = vb.materialize(clf.features(corpus, stage, cfg)).join(ready["parts"], "doc_id")
    model, history = clf.train_with_history(rows.where(F.col("split") == "train"), rows.where(F.col("split") == "val"), cfg,
                                            info["train_samples"], info["val_samples"], wordpiece_vocab, rounds_dir)
    per_class, evaluation = clf.evaluate_model(model, val, cfg.language_map)
    if artifacts_dir:
        clf.save_model(model, f"{artifacts_dir.rstrip('/')}/model")
        sk.write_run_summary(spark, f"{artifacts_dir.rstrip('/')}/training_summary",
                             clf.config_dict(cfg), info, history, evaluation)
    return {"source": source, "model": model, "history": history, "per_class": per_class,
            "evaluation": evaluation, **ready}


def info_frame(spark: SparkSession, info: dict) -> DataFrame:
    """Pipeline info as a one-row table (maps rendered as JSON)."""
    row = {k: (json.dumps(v) if isinstance(v, dict) else v) for k, v in info.items()}
    return spark.createDataFrame([row])
