"""A tokenizer as a persistable ``pyspark.ml`` stage."""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingotile.functions import text as tx

WORDPIECE = "wordpiece"


def named_spec(name: str, options: dict | None = None, vocab: DataFrame | None = None) -> tx.TokenizerSpec:
    """The tokenizer ``char``, ``word``, ``edgegram`` (options ``n``,
    ``use_prefix``, ``use_suffix``), ``rule`` (option ``lang``; without it the
    row's language column) or ``wordpiece`` (with a vocabulary table)."""
    options = options or {}
    if name == WORDPIECE:
        from lingotile.operators.wordpiece import wordpiece_spec

        if vocab is None:
            raise ValueError("the wordpiece tokenizer needs a vocabulary table")
        return wordpiece_spec(vocab)
    made = {"char": tx.char_spec, "word": tx.word_spec, "edgegram": tx.edgegram_spec, "rule": tx.rule_spec}
    if name not in made:
        raise ValueError(f"no tokenizer is named {name!r}; there are {', '.join([*made, WORDPIECE])}")
    return made[name](**options)


class Tokens(Transformer, HasInputCol, HasOutputCol, MLReadable, MLWritable):
    """Adds the token array of a named tokenizer.  All but ``wordpiece`` are
    row-wise expressions and run on streams; ``wordpiece`` matches distinct
    words by a join and needs ``keyCol`` to be unique.  Saved with its options
    and, for ``wordpiece``, its vocabulary table.  With a ``limit`` above 0
    the first so many tokens are made, and a text's rest is not tokenised."""

    tokenizer = Param(Params._dummy(), "tokenizer", "name of the tokenizer", TypeConverters.toString)
    options = Param(Params._dummy(), "options", "its options as JSON", TypeConverters.toString)
    langCol = Param(Params._dummy(), "langCol", "the row's language, for the rule tokenizer", TypeConverters.toString)
    keyCol = Param(Params._dummy(), "keyCol", "unique key, for the wordpiece tokenizer", TypeConverters.toString)
    limit = Param(Params._dummy(), "limit", "tokens made of a text, 0: all", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, tokenizer="edgegram", options="{}", inputCol="text", outputCol="_tokens", langCol="lang",
                 keyCol="doc_id", limit=0, vocab=None):
        super().__init__()
        kwargs = dict(self._input_kwargs)
        self.vocab = kwargs.pop("vocab", None)
        self._setDefault(tokenizer="edgegram", options="{}", inputCol="text", outputCol="_tokens", langCol="lang",
                         keyCol="doc_id", limit=0)
        self._set(**kwargs)

    def spec(self) -> tx.TokenizerSpec:
        return named_spec(self.getOrDefault("tokenizer"), json.loads(self.getOrDefault("options")), self.vocab)

    def _transform(self, df: DataFrame) -> DataFrame:
        spec, text, lang = self.spec(), self.getInputCol(), self.getOrDefault("langCol")
        if spec.prepare is not None:
            made = spec.prepare(df, text, self.getOrDefault("keyCol"))
            own = [c for c in made.columns if c not in df.columns]
            return made.withColumn(self.getOutputCol(), self._cut(spec.tokens(text))).drop(*own)
        limit = self.getOrDefault("limit")
        head = spec.head(F.col(text), limit) if limit and spec.head is not None else F.col(text)
        tokens = spec.tokens(head, lang if lang in df.columns else None)
        return df.withColumn(self.getOutputCol(), self._cut(tokens))

    def _cut(self, tokens: Column) -> Column:
        limit = self.getOrDefault("limit")
        return F.slice(tokens, 1, limit) if limit else tokens

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, stage: Tokens):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        if self.stage.vocab is not None:
            self.stage.vocab.write.parquet(f"{path.rstrip('/')}/vocab")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> Tokens:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.cls()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        if stage.getOrDefault("tokenizer") == WORDPIECE:
            stage.vocab = self.sparkSession.read.parquet(f"{path.rstrip('/')}/vocab")
        return stage
