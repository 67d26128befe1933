"""Language identification by words first, backing off to shorter character n-grams.

Learning counts the words of every labelled document by language, and the
character n-grams (n = 4 to 1) of those words.  The model keeps the
``VOCABULARY`` most frequent words, and n-grams of each length, of every
language, each with its count in all languages, so its size is bounded by the
languages alone.  A document's score for a language is the sum
over its words of the word's log frequency there; a word that the model does
not know is scored by the mean log frequency of its known n-grams of the
greatest length that has any.

Words are runs of letters with their marks, lower-cased.  Texts are read whole.  Edge cases: a
null text, one without letters, or a model without languages gives ``und``
with score 0; ties go to the first language by name; documents without a
label do not teach; repeated rows teach once each.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lingotile.llm.common import materialize

VOCABULARY = 100_000
LONGEST = 4
UNKNOWN = "und"
LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
# Latin letters and general punctuation alone, but for the digits and fractions
# that a plain class takes as letters: there both patterns find the same.
OTHER = re.compile("[\u00b2\u00b3\u00b9\u00bc-\u00be\u0300-\u200f\u2028-\U0010ffff]")
LATIN_LETTERS = re.compile(r"[^\W\d_]+")
FLUSH = 300_000
GRAM_WORDS = 100_000
CACHE_WORDS = 800_000


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    text = text.lower()
    return (LETTERS if OTHER.search(text) else LATIN_LETTERS).findall(text)


def grams_of(word: str, n: int) -> list[str]:
    """n-grams of the word between its borders."""
    w = f"_{word}_"
    return [w[i:i + n] for i in range(len(w) - n + 1)]


def _flushed(counts: dict[str, Counter]) -> pd.DataFrame:
    rows = [(lang, item, n) for lang, found in counts.items() for item, n in found.items()]
    counts.clear()
    return pd.DataFrame(rows, columns=["lang", "item", "n"])


def _full(counts: dict[str, Counter]) -> bool:
    return sum(map(len, counts.values())) > FLUSH


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[str, Counter] = defaultdict(Counter)
    for b in batches:
        for lang, texts in b.groupby("lang")["text"]:
            for t in texts:
                counts[lang].update(words_of(t))
        if _full(counts):
            yield _flushed(counts)
    yield _flushed(counts)


def grams_with_counts(words: list[str], n: np.ndarray) -> Iterator[tuple[list[str], np.ndarray]]:
    """For each length the n-grams of ``words`` and how often they occur, word
    ``i`` counting ``n[i]`` times.  A gram is a number whose digits are its
    characters, numbered among those of the batch, so that equal ones are
    found by a sort; alphabets too large for that go by the strings."""
    text = "_" + "__".join(words) + "_"
    size = np.array([len(w) + 2 for w in words])
    alphabet, code = np.unique(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), return_inverse=True)
    weight, ends = np.repeat(n, size), np.repeat(size.cumsum(), size)
    at, base = np.arange(len(code)), len(alphabet)
    for length in range(1, LONGEST + 1):
        starts = at[at + length <= ends]
        if base ** length < 1 << 62:
            key = np.zeros(len(starts), np.int64)
            for k in range(length):
                key = key * base + code[starts + k]
        else:
            key = np.array([text[i:i + length] for i in starts.tolist()], object)
        _, first, group = np.unique(key, return_index=True, return_inverse=True)
        total = np.zeros(len(first), np.int64)
        np.add.at(total, group, weight[starts])
        yield [text[i:i + length] for i in starts[first].tolist()], total


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def counted(held: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for lang, found in pd.concat(held).groupby("lang"):
            for grams, n in grams_with_counts(found["item"].tolist(), found["n"].to_numpy()):
                yield pd.DataFrame({"lang": lang, "item": grams, "n": n})

    held, rows = [], 0
    for b in batches:
        if len(b):
            held.append(b)
            rows += len(b)
        if rows >= GRAM_WORDS:
            yield from counted(held)
            held, rows = [], 0
    if held:
        yield from counted(held)


_COUNTS = "lang string, item string, n bigint"


def _kept(counts: DataFrame, each: int) -> DataFrame:
    """All counts of the items that are among the ``each`` most frequent of a
    language (and length, for n-grams).  The least count that stays is read off
    a histogram of counts, so no task sorts a language's items; items that tie
    at it stay or go together."""
    steps = counts.groupBy("lang", "kind", "n").agg(F.count(F.lit(1)).alias("_items"))
    above = Window.partitionBy("lang", "kind").orderBy(F.desc("n"))
    least = steps.withColumn("_sum", F.sum("_items").over(above)).where(F.col("_sum") <= each).groupBy(
        "lang", "kind").agg(F.min("n").alias("_least"))
    items = counts.join(F.broadcast(least), ["lang", "kind"]).where(F.col("n") >= F.col("_least")).select(
        "item", "kind").distinct()  # ``least``: a row for each language and length
    return counts.join(items, ["item", "kind"], "left_semi")


class Model:
    """Log frequencies by language of known words and n-grams."""

    def __init__(self, langs: list[str], rows: Iterable[tuple[str, str, int, int]], totals: dict[tuple[str, int], int]):
        """``rows``: (language, item, n-gram length or 0 for words, count)."""
        self.langs = langs
        self.scorer: Scorer | None = None
        at = {lang: i for i, lang in enumerate(langs)}
        # Rows of ``logs`` by item; one array a kind, as items may be many.
        self.known: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
        self.logs: list[np.ndarray] = []
        found = [(array("i"), array("i"), array("d")) for _ in self.known]
        for lang, item, kind, n in rows:
            row, col, count = found[kind]
            row.append(self.known[kind].setdefault(item, len(self.known[kind])))
            col.append(at[lang])
            count.append(n)
        for kind, (row, col, count) in enumerate(found):
            total = np.array([totals.get((lang, kind), 0) for lang in langs], float)
            v = np.zeros((len(self.known[kind]), len(langs)))
            v[np.array(row, int), np.array(col, int)] = count
            self.logs.append(np.log((v + 0.5) / (total + 0.5 * (len(v) + 1)), out=v))

    def unseen(self, word: str) -> np.ndarray:
        for n in range(LONGEST, 0, -1):
            found = [i for g in grams_of(word, n) if (i := self.known[n].get(g)) is not None]
            if found:
                return self.logs[n][found].sum(0) / len(found)
        return np.zeros(len(self.langs))

    def score(self, word: str) -> np.ndarray:
        return self.scores([word])[0]

    def scores(self, words: list[str]) -> np.ndarray:
        at = [self.known[0].get(w, -1) for w in words]
        made = self.logs[0][at] if self.known[0] else np.zeros((len(words), len(self.langs)))
        for k, i in enumerate(at):
            if i < 0:
                made[k] = self.unseen(words[k])
        return made


class Scorer:
    """Rows of word scores with a bounded cache."""

    def __init__(self, model: Model):
        self.model, self.row = model, {}
        self.table = np.zeros((CACHE_WORDS, len(model.langs)))

    def __call__(self, text: str | None) -> tuple[str, float]:
        words, langs = words_of(text), self.model.langs
        if not words or not langs:
            return UNKNOWN, 0.0
        total = np.zeros(len(langs))
        for lo in range(0, len(words), CACHE_WORDS // 2):
            part = words[lo:lo + CACHE_WORDS // 2]
            at = list(map(self.row.get, part))
            if None in at:
                new = {w for w, i in zip(part, at) if i is None}
                if len(self.row) + len(new) > CACHE_WORDS:
                    self.row.clear()
                    new = set(part)
                first = len(self.row)
                self.row.update(zip(new, range(first, first + len(new))))
                self.table[first:first + len(new)] = self.model.scores(list(new))
                at = list(map(self.row.__getitem__, part))
            total += self.table[at].sum(0)
        best = int(total.argmax())
        return langs[best], float(1 / np.exp(np.minimum(total - total[best], 0)).sum())


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", vocabulary: int = VOCABULARY) -> Model:
    """Counts over all ``docs`` with a label; only the bounded model reaches the driver."""
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(F.col("lang").isNotNull())
    words = materialize(rows.mapInPandas(_count_words, _COUNTS).groupBy("lang", "item").agg(F.sum("n").alias("n")), "words")
    grams = words.mapInPandas(_count_grams, _COUNTS).groupBy("lang", "item").agg(F.sum("n").alias("n"))
    both = materialize(words.withColumn("kind", F.lit(0)).union(grams.withColumn("kind", F.length("item"))), "counts")
    totals = {(r["lang"], r["kind"]): r["n"] for r in both.groupBy("lang", "kind").agg(F.sum("n").alias("n")).collect()}
    langs = sorted({lang for lang, _ in totals})
    kept = _kept(both, vocabulary)
    return Model(langs, kept.select("lang", "item", "kind", "n").toLocalIterator(), totals)  # a partition at a time


def predicted(text: Column, spark, model: Model) -> Column:
    """Struct ``(lang_pred, score)`` of a text column."""
    shared = spark.sparkContext.broadcast(model)  # bounded by the vocabulary

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value    # one object for all tasks of a worker: they share the scored words
        if model.scorer is None:
            model.scorer = Scorer(model)
        scorer = model.scorer
        for texts in batches:
            yield pd.DataFrame([scorer(t) for t in texts], columns=["lang_pred", "score"])

    return run(text)


def held_out(doc_id: Column, fold: int = 2, folds: int = 4) -> Column:
    """Whether an id's CRC-32 (of its decimal text) falls in the held-out fold."""
    return F.coalesce(F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(folds)) == fold, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``: learned from the labelled rows
    that are not held out, predicted for every row from its text alone."""
    model = learn(docs.where(~held_out(F.col(id_col))), lang_col, text_col)
    return docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                       predicted(F.col(text_col), docs.sparkSession, model).alias("_p")).select(
        "doc_id", "held_out", "_p.*")
