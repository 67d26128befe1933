"""The classifier's network: token embeddings, hidden layers, training in rounds.

Every token of a text counts: tokens are hashed into ``slots`` embedding rows,
so no vocabulary is cut; a token never seen in training has the zero row, which
counts in the mean as an unknown token would.  The
embeddings of a text's first ``max_length`` tokens are averaged (``mean``), or
laid out one after the other with zeros for padding (``flatten``), and pass
``num_layers`` hidden layers (linear, ReLU, dropout) and a linear output.

A round is one job.  Training rows are dealt into shards by a hash of their
id, so a result does not depend on the cluster.  Each shard's task streams its
rows in the round's seeded order through mini-batches of Adam, starting from
the weights of the round before.  The gradient of the embeddings is sparse:
only the rows of a batch's tokens are touched, and only touched rows leave the
task.  Row by row, the shards' results are averaged by the batches that
touched them (in shard order, so sums are exact repeats).  A model has at most
``slots * embedding_dim`` numbers and those of the layers, whatever the
corpus, so its size is bounded by parameters; the driver holds it, and sends
the embedding rows that were ever touched.

Each round's weights and metrics are written below ``rounds_dir``; Spark's
success mark makes a round count.  A run that finds finished rounds there goes
on after the last of them.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lingotile.session import scratch_path, ship_package

BETA1, BETA2, EPSILON, CLIP = 0.9, 0.999, 1e-8, 1.0
STATS = "stats"
ROWS = "name string, idx int, shard int, n double, vec binary"


def slot_ids(tokens: Column, slots: int, max_length: int) -> Column:
    """The first ``max_length`` tokens as slots 1 to ``slots``; 0 is padding."""
    return F.transform(F.slice(tokens, 1, max_length), lambda t: (F.pmod(F.xxhash64(t), F.lit(slots)) + 1).cast("int"))


STARTS = 1021  # distinct starting rows of the embeddings


def initial(slots: int, embedding_dim: int, hidden_dim: int, num_layers: int, classes: int, mode: str,
            max_length: int, seed: int) -> dict[str, np.ndarray]:
    """Weights before training; the padding row is zero and stays so."""
    rng = np.random.default_rng(seed)
    starts = rng.normal(0, 0.1, (STARTS, embedding_dim)).astype(np.float32)
    weights = {"embedding": starts[np.arange(slots + 1) % STARTS]}
    weights["embedding"][0] = 0
    width = embedding_dim * (max_length if mode == "flatten" else 1)
    for k, size in enumerate([*[hidden_dim] * num_layers, classes]):
        limit = np.sqrt(6 / (width + size))
        weights[f"w{k}"] = rng.uniform(-limit, limit, (width, size)).astype(np.float32)
        weights[f"b{k}"] = np.zeros((1, size), np.float32)
        width = size
    return weights


def packed(state: dict[str, tuple], seen: np.ndarray) -> dict:
    """The layers, and the embedding rows that were touched with their numbers."""
    at = np.flatnonzero(seen)
    return {**{k: v for k, v in state.items() if k != "embedding"}, "slots": at,
            "embedding": tuple(x[at] for x in state["embedding"])}


def unpacked(sent: dict, cfg: dict, classes: int) -> dict[str, tuple]:
    shape = {k: cfg[k] for k in ("slots", "embedding_dim", "hidden_dim", "num_layers", "mode", "max_length", "seed")}
    state = _state(initial(classes=classes, **shape))
    for name, parts in state.items():
        for x, y in zip(parts, sent[name]):
            x[sent["slots"] if name == "embedding" else slice(None)] = y
    return state


class Network:
    """Forward and backward passes over a mini-batch of id lists."""

    def __init__(self, weights: dict[str, np.ndarray], mode: str, max_length: int):
        self.w, self.mode, self.max_length = weights, mode, max_length
        self.depth = sum(k.startswith("w") for k in weights)

    def inputs(self, ids: list[np.ndarray]) -> tuple[np.ndarray, tuple]:
        table = self.w["embedding"]
        size = np.array([len(x) for x in ids])
        flat = np.concatenate(ids).astype(np.int64) if size.sum() else np.zeros(0, np.int64)
        row = np.repeat(np.arange(len(ids)), size)
        if self.mode == "flatten":
            place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
            x = np.zeros((len(ids), self.max_length, table.shape[1]), np.float32)
            x[row, place] = table[flat]
            return x.reshape(len(ids), -1), (flat, row, place, size)
        x = np.zeros((len(ids), table.shape[1]), np.float32)
        full = np.flatnonzero(size)
        if len(full):
            x[full] = np.add.reduceat(table[flat], (np.cumsum(size) - size)[full]) / size[full, None]
        return x, (flat, row, None, size)

    def forward(self, ids: list[np.ndarray], drop: float = 0.0, rng=None) -> tuple[np.ndarray, list, tuple]:
        x, source = self.inputs(ids)
        kept = []
        for k in range(self.depth):
            z = x @ self.w[f"w{k}"] + self.w[f"b{k}"]
            if k == self.depth - 1:
                return z, [*kept, (x, None)], source
            mask = z > 0
            if drop:
                mask = mask * (rng.random(z.shape) >= drop) / (1 - drop)
            kept.append((x, mask.astype(np.float32)))
            x = z * kept[-1][1]

    def gradients(self, ids: list[np.ndarray], labels: np.ndarray, drop: float, rng) -> tuple:
        """Loss, predictions, dense gradients, touched embedding rows and their gradients."""
        logits, kept, (flat, row, place, size) = self.forward(ids, drop, rng)
        p = softmax(logits)
        at = np.arange(len(labels))
        loss = float(-np.log(np.maximum(p[at, labels], 1e-12)).mean())
        g = p.astype(np.float32)
        g[at, labels] -= 1
        g /= len(labels)
        dense = {}
        for k in range(self.depth - 1, -1, -1):
            x, _ = kept[k]
            dense[f"w{k}"], dense[f"b{k}"] = x.T @ g, g.sum(0, keepdims=True)
            g = g @ self.w[f"w{k}"].T
            if k:
                g = g * kept[k - 1][1]
        if not len(flat):
            return loss, logits.argmax(1), dense, flat, np.zeros((0, self.w["embedding"].shape[1]), np.float32)
        if self.mode == "flatten":
            order = np.argsort(flat, kind="stable")
            each = g.reshape(len(ids), self.max_length, -1)[row[order], place[order]]
        else:
            order = np.argsort(flat, kind="stable")
            each = (g / np.maximum(size, 1)[:, None])[row[order]]
        sorted_slots = flat[order]
        first = np.flatnonzero(np.append(True, sorted_slots[1:] != sorted_slots[:-1]))
        return loss, logits.argmax(1), dense, sorted_slots[first], np.add.reduceat(each, first)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z.astype(np.float64) - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


class Adam:
    """Adam over whole layers and over touched embedding rows."""

    def __init__(self, state: dict[str, tuple], steps: int, lr: float, decay: float):
        self.state, self.t, self.lr, self.decay = state, steps, lr, decay

    def step(self, dense: dict, slots: np.ndarray, rows: np.ndarray) -> None:
        self.t += 1
        norm = np.sqrt(sum(float((g ** 2).sum()) for g in dense.values()) + float((rows ** 2).sum()))
        scale = min(1.0, CLIP / (norm + 1e-6))
        for name, g, at in [*((k, g, slice(None)) for k, g in dense.items()), ("embedding", rows, slots)]:
            # Each row is taken once and put back once (a layer is worked on in place).
            own = [x[at] for x in self.state[name]]
            w, m, v = own
            g = g * scale
            g += self.decay * w
            m *= BETA1
            m += (1 - BETA1) * g
            v *= BETA2
            grown = (1 - BETA2) * g
            grown *= g
            v += grown
            change = m / (1 - BETA1 ** self.t)
            change *= self.lr
            root = v / (1 - BETA2 ** self.t)
            np.sqrt(root, out=root)
            root += EPSILON
            change /= root
            w -= change
            if name == "embedding":
                for x, made in zip(self.state[name], own):
                    x[at] = made


def _round(shared, cfg: dict, classes: int, epoch: int, steps: int, lr: float):
    """mapInPandas function over rows sorted by (shard, order): each shard's trained rows and its loss."""
    def finished(shard, opt, touched, stats):
        out = [(STATS, 0, shard, 1.0, np.array(stats, np.float64).tobytes())]
        for name, (w, m, v) in opt.state.items():
            at = np.flatnonzero(touched) if name == "embedding" else range(len(w))
            n = touched if name == "embedding" else np.full(len(w), stats[1])
            out += [(name, int(i), shard, float(n[i]), np.concatenate([w[i], m[i], v[i]]).astype(np.float32).tobytes())
                    for i in at]
        return pd.DataFrame(out, columns=["name", "idx", "shard", "n", "vec"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard = opt = net = rng = touched = stats = None
        ids: list = []
        labels: list = []

        def trained():
            loss, pred, dense, slots, rows = net.gradients(ids, np.array(labels), cfg["dropout"], rng)
            opt.step(dense, slots, rows)
            touched[slots] += 1
            for k, x in enumerate((loss, 1, float((pred == np.array(labels)).sum()), len(labels))):
                stats[k] += x
            ids.clear()
            labels.clear()

        for batch in batches:
            for s, label, own in zip(batch["shard"], batch["label"], batch["ids"]):
                if s != shard:
                    if shard is not None:
                        if ids:
                            trained()
                        yield finished(shard, opt, touched, stats)
                    shard, stats = int(s), [0.0, 0.0, 0.0, 0.0]
                    state = unpacked(shared.value, cfg, classes)
                    opt = Adam(state, steps, lr, cfg["weight_decay"])
                    net = Network({k: v[0] for k, v in state.items()}, cfg["mode"], cfg["max_length"])
                    rng = np.random.default_rng([cfg["seed"], epoch, shard])
                    touched = np.zeros(len(state["embedding"][0]))
                ids.append(np.asarray(own))
                labels.append(int(label))
                if len(ids) == cfg["batch_size"]:
                    trained()
        if shard is not None:
            if ids:
                trained()
            yield finished(shard, opt, touched, stats)

    return run


def _averaged(parts: DataFrame) -> DataFrame:
    """(name, idx, vec): weighted means over the shards of each row, sums of the statistics."""
    @F.pandas_udf("binary")
    def mean(name: pd.Series, weights: pd.Series, vecs: pd.Series) -> pd.Series:
        out = []
        for k, n, v in zip(name, weights, vecs):
            kind = np.float64 if k == STATS else np.float32
            x = np.stack([np.frombuffer(b, kind) for b in v]).astype(np.float64)
            w = np.ones(len(n)) if k == STATS else np.asarray(n) / np.sum(n)
            out.append((x * w[:, None]).sum(0).astype(kind).tobytes())
        return pd.Series(out)

    listed = parts.groupBy("name", "idx").agg(F.array_sort(F.collect_list(F.struct("shard", "n", "vec"))).alias("_p"))
    each = lambda f: F.transform("_p", lambda p: p[f])
    return listed.select("name", "idx", mean(F.col("name"), each("n"), each("vec")).alias("vec"))


def _state(weights: dict[str, np.ndarray]) -> dict[str, tuple]:
    return {k: (w, np.zeros_like(w), np.zeros_like(w)) for k, w in weights.items()}


def _loaded(spark: SparkSession, path: str, state: dict[str, tuple], seen: np.ndarray) -> np.ndarray:
    """Puts a round's written rows into ``state`` and marks the embedding rows
    ``seen``; returns its statistics.  The rows are those of the model, whose
    size is bounded by parameters."""
    stats = np.zeros(4)
    rows = spark.read.parquet(path).select("name", "idx", "vec").toPandas()
    for name, idx, vec in zip(rows["name"], rows["idx"], rows["vec"]):
        if name == STATS:
            stats = np.frombuffer(vec, np.float64)
        else:
            for part, x in zip(state[name], np.split(np.frombuffer(vec, np.float32), 3)):
                part[idx] = x
            if name == "embedding":
                seen[idx] = True
    return stats


def scoring_weights(state: dict[str, tuple], seen: np.ndarray) -> dict[str, np.ndarray]:
    """What a model keeps: the layers and the seen embedding rows with their slots."""
    at = np.flatnonzero(seen)
    layers = {k: v[0].copy() for k, v in state.items() if k != "embedding"}
    return {**layers, "seen": at.astype(np.float64)[:, None], "embedding": state["embedding"][0][at]}


# Rows that are scored together: the vectors of their tokens are in memory at
# once, however many rows an Arrow batch has.
SCORED_AT_ONCE = 256


def scored(net: Network, ids: pd.Series) -> list[np.ndarray]:
    made: list = []
    for k in range(0, len(ids), SCORED_AT_ONCE):
        made += list(softmax(net.forward([np.asarray(x) for x in ids.iloc[k:k + SCORED_AT_ONCE]])[0]))
    return made


class NetworkModel(Model, MLReadable, MLWritable):
    """Scores token arrays: adds ``proba`` (array) and ``pred``; row-wise, so
    it runs on streams too."""

    tokensCol = Param(Params._dummy(), "tokensCol", "token array", TypeConverters.toString)
    settings = Param(Params._dummy(), "settings", "slots, max_length and mode as JSON", TypeConverters.toString)

    def __init__(self, weights: dict[str, np.ndarray] | None = None, settings: dict | None = None, tokens: str = "_tokens"):
        super().__init__()
        self.weights = weights or {}
        self._set(tokensCol=tokens, settings=json.dumps(settings or {}))

    def score(self, ids: Column, spark: SparkSession) -> Column:
        cfg = json.loads(self.getOrDefault("settings"))
        shared = spark.sparkContext.broadcast(self.weights)  # as large as its parameters make it

        @F.pandas_udf("array<double>")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            weights = dict(shared.value)
            table = np.zeros((cfg["slots"] + 1, weights["embedding"].shape[1]), np.float32)
            table[weights["seen"][:, 0].astype(np.int64)] = weights["embedding"]
            net = Network({**{k: w for k, w in weights.items() if k != "seen"}, "embedding": table}, cfg["mode"], cfg["max_length"])
            for ids in batches:
                yield pd.Series(scored(net, ids), dtype=object)

        return run(ids)

    def _transform(self, df: DataFrame) -> DataFrame:
        cfg = json.loads(self.getOrDefault("settings"))
        ship_package(df.sparkSession)
        tokens = F.coalesce(self.getOrDefault("tokensCol"), F.array().cast("array<string>"))
        scored = df.withColumn("proba", self.score(slot_ids(tokens, cfg["slots"], cfg["max_length"]), df.sparkSession))
        return scored.withColumn("pred", (F.array_position("proba", F.array_max("proba")) - 1).cast("int"))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, model: NetworkModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        rows = [(name, i, row.tolist()) for name, w in self.model.weights.items() for i, row in enumerate(w)]
        self.sparkSession.createDataFrame(rows, "name string, idx int, vec array<double>").write.parquet(
            f"{path.rstrip('/')}/weights")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> NetworkModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        parts: dict = {}
        rows = self.sparkSession.read.parquet(f"{path.rstrip('/')}/weights").select("name", "idx", "vec").toPandas()
        for name, idx, vec in zip(rows["name"], rows["idx"], rows["vec"]):
            parts.setdefault(name, {})[idx] = vec
        model.weights = {k: np.array([v[i] for i in range(len(v))], np.float64 if k == "seen" else np.float32) for k, v in parts.items()}
        return model


def shards_for(rows: int) -> int:
    """Shards and rows in each grow alike: the square root of the rows over 16."""
    return max(1, round((rows ** 0.5) / 16))


def fit_rounds(train: DataFrame, val: DataFrame, cfg: dict, n_train: int, classes: int,
               rounds_dir: str | None = None) -> tuple[dict[str, np.ndarray], DataFrame]:
    """``train(doc_id, label, ids)`` and ``val(label, ids, batch_id)`` (written
    tables) -> the best round's weights and the history."""
    from lingotile.sources.readers import path_exists

    spark = train.sparkSession
    ship_package(spark)
    rounds_dir = (rounds_dir or scratch_path(spark, "rounds")).rstrip("/")
    shape = {k: cfg[k] for k in ("slots", "embedding_dim", "hidden_dim", "num_layers", "mode", "max_length", "seed")}
    state, seen = _state(initial(classes=classes, **shape)), np.zeros(cfg["slots"] + 1, bool)
    shards = cfg["shards"] or shards_for(n_train)
    key = F.xxhash64(F.lit(cfg["seed"]), F.col("doc_id"))
    dealt = train.select("doc_id", "label", "ids", F.pmod(key, F.lit(shards)).cast("int").alias("shard"))
    history: list[tuple] = []
    columns = ("epoch int, train_loss double, val_loss double, train_accuracy double, val_accuracy double, "
               "step_size double, steps bigint")

    def ahead() -> tuple[float, int, int]:
        """Step size, rounds since the last improvement, steps: replayed from the history."""
        lr, best, bad, plateau = cfg["lr"], float("inf"), 0, 0
        for h in history:
            if h[2] < best:
                best, bad, plateau = h[2], 0, 0
                continue
            bad, plateau = bad + 1, plateau + 1
            if plateau > cfg["lr_patience"]:
                lr, plateau = lr * cfg["lr_factor"], 0
        return lr, bad, int(history[-1][6]) if history else 0

    while path_exists(spark, f"{rounds_dir}/metrics={len(history) + 1}/_SUCCESS"):
        k = len(history) + 1
        history.append(tuple(spark.read.schema(columns).parquet(f"{rounds_dir}/metrics={k}").first()))
    if history:
        for k in range(1, len(history) + 1):  # a row keeps the last round that touched it
            _loaded(spark, f"{rounds_dir}/weights={k}", state, seen)
    while len(history) < cfg["epochs"]:
        lr, bad, steps = ahead()
        if bad >= cfg["early_stopping"]:
            break
        epoch = len(history) + 1
        order = F.xxhash64(F.lit(cfg["seed"]), F.lit(epoch), F.col("doc_id")) if cfg["shuffle"] else F.col("doc_id")
        shared = spark.sparkContext.broadcast(packed(state, seen))
        rows = dealt.withColumn("_o", order).repartition(shards, "shard").sortWithinPartitions("shard", "_o", "doc_id")
        parts = rows.select("shard", "label", "ids").mapInPandas(_round(shared, cfg, classes, epoch, steps, lr), ROWS)
        _averaged(parts).write.mode("overwrite").parquet(f"{rounds_dir}/weights={epoch}")
        stats = _loaded(spark, f"{rounds_dir}/weights={epoch}", state, seen)
        shared.unpersist()
        scorer = NetworkModel(scoring_weights(state, seen), cfg)
        scored = val.select("label", "batch_id", scorer.score(F.col("ids"), spark).alias("p"))
        scored = scored.select("batch_id", (-F.log(F.greatest(F.element_at("p", F.col("label") + 1), F.lit(1e-12)))).alias("loss"),
                               (F.array_position("p", F.array_max("p")) - 1 == F.col("label")).cast("int").alias("hit"))
        v = scored.groupBy("batch_id").agg(F.avg("loss").alias("loss"), F.sum("hit").alias("hits"), F.count("hit").alias("n")).agg(
            F.avg("loss"), F.sum("hits") / F.sum("n")).first()
        made = (epoch, float(stats[0] / stats[1]), float(v[0]), float(stats[2] / stats[3]), float(v[1]), lr,
                steps + -(-int(stats[1]) // shards))
        fields = [F.lit(x).cast(c.split()[1]).alias(c.split()[0]) for x, c in zip(made, columns.split(", "))]
        spark.range(1).select(*fields).coalesce(1).write.mode("overwrite").parquet(f"{rounds_dir}/metrics={epoch}")
        history.append(made)
    best = min(history, key=lambda h: h[2])[0]
    if best < len(history):
        state, seen = _state(initial(classes=classes, **shape)), np.zeros(cfg["slots"] + 1, bool)
        for k in range(1, best + 1):
            _loaded(spark, f"{rounds_dir}/weights={k}", state, seen)
    return scoring_weights(state, seen), spark.createDataFrame(history, columns).drop("steps")
