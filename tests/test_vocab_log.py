import random
import tempfile

import pytest
from pyspark.sql import functions as F

from lingotile.functions import text as tx
from lingotile.operators import vocab as vb
from lingotile.streaming import vocab_log as vl

WORDS = "doc_ord bigint, pos int, token string"


def batches(n, seed=5):
    rng, out, at = random.Random(seed), [], 1
    for b in range(n):
        rows = []
        for d in range(rng.randrange(0, 4)):
            for p in range(rng.randrange(0, 9)):
                rows.append((at, p, "<unk>" if rng.random() < 0.05 else f"w{int(rng.expovariate(1 / (4 + 2 * b)))}"))
            at += 1
        out.append(rows)
    out[0].append((0, 0, "w0"))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, WORDS)


def whole(spark, parts):
    rows = [r for p in parts for r in p]
    return sorted(map(tuple, vb.build_vocab(frame(spark, rows), specials=tx.SPECIALS_SHORT).collect()))


def test_log_equals_one_build_and_stays_short(spark, monkeypatch):
    monkeypatch.setattr(vl, "FAN", 2)
    root, parts = tempfile.mkdtemp(prefix="lingotile-vocab-") + "/log", batches(6)
    for b, rows in enumerate(parts):
        vl.add_batch(frame(spark, rows), root, b, tx.SPECIALS_SHORT)
        live = vl.live_segments(spark, root)
        assert live[0].first == 0 and live[-1].last == b and len(live) <= bin(b + 1).count("1")
        assert len(vl._segments(spark, root)) <= 2 + 2 * (b + 1).bit_length()
        if b in (2, 5):
            assert sorted(map(tuple, vl.read(spark, root).collect())) == whole(spark, parts[:b + 1])


def test_batch_tried_again_and_broken_attempts(spark, monkeypatch):
    monkeypatch.setattr(vl, "FAN", 2)
    root, parts = tempfile.mkdtemp(prefix="lingotile-vocab-") + "/log", batches(3, seed=8)
    for b, rows in enumerate(parts):
        real, calls = vl._write, []

        def failing(spark, root, span, new, seen):   # the segment's tables are written, its marker is not
            calls.append(span)
            new.write.mode("overwrite").parquet(f"{root}/{'-'.join(map(str, span))}/new")
            raise OSError("lost")

        monkeypatch.setattr(vl, "_write", failing)
        with pytest.raises(OSError):
            vl.add_batch(frame(spark, rows), root, b, tx.SPECIALS_SHORT)
        monkeypatch.setattr(vl, "_write", real)
        vl.add_batch(frame(spark, rows), root, b, tx.SPECIALS_SHORT)
        vl.add_batch(frame(spark, rows), root, b, tx.SPECIALS_SHORT)      # the same batch once more
        assert calls
    assert sorted(map(tuple, vl.read(spark, root).collect())) == whole(spark, parts)
    with pytest.raises(ValueError):
        vl.add_batch(frame(spark, parts[0]), root, 9, tx.SPECIALS_SHORT)


def test_a_batch_writes_its_own_tokens_only(spark):
    root = tempfile.mkdtemp(prefix="lingotile-vocab-") + "/log"
    big = spark.range(30000).select(F.col("id").alias("doc_ord"), F.lit(0).alias("pos"),
                                    F.md5(F.col("id").cast("string")).alias("token"))
    vl.add_batch(big, root, 0, tx.SPECIALS_SHORT)
    vl.add_batch(frame(spark, [(40000, 0, "new"), (40000, 1, "new"), (40001, 0, "<unk>"), (40002, 0, None)]), root, 1,
                 tx.SPECIALS_SHORT)
    first, second = vl.live_segments(spark, root)
    assert (first.low, first.high, second.low, second.high) == (0, 30002, 30002, 30003)
    assert vl._new(spark, [second]).collect()[0].asDict() == {"id": 30002, "token": "new", "freq": 2, "is_special": False}
    assert vl._seen(spark, [second]).count() == 0
    with pytest.raises(FileNotFoundError):
        vl.read(spark, root + "-none")
