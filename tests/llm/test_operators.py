"""Each operator against a brute-force version, an exact round trip or held-out accuracy."""

import hashlib
import struct
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from lingotile.llm import catalog, induced, language, minhash, multi_index, pack, pieces, quality, secrets, sentences, shard, substrings

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"select doc_id, text, lang from '{SF}/documents.parquet' order by 1").fetchall()


EDGE = [
    (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "   \n ", None, None, 1), (4, "word", "fr", "a", 4),
    (None, "the cat sat on the mat and then it ran. " * 30, "en", "b", 5),
    (5, "the cat sat on the mat and then it ran. " * 30, "en", "b", 5),
    (5, "the cat sat on the mat and then it ran. " * 30, "en", "b", 5),
    (6, "x" * 150_000, "de", "b", 6), (7, "token = abcdefghijklmnop ﬁ 你好 \U0001F600 " * 3, "fr", "c", 7),
    (8, " ".join(f"w{i}" for i in range(30_000)), "de", "c", 8),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls, empty and very long texts, repeated rows, and columns whose names operators use inside."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(EDGE, SCHEMA)
    for name in ("row", "node", "label", "bucket", "n", "n_words", "kept", "shard", "_t", "_w", "tile", "pos", "fp", "length",
                 "_id", "_d", "digest", "_digest", "rep", "component"):
        df = df.withColumn(name, F.lit(name))
    return df


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def operators():
    model, bpe = catalog.tokenizer_file("piece_bpe_32k.model"), catalog.tokenizer_file("byte_bpe_50k.json")
    from pyspark.sql import functions as F

    return {
        "language": language.identify,
        "substrings": substrings.report,
        "pieces": lambda d: d.select("doc_id", pieces.digests(F.col("text"), model).alias("r")),
        "pack": lambda d: pack.pack(d, bpe),
        "secrets": lambda d: d.select("doc_id", secrets.report(F.col("text")).alias("r")),
        "quality": quality.quality_report,
        "sentences": sentences.trim,
        "shard": shard.assign,
        "minhash": lambda d: minhash.near_duplicates(d, width=2),
    }


@pytest.mark.parametrize("name", ["language", "substrings", "pieces", "pack", "secrets", "quality", "sentences",
                                  "shard", "minhash"])
def test_edge_rows_and_empty_table(spark, edge, empty, name):
    from lingotile.llm.common import prepare

    prepare(spark)
    run = operators()[name]
    rows = run(edge).collect()
    assert len(rows) >= len(EDGE) if name == "pack" else len(rows) == len(EDGE)
    assert run(empty).count() == 0
    if name == "minhash":
        got = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
        assert got[5]["component_id"] == 5 and got[1]["n_shingles"] == 0 and got[4]["n_shingles"] == 1
        assert [r["component_id"] for r in rows if r["doc_id"] is None] == [5]
    if name == "substrings":
        assert {r["n_removed"] for r in rows if r["n_bytes"] == 1200} == {1200}
    if name == "language":
        assert {r["doc_id"]: r["lang_pred"] for r in rows}[1] == "und"


def test_pipeline_keeps_columns_on_edge_rows(spark, edge):
    import corpus_pipeline

    d = edge
    for name, stage in corpus_pipeline.STAGES[:-1]:
        d = stage(spark, d, SF)
        assert d.columns == edge.columns, name
    assert corpus_pipeline.STAGES[-1][1](spark, d, SF).count() >= 1


def test_induced_sorting_matches_sorting(monkeypatch):
    rng = np.random.default_rng(3)
    for block in (2, 7, 1 << 15):
        monkeypatch.setattr(induced, "BLOCK", block)
        for trial in range(40):
            t = rng.integers(1, int(rng.integers(2, 7)) + 1, int(rng.integers(1, 160)))
            t = np.append(np.tile(t[:max(1, len(t) // 5)], 5) if trial % 3 == 0 else t, 0).astype(np.int32)
            with induced.Store(0 if trial % 2 else 1 << 20) as store:
                got = induced.suffix_array(t, int(t.max()) + 1, store)
                assert list(got) == sorted(range(len(t)), key=lambda i: tuple(t[i:]))
                for n in (1, 3, 8):
                    grams = [tuple(t[i:i + n]) for i in range(len(t) - n + 1)]
                    c = Counter(grams)
                    want = [c[g] > 1 for g in grams] + [False] * (len(t) - len(grams))
                    assert list(induced.repeated(t, int(t.max()) + 1, n, store).astype(bool)) == want


def test_substrings_against_brute_force(spark, docs):
    n, count = substrings.LENGTH, Counter()
    raw = {i: (t or "").encode() for i, t, _ in docs}
    for b in raw.values():
        count.update(hash(b[i:i + n]) for i in range(len(b) - n + 1))
    for r in catalog.op3_suffix_array_dedup(spark, SF).collect():
        b = raw[r["doc_id"]]
        edge = np.zeros(len(b) + 1, int)
        for i in range(len(b) - n + 1):
            if count[hash(b[i:i + n])] > 1:
                edge[i] += 1
                edge[i + n] -= 1
        gone = np.cumsum(edge[:len(b)]) > 0
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1)
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (
            len(b), gone.sum(), spans, hashlib.sha256(kept).hexdigest())


def test_pieces_equal_the_library(spark, docs):
    import sentencepiece

    path = catalog.tokenizer_file("piece_bpe_32k.model")
    sp, codec = sentencepiece.SentencePieceProcessor(model_file=path), pieces.Codec(path)
    rng = np.random.default_rng(1)
    odd = ["", " ", "  a  b ", "x\x00y", "▁a ▁", "ﬁ １２ 你好😀", "<s></s><0x0A>", "a" * 400, "   \n  "]
    odd += ["".join(rng.choice(list("abcdeinorst  ▁\n'é1"), int(rng.integers(1, 60)))) for _ in range(500)]
    for t in odd + [t for _, t, _ in docs]:
        ids, back = codec.encode(t)
        want = sp.encode(t, add_bos=True, add_eos=True)
        assert [x[0] for x in struct.iter_unpack("<I", ids)] == want and back == sp.decode(want)


def test_pieces_with_bounded_tables(docs, monkeypatch):
    path = catalog.tokenizer_file("piece_bpe_32k.model")
    whole = pieces.Codec(path)
    monkeypatch.setattr(pieces, "CACHE_PAIRS", 3)
    monkeypatch.setattr(pieces, "CACHE_RUN_LENGTH", 1)
    small = pieces.Codec(path)
    for t in ["a    b  c", *[t for _, t, _ in docs[:50]]]:
        assert small.encode(t) == whole.encode(t)
    assert len(small.model.pairs) <= 3 and set(small.model.runs) <= {1}


def test_packing_is_whole_and_gapless(spark, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(catalog.tokenizer_file("byte_bpe_50k.json"))
    ids = {i: t.encode(x or "", add_special_tokens=False).ids + [0] for i, x, _ in docs}
    rows = catalog.op5_bin_completion_packing(spark, SF).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
    for i, parts in by_doc.items():
        parts.sort(key=lambda r: r["piece"])
        assert sum(r["length"] for r in parts) == len(ids[i]) and all(r["length"] == 2048 for r in parts[1:])
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    assert len(by_sequence) <= -(-sum(map(len, ids.values())) // 2048) + 2


def test_packing_plan_on_hard_lengths():
    rng = np.random.default_rng(4)
    for _ in range(5):
        counts = Counter(int(x) for x in rng.integers(1, 2049, 300))
        blocks, used = pack.plan(counts), Counter()
        for b in blocks:
            assert sum(b.lengths) <= 2048
            for n in b.lengths:
                used[n] += b.times
        assert used == counts
        assert sum(b.times for b in blocks) <= 1.05 * -(-sum(n * c for n, c in counts.items()) // 2048) + 1


def test_packing_plan_meets_known_optimum_of_mid_lengths():
    counts = {n: 30 for n in range(741, 761)} | {640: 1200}  # three to a sequence at most, 1800 pieces
    blocks, used = pack.plan(counts), Counter()
    for b in blocks:
        assert sum(b.lengths) <= 2048
        for n in b.lengths:
            used[n] += b.times
    assert used == counts and sum(b.times for b in blocks) == 600


def test_packing_plan_of_full_sequences_cut_in_three():
    def thirds(n, low, high):
        while n:
            a, b = (int(x) for x in rng.integers(low, high, 2))
            if low <= 2048 - a - b < high:
                n -= 1
                yield from (a, b, 2048 - a - b)

    for n, low, high, most in ((20, 513, 1024, 20), (500, 1, 2046, 500), (500, 513, 1024, 503)):
        rng = np.random.default_rng(n + low)
        counts, used = Counter(thirds(n, low, high)), Counter()
        blocks = pack.plan(counts)
        for b in blocks:
            assert sum(b.lengths) <= 2048
            for x in b.lengths:
                used[x] += b.times
        assert used == counts and sum(b.times for b in blocks) <= most


def test_other_tokenizer_files_are_refused(tmp_path):
    import json

    made = json.load(open(catalog.tokenizer_file("byte_bpe_50k.json")))
    for key, other in (("normalizer", {"type": "Lowercase"}), ("pre_tokenizer", {"type": "Whitespace"})):
        path = tmp_path / f"{key}.json"
        path.write_text(json.dumps(made | {key: other}))
        with pytest.raises(ValueError):
            pack.TokenIds(str(path))


def test_fillings_are_all_found_best_first():
    rng = np.random.default_rng(8)
    for _ in range(30):
        left = {int(s): int(rng.integers(1, 4)) for s in rng.choice(np.arange(2, 30), 9, replace=False)}
        taken, room = max(left), int(rng.integers(20, 40))
        want = {()}
        for s in sorted(left, reverse=True):
            want |= {f + (s,) * k for f in want for k in range(1, left[s] - (s == taken) + 1) if sum(f) + s * k <= room}
        got = list(pack.Fillings(left, room, taken))
        assert len(got) == len(set(got)) and set(got) == want
        assert [sum(f) for f in got] == sorted((sum(f) for f in got), reverse=True)


def test_secrets_against_plain_search(docs):
    rng = np.random.default_rng(5)
    bits = ["password", "Token", "=", ":", " ", "\"", "api_key", "apiKEY", "abcdefghijkl", "AKIA", "ABCDEFGH12345678",
            "0123456789abcdef", "é", "ſecret", "\n", "secret"]
    made = ["".join(rng.choice(bits, int(rng.integers(1, 14)))) for _ in range(3000)]
    for t in made + [t for _, t, _ in docs]:
        want = [(m.start(), 0, m.end()) for m in secrets.ASSIGN.finditer(t) if len(m[2]) >= 12]
        want += [(m.start(), 1, m.end()) for m in secrets.ACCESS.finditer(t) if m.end() - m.start() >= 18]
        want += [(m.start(), 2, m.end()) for m in secrets.HEX.finditer(t) if m.end() - m.start() >= 16]
        assert [s for s in secrets.scan(t) if s[1] < 3] == sorted(want)


def test_checked_tokens_need_their_checksum():
    body = "A" * 30
    n, out = zlib.crc32(body.encode()), ""
    while n:
        n, r = divmod(n, 62)
        out = secrets.BASE62[r] + out
    good = f"ghp_{body}{out.rjust(6, '0')}"
    assert [s[1] for s in secrets.scan(f"see {good} here")] == [3]
    assert not [s for s in secrets.scan(f"see ghp_{body}AAAAAA here") if s[1] == 3]


def test_embedded_checks_decide():
    import base64

    def kinds(text):
        return [(secrets.KINDS[k], text[s:e]) for s, k, e in secrets.scan(text)]

    head = base64.urlsafe_b64encode(b'{"alg":"HS256","typ":"JWT"}').rstrip(b"=").decode()
    bare = base64.urlsafe_b64encode(b'{"typ":"none at all"}').rstrip(b"=").decode()
    assert kinds(f"see {head}.e30.c2ln end") == [("signed", f"{head}.e30.c2ln")]
    assert not kinds(f"see {bare}.e30.c2ln x{head}.e30.c2ln eyJ####.e30.") and not kinds("eyJhbGci.e30.")
    good = "GB82 WEST 1234 5698 7654 32"
    for text in (f"IBAN: {good}", f"é iban {good} THEN MORE", f"Iban={good.replace(' ', '')}, paid"):
        assert [k for k, _ in kinds(text)] == ["account"] and kinds(text)[0][1].replace(" ", "") == good.replace(" ", "")
    assert not kinds("IBAN: GB83 WEST 1234 5698 7654 32") and not kinds(good)
    assert kinds("Card number: 4111 1111 1111 1111.") == [("card", "4111 1111 1111 1111")]
    assert not kinds("card 4111 1111 1111 1112") and not kinds("card 0000 0000 0000 0000") and not kinds("discard 4 cards")
    assert secrets.mask("my card 4111-1111-1111-1111, thanks") == "my card [SECRET], thanks"


def test_quality_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.execute(quality.REPORT_SQL).df().sort_values("doc_id").reset_index(drop=True)
    got = catalog.op7_host_quality(spark, SF).toPandas()[want.columns].sort_values("doc_id").reset_index(drop=True)
    assert got.astype(str).equals(want.astype(str))


def test_bad_host_loses_its_clean_documents(spark):
    rows = [(i, "one two" if i < 95 else " ".join(f"w{j}" for j in range(20)), "bad") for i in range(100)]
    rows += [(1000 + i, " ".join(f"w{j}" for j in range(20)), f"h{i % 5}") for i in range(100)]
    got = quality.quality_report(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    kept = {r["doc_id"] for r in got.where("kept").collect()}
    assert kept == {1000 + i for i in range(100)}


def test_sentence_spans_keep_the_first(spark):
    a = "The first sentence here has exactly eight words. Another one follows it with quite a few words too. And a third one. "
    rows = [(2, "Own words open this text. " + a + "Own words end it."), (1, a), (3, None), (4, "Short. Short.")]
    got = {r["doc_id"]: r for r in sentences.trim(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[1]["n_removed"] == 0 and got[1]["text"] == a
    assert got[2]["text"] == "Own words open this text. Own words end it."
    assert got[3]["text"] is None and got[4]["n_removed"] == 0


def trimmed_by_all_runs(texts):
    """Sentences that stay, from every run of two and more sentences and 20 and more words."""
    cut = {i: sentences.sentences_of(t) for i, t in texts}
    assert all("".join(cut[i]) in (t, "") for i, t in texts)
    first, gone = {}, {i: set() for i in cut}
    for i in sorted(cut):
        words = [s.split() for s in cut[i]]
        size = [sentences.words_in(s) for s in cut[i]]
        for a in range(len(words)):
            for b in range(a + 2, len(words) + 1):
                if sum(size[a:b]) >= 20 and first.setdefault(str(words[a:b]), (i, a)) != (i, a):
                    gone[i] |= set(range(a, b))
    return {i: "".join(s for k, s in enumerate(cut[i]) if k not in gone[i]) for i in cut}


def test_sentence_spans_cover_every_repeated_run(spark):
    rng = np.random.default_rng(9)

    def sentence(n, tag):
        return " ".join(f"{tag}{k}" for k in range(n)) + ". "

    passage = sentence(30, "a") + sentence(14, "b") + sentence(5, "c")
    rows = [(1, sentence(3, "x") + passage + sentence(25, "y")), (2, passage + sentence(25, "z"))]
    made = [sentence(int(n), "pqr"[k % 3]) for k, n in enumerate(rng.integers(1, 26, 12))]
    rows += [(3 + k, "".join(made[j] for j in rng.integers(0, 12, 15))) for k in range(40)]
    got = {r["doc_id"]: r for r in sentences.trim(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[2]["text"] == sentence(25, "z") and got[1]["n_removed"] == 0
    assert {i: r["text"] for i, r in got.items()} == trimmed_by_all_runs(rows)


def test_sentence_spans_against_all_runs(spark, docs):
    got = {r["doc_id"]: r["text"] for r in catalog.op8_sentence_spans(spark, SF).collect()}
    assert got == trimmed_by_all_runs([(i, t) for i, t, _ in docs])


def test_sentence_spans_that_are_hot(spark, docs, monkeypatch):
    """Every repeated span is hot, none is, or those in between: the same sentences go."""
    passage = " ".join(f"w{k}" for k in range(30)) + ". Then five words follow here. "
    other = " ".join(f"v{k}" for k in range(30)) + ". And five words end it. "
    rows = [(i, f"Own start {i}. " + passage * (1 + i % 2) + other * (i % 7 == 0) + f"Own end {i}.") for i in range(300)]
    want = trimmed_by_all_runs(rows)
    for share in (10 ** 9, 5, 0):
        monkeypatch.setattr(sentences, "HOT_SHARE", share)
        got = sentences.trim(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
        assert {r["doc_id"]: r["text"] for r in got} == want


def test_sentences_take_their_closing_quotes():
    assert sentences.sentences_of('He said "Go now." Then he left. (So.) Yes') == [
        'He said "Go now." ', "Then he left. ", "(So.) ", "Yes"]
    assert sentences.sentences_of('Version 1.2 "a.b" c') == ['Version 1.2 "a.b" c']


def test_sentence_spans_in_other_scripts(spark):
    assert sentences.sentences_of("你好。「再见！」他说。") == ["你好。", "「再见！」", "他说。"]
    assert sentences.sentences_of("यह है। वह था। ") == ["यह है। ", "वह था। "]
    assert sentences.sentences_of("ما هذا؟ هذا كتاب۔ ") == ["ما هذا؟ ", "هذا كتاب۔ "]
    assert sentences.words_in("你好 world。") == 3 and sentences.words_in("two words. ") == 2
    same = "今天的天气非常好我们去公园。然后大家一起回家吃晚饭。"
    rows = [(1, "第一篇文章的开头。" + same + "结尾不同。"), (2, "另外一个开头在这里。" + same + "别的结尾。")]
    got = {r["doc_id"]: r for r in sentences.trim(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[1]["n_removed"] == 0 and got[2]["text"] == "另外一个开头在这里。别的结尾。"


def test_shards_move_only_into_the_new_one(spark, docs):
    rows = catalog.op9_hash_tree_shards(spark, SF).collect()
    text = {i: (t or "").encode() for i, t, _ in docs}
    slots = {}
    for r in rows:
        assert r["grown_shard"] in (r["shard"], 8) and 0 <= r["shard"] < 8
        assert (r["size"], r["text_crc32"]) == (len(text[r["doc_id"]]) + 1, zlib.crc32(text[r["doc_id"]]))
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 8
    assert {r["grown_shard"] for r in rows} == set(range(9))


def test_shards_are_the_draws_of_the_tree(spark):
    """Places from hashes of the xxhash library, level by level."""
    import math

    import xxhash

    def descend(key, node, path=""):
        while node.children:
            def lot(c):
                h = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
                h = xxhash.xxh64_intdigest(f"0/{path}/{c.name}".encode(), h)
                return -math.log(((h >> 12) + 0.5) / 2 ** 52) / c.weight

            node = min(node.children, key=lot) if len(node.children) > 1 else node.children[0]
            path += f"/{node.name}"
        return node.shard

    for r in catalog.op9_hash_tree_shards(spark, SF).collect():
        assert r["shard"] == descend(r["doc_id"], shard.layout(8))
        assert r["grown_shard"] == descend(r["doc_id"], shard.layout(9, 8))


def test_shard_weights_decide_shares(spark):
    from pyspark.sql import functions as F

    tree = shard.layout(4, region_size=2, rack_size=1, weights={0: 3.0})
    got = dict(spark.range(20_000).groupBy(shard.place(F.col("id"), tree).alias("s")).count().collect())
    assert abs(got[0] - 10_000) < 500 and abs(got[3] - 3333) < 300


def test_near_duplicates_against_all_pairs(spark, docs):
    sets = {}
    for i, t, _ in docs:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset([tuple(w)] if w else [])
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    for r in catalog.op10_minhash_dedup(spark, SF).collect():
        assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), find(r["doc_id"]))
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_residual_links_join_what_stars_miss(spark):
    """A chain a-b-c where the ends are not near each other."""
    base = [f"w{i}" for i in range(400)]
    rows = [(k, " ".join(base[10 * k:10 * k + 200])) for k in range(15)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), width=2)
    assert {r["component_id"] for r in got.collect()} == {0}


def test_rows_without_id_link_like_others(spark):
    base = [f"w{i}" for i in range(200)]
    near = [" ".join(base[:100] + [f"x{k}"] + base[101:]) for k in range(3)]
    schema = "doc_id bigint, text string, _id int"
    rows = [(1, near[0], 0), (3, near[1], 1), (None, near[2], 2), (None, near[2], 3), (None, "other words altogether here", 4),
            (None, " ".join(base[::-1]), 5), (None, " ".join(base[::-1] + ["end"]), 6), (5, None, 7), (5, "", 8)]
    docs = spark.createDataFrame(rows, schema)
    got = minhash.near_duplicates(docs, width=2).collect()
    assert sorted(((r["doc_id"] or 0, r["component_id"] or 0) for r in got)) == [
        (0, 0), (0, 0), (0, 0), (0, 1), (0, 1), (1, 1), (3, 1), (5, 5), (5, 5)]
    kept = minhash.deduplicated(docs, width=2)
    assert kept.columns == docs.columns
    left = {r["_id"] for r in kept.collect()}
    assert left - {5, 6} == {0, 4, 7, 8} and len(left & {5, 6}) == 1


def test_multi_index_with_repeated_rows(spark):
    rng = np.random.default_rng(11)
    points = [(i, rng.random(4).tolist()) for i in range(101, 131)]
    own = (100, rng.random(4).tolist())
    for times in (1, 3, 12, 40):
        rows = points + [own] * times + [points[0]] * 3
        got = multi_index.search(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).orderBy("rank").collect()
        d = sorted((float(np.sqrt(((np.array(x) - own[1]) ** 2).sum())), i) for i, x in rows if i != 100)[:10]
        assert [(r["rank"], r["vec_id"]) for r in got] == [(n + 1, i) for n, (_, i) in enumerate(d)]


def test_multi_index_recall_where_the_probe_prunes(spark):
    """Few first entries, so that most cells stay closed: clusters and a sphere."""
    rng = np.random.default_rng(12)
    centers = rng.normal(size=(60, 16))
    for x in (centers[rng.integers(0, 60, 6000)] + 0.15 * rng.normal(size=(6000, 16)), rng.normal(size=(6000, 16))):
        rows = [(i, v.tolist()) for i, v in enumerate(x)]
        got = multi_index.search(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), first=100).collect()
        found = {}
        for r in got:
            found.setdefault(r["query_id"], set()).add(r["vec_id"])
        hits = 0
        for q in range(0, 6000, 100):
            order = np.argsort(((x - x[q]) ** 2).sum(1))
            hits += len(found[q] & set(order[order != q][:10].tolist()))
        assert len(found) == 60 and hits >= 0.9 * 600, hits


def test_multi_index_recall_and_order(spark):
    r = duckdb.sql(f"select vec_id, embedding from '{SF}/embeddings.parquet' order by 1").fetchnumpy()
    ids, x = r["vec_id"], np.stack(r["embedding"]).astype(float)
    got, hits, total = {}, 0, 0
    for row in catalog.op1_inverted_multi_index(spark, SF).collect():
        got.setdefault(row["query_id"], {})[row["rank"]] = (row["vec_id"], row["score"])
    assert set(got) == {int(i) for i in ids if i % 100 == 0}
    for q, found in got.items():
        d = np.sqrt(((x - x[ids == q]) ** 2).sum(1))
        best = [int(ids[j]) for j in np.lexsort((ids, d)) if ids[j] != q][:10]
        hits, total = hits + len(set(best) & {v for v, _ in found.values()}), total + 10
        assert sorted(found) == list(range(1, 11)) and [s for _, (_, s) in sorted(found.items())] == sorted(s for _, s in found.values())
    assert hits >= 0.9 * total


def test_multi_index_edge_vectors(spark):
    nan = float("nan")
    rows = [(100, [1.0, 0.0]), (200, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]),
            (None, [1.0, 1.0]), (5, [1.0, None]), (6, [1.0]), (7, [0.0, 2.0]), (300, [0.0, 0.0])]
    rows += [(1000 + i, [1.0, 0.0]) for i in range(1, 40)]
    got = multi_index.search(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    found = {}
    for r in got.orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    assert found[100][:3] == [1, 200, 1001] and found[200][:2] == [1, 100]
    assert all(len(v) == 10 for v in found.values()) and not {2, 3, 4, 5, 6, 300} & {i for v in found.values() for i in v}
    none = spark.createDataFrame([], "vec_id bigint, embedding array<double>")
    assert multi_index.search(none).count() == 0


def test_pairs_come_in_order_of_sums():
    rng = np.random.default_rng(6)
    a, b = rng.random(7), rng.random(9)
    got = list(multi_index.pairs_by_sum(a, b))
    assert len({(i, j) for _, i, j in got}) == 63 and [s for s, _, _ in got] == sorted(s for s, _, _ in got)


def test_language_accuracy_on_held_out(spark, docs):
    lang = {i: x for i, _, x in docs}
    rows = catalog.op2_word_backoff_language(spark, SF).collect()
    out = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in out} == {i for i in lang if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in out) >= 0.95 * len(out)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_words_are_letters_and_their_marks():
    assert language.words_of("हिन्दी ไทยที่ naïve x²y ½ ٣ _a1") == ["हिन्दी", "ไทยที่", "naïve", "x", "y", "a"]
    assert language.words_of("² ½ \u0301 123") == [] and language.words_of(None) == []
    scorer = language.Scorer(language.Model(["en"], [("en", "a", 0, 1)], {("en", 0): 1}))
    assert scorer("² ½") == ("und", 0.0) and scorer("a")[0] == "en"


def test_both_word_patterns_agree():
    for code in (*range(0xD800), *range(0xE000, 0x3000)):
        t = f"a{chr(code)}b"
        assert language.words_of(t) == language.LETTERS.findall(t.lower()), hex(code)


@pytest.mark.parametrize("letters", ["abcdé", "".join(map(chr, range(0x4E00, 0x9E00)))])  # few, and too many for a code
def test_gram_counts_are_the_plain_ones(letters):
    rng = np.random.default_rng(13)
    words = ["".join(rng.choice(list(letters), int(rng.integers(1, 9)))) for _ in range(4000)]
    n = rng.integers(1, 9, len(words))
    for size, (grams, counts) in enumerate(language.grams_with_counts(words, n), 1):
        want = Counter()
        for w, k in zip(words, n.tolist()):
            for g in language.grams_of(w, size):
                want[g] += k
        assert dict(zip(grams, counts.tolist())) == want and len(grams) == len(want)


def test_language_against_a_plain_scorer(spark, docs):
    """Whole predictions from whole counts, without the library's model."""
    words, grams = {}, {}
    for i, t, lang in docs:
        if lang is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            words.setdefault(lang, Counter()).update(language.words_of(t))
    langs = sorted(words)
    for lang in langs:
        for w, k in words[lang].items():
            for n in (1, 2, 3, 4):
                for g in language.grams_of(w, n):
                    grams.setdefault((lang, n), Counter())[g] += k
    table = {0: words} | {n: {lang: grams[lang, n] for lang in langs} for n in (1, 2, 3, 4)}
    known = {k: set().union(*(c.keys() for c in v.values())) for k, v in table.items()}
    log = lambda kind, item: np.array([np.log((table[kind][x][item] + 0.5) / (table[kind][x].total() + 0.5 * (len(known[kind]) + 1))) for x in langs])

    def score(w):
        if w in known[0]:
            return log(0, w)
        for n in (4, 3, 2, 1):
            hit = [g for g in language.grams_of(w, n) if g in known[n]]
            if hit:
                return np.mean([log(n, g) for g in hit], axis=0)
        return np.zeros(len(langs))

    cache = {}
    for r in catalog.op2_word_backoff_language(spark, SF).collect():
        text = next(t for i, t, _ in docs if i == r["doc_id"])
        total = sum((cache.setdefault(w, score(w)) if w not in cache else cache[w] for w in language.words_of(text)), np.zeros(len(langs)))
        if not language.words_of(text):
            assert r["lang_pred"] == "und"
            continue
        p = np.exp(total - total.max())
        assert r["lang_pred"] == langs[int(total.argmax())] and abs(r["score"] - p.max() / p.sum()) < 1e-9


def test_language_model_holds_whole_counts_of_kept_items(spark):
    rows = [("a", "shared " * 5 + "alone " * 9), ("b", "other " * 8 + "more " * 7 + "shared " * 6)]
    model = language.learn(spark.createDataFrame(rows, "lang string, text string"), vocabulary=2)
    scale = np.array([14, 21]) + 0.5 * (len(model.known[0]) + 1)
    words = {w: np.exp(model.score(w)) * scale - 0.5 for w in model.known[0]}
    # Two words of each language; "shared" is third in b, with its count there.
    assert {w: [round(x) for x in n] for w, n in words.items()} == {
        "alone": [9, 0], "shared": [5, 6], "other": [0, 8], "more": [0, 7]}


def test_anchor_hit_in_every_window():
    rng = np.random.default_rng(7)
    data = bytes(rng.integers(97, 100, 3000, dtype=np.uint8))
    _, pos = substrings.anchors_in(data, 200, 48)
    assert all(any(i <= p <= i + 48 for p in pos) for i in range(len(data) - 199))
