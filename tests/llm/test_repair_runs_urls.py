"""Conversation repair, periodic runs and the URL filter against plain-Python versions."""

import hashlib
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from lingotile.llm import catalog, periodic, repair, urls
from lingotile.llm.common import prepare

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---- conversation repair ------------------------------------------------

def brute_damage(rows):
    """(conv, turn, role, text) rows -> damaged ones; nulls are one space."""
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        d = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if d == 0:
            continue
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        for _ in range(2 if d == 3 else 1):
            yield conv, turn, "user" if d == 4 else role, text


def brute_repair(rows):
    """Rows in order as (turn, role, text) -> the contract's columns, by strings."""
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    seen, faults = set(), []
    for _, role, text in rows:
        words = WORD.findall(text)
        faults.append("blank" if not words else "duplicate" if (role, text) in seen
                      else "truncated" if words[-1][-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    go = {("0", "s"): "S", ("0", "u"): "U", ("S", "u"): "U", ("U", "a"): "A", ("A", "u"): "U"}
    after = {s: (0, "", ()) if s in "0A" else None for s in "0SUA"}

    def closed(v):
        for _ in range(4):
            for s in "0SUA":
                for c, name in (("u", "user"), ("a", "assistant")):
                    x = v.get(go.get((s, c)))
                    if x and (v[s] is None or (x[0] + 2, "I" + x[1]) < v[s][:2]):
                        v[s] = (x[0] + 2, "I" + x[1], (name + ":", x[2]))
        return v

    v = closed(after)
    for (_, role, text), fault in zip(rows[::-1], faults[::-1]):
        now = {}
        for s in "0SUA":
            ways = [(v[s][0] + 3, "D" + v[s][1], v[s][2])] if v[s] else []
            if fault in ("", "truncated"):
                more = fault == "truncated"
                for c, letter, name, price in ((role[:1], "K", role, 0), ("u", "R", "user", 2), ("a", "R", "assistant", 2)):
                    x = v.get(go.get((s, c)))
                    if x:
                        ways.append((x[0] + price + more, letter + x[1], (f"{name}:{text}", x[2])))
            now[s] = min(ways, key=lambda w: w[:2], default=None)
        v = closed(now)
    cost, audit, chain = v["0"]
    lines = []
    while chain:
        lines.append(chain[0])
        chain = chain[1]
    count = [faults.count(x) for x in ("blank", "duplicate", "truncated")]
    return (gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()), lines


def expected(rows):
    first = lambda r: (r[1] is not None, r[1] or 0, r[2], r[3][:64], hashlib.sha256(f"{len(r[2])}:{r[2]}:{r[3]}".encode()).digest())
    by = {c: [] for c, *_ in rows}
    for r in brute_damage(rows):
        by[r[0]].append(r)
    return {c: brute_repair([r[1:] for r in sorted(x, key=first)]) for c, x in by.items()}


CONVERSATION = "conv_id bigint, turn bigint, role string, text string"


def run_repair(spark, rows):
    prepare(spark)
    df = spark.createDataFrame(rows, CONVERSATION)
    for name in ("_c", "_m", "_p", "audit", "cost", "codes", "pieces"):
        df = df.withColumn(name, F.lit(name))
    got = repair.report(df.repartition(7)).collect()
    assert len(got) == len({r["conv_id"] for r in got})
    return {r["conv_id"]: tuple(r)[1:] for r in got}


def test_repair_on_the_table(spark):
    rows = duckdb.sql(f"select conv_id, turn, role, text from '{SF}/conversations.parquet'").fetchall()
    got = {r["conv_id"]: tuple(r)[1:] for r in catalog.op11_conversation_repair(spark, SF).collect()}
    assert got == {c: x for c, (x, _) in expected(rows).items()}


def test_repair_of_random_and_hot_conversations(spark, monkeypatch):
    monkeypatch.setattr(repair, "PIECE_BITS", 4)  # a piece holds 16 rows: conversations span many
    rng = random.Random(5)
    texts = ["Yes.", "No!", "why", "so it is", "", " \n\t", "Is it?", None, "ok.  ", "é…", "x" * 90 + "1.", "x" * 90 + "2"]
    roles = ["user", "assistant", "system", "tool", None, "", "User", "u", "agent"]
    rows = [(c, t if rng.random() < .9 else None, rng.choice(roles[:rng.choice((2, 3, 9))]), rng.choice(texts) if rng.random() < .6 else f"line {rng.random()}.")
            for c in [*range(60), None] for t in rng.sample(range(30), rng.randrange(1, 14))]
    rows += [(1000, t, rng.choice(roles[:3]), rng.choice((f"turn {t}", f"turn {t}.", "Yes.", ""))) for t in range(900)]
    rows += [(1001, None, "user", "the same row.")] * 700  # one row repeated: all but one are duplicates
    want = {c: x for c, (x, _) in expected(rows).items()}
    got = run_repair(spark, rows)
    assert set(got) == set(want)
    for c in want:
        assert got[c] == want[c], c


def test_repaired_messages(spark):
    prepare(spark)
    rows = [(c, t, r, f"{c} {t}." if t % 3 else "cut") for c in range(9) for t, r in enumerate(("assistant", "user", "user", "system", "assistant"))]
    made = repair.Repair(repair.rows_of(spark.createDataFrame(rows, CONVERSATION))).messages().collect()
    for c in range(9):
        own = sorted((r["position"], f"{r['role']}:{r['text']}", r["edit"]) for r in made if r["_c"] == str(c))
        (_, _, _, _, _, _, audit, _), lines = brute_repair([x[1:] for x in rows if x[0] == c])
        assert [x[1] for x in own] == lines
        assert "".join(x[2] for x in own) == audit.replace("D", "")


def test_repair_of_nothing(spark):
    assert run_repair(spark, []) == {}
    gone = next((7, t, "user", "a.") for t in range(99) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    assert run_repair(spark, [gone]) == {7: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


# ---- periodic runs ------------------------------------------------------

def brute_runs(words):
    n, found = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(24, 3 * q):
                part = words[i:i + length]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_runs_against_brute_force():
    rng = random.Random(2)
    for trial in range(400):
        words = []
        while len(words) < rng.randrange(1, 330):
            kind = rng.randrange(5)
            if kind == 0:
                words += [rng.choice("ab") for _ in range(rng.randrange(1, 40))]
            elif kind == 1:
                block = [rng.choice("abc") for _ in range(rng.randrange(1, 45))]
                words += (block * 8)[:rng.randrange(1, 5 * len(block) + 20)]
            elif kind == 2:
                words += ["x"] * rng.randrange(1, 60)
            elif kind == 3:
                words += [str(rng.random()) for _ in range(rng.randrange(1, 20))]
            else:
                block = (["p"] * rng.randrange(1, 30) + [rng.choice("qr")]) * rng.randrange(1, 4)
                words += block * rng.randrange(1, 6)
        assert periodic.find_runs(words) == brute_runs(words), (trial, words)


def test_long_uniform_and_nested_texts_are_fast():
    assert periodic.find_runs([b"x"] * 200_000) == [(0, 200_000, 1)]
    nested = ([b"a"] * 30 + [b"b"]) * 3_000
    runs = periodic.find_runs(nested)
    assert (0, len(nested), 31) in runs and sum(q == 1 for _, _, q in runs) == 3_000


def test_runs_on_the_table(spark):
    docs = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    got = {r["doc_id"]: tuple(r)[1:] for r in catalog.op12_periodic_runs(spark, SF).collect()}
    assert len(got) == len(docs)
    some = 0
    for i, text in docs:
        words = WORD.findall(text or "")
        h = zlib.crc32(str(i).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        runs = brute_runs(words) if len(words) < 1500 else periodic.find_runs(words)
        dropped = {k for s, n, q in runs for k in range(s + q, s + n)}
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        kept = " ".join(w for k, w in enumerate(words) if k not in dropped)
        assert got[i] == (len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()), i
        some += bool(runs)
    assert some >= 5


def test_runs_on_edge_rows(spark):
    prepare(spark)
    text = "a b c " * 20
    rows = [(1, None), (2, ""), (3, " \n "), (None, text), (4, text), (4, text), (5, "z" * 100_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("start", F.lit("x")).withColumn("_r", F.lit(1))
    got = periodic.report(df).collect()
    assert len(got) == len(rows) and periodic.report(df.limit(0)).count() == 0
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(r)[1:] for r in got if r["doc_id"] in (1, 2, 3)] == [(0, None, None, None, None, empty, empty)] * 3
    assert [r["period"] for r in got if r["doc_id"] in (None, 4)] == [3, 3, 3]
    assert [r["collapsed_sha256"] for r in got if r["doc_id"] is None] == [hashlib.sha256(b"a b c").hexdigest()]
    spans = df.select("doc_id", periodic.runs_of(F.col("text")).alias("r"), periodic.collapse(F.col("text")).alias("c")).collect()
    assert {(x["doc_id"], len(x["r"]), x["c"]) for x in spans if x["doc_id"] in (1, 4)} == {(1, 0, None), (4, 1, "a b c")}


# ---- url filter ---------------------------------------------------------

def brute_url(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), h + p, a) for a, h, p in urls.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), url or "")
    found = {t for t in urls.TERMS for m in re.finditer(f"(?={t})", lowered)
             if not lowered[:m.start()][-1:].isalnum() and not lowered[m.start() + len(t):][:1].isalnum()}
    strict = len(found & set(urls.STRICT))
    score = urls.LIMIT * strict + len(found) - strict
    rule, verdict = max(fits)[1:] if fits else (None, "block" if score >= urls.LIMIT else "allow")
    return host, path, rule, verdict, strict, len(found) - strict, score


URLS = [None, "", "://", "no scheme/casino", "HTTP://WWW.Example.COM/en/x?free=win#hot", "https://example.com/en", "https://a.example.com/en/",
        "https://www.example.com/en/?q", "x://y.net/es/://z.com/", "http://net/fr/", "http://notnet/fr/", "http://a.com", "http://a.com?casino",
        "http://casinos.org/", "http://my-casino.org/", "http://freewin.org/free/free", "http://free.org/a-WIN", "http://é.org/éfree/win",
        "http://u:p@free-bets.org:80#frag", "http://n.org/\nfree\nbets", "http://x.org/" + "a/" * 50_000 + "xxx", "http://x.org/sex/sexy/pills1"]


def test_urls_against_brute_force(spark):
    prepare(spark)
    pages = duckdb.sql(f"select page_id, url from '{SF}/pages.parquet'").fetchall()
    rows = pages + [(10_000 + i, u) for i, u in enumerate(URLS)] + [(None, URLS[4]), (10_004, URLS[4])]
    df = spark.createDataFrame(rows, "page_id bigint, url string")
    for name in ("host", "path", "rule", "verdict", "_w", "score"):
        df = df.withColumn(name, F.lit(name))
    got = urls.judge(df).collect()
    assert len(got) == len(rows) and urls.judge(df.limit(0)).count() == 0
    want = sorted(((i, *brute_url(u)) for i, u in rows), key=str)
    assert sorted((tuple(r) for r in got), key=str) == want


def test_urls_against_sql(spark):
    rows = [(i, u) for i, u in enumerate(URLS)]
    prepare(spark)
    got = sorted(tuple(r) for r in urls.judge(spark.createDataFrame(rows, "page_id bigint, url string")).collect())
    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar)")
    con.executemany("insert into pages values (?, ?)", rows)
    assert sorted(con.sql(urls.JUDGE_SQL).fetchall()) == got


@pytest.mark.parametrize("terms, limit, blocked", [({"alpha": 1, "beta": 1, "gamma": 1}, 3, {2}), ({"alpha": 5}, 5, {0, 1, 2})])
def test_other_vocabularies(spark, terms, limit, blocked):
    prepare(spark)
    rows = [(0, "http://a.org/alpha"), (1, "http://a.org/alpha-beta"), (2, "http://alpha.org/beta/gamma"), (3, "http://a.org/")]
    got = urls.judge(spark.createDataFrame(rows, "page_id bigint, url string"), terms=terms, limit=limit).collect()
    assert {r["page_id"] for r in got if r["verdict"] == "block"} == blocked
