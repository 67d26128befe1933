import os
import tempfile

import pytest
from pyspark.sql import functions as F

from lingotile.sources import readers as rd
from lingotile.sources import sinks as sk


def _tmp():
    return tempfile.mkdtemp(prefix="lingotile-test-")


def test_read_lines_cases(spark):
    d = _tmp()
    p = os.path.join(d, "a.txt")
    with open(p, "wb") as f:
        f.write("first\r\n\r\n  second  \rthird\n\n   \nlast".encode("utf-8"))
    got = [r.text for r in rd.read_lines(spark, p).orderBy("line_no").collect()]
    assert got == ["first", "second", "third", "last"]


def test_read_lines_missing(spark):
    with pytest.raises(FileNotFoundError):
        rd.read_lines(spark, "/nonexistent/xyz.txt")
    assert rd.read_lines(spark, "/nonexistent/xyz.txt", missing="empty").count() == 0


def test_read_corpus_order_and_labelled_txt(spark):
    d = _tmp()
    for lang, lines in {"es": ["hola", "adiós"], "en": ["hello"], "fr": ["salut", "", "merci"]}.items():
        with open(os.path.join(d, f"sample_{lang}.txt"), "w", encoding="utf-8") as f:
            f.write("\n".join(lines))
    c = rd.read_corpus(spark, {k: os.path.join(d, f"sample_{k}.txt") for k in ("es", "en", "fr")})
    assert [(r.lang, r.text) for r in c.orderBy("doc_ord").collect()] == [
        ("es", "hola"), ("es", "adiós"), ("en", "hello"), ("fr", "salut"), ("fr", "merci")]
    lab = rd.read_labelled_txt(spark, data_dir=d)
    assert [(r.text, r.label) for r in lab.orderBy("doc_ord").collect()] == [
        ("hola", 0), ("adiós", 0), ("hello", 1), ("salut", 2), ("merci", 2)]
    only = rd.read_labelled_txt(spark, spanish_file=os.path.join(d, "sample_es.txt"),
                                english_file=os.path.join(d, "missing.txt"))
    assert only.count() == 2


def test_read_csv_cases(spark):
    d = _tmp()
    p = os.path.join(d, "data.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write('text,language,lab\n"line one\nline two",ES,0\n"say ""hi""",en,1\n,Fr,2\nNA,en,1\n')
    df = rd.read_labelled_csv(spark, p).orderBy("line_no").collect()
    assert [(r.text, r.label) for r in df] == [("line one\nline two", 0), ('say "hi"', 1), ("", 2), ("NA", 1)]
    by_label = rd.read_labelled_csv(spark, p, label_col="lab").orderBy("line_no").collect()
    assert [r.label for r in by_label] == [0, 1, 2, 1]
    with pytest.raises(ValueError):
        rd.read_labelled_csv(spark, p, text_col="body")
    with pytest.raises(ValueError):
        rd.read_labelled_csv(spark, p, label_col="nope")
    with pytest.raises(FileNotFoundError):
        rd.read_labelled_csv(spark, os.path.join(d, "none.csv"))
    q = os.path.join(d, "bad.csv")
    with open(q, "w", encoding="utf-8") as f:
        f.write("text,language\nhallo,de\n")
    with pytest.raises(Exception, match="no label is mapped to language 'de'; mapped are es, en, fr"):
        rd.read_labelled_csv(spark, q).collect()


def test_sample_corpus_and_load_auto(spark):
    s = rd.sample_corpus(spark, 10)
    assert s.count() == 300
    first = s.orderBy("doc_ord").first()
    assert (first.text, first.label) == ("Hola, ¿cómo estás?", 0)
    df, src = rd.load_auto(spark, csv_path="/nonexistent.csv")
    assert src == "sample" and df.count() == 300
    df, src = rd.load_auto(spark, data_dir="/nonexistent-dir")
    assert src == "sample"


def test_corpus_from_lists(spark):
    assert rd.corpus_from_lists(spark, ["a", "b"], [1, 0]).count() == 2
    with pytest.raises(ValueError):
        rd.corpus_from_lists(spark, ["a"], [1, 0])
    with pytest.raises(ValueError):
        rd.corpus_from_lists(spark, [], [])


def test_vocab_and_summary_sinks(spark):
    from lingotile.operators import vocab as vb

    d = _tmp()
    v = vb.char_vocab(spark, "abc")
    sk.write_vocab(v, os.path.join(d, "v"))
    assert [r.token for r in sk.read_vocab(spark, os.path.join(d, "v")).orderBy("id").collect()] == \
        ["<pad>", "<unk>", "a", "b", "c"]
    hist = spark.createDataFrame([(1, 1.0, 0.9, 0.5, 0.6), (2, 0.8, 0.7, 0.7, 0.8)],
                                 "epoch int, train_loss double, val_loss double, train_accuracy double, val_accuracy double")
    sk.write_run_summary(spark, os.path.join(d, "summary"), {"epochs": 2}, {"vocab_size": 5}, hist,
                         {"overall_accuracy": 0.8, "total_samples": 10})
    j = spark.read.json(os.path.join(d, "summary")).first()
    assert list(j.training_history.val_losses) == [0.9, 0.7]
    assert j.evaluation.total_samples == 10
    assert F is not None


def _csv_file(path, rows, header, end="\n"):
    import csv

    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(",".join(header) + end)
        csv.writer(f, lineterminator=end).writerows(rows)


def _split_sizes(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")


@pytest.fixture
def split_conf(spark):
    yield lambda size: _split_sizes(spark, size)
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_csv_is_split_anywhere_and_equals_the_csv_module(spark, split_conf):
    import random

    from lingotile.sources.csv import read_csv

    rng, d, want = random.Random(4), _tmp(), []
    for f, end in enumerate(("\n", "\r\n", "\n")):
        rows = [("".join(rng.choice(["a", '"', "\n", ",", "é", "x y", "\n\n", '""', "\U0001F600"])
                         for _ in range(rng.randrange(0, 14))), f"{f}-{i}") for i in range(90)]
        if f == 2:
            rows[40] = ("\n".join('many "lines", one cell' for _ in range(60)), "2-40")  # spans several splits
        _csv_file(os.path.join(d, f"part{f}.csv"), rows, ["text", "lang"], end)
        want += rows
    seen = []
    for size, tasks in (("97", 60), ("1000", 5), ("1m", 1)):
        split_conf(size)
        assert spark.read.text(d).rdd.getNumPartitions() >= tasks
        rows, columns = read_csv(spark, d)
        assert columns == ["text", "lang"]
        got = rows.orderBy("record_id").collect()
        assert [(r.cells.text or "", r.cells.lang) for r in got] == want
        seen.append([r.record_id for r in got])
    assert seen[0] == seen[1] == seen[2] and len(set(seen[0])) == len(want)


def test_csv_quotes_and_missing_cells(spark, split_conf):
    from lingotile.sources import csv

    d = _tmp()
    p = os.path.join(d, "odd.csv")
    with open(p, "w", encoding="utf-8", newline="") as f:
        f.write('text,b\n5" disk,1\n"a ""b"" c",2\n\n"",3\nNA,4\n"NA",5\n,6\n"x\n\ny",7\nlast "word",8')
    for size in ("7", "1m"):
        split_conf(size)
        rows, _ = csv.read_csv(spark, p)
        got = {r.cells.b: r.cells.text for r in rows.collect()}
        assert got == {"1": '5" disk', "2": 'a "b" c', "3": None, "4": "NA", "5": "NA", "6": None, "7": "x\n\ny", "8": 'last "word"'}
        rows, _ = csv.read_csv(spark, p, na_values=csv.NA_VALUES)
        assert {r.cells.b for r in rows.collect() if r.cells.text is None} == {"3", "4", "5", "6"}
    with open(p, "w", encoding="utf-8") as f:
        f.write('text,b\n"open,1\nmore,2\n')
    with pytest.raises(Exception, match="quotes are not closed"):
        csv.read_csv(spark, p)
    with open(p, "w", encoding="utf-8") as f:
        f.write("text,b\n")
    assert csv.read_csv(spark, p)[0].count() == 0


def test_csv_ends_inside_is_the_plain_state_machine(spark):
    import itertools

    from lingotile.sources.csv import ends_inside

    def plain(line, inside):
        state = "quoted" if inside else "field"
        for c in line:
            if state == "quoted":
                state = "closing" if c == '"' else "quoted"
            elif state == "closing":
                state = "quoted" if c == '"' else "field" if c == "," else "plain"
            elif c == '"' and state == "field":
                state = "quoted"
            else:
                state = "field" if c == "," else "plain"
        return state == "quoted"

    lines = ["".join(x) for n in range(7) for x in itertools.product('",a', repeat=n)]
    got = spark.createDataFrame([(x,) for x in lines], "v string").select(
        "v", ends_inside(F.col("v"), False).alias("o"), ends_inside(F.col("v"), True).alias("i")).collect()
    assert [(r.o, r.i) for r in got] == [(plain(r.v, False), plain(r.v, True)) for r in got]


def test_csv_corpus_splits_alike_at_any_partitioning(spark, split_conf):
    from lingotile.operators.split import stratified_split

    d = _tmp()
    rows = [(f"line {i}\nand \"more\" of it", ("ES", "en", "Fr")[i % 3]) for i in range(120)]
    _csv_file(os.path.join(d, "c.csv"), rows, ["text", "language"])
    seen = []
    for size in ("500", "1m"):
        split_conf(size)
        c = rd.read_labelled_csv(spark, os.path.join(d, "c.csv"))
        seen.append(sorted((r.doc_id, r.text, r.split) for r in stratified_split(c, 0.8, 42).collect()))
    assert seen[0] == seen[1] and len(seen[0]) == 120
