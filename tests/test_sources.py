import csv
import random
from contextlib import contextmanager

import pytest

from chatsieve.sources import readers


def test_messages(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text(
        'index,message,label\n0,"he said ""hi"", ok",3.0\n1,"two\nlines",0\n2,NA,1\n3,null,1\n4,None,0\n5,,2\n6,fine,\n'
        "7,none,5\n8,n/a text,1.0\n,lost,1\n",
        encoding="utf-8",
    )
    rows = [(r["index"], r.message, r.label) for r in readers.read_messages(spark, str(path)).orderBy("index").collect()]
    assert rows == [(0, 'he said "hi", ok', 3), (1, "two\nlines", 0), (7, "none", 5), (8, "n/a text", 1)]
    kept = readers.read_messages(spark, str(path), na_tokens=[""])
    assert kept.filter("message = 'null'").count() == 1


def test_missing_column(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("index,text\n1,x\n")
    with pytest.raises(ValueError, match="message"):
        readers.read_messages(spark, str(path))


def test_usernames(spark, tmp_path):
    path = tmp_path / "u.csv"
    path.write_text("author,n\nann,1\nnull,2\nbob,3\n,4\ncat,5\n")
    assert [r.author for r in readers.read_usernames(spark, str(path)).collect()] == ["ann", "bob", "cat"]
    assert [r.author for r in readers.read_usernames(spark, str(path), 2).collect()] == ["ann"]


def test_wordlist(spark, tmp_path):
    path = tmp_path / "w.txt"
    path.write_text("  one \n\n\ttwo words\n   \nthree \n", encoding="utf-8")
    assert [r.word for r in readers.read_wordlist(spark, str(path)).collect()] == ["one", "two words", "three"]


def by_spark(spark, path):
    return sorted(tuple(r) for r in spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True).collect())


@contextmanager
def small_splits(spark):
    """The lines are read in splits of 64 bytes; later tables are not."""
    settings = {"maxPartitionBytes": "64", "openCostInBytes": "0", "minPartitionNum": "1"}
    for key, value in settings.items():
        spark.conf.set(f"spark.sql.files.{key}", value)
    try:
        yield
    finally:
        for key in settings:
            spark.conf.unset(f"spark.sql.files.{key}")


def test_a_file_with_line_breaks_is_split(spark, tmp_path):
    rng = random.Random(4)
    parts = ["a", "bc", " ", "\n", "\n\n", '"', ",", "é", "1", '""', "x,y", "\r\n"]
    for turn in range(4):
        rows = [[str(i)] + ["".join(rng.choice(parts) for _ in range(rng.randrange(7))) for _ in range(2)] for i in range(120)]
        path = tmp_path / f"{turn}.csv"
        with open(path, "w", newline="", encoding="utf-8") as file:
            writer = csv.writer(file, lineterminator="\r\n" if turn % 2 else "\n", quoting=csv.QUOTE_ALL if turn > 1 else csv.QUOTE_MINIMAL)
            writer.writerow(["index", "message", "label"])
            writer.writerows(rows)
        with small_splits(spark):
            assert spark.read.option("lineSep", "\n").text(str(path)).rdd.getNumPartitions() > 10
            records, fields = readers.csv_records(spark, str(path)), readers.read_csv(spark, str(path))
        assert records.count() == 120
        got = sorted((r[0], r.message or "", r.label or "") for r in fields.collect())
        plain = lambda t: t.replace("\r\n", "\n")
        assert [tuple(map(plain, r)) for r in got] == sorted(tuple(map(plain, r)) for r in rows)


def test_stray_quotes_end_with_their_line(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text(
        'index,message,label\n1,5" disk,0\n\n2,"two\nlines, and ""more""\n\nof them",1\n3,a "b" c,0\n4,"",\n5,"x" y,1\n6,"""q""",0\n'
        '7,"long\n' + "line\n" * 40 + 'end",3\n8,"last, one",2',
        encoding="utf-8",
    )
    with small_splits(spark):
        made = readers.read_csv(spark, str(path))
    got = sorted(tuple(r) for r in made.collect())
    assert got == by_spark(spark, str(path)) and len(got) == 8


def test_every_file_has_a_header(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.csv").write_text(f'index,message,label\n{k},"a\nb",1\n{k + 10},c,0\n')
    (tmp_path / "none.csv").write_text("index,message,label\n")
    with small_splits(spark):
        made = readers.read_messages(spark, str(tmp_path))
    got = [(r["index"], r.message) for r in made.orderBy("index").collect()]
    assert got == [(0, "a\nb"), (1, "a\nb"), (2, "a\nb"), (10, "c"), (11, "c"), (12, "c")]
