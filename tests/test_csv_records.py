"""Multi-line CSV from many splits against Spark's reader of whole files."""

import csv
import random

import pytest

from kinolens.sources import csv_records as cr

SCHEMA = "id int, text string, n int"


@pytest.fixture
def small_splits(spark):
    """Files are cut into splits of about 100 bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "100", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def written(path, rows, escape='"', header=True):
    with open(path, "w", newline="") as out:
        w = csv.writer(out, lineterminator="\n", escapechar="\\" if escape == "\\" else None, doublequote=escape == '"')
        if header:
            w.writerow(["id", "text", "n"])
        w.writerows(rows)
    return str(path)


def some_rows(n, seed):
    r = random.Random(seed)
    words = ["a", 'say "x"', "two\nlines", "\n\n", ",", "end\n", "plain text", "é日", 'q"']
    return [(i, " ".join(r.choice(words) for _ in range(r.randint(1, 12))), r.choice([r.randrange(99), ""])) for i in range(n)]


def same(spark, path, escape='"', header=True):
    got = cr.read_csv_split(spark, path, SCHEMA, header=header, escape=escape)
    want = spark.read.csv(path, schema=SCHEMA, header=header, multiLine=True, quote='"', escape=escape)
    key = lambda rows: sorted(map(repr, rows))
    assert key(got.collect()) == key(want.collect())
    return got


@pytest.mark.parametrize("seed", range(4))
def test_rows_equal_those_of_whole_files(small_splits, tmp_path, seed):
    """Several files, quotes doubled within fields, records over many splits."""
    for f in range(3):
        written(tmp_path / f"{f}.csv", some_rows(40, 10 * seed + f))
    same(small_splits, str(tmp_path))


def test_escaped_quotes_and_no_header(small_splits, tmp_path):
    rows = [(i, t.replace("\\", ""), n) for i, t, n in some_rows(60, 9)]
    same(small_splits, written(tmp_path / "a.csv", rows, "\\", header=False), "\\", header=False)


def test_one_record_over_many_splits(small_splits, tmp_path):
    rows = [(0, "x", 1), (1, "line\n" * 500, 2), (2, 'a "quoted" end', 3), (3, "\n" * 300, 4), (4, "y", 5)]
    assert same(small_splits, written(tmp_path / "a.csv", rows)).count() == 5


def test_one_file_is_read_by_many_tasks(small_splits, tmp_path):
    path = written(tmp_path / "a.csv", some_rows(300, 3))
    assert cr._lines(small_splits, path).rdd.getNumPartitions() > 20
    assert small_splits.read.csv(path, schema=SCHEMA, multiLine=True).rdd.getNumPartitions() == 1


def test_empty_files(small_splits, tmp_path):
    written(tmp_path / "a.csv", [])
    (tmp_path / "b.csv").write_text("")
    (tmp_path / "c.csv").write_text("id,text,n\n\n\n1,x,2\n\n")
    same(small_splits, str(tmp_path))
