"""Streams give what the batch operators give, and a rerun adds nothing."""

from pyspark.sql import functions as F

from kinolens.operators.ranking import longest_review
from kinolens.operators.tables import update_by_key
from kinolens.operators.vectors import hash_scorer, score_batches
from kinolens.session import fresh_dir
from kinolens.streaming import streams as sm

SCHEMA = "title_url string, pos long, review string"


def land(df, path):
    df.write.mode("append").parquet(path)


def test_new_titles_once(spark):
    landed, out, ckpt = (fresh_dir(spark, x) for x in ("landed", "titles", "ckpt"))
    seen = spark.createDataFrame([("s",)], "title_url string")
    pages = spark.createDataFrame([("s", 1), ("a", 1), ("a", 2), ("b", 1)], "title_url string, n int")

    def run():
        stream = sm.file_stream(spark, landed, pages.schema)
        sm.run_to_end(sm.stream_new_titles(stream, lambda p: p, seen, "title_url", out, ckpt, order="n"))
        return sorted((r.title_url, r.n) for r in spark.read.parquet(out).collect())

    land(pages, landed)
    assert run() == [("a", 1), ("b", 1)]
    assert run() == [("a", 1), ("b", 1)]
    land(spark.createDataFrame([("a", 7), ("c", 7)], pages.schema), landed)
    assert run() == [("a", 1), ("b", 1), ("c", 7)]


def test_replayed_batch_is_not_added_twice(spark):
    out = fresh_dir(spark, "batches")
    rows = spark.createDataFrame([("a", 1)], "title_url string, n int")
    sm._write_batch(rows, out, 0)
    sm._write_batch(rows, out, 0)
    assert spark.read.parquet(out).count() == 1
    assert sm.read_batches(spark, out, rows.schema, before=0).count() == 0
    assert sm.read_batches(spark, fresh_dir(spark, "none"), rows.schema).count() == 0


def test_longest_review_improves(spark):
    landed, out, ckpt = (fresh_dir(spark, x) for x in ("landed", "longest", "ckpt"))
    first = spark.createDataFrame([("f", 0, "a b"), ("f", 1, "c d"), ("g", 0, "")], SCHEMA)
    second = spark.createDataFrame([("f", 2, "e f g"), ("h", 0, "x")], SCHEMA)

    def run():
        stream = sm.file_stream(spark, landed, first.schema)
        sm.run_to_end(sm.stream_longest_review(stream, out, ckpt))
        return sorted(map(tuple, sm.latest_longest_review(spark, out, spark.read.parquet(landed)).collect()))

    land(first, landed)
    assert run() == [("f", 0, "a b", 2)]
    land(second, landed)
    whole = longest_review(first.unionByName(second)).select("title_url", "pos", "review", "wc")
    assert run() == sorted(map(tuple, whole.collect()))


def test_backfill_and_score(spark):
    landed, out, ckpt = (fresh_dir(spark, x) for x in ("landed", "filled", "ckpt"))
    rows = spark.createDataFrame([("f", 0, "a b"), ("g", 0, "")], SCHEMA)
    land(rows, landed)
    for _ in range(2):
        stream = sm.file_stream(spark, landed, rows.schema)
        sm.run_to_end(sm.stream_backfill(stream, "title_url", "review", hash_scorer(8), out, ckpt, 1))
    got = {r.title_url: (r.word_count, len(r.doc_vec)) for r in spark.read.parquet(out).collect()}
    assert got == {"f": (2, 8), "g": (0, 8)}
    scored, ckpt2 = fresh_dir(spark, "scored"), fresh_dir(spark, "ckpt")
    stream = sm.file_stream(spark, landed, rows.schema)
    sm.run_to_end(sm.stream_score(stream, lambda s: s.select("title_url", F.length("review").alias("p")), scored, ckpt2))
    assert spark.read.parquet(scored).count() == 2


def test_review_that_lands_twice_counts_once(spark):
    landed, out, ckpt = (fresh_dir(spark, x) for x in ("landed", "filled", "ckpt"))
    for text in ("a b", "a b c"):
        land(spark.createDataFrame([("f", 0, text)], SCHEMA), landed)
        stream = sm.file_stream(spark, landed, spark.read.parquet(landed).schema)
        sm.run_to_end(sm.stream_backfill(stream, "title_url", "review", hash_scorer(8), out, ckpt, 1))
    schema = spark.read.parquet(out).drop(sm.BATCH).schema
    got = sm.newest_by_key(spark, out, schema, "title_url")
    assert [(r.title_url, r.word_count) for r in got.collect()] == [("f", 3)]
    base = spark.createDataFrame([("f",)], "title_url string")
    assert update_by_key(base, got, "title_url", ["doc_vec", "word_count"]).count() == 1
    sm.merge_updates(spark, out, schema, "title_url", 5)
    assert sm.newest_by_key(spark, out, schema, "title_url").collect()[0].word_count == 3


def test_longest_review_on_repeated_and_null_positions(spark):
    """The stream keeps the row that the table operator takes, one per film."""
    landed, out, ckpt = (fresh_dir(spark, x) for x in ("landed", "longest", "ckpt"))
    parts = [[("f", 1, "a b c"), ("f", 1, "x y z"), ("g", None, "p q")], [("f", 1, "k l m"), ("g", None, "r s"), ("g", None, "p q"), ("h", None, "v")]]
    for part in parts:
        land(spark.createDataFrame(part, SCHEMA), landed)
        stream = sm.file_stream(spark, landed, spark.createDataFrame([], SCHEMA).schema)
        sm.run_to_end(sm.stream_longest_review(stream, out, ckpt))
    whole = spark.createDataFrame([r for p in parts for r in p], SCHEMA)
    got = sorted(map(tuple, sm.latest_longest_review(spark, out, whole).collect()))
    assert got == sorted(map(tuple, longest_review(whole).select("title_url", "pos", "review", "wc").collect())) and len(got) == 3


def test_a_batch_reads_the_buckets_of_its_keys(spark):
    """With much collected, a batch of one key opens the files of one bucket."""
    out, ckpt, landed = (fresh_dir(spark, x) for x in ("titles", "ckpt", "landed"))
    seen = spark.createDataFrame([], "title_url string")
    for part in ([(f"t{i}", i) for i in range(300)], [("t5", 9), ("new", 1)]):
        land(spark.createDataFrame(part, "title_url string, n int"), landed)
        stream = sm.file_stream(spark, landed, spark.read.parquet(landed).schema)
        sm.run_to_end(sm.stream_new_titles(stream, lambda p: p, seen, "title_url", out, ckpt, order="n", buckets=32))
    rows = spark.read.parquet(out)
    assert rows.count() == 301 and rows.select("title_url").distinct().count() == 301
    one = spark.createDataFrame([("t5",)], "title_url string").select(sm.key_bucket("title_url", 32)).first()[0]
    known = sm.known_keys(spark, out, rows.schema["title_url"].dataType, "title_url", [one], 2)
    assert 0 < len(known.inputFiles()) < len(rows.inputFiles()) / 8 and all(f"{sm.BUCKET}={one}/" in f for f in known.inputFiles())
    assert "ReadSchema: struct<title_url:string>" in known._jdf.queryExecution().toString()


def test_a_table_may_be_a_file_or_a_folder(spark):
    """Streams over given tables read both, and only the table that is named."""
    from kinolens.plans.q_stream import _arriving

    base = fresh_dir(spark, "tables")
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(5)], "n int, t string")
    rows.repartition(2).write.parquet(f"{base}/folder.parquet")
    rows.repartition(2).write.parquet(f"{base}/folders.parquet")
    rows.coalesce(1).write.parquet(f"{base}/parts")
    part = next(f for f in spark.read.parquet(f"{base}/parts").inputFiles())
    place = spark._jvm.org.apache.hadoop.fs.Path
    place(part).getFileSystem(spark._jsc.hadoopConfiguration()).rename(place(part), place(f"{base}/single.parquet"))
    for name in ("folder", "single"):
        out = fresh_dir(spark, "out")
        sm.run_to_end(sm.stream_score(_arriving(spark, base, name), lambda s: s, out, fresh_dir(spark, "ckpt")))
        assert sorted(map(tuple, spark.read.parquet(out).collect())) == [(i, f"t{i}") for i in range(5)]


def test_the_scorer_gets_lists_of_a_batch_and_keys_stay_whole(spark):
    big = (1 << 60) + 1
    rows = spark.createDataFrame([(big + i if i % 5 else None, None if i == 3 else f"t{i}") for i in range(25)], "id long, text string").coalesce(1)
    got = score_batches(rows, "id", "text", lambda texts: [[float(len(texts)), float(texts.count(None))] for _ in texts], 10).collect()
    assert [r.vec[0] for r in got] == [10.0] * 20 + [5.0] * 5 and sum(r.vec[1] for r in got) == 10.0
    assert [r.id for r in got] == [big + i if i % 5 else None for i in range(25)]


def test_a_batch_of_many_buckets_reads_the_list_of_keys(spark):
    """Not a file per bucket and earlier batch, which would grow with the number of batches; a table without a list gets one."""
    out, ckpt, landed = (fresh_dir(spark, x) for x in ("titles", "ckpt", "landed"))
    seen = spark.createDataFrame([("t3",)], "title_url string")
    for k in (0, 1, 0):
        land(spark.createDataFrame([(f"t{k * 40 + i}", k) for i in range(40)], "title_url string, n int").coalesce(1), landed)
    stream = sm.file_stream(spark, landed, spark.read.parquet(landed).schema, files_per_batch=1)
    sm.run_to_end(sm.stream_new_titles(stream, lambda p: p, seen, "title_url", out, ckpt, order="n", buckets=16))
    rows = spark.read.parquet(out)
    kind, want = rows.schema["title_url"].dataType, sorted(f"t{i}" for i in range(80) if i != 3)
    assert sorted(r.title_url for r in rows.collect()) == want
    for _ in range(2):
        keys = sm.all_keys(spark, out, kind, "title_url", 3)
        assert sorted(r.title_url for r in keys.collect()) == want and len(keys.inputFiles()) < len(rows.inputFiles()) / 4
        assert sm.all_keys(spark, out, kind, "title_url", 1).count() in (39, 40)
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/{sm.KEYS}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def test_null_keys_stay_new(spark):
    """A row without a key is known nowhere: each batch adds one."""
    out, ckpt, landed = (fresh_dir(spark, x) for x in ("titles", "ckpt", "landed"))
    seen = spark.createDataFrame([], "title_url string")
    for n in (1, 2):
        land(spark.createDataFrame([(None, n), (None, n + 5), ("a", n)], "title_url string, n int"), landed)
        stream = sm.file_stream(spark, landed, spark.read.parquet(landed).schema)
        sm.run_to_end(sm.stream_new_titles(stream, lambda p: p, seen, "title_url", out, ckpt, order="n", buckets=4))
    assert sorted((r.title_url or "", r.n) for r in spark.read.parquet(out).collect()) == [("", 1), ("", 2), ("a", 1)]
