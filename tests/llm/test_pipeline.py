"""The pipeline: every stage on its own input, and as a whole."""

import corpus_pipeline
from kinolens.llm.common import documents, stored
from kinolens.llm.decontaminate import decontaminate
from kinolens.llm.sentencepiece_codec import PieceCodec, model_path
from tests.llm import brute

SF = "/root/testdata/sf0.01"


def test_stages_in_turn(spark):
    docs = documents(spark, SF)
    columns = docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = {r.doc_id: r.text for r in docs.collect()}

    kept = stored(corpus_pipeline.quality(spark, docs, SF), "q")
    assert kept.columns == columns
    ids = {r.doc_id for r in kept.collect()}
    marked = [(i in ids) == (q == 1) for i, q in labels.items() if q is not None]
    assert sum(marked) > 0.97 * len(marked)

    single = stored(corpus_pipeline.near_duplicates(spark, kept, SF), "s")
    before = [(i, rows[i]) for i in sorted(ids)]
    expected = {c for _, _, c in brute.op6(before)}
    assert {r.doc_id for r in single.collect()} == expected

    clean = stored(corpus_pipeline.decontamination(spark, single, SF), "d")
    judged = brute.op5([(i, rows[i]) for i in sorted(expected)], items)
    assert {r.doc_id for r in clean.collect()} == {j[0] for j in judged if not j[5]}
    untouched = {j[0] for j in judged if j[2] == 0}
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert all(texts[i] == rows[i] for i in untouched)
    assert all(j[2] == 0 for j in brute.op5(list(texts.items()), items))

    private = stored(corpus_pipeline.personal_data(spark, clean, SF), "p")
    after = {r.doc_id: r.text for r in private.collect()}
    assert not any(brute.base_spans(t) for t in after.values())
    assert all(after[i] == t for i, t in texts.items() if not brute.base_spans(t))

    coder = PieceCodec(model_path())
    encoded = corpus_pipeline.encoding(spark, private, SF).collect()
    assert sorted(r.doc_id for r in encoded) == sorted(after)
    assert all(r.ids == ",".join(map(str, coder.encode(after[r.doc_id]))) and r.decoded == after[r.doc_id] for r in encoded)


def test_run(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert 0 < got.count() < 200
    assert [name for name, _ in corpus_pipeline.STAGES][-1].startswith("SentencePiece")


def test_decontamination_holds_one_worker_per_core(spark):
    """Judging and cutting are one map, and its rows are those of the judgement with the spans cut out."""
    words = [f"w{i}" for i in range(60)]
    leak = " ".join(f"q{i}" for i in range(20))
    rows = [(i, " ".join(words * 10) + (f" {leak} " if i % 3 == 0 else " ") + f"end{i}", 7) for i in range(1200)]
    rows += [(5000, leak, 1), (5001, None, 2), (5002, "", 3), (None, f"x {leak}", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").coalesce(1)
    items = spark.createDataFrame([("a", leak)], "item_id string, text string")
    kept = decontaminate(docs, items)
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    expected = []
    for i, t, n in rows[:1200] + rows[1201:1203]:
        cut = t and t.replace(leak, "")
        expected.append((i, cut, n if cut == t else len(cut)))
    assert [tuple(r) for r in kept.collect()] == expected
