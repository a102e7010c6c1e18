"""The near-duplicate stage of the pipeline against planted near copies and exact five-word similarity."""

import random

import pytest

import corpus_pipeline
from kinolens.llm import near_copies


def words(r, n):
    return ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n)]


def changed(r, given, n):
    out = list(given)
    for i in r.sample(range(len(out)), n):
        out[i] = words(r, 1)[0]
    return out


def similarity(a, b):
    a, b = ({tuple(t.lower().split()[k : k + 5]) for k in range(max(1, len(t.split()) - 4))} for t in (a, b))
    return len(a & b) / len(a | b)


def planted():
    r = random.Random(3)
    rows = []
    for g in range(12):
        base = words(r, 150)
        rows += [(10 * g, " ".join(base)), (10 * g + 1, " ".join(changed(r, base, 2)).upper()), (10 * g + 2, " ".join(base + words(r, 20))), (10 * g + 3, " ".join(changed(r, base, 25)))]
    return [*rows, (500, "a few words"), (501, "A few  words"), (502, "a few other"), (None, " ".join(words(r, 30))), (600, None), (601, "")]


@pytest.mark.parametrize("list_length", [64, 2])
def test_planted_near_copies(spark, list_length):
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    kept = near_copies.keep_first_copy(docs, list_length=list_length)
    assert kept.columns == docs.columns
    got = {r.doc_id for r in kept.collect()}
    assert got == {10 * g + k for g in range(12) for k in (0, 3)} | {500, 502, None, 600}
    texts = dict(rows)
    assert all(similarity(texts[10 * g], texts[10 * g + k]) >= 0.8 for g in range(12) for k in (1, 2))
    assert all(similarity(texts[10 * g], texts[10 * g + 3]) < 0.8 for g in range(12))


def test_crowded_group(spark):
    r = random.Random(4)
    base = words(r, 120)
    docs = spark.createDataFrame([(i, " ".join(changed(r, base, 1))) for i in range(300)] + [(900, " ".join(words(r, 120)))], "doc_id bigint, text string")
    assert {x.doc_id for x in near_copies.keep_first_copy(docs).collect()} == {0, 900}
    assert near_copies.keep_first_copy(docs.limit(0)).count() == 0


def test_crowd_around_the_bar(spark):
    """Texts that share 160 of 182 words are below the bar; pairs planted among them are above it."""
    r = random.Random(6)
    base = words(r, 160)
    texts = []
    for _ in range(150):
        own = words(r, 22)
        texts += [base + own, base + own[:10] + words(r, 12)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    assert similarity(rows[0][1], rows[1][1]) >= 0.8 > similarity(rows[0][1], rows[2][1])
    kept = near_copies.keep_first_copy(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {x.doc_id for x in kept.collect()} == {i for i, _ in rows if i % 2 == 0}


def test_links_as_by_brute_force(spark):
    """Groups at all distances, in lists so short that rounds with leaders decide most."""
    r = random.Random(8)
    rows = []
    for _ in range(3):
        base = words(r, 120)
        for k in range(40):
            rows.append((len(rows), " ".join(changed(r, base, k % 8))))
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {x.doc_id for x in near_copies.keep_first_copy(docs, list_length=3).collect()} == {find(i) for i in sets}


def test_stage_drops_near_copies(spark):
    docs = spark.createDataFrame(planted(), "doc_id bigint, text string")
    stage = dict(corpus_pipeline.STAGES)["SimHash near-dedup"]
    assert not {10 * g + k for g in range(12) for k in (1, 2)} & {r.doc_id for r in stage(spark, docs, "").collect()}


def test_sets_leave_in_parts():
    """What a task holds at a time does not grow with the rows of a batch."""
    import pyarrow as pa

    r = random.Random(8)
    text = " ".join(words(r, 2000))
    batch = pa.record_batch({"node": pa.array(range(400)), "text": pa.array([text] * 400)})
    parts = list(near_copies._whole(5)([batch]))
    assert sum(p.num_rows for p in parts) == 400 and [i for p in parts for i in p.column("node").to_pylist()] == list(range(400))
    assert max(p.nbytes for p in parts) < 4 << 20


def test_frequent_counts_all_shingles(spark):
    r = random.Random(9)
    common, seldom = words(r, 12), words(r, 9)
    rows = [(" ".join([*common, *words(r, 5)]),) for _ in range(40)] + [(" ".join([*seldom, *words(r, 5)]),) for _ in range(35)] + [(None,)]
    values, ranks = near_copies.frequent(spark.createDataFrame(rows, "text string").repartition(3).selectExpr("coalesce(text, '') as text"), 5, 32)
    import pyarrow as pa

    cut = lambda w: near_copies.shingle_sets(pa.array([" ".join(w)]))[0] >> near_copies._CUT
    assert sorted(values.tolist()) == sorted([*cut(common).tolist(), *cut(seldom).tolist()])
    rank = dict(zip(values.tolist(), ranks.tolist(), strict=True))
    assert max(rank[s] for s in cut(seldom).tolist()) < min(rank[s] for s in cut(common).tolist())


def test_sets_meet_one_range_at_a_time(spark, monkeypatch):
    """Distances are those of whole sets, but no join ships more than one range of them; hopeless pairs leave after the first."""
    import re

    import pyarrow as pa

    r = random.Random(10)
    base = words(r, 200)
    texts = [" ".join(t) for t in (base, changed(r, base, 3), changed(r, base, 60), words(r, 200))]
    batch = pa.record_batch({"node": pa.array(range(len(texts))), "text": pa.array(texts)})
    rows = [row for part in near_copies._whole(5)([batch]) for row in part.to_pylist()]
    kinds = ", ".join(f"{name} array<bigint>" for name in near_copies.SLICE_NAMES)
    sets = near_copies.stored(spark.createDataFrame(rows, f"node bigint, n int, {kinds}"), "sets")
    pairs = near_copies.stored(spark.createDataFrame([(0, k) for k in (1, 2, 3)], "a bigint, b bigint"), "pairs")
    plans, sizes = [], []

    def spied(df, name, codec=None):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        sizes.append(df.count())
        return stored(df, name, codec)

    stored = near_copies.stored
    monkeypatch.setattr(near_copies, "stored", spied)
    far = {x.b: (x.far, x.linked) for x in near_copies._compared(pairs, sets, 0.8).collect()}
    assert all(far[k][0] == pytest.approx(1 - similarity(texts[0], texts[k])) for k in (1, 2, 3))
    assert [far[k][1] for k in (1, 2, 3)] == [True, False, False]
    assert all(len(set(re.findall(r"s\d+:array<bigint>", plan))) == 1 for plan in plans) and len(plans) == near_copies.SLICES
    del plans[:], sizes[:]
    assert [(x.b, x.far) for x in near_copies._compared(pairs, sets, 0.8, exact=False).collect() if x.linked] == [(1, far[1][0])]
    assert sizes[0] < 3
