"""The numbered operators against brute force, on real rows and on awkward ones."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F

from kinolens.llm import (
    components, decontaminate, fingerprints, licenses, pii, quality, repeats, sentencepiece_codec, simhash, substring_dedup, suffix_dedup, token_counts,
)
from tests.llm import brute

SF = "/root/testdata/sf0.001"
#: Columns of the input that have names the operators use within.
EXTRA = "mark string, doc string, row string, fp string, n_words string, stretches string, runs string, left string, stats string, spans string"


def some_documents():
    table = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).slice(0, 70)
    return list(zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True))


def awkward_rows():
    """Nulls, empty and long texts, ties, repeated rows, rows without an id."""
    r = random.Random(5)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6))) for _ in range(400)]
    passage = " ".join(r.choice(vocabulary) for _ in range(60))
    rows = [(1000, None), (1001, ""), (1002, "   \n\t "), (1003, "one"), (1004, "two words"), (1005, "a" * 3000), (1006, "ab" * 1500)]
    rows += [(1100 + i, " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 80)))) for i in range(15)]
    rows += [(1200 + i, " ".join(r.choice(vocabulary) for _ in range(r.randint(5, 40))) + "\n" + passage + " " + r.choice(vocabulary)) for i in range(8)]
    rows += [(1207, passage), (1207, passage), (1300, passage), (None, passage + " end"), (None, None)]
    rows += [(1400, passage.replace(" ", "  ")), (1401, " ".join(r.choice(vocabulary) for _ in range(9000))), (1402, "é日😀 " * 40 + passage)]
    return rows


def frame(spark, rows):
    df = spark.createDataFrame([(i, t) for i, t in rows], "doc_id bigint, text string").repartition(3)
    for column in EXTRA.split(", "):
        df = df.withColumn(column.split()[0], F.lit(None).cast("string"))
    return df


def collected(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def rows():
    return some_documents() + awkward_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows)


@pytest.fixture(scope="module")
def nothing(spark):
    return frame(spark, [])


# ---- 1 and 7: repeated passages ----


@pytest.mark.parametrize(("hot", "group"), [(repeats.HOT, repeats.GROUP), (1, 1), (6, 2)])
def test_repeated_words(docs, rows, hot, group):
    got = substring_dedup.remove_repeated_words(docs, hot=hot, group=group)
    assert collected(got, "doc_id", "n_words", "n_removed", "kept_sha256") == Counter(brute.op1(rows))


@pytest.mark.parametrize(("window", "hot"), [(1, 1000), (2, 1000), (5, 2), (30, 1000)])
def test_other_windows_of_words(spark, window, hot):
    rows = awkward_rows()
    got = substring_dedup.remove_repeated_words(frame(spark, rows), window, hot=hot)
    assert collected(got, "doc_id", "n_words", "n_removed", "kept_sha256") == Counter(brute.op1(rows, window))


def test_longest_repeats_double_until_none_is_left(spark):
    words = [f"w{i}" for i in range(200)]
    rows = [(1, " ".join(words)), (2, "x " + " ".join(words[:30])), (3, "y " + " ".join(words[50:110]) + " z"), (4, "alone")]
    got = dict(substring_dedup.longest_repeats(frame(spark, rows)).collect())
    assert got == {2: 26, 3: 52}


@pytest.mark.parametrize(("hot", "group"), [(repeats.HOT, repeats.GROUP), (1, 1), (6, 2)])
def test_repeated_bytes(docs, rows, hot, group, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 500)
    got = suffix_dedup.remove_repeated_bytes(docs, hot=hot, group=group)
    assert collected(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == Counter(brute.op7(rows))


@pytest.mark.parametrize("length", [1, 7, 64])
def test_other_lengths_of_bytes(spark, length):
    rows = awkward_rows()
    got = suffix_dedup.remove_repeated_bytes(frame(spark, rows), length)
    assert collected(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == Counter(brute.op7(rows, length))


def test_long_texts_are_read_in_parts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 700)
    rows = awkward_rows()
    data = [pa.RecordBatch.from_pylist([{"doc": i or 0, "mark": 0, "text": t or ""}]) for i, t in rows]
    batches = list(suffix_dedup._runs((40, 80, 160, 200))(iter(data)))
    assert sum(n for b in batches for n in b.column("n").to_pylist()) == sum(max(0, len((t or "").encode()) - 199) for _, t in rows)


# ---- 2: SentencePiece ----


def test_ids_and_text_of_the_library():
    path = sentencepiece_codec.model_path()
    library, coder = sentencepiece.SentencePieceProcessor(model_file=path), sentencepiece_codec.PieceCodec(path)
    r = random.Random(1)
    parts = ["the", "ing", " ", "  ", "   ", "a", "b", "é", "\n", "日本", "▁", "\x00", "1", "23", "😀", "er", "\t", "AB", "…", "x" * 70, "'s", "_", "<s>", "<0x0A>"]
    texts = ["", " ", "▁", "a" * 5000, " " * 300] + ["".join(r.choice(parts) for _ in range(r.randint(0, 60))) for _ in range(1500)]
    counts, ids, decoded = coder.columns(texts)
    for t, n, i, d in zip(texts, counts, ids, decoded, strict=True):
        expected = library.encode(t)
        assert coder.encode(t) == expected
        assert (n, i.decode(), d.decode()) == (len(expected), ",".join(map(str, expected)), library.decode(expected))
        assert coder.decode(expected) == library.decode(expected)
    for _ in range(300):
        any_ids = [r.choice([r.randrange(3, 259), r.randrange(259, 32000)]) for _ in range(r.randint(0, 12))]
        assert coder.decode(any_ids) == library.decode(any_ids)


def test_memo_may_overflow(monkeypatch):
    monkeypatch.setattr(sentencepiece_codec, "MEMO_PARTS", 10)
    path = sentencepiece_codec.model_path()
    library, coder = sentencepiece.SentencePieceProcessor(model_file=path), sentencepiece_codec.PieceCodec(path)
    for _, t in some_documents()[:20]:
        assert coder.encode(t) == library.encode(t)


def test_encoded_documents(docs, rows):
    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.model_path())
    expected = []
    for i, t in rows:
        ids = library.encode(t or "")
        expected.append((i, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(library.decode(ids))))
    assert collected(sentencepiece_codec.encoded_digests(docs), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == Counter(expected)


# ---- 3: fingerprints ----


def test_fingerprints(spark, rows):
    order = sorted({i: t for i, t in rows if i is not None}.items())
    got = {r.doc_id: r for r in fingerprints.fingerprints(frame(spark, order)).collect()}
    sets = fingerprints.anchor_sets(pa.array([t or "" for _, t in order]))
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        changed = t[: len(t) - half] + after[:half]
        changed_set = fingerprints.anchor_sets(pa.array([changed]))[0]
        r = got[i]
        assert (r.n_chars, r.edited_sha256, r.fingerprint) == (len(t), brute.sha(changed), fingerprints.written(sets[k]))
        assert r.edited_fingerprint == fingerprints.written(changed_set)
        assert r.near_edited == fingerprints.likeness(sets[k], changed_set)
        assert r.near_next == fingerprints.likeness(sets[k], sets[(k + 1) % len(order)])
        if len(t) > 400 and len(after) > 400 and len(set(t)) > 5 and t not in after:
            assert 0.1 < r.near_edited <= 1
            assert r.near_edited > r.near_next


def test_fingerprints_of_repeated_rows(spark):
    got = fingerprints.fingerprints(frame(spark, [(5, "same text here"), (5, "same text here"), (None, None), (6, "")])).collect()
    assert len(got) == 4
    assert len({r.fingerprint for r in got if r.doc_id == 5}) == 1
    one = fingerprints.fingerprints(frame(spark, [(5, "alone")])).collect()
    assert [(r.doc_id, r.near_next) for r in one] == [(5, 1.0)]


def test_syncmers_are_context_free():
    r = random.Random(2)
    passage = "".join(r.choice("abcdefghij ") for _ in range(400))
    whole = [set(s.tolist()) for s in fingerprints.anchor_sets(pa.array([passage, "zzz" + passage, passage + "qqqq"]))]
    assert len(whole[0] & whole[1]) >= 0.85 * len(whole[0])
    assert len(whole[0] & whole[2]) >= 0.85 * len(whole[0])


# ---- 4: quality ----


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    scored = quality.quality_scores(docs.withColumn("stats", F.lit("x")).withColumn("score", F.lit(0)), labels)
    got = scored.join(labels, "doc_id").where("held_out").select("score", "predicted", "quality").toPandas()
    assert scored.count() == docs.count()
    assert scored.where("score < 0 or score > 1 or score is null or predicted <> int(score >= 0.7)").count() == 0
    assert (got.predicted == got.quality).mean() > 0.95
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.quality_scores(docs, flipped)
    assert scored.join(again.withColumnRenamed("score", "other"), "doc_id").where("abs(score - other) > 1e-6").count() == 0


def test_quality_of_awkward_rows(spark, docs, rows, nothing):
    labels = spark.read.parquet(f"{SF}/labels.parquet").union(spark.createDataFrame([(1001, 0, 0), (1003, None, None), (None, 1, 0)], "doc_id bigint, quality bigint, toxic bigint"))
    got = quality.quality_scores(docs, labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    assert all(0 <= r.score <= 1 for r in got)
    kept = quality.keep_quality(docs, labels)
    assert kept.columns == docs.columns
    assert {r.score for r in quality.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.keep_quality(docs, labels.limit(0)).count() == docs.count()
    assert quality.quality_scores(nothing, labels).count() == 0


def test_isotonic_is_monotone_and_keeps_the_mean():
    x, y = quality.isotonic([(0.1, 2, 1), (0.2, 2, 0), (0.3, 4, 3), (0.4, 1, 0), (0.5, 3, 3)])
    assert list(y) == sorted(y)
    assert y[0] == 0.25
    assert len(x) == len(y)


# ---- 5: decontamination ----

ITEMS = [
    (1, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15"), (2, "Short item"), (3, None), (4, ""), (5, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15 w16"),
    (6, "aa aa aa aa aa aa aa aa aa aa aa aa aa aa aa"), (7, "short ITEM"), (8, "Éa x"), (9, "single"),
]


def contaminated_rows():
    plain = " ".join(f"u{i}" for i in range(400))
    return awkward_rows() + [
        (2000, "W1, w2;w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15 w16 w17"), (2001, plain + " w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 " + plain),
        (2002, "a short, item! and short x item"), (2003, "aa " * 40), (2004, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12"), (2005, "Éa-x éa x"), (2006, plain + " single"),
    ]


@pytest.mark.parametrize("block_words", [decontaminate.BLOCK_WORDS, 8])
def test_contaminated(spark, block_words):
    rows = contaminated_rows()
    bench = spark.createDataFrame(ITEMS + ITEMS[:1], "item_id bigint, text string")
    found = decontaminate.contaminated_spans(frame(spark, rows), bench, block_words=block_words)
    got = collected(found.select("doc_id", "n_words", "n_hit", F.size("items").alias("n"), F.sha2(F.array_join("items", ","), 256).alias("s"), "contaminated"), "*")
    assert got == Counter(brute.op5(rows, ITEMS))


def test_contamination_of_given_rows(spark):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    rows, items = [(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()]
    assert collected(decontaminate.contamination_report(docs, bench), "*") == Counter(brute.op5(rows, items))


def test_decontaminate_cuts_and_drops(spark, nothing):
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = frame(spark, contaminated_rows()).withColumn("n_chars", F.length("text"))
    kept = {r.doc_id: r for r in decontaminate.decontaminate(docs, bench).collect()}
    assert not {2000, 2002, 2003} & set(kept)
    assert kept[2001].text == " ".join(f"u{i}" for i in range(400)) + "  " + " ".join(f"u{i}" for i in range(400))
    assert kept[2001].n_chars == len(kept[2001].text)
    assert kept[1000].text is None
    assert decontaminate.contaminated_spans(nothing, bench).count() == 0
    assert decontaminate.contaminated_spans(docs, bench.limit(0)).where("n_hit > 0").count() == 0


# ---- 6: near-duplicates ----


def test_near_duplicates(docs, rows):
    got = collected(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id")
    assert got == Counter(brute.op6(rows))


@pytest.mark.parametrize("list_length", [64, 2, 1])
def test_links_of_crowded_fingerprints(spark, list_length):
    r = random.Random(9)
    values = [0, 1, 3, 2**63, 2**64 - 1]
    for _ in range(6):
        value = r.getrandbits(64)
        for _ in range(25):
            value ^= (1 << r.randrange(64)) | (1 << r.randrange(64))
            values.append(value)
        values += [values[-1] ^ (1 << k) for k in range(30)]
    values = list(dict.fromkeys(values + [r.getrandbits(64) for _ in range(50)]))
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    nodes = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    found = dict(components.components(simhash.near_links(nodes, list_length)).collect())
    groups = brute.components_of(values)
    assert len({(g, found.get(v, v)) for g, v in zip(groups, signed, strict=True)}) == len(set(groups)) == len({found.get(v, v) for v in signed})


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (102, 100), (7, 7), (200, 201), (200, 202), (200, 203)]
    got = dict(components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100, 102: 100} | {i: 200 for i in range(200, 204)}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_one_of_each_group_stays(docs, rows, nothing):
    kept = simhash.keep_first(docs)
    groups = brute.components_of([brute.simhash(t) for _, t in rows])
    assert kept.columns == docs.columns
    got = [r.doc_id for r in kept.select("doc_id").collect()]
    least = {}
    for (i, _), g in zip(rows, groups, strict=True):
        least.setdefault(g, []).append(i)
    assert Counter(got) == Counter(min((i for i in ids if i is not None), default=None) for ids in least.values())
    assert simhash.keep_first(nothing).count() == 0


# ---- 8: licences ----


@pytest.fixture(scope="module")
def license_model(spark):
    return licenses.fit_licenses(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_license_lines(spark, license_model, nothing):
    rows = [
        (1, "Some words here.\nReleased under the MIT License.\nMore words."), (2, "Licensed under the Apache License, Version 2.0."), (3, "Licensed under CC BY-NC 4.0."),
        (4, "He lost his driving license near the public library."), (5, None), (6, ""), (7, "the of and to in"),
        (8, "This work is licensed under the GNU General Public License, version 3.\n\nReleased under the MIT License."),
        (9, "The MIT team will licence the version that is available to the public."), (2, "Licensed under the Apache License, Version 2.0."),
    ]
    got = collected(licenses.license_report(frame(spark, rows), model=license_model), "doc_id", "n_paragraphs", "n_license", "families", "first")
    assert got == Counter([
        (1, 3, 1, "MIT", 1), (2, 1, 1, "Apache-2.0", 0), (2, 1, 1, "Apache-2.0", 0), (3, 1, 1, "CC-BY-NC", 0), (4, 1, 0, "", None), (5, 1, 0, "", None),
        (6, 1, 0, "", None), (7, 1, 0, "", None), (8, 2, 2, "GPL,MIT", 0), (9, 1, 0, "", None),
    ])
    assert licenses.license_report(nothing, model=license_model).count() == 0


def test_license_held_out_accuracy(spark, license_model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    planted = {"CC-BY-NC": "Licensed under CC BY-NC 4.0.", "GPL": "GNU General Public License, version 3.", "Apache-2.0": "Licensed under the Apache License, Version 2.0.", "MIT": "Released under the MIT License."}
    got = dict(licenses.license_report(docs, model=license_model).select("doc_id", "families").collect())
    expected = {r.doc_id: ",".join(sorted(k for k, v in planted.items() if v in r.text)) for r in docs.collect()}
    assert np.mean([got[i] == e for i, e in expected.items()]) > 0.995


def test_license_of_only_awkward_rows(spark, nothing):
    model = licenses.fit_licenses(nothing)
    assert licenses.license_report(frame(spark, [(None, "Released under the MIT License."), (1, None)]), model=model).count() == 2


# ---- 9: token counts ----


def test_token_tree_follows_edits():
    coder = token_counts.PieceCounter(token_counts.rank_file(), token_counts.split_pattern())
    r = random.Random(3)
    parts = ["the ", " cat", "\n\n", "  ", "'s", "'re", " 123", "é", "日", "!?", " a", "\t", "x", "'"]
    for _ in range(400):
        tree = token_counts.TokenTree("".join(r.choice(parts) for _ in range(r.choice([0, 3, 30, 900]))), coder)
        for _ in range(5):
            a = r.randint(-1, len(tree.text) + 2)
            b, new = a + r.choice([-1, 0, 1, 5, 400]), "".join(r.choice(parts) for _ in range(r.choice([0, 1, 4, 300])))
            s = min(max(a, 0), len(tree.text))
            expected = tree.text[:s] + new + tree.text[max(s, min(b, len(tree.text))) :]
            tree.edit(a, b, new)
            assert tree.text == expected
            assert tree.tokens == len(coder.encoding.encode_ordinary(expected))


def test_edits_encode_little_of_long_texts():
    coder = token_counts.PieceCounter(token_counts.rank_file(), token_counts.split_pattern())
    tree = token_counts.TokenTree("some words of a long text, " * 3000, coder)
    tree.edit(30000, 30005, "other")
    assert tree.encoded < 8


def test_edited_counts(spark, docs, rows):
    got = token_counts.count_report(docs.withColumn("source", F.lit("src1")))
    coder = token_counts.PieceCounter(token_counts.rank_file(), token_counts.split_pattern())
    count = lambda t: len(coder.encoding.encode_ordinary(t))
    expected = []
    for i, t in rows:
        t = t or ""
        third = len(t) // 3
        new = t[:third] + "src1" + t[third + 24 :]
        new = new[: 2 * third] + t[:40] + new[2 * third :]
        expected.append((i, count(t), count(new)))
    assert isinstance(coder.encoding, tiktoken.Encoding)
    assert collected(got, "doc_id", "n_tokens", "n_tokens_edited") == Counter(expected)


# ---- 10: personal data ----

PERSONAL = [
    (3000, "mail a.b+c@d-e.co.uk, x@y.z@w.v 1.2.3.4.5.6.7.8 999.1.1.1 0255.0.0.0"), (3001, "card 4111 1111 1111 1111 and 4111-1111-1111-1112 and 4111  1111 1111 1111"),
    (3002, "+1 (578) 555-6437 4918187128635271"), (3003, "+1 (578) 555-6437, +44 20 7946 0958."), (3004, "😀é a@b.cc é 10.0.0.1\u0001 4111\u00011111 1111 1111"),
    (3005, "1 " * 4000 + "x@" + "a" * 4000), (3006, "a@b.c%d@e.f"), (3007, "+1-2-3-4-5-6-7-8, @@, +, ..1.2.3.4.."), (3008, "00000000000000000000 4111111111111111"),
]


def test_base_spans(spark, rows):
    rows = rows + PERSONAL
    got = pii.personal_data_report(frame(spark, rows))
    assert collected(got, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == Counter(brute.op10(rows))
    spans = {r.doc_id: r.spans for r in got.collect()}
    assert all(spans[i] == ",".join(f"{k}:{s}:{e}" for k, s, e in brute.base_spans(t)) for i, t in rows if i is not None and i < 3000)


def test_patterns_discover_identifiers(spark, nothing):
    rows = [(i, f"You can write to mail: user{i}@host{i}.example.com or call me.") for i in range(12)]
    rows += [(20, "Please mail: root@localhost now"), (21, "the sign me@home stands here"), (22, "mail: bob(at)home"), (23, "call me. 555-123-4567")]
    got = {r.doc_id: r.spans for r in pii.personal_data_report(frame(spark, rows)).collect()}
    assert got[20] == "email:13:27"
    assert got[22] == "email:6:17"
    assert got[21] == got[23] == ""
    assert pii.personal_data_report(nothing).count() == 0


def test_redaction(spark):
    rows = [(1, "write a@b.cc or +1 (578) 555-6437!"), (2, None), (3, "nothing"), (None, "ip 10.0.0.1"), (1, "write a@b.cc or +1 (578) 555-6437!")]
    docs = frame(spark, rows).withColumn("n_chars", F.length("text"))
    done = pii.redact(docs)
    assert done.columns == docs.columns
    expected = [(1, "write <EMAIL> or <PHONE>!", 25), (2, None, None), (3, "nothing", 7), (None, "ip <IP>", 7), (1, "write <EMAIL> or <PHONE>!", 25)]
    assert collected(done, "doc_id", "text", "n_chars") == Counter(expected)


def test_no_python_on_native_paths(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for df in (pii.hits(docs), pii.personal_data_report(docs), pii.redact(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


# ---- empty tables ----


def test_empty_tables(nothing):
    for df in (
        substring_dedup.remove_repeated_words(nothing), suffix_dedup.remove_repeated_bytes(nothing), sentencepiece_codec.encoded_digests(nothing),
        fingerprints.fingerprints(nothing), simhash.near_duplicates(nothing), token_counts.count_report(nothing.withColumn("source", F.lit(""))), pii.redact(nothing),
    ):
        assert df.count() == 0
