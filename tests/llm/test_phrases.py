"""Phrase mining against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kinolens.llm import phrases
from tests.llm.brute import LOWER


def plain(rows, least=100, longest=5, keep=2000, share=100):
    """(lang, rank, phrase, a, l, r, n, score) from (lang, text)."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    inside = Counter()
    for (lang, words), a in candidates.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                part = (lang, words[i : i + size])
                inside[part] = max(inside[part], a)
    found = {}
    for (lang, words), a in candidates.items():
        if 100 * inside[lang, words] >= share * a:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
    return [(lang, rank, p.decode(), -a, l, r, n[lang], -s) for lang, every in found.items() for rank, (s, a, p, l, r) in enumerate(sorted(every)[:keep], 1)]


def same(got, want):
    assert sorted(map(tuple, got)) == sorted(want)


def some_rows(seed=3, docs=60):
    r = random.Random(seed)
    words = ["a", "B", "b", "la", "É", "é", "x-y", "(z)", "don't", "日本"]
    rows = []
    for _ in range(docs):
        parts = []
        for _ in range(r.randint(0, 60)):
            parts.append(r.choice(words) if r.random() < 0.5 else r.choice(["new york city hall", "new york times", "as well as", "a a a a a a"]))
            parts.append(r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "\x0c\r", "!?"]))
        rows.append((r.choice(["en", "en", "fr", None, "und", ""]), "".join(parts)))
    return [*rows, (None, None), ("en", None), ("de", ""), ("xx", " .,"), ("en", "new york city hall " * 2000), rows[0], rows[0]]


@pytest.mark.parametrize("least, longest, share, keep", [(20, 5, 100, 2000), (3, 5, 80, 7), (5, 2, 100, 2000), (10**6, 5, 100, 10)])
def test_collocations(spark, least, longest, share, keep):
    """Nulls, empty texts, ties, repeated rows, overlaps, every kind of break, one long text, clashing columns."""
    rows = some_rows()
    docs = spark.createDataFrame([(*r, 1, "w", 5) for r in rows], "lang string, text string, n long, word string, f long").repartition(3)
    same(phrases.collocations(docs, least=least, longest=longest, share=share, keep=keep).collect(), plain(rows, least, longest, keep, share))


def test_no_rows(spark):
    assert phrases.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []


def test_long_texts_are_cut_at_gaps(spark, monkeypatch):
    """Blocks far smaller than the texts give the same counts."""
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 200)
    monkeypatch.setattr(phrases, "SLICE_BLOCKS", 3)  # tiles are split
    monkeypatch.setattr(phrases, "HELD_PAIRS", 20)
    monkeypatch.setattr(phrases.stretches, "__defaults__", (50,))
    rows = some_rows(5, 20)
    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    same(phrases.collocations(docs, least=4).collect(), plain(rows, 4))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-1, 30), max_size=300), st.sampled_from([1, 2, 4, 8, 64]), st.sampled_from([1, 4, 16, 1000]))
def test_tiles_count_like_a_dictionary(seq, tile, dense):
    """Direct and sorted tiles, whatever their size, count all neighbours and number them by place."""
    tiles, edges, cells, n, number = phrases.tiled_pairs(np.array(seq, np.int64), tile, dense)
    names = np.repeat(tiles, np.diff(edges))
    a, b = (names >> phrases.SIDE) * tile + cells // tile, (names & (1 << phrases.SIDE) - 1) * tile + cells % tile
    want = Counter((x, y) for x, y in zip(seq, seq[1:], strict=False) if x >= 0 and y >= 0)
    assert dict(zip(zip(a.tolist(), b.tolist(), strict=True), n.tolist(), strict=True)) == want
    for i, k in enumerate(number.tolist()):
        if k >= 0:
            assert (seq[i], seq[i + 1]) == (a[k], b[k])
        else:
            assert i == len(seq) - 1 or seq[i] < 0 or seq[i + 1] < 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(-1, 5), max_size=200), st.integers(1, 50))
def test_stretches_lose_no_neighbours(seq, most):
    parts = list(phrases.stretches(np.array(seq, np.int64), most))
    count = lambda s: Counter((x, y) for x, y in zip(s, s[1:], strict=False) if x >= 0 and y >= 0)
    assert sum((count(p.tolist()) for p in parts), Counter()) == count(seq)
    assert [x for p in parts for x in p.tolist()] == seq


def test_scores_beyond_64_bits(spark):
    """The score's products are decimals of 38 digits."""
    a, n, l, r = 3 * 10**11, 25 * 10**12, 4 * 10**11, 7 * 10**11
    row = spark.range(1).selectExpr(f"cast(1000 as decimal(38,0)) * {a}L * {n}L div (cast({l}L as decimal(38,0)) * {r}L) as score").first()
    assert row.score == 1000 * a * n // (l * r)


def test_known_words_has_a_row_per_block(spark):
    """What a block learns of its words leaves the tasks in one row, however many words are frequent."""

    held = spark.createDataFrame(
        [(b, None, "en", f"w{i}", i, 1) for b in range(7) for i in range(200)] + [(b, b"seq", None, None, None, None) for b in range(7)], phrases.WORDS
    ).repartition(5)
    words = spark.createDataFrame([(1000 + i, "en", f"w{i}") for i in range(0, 200, 2)] + [(5, "de", "w1")], "id long, lang string, word string")
    rows = phrases.known_words(held, words).collect()
    assert sorted(r.of for r in rows) == list(range(7))
    for r in rows:
        pairs = zip(np.frombuffer(r.locals, "<u4").tolist(), np.frombuffer(r.ids, "<i8").tolist(), strict=True)
        assert sorted(pairs) == [(i, 1000 + i) for i in range(0, 200, 2)]


def test_known_words_joins_a_row_per_word(spark):
    """The blocks of a word are gathered in front of the join, in spans of partitions; none is lost or doubled."""
    at = [(p << 32) + b for p in (0, 1, phrases.PART_SPAN, 3 * phrases.PART_SPAN + 1) for b in range(3)]
    held = spark.createDataFrame([(b, None, "en", f"w{i}", i, 1) for b in at for i in range(b % 3, 60)], phrases.WORDS).repartition(4)
    words = spark.createDataFrame([(1000 + i, "en", f"w{i}") for i in range(0, 60, 2)] + [(5, "und", "w1")], "id long, lang string, word string")
    known = phrases.known_words(held, words)
    rows = {r.of: dict(zip(np.frombuffer(r.locals, "<u4").tolist(), np.frombuffer(r.ids, "<i8").tolist(), strict=True)) for r in known.collect()}
    assert rows == {b: {i: 1000 + i for i in range(60) if i % 2 == 0 and i >= b % 3} for b in at}
    plan = known._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("collect_list")
