"""Wavelet matrices, the word encoder and token files against plain arrays and the tokenizers library."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kinolens.llm import token_files
from kinolens.llm.queries import QUERIES
from kinolens.llm.wavelet import WaveletMatrix
from kinolens.llm.word_encoder import WordEncoder
from tests.llm.test_operators import SF, awkward_rows

MODEL = public_tokenizers.path("word_bpe_49k.json")


def library_ids(texts):
    model = Tokenizer.from_file(MODEL)
    return [model.encode(t or "", add_special_tokens=False).ids for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70_000), max_size=1500), st.integers(0, 70_000))
def test_wavelet_matrix_is_the_array(values, token):
    ids = np.array(values, np.uint32)
    matrix = WaveletMatrix.from_bytes(WaveletMatrix.build(ids, np.array([7]), np.array([0, len(ids)])).to_bytes())
    assert matrix.decode().tolist() == values and matrix.access(np.arange(len(ids))).tolist() == values
    for t in {token, *values[:20]}:
        assert matrix.occurrences(t).tolist() == np.flatnonzero(ids == t).tolist()
        low, high = len(ids) // 4, len(ids) // 2
        assert matrix.count(t, low, high) == int((ids[low:high] == t).sum())


@pytest.mark.parametrize("n", [0, 1, 63, 64, 511, 512, 513, 1024, 5000])
def test_wavelet_block_edges(n):
    ids = np.random.default_rng(n).integers(0, 5, n).astype(np.uint16)
    matrix = WaveletMatrix.from_bytes(WaveletMatrix.build(ids, np.zeros(0), np.zeros(1)).to_bytes())
    assert (matrix.decode() == ids).all()
    assert all((matrix.occurrences(t) == np.flatnonzero(ids == t)).all() and matrix.count(t) == (ids == t).sum() for t in range(6))


def test_damaged_file_is_refused():
    data = bytearray(WaveletMatrix.build(np.arange(100, dtype=np.uint16), np.array([1]), np.array([0, 100])).to_bytes())
    data[-5] ^= 1
    for bad in (data, data[:-9], data[:10]):
        with pytest.raises(ValueError, match="token file"):
            WaveletMatrix.from_bytes(bytes(bad))


def test_encoder_equals_library():
    texts = [
        "don't DON'T we'll 're 's a.b.c x--y...z' it's. !!! 'S", "J̌ J̌. İstanbul ΣΑΣ. ΟΔΟΣ, Kelvin K", "a<|endoftext|>b <|endoftext|>. <|ENDOFTEXT|>",
        "12 3a4 5% $6.70 a1b2,", " x y​z\x1cq\x85r", "é é. é— word—. “q” ’s don’t", "", None, " \n", "日本語 テスト。 한국어 ｆｕｌｌ",
        "a\x00b \x01.\x7f!", "word'", "word's'", "fi ﬁ ⅷ ½ ² x².", "!a", "a!", "é!", "<a.", "x" * 5000 + ".",
    ]
    for memo in (500_000, 3):
        ids, n = WordEncoder(MODEL, memo).encode(pa.array(texts, pa.string()))
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == library_ids(texts)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from("aBé'sST.!-1 \ńΣJ̌<|>endoftxﬁ"), max_size=40), max_size=5))
def test_encoder_on_any_text(texts):
    coder = test_encoder_on_any_text.coder
    ids, n = coder.encode(pa.array(texts, pa.string()))
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])][: len(texts)] == library_ids(texts)


test_encoder_on_any_text.coder = WordEncoder(MODEL)


def test_query_against_library(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    want, start = {}, 0
    for (doc, _), ids in zip(rows, library_ids([r.text for r in rows]), strict=True):
        data = np.array([*ids, 2], "<u4")
        want[doc] = (start, len(data), zlib.crc32(data.tobytes()))
        start += len(data)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op11_token_files"](spark, SF).collect()}
    assert got == want


def test_files_of_awkward_rows(spark):
    """Null and repeated ids and texts, other columns of the same names, many small files."""
    rows = awkward_rows()
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, start string, row string").repartition(3)
    files = token_files.write_token_files(docs, shard_tokens=300)
    listed = files.orderBy("file").collect()
    assert len(listed) > 10 and [f.start for f in listed] == np.concatenate([[0], np.cumsum([f.n_tokens for f in listed])[:-1]]).tolist()
    read = token_files.read_tokens(files).orderBy("start").collect()
    ids = [np.frombuffer(r.ids, "<u4").tolist() for r in read]
    order = lambda i: -(2**63) if i is None else i
    assert sorted((order(r.doc_id), x) for r, x in zip(read, ids, strict=True)) == sorted((order(i), [*x, 2]) for (i, _), x in zip(rows, library_ids([t for _, t in rows]), strict=True))
    assert [order(r.doc_id) for r in read] == sorted(order(i) for i, _ in rows)
    every = np.concatenate(ids)
    assert [r.start for r in read] == np.concatenate([[0], np.cumsum(list(map(len, ids)))[:-1]]).tolist()

    common = [int(t) for t in np.bincount(every).argsort()[-3:]]
    counted = {r.token: r.n for r in token_files.token_frequencies(files, [*common, 49405, 10**6]).collect()}
    assert counted == {t: int((every == t).sum()) for t in [*common, 49405, 10**6]}
    places = token_files.token_places(files, common[0]).orderBy("position").collect()
    assert [p.position for p in places] == np.flatnonzero(every == common[0]).tolist()
    assert all(ids[np.searchsorted([r.start for r in read], p.position, "right") - 1][p.place] == common[0] for p in places)
    wanted = [0, 1, 7, 299, 300, 1000, len(every) - 1, len(every), 7]
    at = spark.createDataFrame([(p,) for p in wanted], "position long")
    assert sorted(map(tuple, token_files.tokens_at(files, at).collect())) == sorted((p, int(every[p])) for p in wanted if p < len(every))


def test_no_rows_no_files(spark):
    files = token_files.write_token_files(spark.createDataFrame([], "doc_id long, text string"))
    assert files.count() == 0 and token_files.read_tokens(files).count() == 0


def test_plain_words_need_only_the_model(monkeypatch):
    """Lower-cased ASCII words take the tokenizer's model alone; all other parts still take the whole library."""
    texts = ["The cat sat ON internationalisation", "Straße ſ K it's x1y <|a", "zz" * 400, None]
    expected = library_ids(texts)
    coder = WordEncoder(MODEL)
    ids, n = coder.encode(pa.array(texts))
    assert [part.tolist() for part in np.split(ids, np.cumsum(n)[:-1])] == expected
    bare = WordEncoder(MODEL)
    monkeypatch.setattr(bare, "whole", None)
    ids, n = bare.encode(pa.array(texts[:1]))
    assert ids.tolist() == expected[0]


def test_full_memo_keeps_what_comes_again(monkeypatch):
    """Parts that come in every block are learnt once, however many others pass through the memo."""
    import pyarrow as pa

    from kinolens.llm import word_encoder

    monkeypatch.setattr(word_encoder, "ENCODED_BYTES", 2000)
    coder = word_encoder.WordEncoder(token_files.token_model(), memo=400)
    common = [f"word{chr(97 + i)}{chr(97 + j)}," for i in range(5) for j in range(5)]
    texts = [" ".join([*common, *(f"x{k}y{i}!?" for i in range(60))]) for k in range(150)]
    learnt = []
    learn = coder._learn
    monkeypatch.setattr(coder, "_learn", lambda parts: (learnt.extend(parts), learn(parts)))
    ids, n = coder.encode(pa.array(texts))
    expected = [e.ids for e in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert n.tolist() == [len(e) for e in expected] and ids.tolist() == [i for e in expected for i in e]
    assert len(learnt) > 10 * 400 and len(coder.memo) <= 400
    assert all(learnt.count(w) == 1 for w in [c.rstrip(",") for c in common])
