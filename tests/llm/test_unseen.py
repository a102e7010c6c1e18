"""Patterns with many unseen identifiers."""

import time

import pytest

from kinolens.llm import pii


@pytest.mark.parametrize("unseen", [12, 60])
def test_unseen_instances_do_not_count_against_a_pattern(spark, unseen):
    rows = [(i, f"tel: +1 578 555 {1000 + i} is open") for i in range(12)] + [(1000 + i, f"tel: 578-555-{2000 + i} is open") for i in range(unseen)]
    # of what stands behind this word, a fixed form rejects too much
    rows += [(2000 + i, f"size +1 578 556 {1000 + i} of") for i in range(8)] + [(2100 + i, f"size +12{i} of") for i in range(9)] + [(2200, "size 578-555-9999 of")]
    rows += [(3000 + i, f"visa {n} paid") for i, n in enumerate(("4111111111111111", "5500005555555559", "4012888888881881", "5105105105105100", "4222222222222220", "4000056655665556"))]
    rows += [(3100, "visa 3782 822463 10005 paid"), (3101, "visa 4111 / 1111 / 1111 / 1111 paid"), (3102, "visa 4111 / 1111 / 1111 / 1112 paid")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.spans for r in pii.personal_data_report(docs).collect()}
    assert all(got[1000 + i] == "phone:5:17" for i in range(unseen))
    assert got[2200] == ""
    assert (got[3100], got[3101], got[3102]) == ("card:5:22", "card:5:30", "")


def test_many_matches_in_one_text(spark):
    """Work on one text grows with its matches, and spans far into it are at their places."""
    n = 30000
    text = "é😀 " + " ".join(f"mail: u{i}@h.example.com" for i in range(n)) + " mail: root@localhost"
    docs = spark.createDataFrame([(1, text), (2, "x" * 9000 + " call +1 578 555 1000 " + "é" * 9000)], "doc_id bigint, text string")
    begun = time.monotonic()
    done = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert time.monotonic() - begun < 60
    assert done[1] == "é😀 " + " ".join(["mail: <EMAIL>"] * (n + 1))
    assert done[2] == "x" * 9000 + " call <PHONE> " + "é" * 9000


def test_word_in_front_of_any_length(spark):
    word = "w" * 300
    rows = [(i, f"{word} user{i}@host.example.com") for i in range(6)] + [(10, f"{word}\tadmin@localhost"), (11, f"v{word[1:]} admin2@localhost")]
    got = {r.doc_id: r.spans for r in pii.personal_data_report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[10] == "email:301:316"
    assert got[11] == ""


def test_short_numbers_are_no_cards_and_long_names_are_read(spark):
    """Every match of a text is held to 16 digits, the first ones too; a name of thousands of parts is one match."""
    name = "a@" + "b." * 5000 + "c"
    rows = [(1, "00 and 18 and 4111 1111 1111 1111"), (2, name), (3, "0 0 0, 42")]
    got = {r.doc_id: (r.n_card, r.n_email, r.spans) for r in pii.personal_data_report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: (1, 0, "card:14:33"), 2: (0, 1, f"email:0:{len(name)}"), 3: (0, 0, "")}
