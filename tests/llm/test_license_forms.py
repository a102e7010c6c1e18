"""Licence grants in wordings and surroundings that the notices do not have."""

import pytest
from pyspark.sql import functions as F

from kinolens.llm import licenses

FORMS = {
    "Copyright 2019 the authors. Released under the MIT License.": "MIT",
    "MIT License": "MIT",
    "The source of this parser is distributed under the terms of the MIT license, see the file for more": "MIT",
    'the software is provided "as is", without warranty of any kind, express or implied, including the warranties of merchantability, fitness for a particular purpose and noninfringement': "MIT",
    "Apache License Version 2.0, January 2004": "Apache-2.0",
    "Copyright 2021 Some Company. This module is licensed under the Apache License, Version 2.0 and comes with its documentation": "Apache-2.0",
    "GNU GENERAL PUBLIC LICENSE Version 3": "GPL",
    "GNU LESSER GENERAL PUBLIC LICENSE Version 3": "LGPL",
    "All plugins are licensed under the GNU Lesser General Public License, version 2.1 only": "LGPL",
    "Permission to use, copy, modify and distribute this software for any purpose with or without fee is hereby granted": "ISC",
    "The tool is licensed under the GNU Affero General Public License, version 3.": "AGPL",
    "All articles on this page are licensed under CC BY-SA 4.0.": "CC-BY-SA",
    "Redistribution and use in source and binary forms, with or without changes, are permitted provided that the following conditions are met": "BSD",
    "subject to the terms of the Mozilla Public License, v. 2.0": "MPL-2.0",
}
NONE = (
    "The licence of the pub was renewed by the town.", "He was licensed to drive in the state of the union.", "The software was provided to the school without charge.",
    "Under the terms of the contract the version of the film was released to the public.", "The general public was free to use the library.", "",
)


@pytest.fixture(scope="module")
def model(spark):
    return licenses.fit_licenses(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_held_out_forms(spark, model):
    plain = " ".join(f"word{i % 17} of" for i in range(150))
    rows = [(i, t) for i, t in enumerate(FORMS)] + [(100 + i, t) for i, t in enumerate(NONE)]
    # one line without breaks, with grants at several places in it
    rows += [(200, f"{plain} Licensed under the Apache License, Version 2.0. {plain} Released under the MIT License. {plain}"), (201, plain)]
    got = {r.doc_id: (r.families, r.n_license) for r in licenses.license_report(spark.createDataFrame(rows, "doc_id bigint, text string"), model=model).collect()}
    assert {t: got[i][0] for i, t in enumerate(FORMS)} == FORMS
    assert {t: got[100 + i] for i, t in enumerate(NONE)} == {t: ("", 0) for t in NONE}
    assert got[200] == ("Apache-2.0,MIT", 1)
    assert got[201] == ("", 0)


def test_cues_are_words_in_any_case(spark):
    rows = spark.createDataFrame([("A LICENSE here",), ("unlicensed",), ("é Spdx",), ("nothing",), (None,), ("",)], "t string")
    got = rows.select("t", licenses.has_cue(F.col("t"), ["license", "licensed", "spdx"]).alias("c")).collect()
    assert [r.t for r in got if r.c] == ["A LICENSE here", "unlicensed", "é Spdx"]
    assert not rows.where(licenses.has_cue(F.col("t"), [])).count()


def test_no_python_on_the_native_path(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for df in (licenses.license_lines(docs, model=model), licenses.license_report(docs, model=model)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
