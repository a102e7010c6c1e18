"""Licence scan by a trained paragraph classifier, in DataFrame functions and Spark ML only.

A paragraph is a line of a text; a line of more than ``WINDOW`` words is judged
in windows that overlap by half, so texts without line breaks keep their grants.
Logistic regression on sparse hashed word n-grams tells licence families from
ordinary text. It is fitted on the notices below with words left out and put in
front or behind, and on ordinary lines: a bounded sample of the documents
without any licence word, and sentences that talk about licences without
granting one. A second regression on rows the first one has not seen turns its
margin into the probability that a paragraph is a licence at all; below one half
the family is unknown. A prediction is confirmed if a notice of its family is
found: ``CONFIRMED`` or more of the notice's word pairs occur in the paragraph,
whatever else it holds.

A paragraph that holds so much of a notice holds one of its telling words, and
few words tell all notices (``cue_words``); only lines with one of them are cut
into n-grams.
"""

from __future__ import annotations

import random
import re
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinolens.llm.common import bound, given_id, keyed, stored

UNKNOWN = "unknown"
#: Most ordinary lines in the fit, as a documented bound on its sample, and of
#: each the first characters at most.
ORDINARY_LINES = 4000
ORDINARY_CHARS = 400
FEATURES = 1 << 14
COPIES = 24
#: Share of a notice's word pairs that a paragraph of its family must have.
CONFIRMED = 0.6
#: Most words that are judged together.
WINDOW = 64
#: Most word pairs of a line that may be a notice of one pair, such as a heading.
ALONE = 6

#: Notices and short grants of each family.
NOTICES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
        "This project is released under the Apache 2.0 license.",
        "Apache License Version 2.0, January 2004",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements.",
        "distributed under the terms of the Apache License (Version 2.0)",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "BSD 3-Clause License",
        "BSD 2-Clause License",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        'This software is provided by the copyright holders and contributors "as is" and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed.',
        "distributed under the terms of the BSD license",
        "SPDX-License-Identifier: BSD-2-Clause",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Content is available under the Creative Commons Attribution License.",
        "Creative Commons Attribution 4.0 International Public License",
        "SPDX-License-Identifier: CC-BY-4.0",
        "published under CC BY 3.0",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Released under the CC BY-NC License for noncommercial use.",
        "Creative Commons Attribution-NonCommercial 4.0 International Public License",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
        "published under CC BY-NC 3.0",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
        "Creative Commons Attribution-ShareAlike 4.0 International Public License",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
        "published under CC BY-SA 3.0",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Released under the GPL v3.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
        "GNU General Public License version 3",
        "You should have received a copy of the GNU General Public License along with this program.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
        "distributed under the terms of the GNU GPL",
        "SPDX-License-Identifier: GPL-2.0-only",
        "Licensed under the GPL version 2",
    ),
    "LGPL": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "Released under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
        "distributed under the terms of the GNU LGPL",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
        "Released under the LGPL v3.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
        "provided that the above copyright notice and this permission notice appear in all copies.",
        "ISC License", "Licensed under the ISC License.", "SPDX-License-Identifier: ISC", "distributed under the terms of the ISC license",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    ),
    "AGPL": (
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007", "Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only",
        "You should have received a copy of the GNU Affero General Public License along with this program.", "Released under the AGPL v3.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
        "MIT License",
        "The MIT License (MIT)",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE.",
        "distributed under the terms of the MIT license",
        "available under the MIT license",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "Mozilla Public License Version 2.0",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "distributed under the terms of the Mozilla Public License",
    ),
    "public domain": (
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "Released into the public domain under CC0.",
        "The person who associated a work with this deed has dedicated the work to the public domain.",
        "CC0 1.0 Universal",
        "SPDX-License-Identifier: CC0-1.0",
        "SPDX-License-Identifier: Unlicense",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    "proprietary": (
        "All rights reserved. No part of this publication may be reproduced without prior written permission.",
        "This software is proprietary and confidential. Unauthorized copying of this file is strictly prohibited.",
        "The receipt or possession of this source code does not convey any rights to reproduce, disclose or distribute its contents.",
        "No license, express or implied, is granted to any third party.",
    ),
}

#: Lines about licences that are none.
DECOYS = (
    "He lost his driver's license on the way to the work.", "The fishing licence costs twenty crowns and is valid for one year.",
    "A license to teach is issued by the general public school board.", "The driving license was released to the public in the new version.",
    "Permission to enter the source of the river was granted free of charge.", "The software team moved to the apache trail with a copy of the map.",
    "She studied at MIT and released her first work under a new name.", "The commons of the town are free and public, with creative people.",
    "The state will license new broadcasters in the next version of the law.", "Poetic license lets the author use this form of the word.",
)


def words(line: Column) -> Column:
    return F.filter(F.split(F.lower(line), r"[^a-z0-9.-]+|[.-]+(?![a-z0-9])"), lambda w: w != "")


def grams(tokens: Column) -> Column:
    """Words and pairs of neighbouring words."""
    return F.concat(tokens, pairs(tokens))


def pairs(tokens: Column) -> Column:
    return F.zip_with(tokens, F.slice(tokens, 2, F.greatest(F.size(tokens), F.lit(1))), lambda a, b: F.concat_ws(" ", a, b))


def _tokens(line: str) -> list[str]:
    return [w for w in re.split(r"[^a-z0-9.-]+|[.-]+(?![a-z0-9])", line.lower()) if w]


def _copies(line: str, random_: random.Random) -> list[str]:
    """The line itself and copies with a word left out or others beside it."""
    out = [line]
    tokens = line.split()
    beside = ["copyright 2019 the authors", "see the file", "notice", "more at the project page", "part of the set"]
    for i in range(COPIES - 1):
        t = list(tokens)
        if i % 3 and len(t) > 4:
            del t[random_.randrange(len(t))]
        if i % 4 == 1:
            t = [*random_.choice(beside).split(), *t]
        if i % 4 == 2:
            t = [*t, *random_.choice(beside).split()]
        out.append(" ".join(t))
    return out


class LicenseModel:
    """The fitted classifier, its calibration, and the words a licence paragraph must have one of."""

    def __init__(self, spark: SparkSession, ordinary: list[str], seed: int = 11):
        pick = random.Random(seed)
        self.families = [*sorted(NOTICES), UNKNOWN]
        rows = [(line, float(i), pick.random() < 0.25) for i, f in enumerate(self.families[:-1]) for n in NOTICES[f] for line in _copies(n, pick)]
        rows += [(line, float(len(self.families) - 1), pick.random() < 0.25) for d in DECOYS for line in _copies(d, pick)]
        rows += [(line, float(len(self.families) - 1), pick.random() < 0.25) for line in ordinary]
        table = spark.createDataFrame(rows, "line string, label double, held boolean")
        self.hasher = HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True)
        table = self.hasher.transform(table.withColumn("grams", grams(words(F.col("line")))))
        fit = LogisticRegression(family="multinomial", regParam=0.002, maxIter=60, probabilityCol="shares", rawPredictionCol="raw", predictionCol="guess")
        self.model = fit.fit(table.where(~F.col("held")).repartition(1))
        judged = self.margin(self.model.transform(table.where("held"))).select("margin", (F.col("label") < len(self.families) - 1).cast("double").alias("known"))
        a, b = _platt([(r.margin, r.known) for r in judged.collect()])
        self.slope, self.shift = a, b
        self.cues = cue_words(ordinary)

    def margin(self, scored: DataFrame) -> DataFrame:
        """With best (family number) and margin (its raw score above that of unknown)."""
        raw = vector_to_array("raw")
        known = F.slice(raw, 1, len(self.families) - 1)
        top = F.array_max(known)
        return scored.withColumn("margin", top - F.get(raw, F.lit(len(self.families) - 1))).withColumn("best", F.array_position(known, top).cast("int") - 1)

    def judge(self, lines: DataFrame) -> DataFrame:
        """``lines`` (with a column ``line``) with family, probability and confirmed."""
        tokens = words(F.col("line"))
        scored = self.margin(self.model.transform(self.hasher.transform(lines.withColumn("tokens", tokens).withColumn("grams", grams(F.col("tokens"))))))
        probability = 1 / (1 + F.exp(-(F.col("margin") * self.slope + self.shift)))
        names = F.array(*[F.lit(f) for f in self.families[:-1]])
        templates = F.array(*[F.array(*[F.array(*[F.lit(" ".join(p)) for p in _pairs_of(n)]) for n in NOTICES[f]]) for f in self.families[:-1]])
        # a notice of a single word pair is looked for as a whole line only
        def shares(own):
            alone = lambda notice: (F.size(notice) > 1) | (F.size(own) <= ALONE)
            return F.transform(F.get(templates, F.col("best")), lambda notice: F.when(alone(notice), F.size(F.array_intersect(notice, own)) / F.size(notice)).otherwise(0.0))

        found = bound(F.array_distinct(pairs(F.col("tokens"))), shares)
        share = F.coalesce(F.array_max(found), F.lit(0.0))
        out = scored.withColumn("probability", probability).withColumn("share", share)
        family = F.when(F.col("probability") >= 0.5, F.get(names, F.col("best"))).otherwise(F.lit(UNKNOWN))
        drop = [c for c in ("features", "grams", "tokens", "raw", "shares", "guess", "margin", "best") if c not in lines.columns]
        return out.withColumn("family", family).withColumn("confirmed", (F.col("family") != UNKNOWN) & (F.col("share") >= CONFIRMED)).drop(*drop)


def _platt(points: list[tuple[float, float]]) -> tuple[float, float]:
    """Slope and shift of a logistic curve by gradient steps; the held rows are few."""
    import numpy as np

    x, y = np.array([p[0] for p in points]), np.array([p[1] for p in points])
    scale = x.std() or 1.0
    a, b, z = 1.0, 0.0, x / scale
    for _ in range(500):
        error = 1 / (1 + np.exp(-(a * z + b))) - y
        a -= (error @ z) / len(z) + 0.001 * a
        b -= error.mean()
    return float(a / scale), float(b)


def _pairs_of(notice: str) -> list[tuple[str, str]]:
    t = _tokens(notice)
    return sorted(set(zip(t, t[1:], strict=False)))


def cue_words(ordinary: list[str], share: float = CONFIRMED) -> list[str]:
    """Few words, one of which is in every paragraph that holds ``share`` of a notice's word pairs.

    Of a notice of p pairs, ceil(share * p) must be there, so some pair of any
    p - ceil(share * p) + 1 is. Words are taken one by one until they touch so
    many pairs of every notice: next the one that touches most for the number of
    ``ordinary`` lines that hold it. A word that holds a cue is touched as well.
    """
    rows = [line.lower() for line in ordinary]
    notices = [_pairs_of(n) for f in NOTICES.values() for n in f]
    need = [len(p) - -int(-share * len(p) // 1) + 1 for p in notices]
    vocabulary = sorted({w for p in notices for pair in p for w in pair})
    price = {w: 1 + len(rows) / 500 + sum(w in r for r in rows) for w in vocabulary}
    cues: list[str] = []
    while True:
        rest = [[pair for pair in p if not any(c in w for c in cues for w in pair)] for p in notices]
        missing = [max(0, n - (len(p) - len(r))) for n, p, r in zip(need, notices, rest, strict=True)]
        if not any(missing):
            return sorted(cues)
        gain = {c: sum(min(m, sum(c in a or c in b for a, b in r)) for m, r in zip(missing, rest, strict=True) if m) for c in vocabulary}
        cues.append(min((c for c in vocabulary if gain[c]), key=lambda c: (price[c] / gain[c], c)))


def has_cue(text: Column, cues: list[str]) -> Column:
    """Whether ``text`` holds one of ``cues``, whatever its case.

    Plain substring tests on the text in lower case, which is made once; a cue
    that holds another one need not be tried. What passes is more than the
    words themselves, never less.
    """
    least = [c for c in cues if not any(o != c and o in c for o in cues)]
    test = lambda low: reduce(lambda a, b: a | b, [low.contains(c) for c in least], F.lit(False))
    return F.exists(F.array(F.lower(text)), test)


def fit_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> LicenseModel:
    """Fit on the notices and on at most ORDINARY_LINES lines of the documents.

    The sample is the least by hash of one line per document, so it does not
    depend on how the table is partitioned. A share of the hashes that holds
    several times the wanted lines is cut out first: each task then sends a few
    rows, however many tasks there are.
    """
    size = max(1, docs.count())
    least = int(min(1.0, 8 * ORDINARY_LINES / size) * 2**64) - 2**63 - 1
    rows = keyed(docs, key, text).select("text", F.xxhash64("doc", "mark").alias("h")).where(F.col("h") <= least)
    rows = rows.where(~F.lower("text").rlike("licen[cs]|copyright|public domain|permission"))
    pick = F.get(F.split("text", "\n+"), F.lit(0))
    sample = rows.select("h", F.left(pick, F.lit(ORDINARY_CHARS)).alias("line")).orderBy("h", "line").limit(ORDINARY_LINES)
    return LicenseModel(docs.sparkSession, [r.line for r in sample.select("line").collect()])


def license_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", model: LicenseModel | None = None) -> DataFrame:
    """(doc, mark, place, line, family, probability, share, confirmed) of the lines, or windows of long lines, with a known family.

    ``place`` counts lines from 0; a long line has a row per window with a family. Empty and null texts have none.
    """
    model = model or fit_licenses(docs, key, text)
    lines = keyed(docs, key, text).where(has_cue(F.col("text"), model.cues)).select("doc", "mark", F.posexplode(F.split("text", "\n+")).alias("place", "line"))
    lines = lines.where(has_cue(F.col("line"), model.cues))
    own = F.split("line", r"\s+")
    starts = F.sequence(F.lit(1), F.greatest(F.size(own) - WINDOW // 2, F.lit(1)), F.lit(WINDOW // 2))
    parts = F.when(F.size(own) <= WINDOW, F.array("line")).otherwise(F.transform(starts, lambda a: F.array_join(F.slice(own, a, WINDOW), " ")))
    return model.judge(lines.select("doc", "mark", "place", F.explode(parts).alias("line"))).where(F.col("family") != UNKNOWN)


def license_report(docs: DataFrame, key: str = "doc_id", text: str = "text", model: LicenseModel | None = None) -> DataFrame:
    """(key, n_paragraphs, n_license, families, first) of every row.

    ``n_license`` counts confirmed licence paragraphs, ``families`` are theirs,
    sorted and joined by commas, ``first`` is the line number of the first one.
    Empty and null texts have one empty paragraph and no family. Rows that
    repeat id and text get the same result; other columns are not read.
    """
    found = license_lines(docs, key, text, model).where("confirmed").select("doc", "mark", "place", "family").distinct()
    found = stored(
        found.groupBy("doc", "mark").agg(
            F.count_distinct("place").alias("n_license"), F.array_join(F.array_sort(F.collect_set("family")), ",").alias("families"), F.min("place").alias("first")
        ),
        "licenses",
    )
    rows = keyed(docs, key, text).select("doc", "mark", F.size(F.split("text", "\n+")).cast("long").alias("n_paragraphs"))
    rows = rows.join(found, ["doc", "mark"], "left")
    return rows.select(given_id().alias(key), "n_paragraphs", F.coalesce("n_license", F.lit(0).cast("long")).alias("n_license"), F.coalesce("families", F.lit("")).alias("families"), "first")
