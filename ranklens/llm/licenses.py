"""Licence scans: Dice coefficient over word bigrams between texts and licence templates.

Every line of a document and the whole document is compared with every
template.  A text is normalised to its words (runs of a-z and 0-9, A-Z
lower-cased); the similarity is ``2 |A & B| / (|A| + |B|)`` over the sets of
word pairs.  A pair of sizes that cannot reach the threshold is pruned before
anything is counted: ``|A|`` must lie between ``t / (2 - t)`` and
``(2 - t) / t`` times ``|B|``.  Only bigrams that some template has are counted
further, by a hash join with the templates' bigrams.

Null and empty texts, and texts of one word, match nothing.  A document is an
(id, text) pair: rows that repeat both give one result.  Only id and text are read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Public licence notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS,"
        " WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without"
        " restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the"
        " Software is furnished to do so, subject to the following conditions:"
    ),
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of"
        " the License, or (at your option) any later version."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "All-rights-reserved": "All rights reserved. No part of this publication may be reproduced without permission.",
}


def template_bigrams(templates: dict[str, str]) -> list[tuple[str, str, int]]:
    """(licence, bigram, number of the licence's bigrams)."""
    out = []
    for name, text in templates.items():
        words = re.findall("[a-z0-9]+", text.lower())
        pairs = sorted(set(zip(words, words[1:])))
        out += [(name, f"{a} {b}", len(pairs)) for a, b in pairs]
    return out


def _words(text: Column) -> Column:
    """What isn't a letter or digit goes before the lower-casing, so that A-Z alone are lower-cased."""
    return F.split(F.trim(F.lower(F.regexp_replace(text, "[^A-Za-z0-9]+", " "))), " ")


def _bigrams(words: str) -> Column:
    """Hashes of the distinct word pairs."""
    pairs = F.zip_with(words, F.slice(words, F.lit(2), F.size(words)), lambda a, b: F.xxhash64(a, b))
    return F.array_distinct(F.slice(pairs, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))))


def _given(spark: SparkSession, templates: dict[str, str], threshold: float) -> DataFrame:
    """(bigram, licence, n_template, least, most) with the sizes a text may have."""
    rows = []
    for name, pair, n in template_bigrams(templates):
        a, b = pair.split(" ")
        rows.append(F.struct(F.xxhash64(F.lit(a), F.lit(b)).alias("bigram"), F.lit(name).alias("license"), F.lit(n).alias("n_template")))
    table = spark.range(1).select(F.explode(F.array(*rows)).alias("t")).select("t.*")
    return table.withColumns({"least": F.col("n_template") * (threshold / (2 - threshold)) - 1e-9, "most": F.col("n_template") * ((2 - threshold) / threshold) + 1e-9})


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, line, license, n_common, dice): every line (from 0; -1: the whole text) at least ``threshold`` like a template.

    The templates are a fixed list in memory, so their bigrams are broadcast.
    """
    templates = TEMPLATES if templates is None else templates
    sizes = [n for _, _, n in template_bigrams(templates)] or [0]
    least, most = min(sizes) * threshold / (2 - threshold) - 1e-9, max(sizes) * (2 - threshold) / threshold + 1e-9
    src = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).cast("string").alias("text"))
    lines = src.select("id", "th", F.posexplode(F.split("text", "\n", -1)).alias("line", "text"))
    whole = src.where(F.instr("text", "\n") > 0).select("id", "th", F.lit(-1).alias("line"), "text")
    # a word has a letter and stands apart, so fewer characters than this hold too few pairs
    # the one-element arrays keep words and pairs columns of their own: otherwise the plan holds their expressions several times
    units = lines.unionByName(whole).where(F.length("text") >= 2 * least + 1).select("id", "th", "line", F.explode(F.array(_words(F.col("text")))).alias("words"))
    units = units.where(F.size("words") > least).select("id", "th", "line", F.explode(F.array(_bigrams("words"))).alias("bigrams"))
    units = units.withColumn("n_text", F.size("bigrams")).where((F.col("n_text") >= least) & (F.col("n_text") <= most))
    pairs = units.select("id", "th", "line", "n_text", F.explode("bigrams").alias("bigram"))
    pairs = pairs.join(F.broadcast(_given(docs.sparkSession, templates, threshold)), "bigram").where("n_text >= least and n_text <= most")
    counted = pairs.groupBy("id", "th", "line", "license", "n_text", "n_template").agg(F.size(F.collect_set("bigram")).cast("long").alias("n_common"))
    dice = 2 * F.col("n_common") / (F.col("n_text") + F.col("n_template"))
    return counted.withColumn("dice", dice).where(F.col("dice") >= threshold).select(F.col("id").alias(id_col), "line", "license", "n_common", "dice")
