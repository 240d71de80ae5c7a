"""Licence scan: a trained paragraph classifier, confirmed against templates.

Non-empty lines, and the blocks of consecutive non-empty lines that a wrapped
text takes (comment marks at line starts are no words, and a line of them alone
ends a block), are paragraphs, read as word 1- to 3-grams. Multinomial
logistic regression over them, fitted on the templates below, their variants
and negative sentences, gives each licence family and the class "none" a
probability. The class unknown is calibrated on variants that the fit has not
seen: the least probability that no negative reaches. A prediction counts
only if the paragraph also holds ``MIN_SHARE`` of the word 3-grams of one of
that family's templates. A block counts besides its lines if none of them has
its family; a block that looks like a licence, but has no confirmed one in it
or its lines, is unknown.

Only paragraphs with a cue are scored: one of the words of ``CUES``, or of the
words that the templates need so that no paragraph which can be confirmed is
without one (``cues``); that test is exact, and one search per text and line
(``cue_pattern``) spares it for almost all of them. So unknown licences are
found whether or not they share a phrase with a template. The paragraphs with
a cue are written once. The data path is DataFrame functions alone; the fit
runs on the fixed sentences below, on the driver.

Edge cases: a null or empty text has no paragraphs; null ids and repeated
rows each get their row; a very long text is split into its lines, and one very
long line into its words, as arrays in one row; an empty table gives no rows; an input column with
the name of an output gives way to it.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.util import boxed, stored, table, unboxed

MIN_SHARE = 0.5
# Words by which a paragraph is looked at as a possible licence.
CUES = ("license", "licenses", "licensed", "licence", "licences", "licensor", "licensee", "sublicense", "spdx", "copyleft",
        "warranties", "redistribution", "redistributions", "redistribute", "merchantability", "released", "software", "arising",
        "cc", "nc", "gnu", "bsd")

# How the families are usually stated.
TEMPLATES = {
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "BSD": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC0": [
        "Released under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "under the terms of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "under the terms of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ],
    "LGPL": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "Licensed under the MIT License.",
    ],
    "MPL-2.0": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
}
# Fixed values, as above, for families whose notices are less often wrapped into prose.
TEMPLATES |= {
    "Artistic-2.0": ["This is free software, licensed under the Artistic License 2.0."],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
        "and accompanying documentation covered by this license",
    ],
    "CDDL-1.0": ["The contents of this file are subject to the terms of the Common Development and Distribution License"],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public "
                "License 2.0"],
    "EUPL-1.2": ["Licensed under the EUPL, Version 1.2 or as soon they will be approved by the European Commission"],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "MS-PL": ["This license governs use of the accompanying software. If you use the software, you accept this license."],
    "ODbL-1.0": ["This database is made available under the Open Database License"],
    "OFL-1.1": ["This Font Software is licensed under the SIL Open Font License, Version 1.1."],
    "PostgreSQL": ["Permission to use, copy, modify, and distribute this software and its documentation for any "
                   "purpose, without fee, and without a written agreement is hereby granted"],
    "Python-2.0": ["Python Software Foundation License Version 2"],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source "
        "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software.",
    ],
}
# The names and registered tags of each family.
NAMES = {
    "AGPL-3.0": ("GNU AGPLv3", "GNU Affero General Public License v3.0"), "Apache-2.0": ("Apache License 2.0",),
    "Artistic-2.0": ("Artistic License 2.0",), "BSD": ("BSD License", "BSD 2-Clause License", "BSD 3-Clause License"),
    "BSL-1.0": ("Boost Software License 1.0",), "CC-BY-NC-ND-4.0": ("CC BY-NC-ND 4.0",),
    "CC-BY-NC-SA-4.0": ("CC BY-NC-SA 4.0",), "CC-BY-ND-4.0": ("CC BY-ND 4.0",), "CC0": ("CC0 1.0",),
    "CDDL-1.0": ("Common Development and Distribution License 1.0",), "EPL-2.0": ("Eclipse Public License 2.0",),
    "EUPL-1.2": ("European Union Public Licence 1.2",), "GPL-2.0": ("GPLv2", "GNU General Public License v2.0"),
    "GPL-3.0": ("GPLv3", "GNU General Public License v3.0"), "ISC": ("ISC License",),
    "LGPL": ("LGPLv2.1", "LGPLv3", "GNU Lesser General Public License"), "MIT": ("MIT License",),
    "MPL-2.0": ("Mozilla Public License 2.0",), "MS-PL": ("Microsoft Public License",),
    "ODbL-1.0": ("Open Database License",), "OFL-1.1": ("SIL Open Font License 1.1",),
    "PostgreSQL": ("PostgreSQL License",), "Unlicense": ("Unlicense",), "Zlib": ("zlib License",),
}
TAGS = {
    "AGPL-3.0": ("AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"), "Apache-2.0": ("Apache-2.0",),
    "Artistic-2.0": ("Artistic-2.0",), "BSD": ("BSD-2-Clause", "BSD-3-Clause"), "BSL-1.0": ("BSL-1.0",),
    "CC-BY-4.0": ("CC-BY-4.0",), "CC-BY-NC-4.0": ("CC-BY-NC-4.0",), "CC-BY-NC-ND-4.0": ("CC-BY-NC-ND-4.0",),
    "CC-BY-NC-SA-4.0": ("CC-BY-NC-SA-4.0",), "CC-BY-ND-4.0": ("CC-BY-ND-4.0",), "CC-BY-SA-4.0": ("CC-BY-SA-4.0",),
    "CC0": ("CC0-1.0",), "CDDL-1.0": ("CDDL-1.0",), "EPL-2.0": ("EPL-2.0",), "EUPL-1.2": ("EUPL-1.2",),
    "GPL-2.0": ("GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later"), "GPL-3.0": ("GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"),
    "ISC": ("ISC",), "LGPL": ("LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later"), "MIT": ("MIT",),
    "MPL-2.0": ("MPL-2.0",), "MS-PL": ("MS-PL",), "ODbL-1.0": ("ODbL-1.0",), "OFL-1.1": ("OFL-1.1",),
    "PostgreSQL": ("PostgreSQL",), "Python-2.0": ("Python-2.0",), "Unlicense": ("Unlicense",), "Zlib": ("Zlib",),
}
for _family in sorted({*NAMES, *TAGS}):
    TEMPLATES[_family] = [*dict.fromkeys([
        *TEMPLATES.get(_family, ()), *[f"Licensed under the {n}." for n in NAMES.get(_family, ())],
        *[f"Released under the {n}." for n in NAMES.get(_family, ())], *[f"The {n}" for n in NAMES.get(_family, ())],
        *[f"SPDX-License-Identifier: {t}" for t in TAGS.get(_family, ())]])]
NONE = "none"
NEGATIVES = [
    "All rights reserved.", "See the license for details.", "Her driving license was renewed last year.",
    "This work is not for sale.", "The software is licensed to the customer for internal use only.",
    "You may not use this file.", "Released under a new name.", "Released on the first of May.",
    "The general public was invited.", "A copy of the report can be found in the library.",
    "The license expired and the shop had to close.", "Permission is granted to enter the building.",
    "The source of the river is in the hills.", "Under the terms of the contract both parties agree.",
    "A public license hearing will be held, version 3 of the agenda is attached.",
    "The foundation published a report on free software in schools.", "Creative work needs time and commons.",
    "Licensed under a private agreement.", "This work is licensed under terms agreed with the author.",
    "A fishing license is needed at the lake.", "The license plate was found by the road.", "Licensed premises close at ten.",
    "He lost his pilot's licence.", "The warranties of the seller end after two years.", "The seller gives no warranties.",
    "She is a licensed electrician.", "Licenses for shops are issued by the council.", "The bus was built under license.",
    "Distributed under commercial licence terms only.", "It is of the to and in that is for.",
]
#: What stands around a sentence in its variants.
AROUND = [("", ""), ("Copyright (c) 2021 The Authors. ", ""), ("Note: ", " Thank you for reading."), ("", " All rights reserved."),
          ("Unless stated otherwise, ", ""), ("License: ", " See the LICENSE file.")]


#: Lines without a letter or digit between two blocks.
BLANK = r"\n(?:[^\p{L}\p{N}\n]*\n)+"


def words(text: str) -> list[str]:
    return [w for w in re.sub(r"[^a-z0-9.]+", " ", text.lower()).replace(". ", " ").strip(" .").split(" ") if w]


def grams(w: list[str], sizes=(1, 2, 3)) -> set[str]:
    return {" ".join(w[i:i + n]) for n in sizes for i in range(len(w) - n + 1)}


def trigrams(text: str) -> set[str]:
    w = words(text)
    return grams(w, (min(3, len(w)),))


def variants() -> tuple[list[str], list[set[str]], np.ndarray, np.ndarray]:
    """(families with NONE first, n-grams of each variant, its family, whether it is kept from the fit)."""
    families = [NONE, *sorted(TEMPLATES)]
    rows, y, unseen = [], [], []
    for c, family in enumerate(families):
        for s, sentence in enumerate(NEGATIVES if family == NONE else TEMPLATES[family]):
            for v, (before, after) in enumerate(AROUND):
                rows.append(grams(words(before + sentence + after)))
                y.append(c)
                unseen.append((s + v) % 4 == 3 or family == NONE and s % 4 == 3)
    return families, rows, np.array(y), np.array(unseen)


@cache
def model() -> tuple[list[str], list[str], np.ndarray, float]:
    """(families with NONE first, n-grams, weights with the biases as last row, least probability)."""
    families, rows, y, unseen = variants()
    vocab = sorted(set().union(*[r for r, u in zip(rows, unseen) if not u]))
    x = features(rows, vocab)
    truth = np.eye(len(families), dtype=np.float32)[y]
    w = np.zeros((len(vocab) + 1, len(families)), dtype=np.float32)
    fit, aim = x[~unseen], truth[~unseen]
    step = 2.0 / fit.sum(axis=1).mean()
    for _ in range(300):
        w -= step * (fit.T @ (probabilities(fit @ w) - aim) / len(fit) * len(families) / 2 + 1e-4 * w)
    # Calibration: half way between the surest negative and certainty, never under one half.
    p = probabilities(x[unseen] @ w)
    worst = max([float(r[1:].max()) for r, c in zip(p, y[unseen]) if c == 0], default=0.0)
    return families, vocab, w.astype(np.float64), max(0.5, min(0.95, (1 + worst) / 2))


def features(rows: list[set[str]], vocab: list[str]) -> np.ndarray:
    index = {g: i for i, g in enumerate(vocab)}
    x = np.zeros((len(rows), len(vocab) + 1), dtype=np.float32)
    for i, r in enumerate(rows):
        x[i, [index[g] for g in r if g in index]] = 1
    x[:, -1] = 1
    return x


def probabilities(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@cache
def cues() -> list[str]:
    """Words of which every paragraph that can be confirmed has at least one:
    for each template, the words that leave less than ``MIN_SHARE`` of its
    3-grams without a cue, rare ones among the sentences first."""
    common = {w for sentence in NEGATIVES for w in set(words(sentence))}
    out: set[str] = set(CUES)
    for sentences in TEMPLATES.values():
        for sentence in sentences:
            all_ = trigrams(sentence)
            while True:
                bare = [g.split(" ") for g in all_ if not out & set(g.split(" "))]
                if len(bare) < MIN_SHARE * len(all_):
                    break
                count: dict[str, int] = {}
                for w in {w for g in bare for w in g}:
                    count[w] = sum(w in g for g in bare)
                out.add(max(count, key=lambda w: (w not in common and len(w) > 3, w not in common, count[w], w)))
    return sorted(out)


def word_array(paragraph: Column) -> Column:
    """The SQL twin of ``words``."""
    flat = F.regexp_replace(F.regexp_replace(F.lower(paragraph), r"[^a-z0-9.]+", " "), r"\. ", " ")
    return F.filter(F.split(F.regexp_replace(flat, r"^[ .]+|[ .]+$", ""), " "), lambda w: w != "")


@cache
def cue_pattern() -> str:
    """Matches the lower-cased text of every paragraph with a cue (and of few
    others): ``words`` parts words at other characters than letters and digits."""
    starts: dict[str, list[str]] = {}
    for w in cues():
        starts.setdefault(re.escape(w[0]), []).append(re.escape(w[1:]))
    first = "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in sorted(starts.items()))
    return f"(?<![a-z0-9])(?:{first})(?![a-z0-9])"


def gram_array(w: Column, n: int) -> Column:
    """n-grams of a word array; none if it is shorter."""
    return F.when(F.size(w) >= n, F.transform(
        F.sequence(F.lit(1), F.size(w) - (n - 1)),
        lambda i: F.concat_ws(" ", *[F.element_at(w, i + k) for k in range(n)]))
    ).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", unknown: bool = False) -> DataFrame:
    """``docs`` plus ``_n_paragraphs`` (non-empty lines), ``_n_licensed``, ``_licenses`` (sorted,
    comma-joined families) and, if asked for, ``_n_unknown`` (blocks)."""
    spark = docs.sparkSession
    families, vocab, w, least = model()
    known = [(f"{f}/{i}", f, g, len(t)) for f, ts in TEMPLATES.items()
             for i, t in enumerate(map(trigrams, ts)) for g in sorted(t)]
    # Both tables have the size of the fixed templates: broadcast.
    templates = F.broadcast(spark.createDataFrame(known, "template string, family string, gram string, n long"))
    weights = F.broadcast(spark.createDataFrame(
        [(g, *map(float, row)) for g, row in zip(vocab, w[:-1])],
        "gram string, " + ", ".join(f"w{c} double" for c in range(len(families)))))

    text = F.coalesce(F.col(text_col), F.lit(""))
    # Rows equal in id and text have equal results, so this is key enough.
    key = [F.col(id_col).alias("_id"), F.xxhash64(text).alias("_h"), F.md5(text).alias("_m")]
    # Most texts have no cue in any word, and most lines of the others have none:
    # one search says so, before any words are made.
    blocks = docs.where(F.lower(text).rlike(cue_pattern())).select(*key, F.posexplode(F.split(text, BLANK)).alias("_b", "_block"))
    # Place 0 is the block as a whole, if it has several lines.
    its = F.split(F.col("_block"), "\n")
    whole = F.when(F.size(its) > 1, F.col("_block"))
    lines = blocks.select("_id", "_h", "_m", "_b", F.posexplode(F.concat(F.array(whole), its)).alias("_p", "_line"))
    likely = lines.where(F.lower("_line").rlike(cue_pattern()))
    read = likely.select("_id", "_h", "_m", "_b", "_p", word_array(F.col("_line")).alias("_w"))
    at = ["_id", "_h", "_m", "_b", "_p"]
    cued = F.arrays_overlap("_w", F.array(*[F.lit(w) for w in cues()]))
    # The paragraphs with a cue, written once: all that follows reads those few, not the texts.
    some = stored(read.where(cued).dropDuplicates(at).select(*at, "_w"), "license-paragraphs")
    all_grams = F.array_distinct(F.concat(*[gram_array(F.col("_w"), n) for n in (1, 2, 3)]))
    found = some.select(*at, F.explode(all_grams).alias("gram"))
    sums = found.join(weights, on="gram").groupBy(*at).agg(
        *[(F.sum(f"w{c}") + F.lit(float(w[-1, c]))).alias(f"z{c}") for c in range(len(families))])
    best = F.greatest(*[F.col(f"z{c}") for c in range(len(families))])
    total = sum((F.exp(F.col(f"z{c}") - best) for c in range(1, len(families))), F.exp(F.col("z0") - best))
    name = F.coalesce(*[F.when(F.col(f"z{c}") == best, F.lit(f)) for c, f in enumerate(families)])
    predicted = sums.select(*at, name.alias("family"), (1 / total).alias("p")).where(F.col("family") != NONE)
    shares = (found.join(templates, on="gram").groupBy(*at, "family", "template")
              .agg((F.count(F.lit(1)) / F.max("n")).alias("share"))
              .where(F.col("share") >= MIN_SHARE).select(*at, "family").distinct())
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*at, "family"]]
    # A paragraph has one prediction, so the join adds no rows.
    sure = (F.col("p") >= least) & F.col("b.family").isNotNull()
    line = F.col("a._p") > 0
    per_block = (predicted.alias("a").join(shares.alias("b"), on=same, how="left")
                 .groupBy(*[F.col(f"a.{c}") for c in ("_id", "_h", "_m", "_b")]).agg(
        F.count(F.when(sure & line, 1)).alias("_lines"),
        F.collect_set(F.when(sure & line, F.col("a.family"))).alias("_on_lines"),
        F.collect_set(F.when(sure & ~line, F.col("a.family"))).alias("_wrapped")))
    extra = F.array_except("_wrapped", "_on_lines")
    per_doc = per_block.groupBy("_id", "_h", "_m").agg(
        F.sum(F.col("_lines") + F.size(extra)).alias("_n"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.concat("_on_lines", extra))))), ",").alias("_f"),
        F.count(F.when((F.col("_lines") == 0) & (F.size("_wrapped") == 0), 1)).alias("_u"))
    rows = docs.select(*key, F.size(F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")).cast("long").alias("_all"),
                       boxed(docs))
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ("_id", "_h", "_m")]
    out = rows.alias("d").join(per_doc.alias("r"), on=same, how="left").select(
        "d._doc", "d._all", F.coalesce("r._n", F.lit(0).cast("long")).alias("_n"),
        F.coalesce("r._f", F.lit("")).alias("_f"), F.coalesce("r._u", F.lit(0).cast("long")).alias("_u"))
    added = {"_n_paragraphs": F.col("_all"), "_n_licensed": F.col("_n"), "_licenses": F.col("_f")}
    return unboxed(out, docs, added | ({"_n_unknown": F.col("_u")} if unknown else {}))


def query(spark, sf_dir):
    r = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), unknown=True)
    return r.select("doc_id", F.col("_n_paragraphs").alias("n_paragraphs"),
                    F.col("_n_licensed").alias("n_licensed"), F.col("_licenses").alias("licenses"),
                    F.col("_n_unknown").alias("n_unknown"))
