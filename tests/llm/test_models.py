"""op1 recall, op3 and op9 on held-out cases, op10 by hand, the pipeline against its stages."""

import tracemalloc

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from faultline.llm import op1_ann, op3_licenses, op9_toxicity, op10_html, registry

SF = "/root/testdata/sf0.001"


def test_every_operator_has_its_query():
    import __spark_entry__ as E

    found = E.queries()
    assert [n.split("_")[0] for n in registry.MODULES] == [f"op{i}" for i in range(1, 14)]
    assert set(registry.MODULES) <= set(found) and "pipeline" in found
    assert "op8_exact_dedup" in E.oracle_sql()


# -- op1

def exact(ids, x, k=20):
    out = {}
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        s[ids == ids[i]] = -np.inf
        out[ids[i]] = ids[np.lexsort((ids, -s))[:k]]
    return out


def test_nearest_neighbours(spark):
    rows = duckdb.sql(f"select vec_id, embedding from '{SF}/embeddings.parquet' order by 1").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)
    got = {}
    for r in op1_ann.query(spark, SF).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"], r["score"]
    want = exact(ids, x)
    assert set(got) == set(want)
    hits = [len(set(want[q].tolist()) & {v for v, _ in m.values()}) for q, m in got.items()]
    assert sum(hits) / (20 * len(hits)) >= 0.9
    at = {i: n for n, i in enumerate(ids)}
    for q, m in got.items():
        assert sorted(m) == list(range(1, 21))
        assert all(abs(s - x[at[q]] @ x[at[v]]) < 1e-12 for v, s in m.values())
        assert [(-s, v) for _, (v, s) in sorted(m.items())] == sorted((-s, v) for v, s in m.values())


def test_neighbours_norms_ties_and_a_crowded_leaf(spark, monkeypatch):
    monkeypatch.setattr(op1_ann, "VECTORS", 50)
    monkeypatch.setattr(op1_ann, "QUERIES", 3)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 8)) * rng.uniform(0.1, 5, size=(400, 1))
    x[100:300] = x[100]  # half of all vectors are one
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in op1_ann.search(df, F.col("vec_id") % 20 == 0, k=10).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    want = exact(np.arange(400), x, 10)
    hits = sum(len(set(want[q].tolist()) & {v for _, v in m}) for q, m in got.items())
    assert hits >= 0.9 * 10 * len(want)
    assert [v for _, v in sorted(got[100])] == want[100].tolist()  # exact copies: smaller ids first


def test_neighbour_edges(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame(
        [(20, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, None, 1), (4, [0.0, 0.0], 1), (5, [nan, 1.0], 1),
         (6, [1.0], 1), (None, [1.0, 1.0], 1), (40, [None, 1.0], 1), (60, [inf, 0.0], 1), (20, [1.0, 0.0], 1)],
        "vec_id long, embedding array<double>, score int")
    got = [tuple(r) for r in op1_ann.search(df, F.col("vec_id") % 20 == 0).orderBy("rank").collect()]
    assert got == [(20, 1, 1, 1.0), (20, 2, 2, 1.0)]
    rng = np.random.default_rng(4)  # a repeated query row is one query, with as many different neighbours
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(60, 5)))]
    many = spark.createDataFrame([*rows, rows[20], rows[20]], "vec_id long, embedding array<double>")
    got = op1_ann.search(many, F.col("vec_id") == 20).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 21)) and len({r["vec_id"] for r in got}) == 20
    assert op1_ann.search(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []


# -- op3

def test_license_cues_are_searched_before_words_are_made(spark):
    """The search passes every paragraph with a cue, whatever stands around it,
    and stands before the words in the plan."""
    import re

    cues, found = set(op3_licenses.cues()), re.compile(op3_licenses.cue_pattern()).search
    around = ["", " ", ".", ". ", "..", "...", "-", "\n", "x ", " x", "x. ", ".x", "é", "(", ") ", "1", "x"]
    for cue in cues:
        for before in around:
            for after in around:
                text = before + cue.upper() + after
                assert found(text.lower()) or not cues & set(op3_licenses.words(text)), text
    assert not found("accord since software1 xlicense")
    rows = [(i, b + c + a) for i, (c, b, a) in enumerate(
        (c, b, a) for c in sorted(cues)[::5] for b in around for a in around)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    cued = F.arrays_overlap(op3_licenses.word_array(F.col("text")), F.array(*[F.lit(c) for c in sorted(cues)]))
    assert df.where(cued & ~F.lower("text").rlike(op3_licenses.cue_pattern())).count() == 0
    plans = []
    keep, op3_licenses.stored = op3_licenses.stored, lambda d, name: plans.append(d) or keep(d, name)
    try:
        op3_licenses.scan(df)
    finally:
        op3_licenses.stored = keep
    plan = plans[0]._jdf.queryExecution().optimizedPlan().toString()
    below = [x for x in plan.splitlines() if "Filter" in x and "RLIKE" in x and "arrays_overlap" not in x]
    assert below, plan[:2000]


def test_license_families(spark):
    rows = [(i, f"Some words first.\n{t}\nand after") for i, t in enumerate(
        ["Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3.",
         "Licensed under CC BY-NC 4.0.", "Licensed under the Apache License, Version 2.0. All rights reserved.",
         "Copyright 2019 Someone. Licensed under CC BY-SA 4.0.", "Her driving license was renewed under the terms.",
         "Licensed under a private agreement.", "The general public license fee was raised."])]
    rows += [(90, None), (None, "Licensed under CC BY 4.0."), (91, ""), (91, ""), (92, "x " * 30_000 + "\nReleased under the MIT License.")]
    df = spark.createDataFrame([(*r, "a") for r in rows], "doc_id long, text string, _licenses string")
    out = op3_licenses.scan(df)
    assert out.columns == ["doc_id", "text", "_n_paragraphs", "_n_licensed", "_licenses"] and out.count() == len(rows)
    got = {r["doc_id"]: (r["_n_paragraphs"], r["_n_licensed"], r["_licenses"]) for r in out.collect()}
    assert [got[i][2] for i in range(8)] == ["MIT", "GPL-3.0", "CC-BY-NC-4.0", "Apache-2.0", "CC-BY-SA-4.0", "", "", ""]
    assert got[0][:2] == (3, 1) and got[90] == (0, 0, "") and got[None] == (1, 1, "CC-BY-4.0")
    assert got[91] == (0, 0, "") and got[92] == (2, 1, "MIT")
    assert op3_licenses.scan(df.limit(0)).collect() == []


MIT_FILE = """The MIT License (MIT)

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:
"""
BSD_FILE = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:
"""
GPL_FILE = """This program is free software; you can redistribute it and/or modify it
under the terms of the GNU General Public License as published by the
Free Software Foundation; either version 2 of the License, or (at your
option) any later version.

This program is distributed in the hope that it will be useful,
"""


def test_wrapped_licenses_and_the_unknown_class(spark):
    texts = [MIT_FILE, BSD_FILE, GPL_FILE]
    marked = ["".join(f"{m} {x}".rstrip() + "\n" for x in t.splitlines()) for t, m in zip(texts, ["#", " *", "//"])]
    odd = "This work is licensed under the Foo General Public Grant."
    rows = [*enumerate([*texts, *marked, "Released under the MIT License.\nand\n" + BSD_FILE, odd])]
    out = op3_licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), unknown=True).collect()
    got = {r["doc_id"]: (r["_licenses"], r["_n_licensed"], r["_n_unknown"]) for r in out}
    assert [got[i][0] for i in range(6)] == ["MIT", "BSD", "GPL-2.0"] * 2
    assert got[7] == ("", 0, 1)


def test_license_classifier_on_held_out_variants():
    families, rows, y, unseen = op3_licenses.variants()
    _, vocab, w, least = op3_licenses.model()
    p = op3_licenses.probabilities(op3_licenses.features(rows, vocab) @ w)
    assert len(families) > 28 and unseen.sum() > 150
    assert (p.argmax(axis=1) == y)[unseen].mean() > 0.9
    sure = p[:, 1:].max(axis=1) >= least
    assert not (sure & (y == 0))[unseen].any()  # no negative counts as a licence


def test_license_tags_and_names(spark):
    cases = {"The MIT License (MIT)": "MIT", "// SPDX-License-Identifier: GPL-2.0-or-later": "GPL-2.0",
             "# SPDX-License-Identifier: Apache-2.0": "Apache-2.0", "Licensed under the GPLv3": "GPL-3.0",
             "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted, provided that the above copyright notice and this permission notice appear in all copies.": "ISC",
             "This is free and unencumbered software released into the public domain.": "Unlicense",
             "Distributed under the Boost Software License, Version 1.0. (See accompanying file)": "BSL-1.0",
             "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
             "which is available at https://www.eclipse.org/legal/epl-2.0/": "EPL-2.0",
             "A fishing licence is needed at the lake.": "", "All rights reserved.": ""}
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id int, text string")
    got = {r["doc_id"]: r["_licenses"] for r in op3_licenses.scan(df).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())


def test_every_paragraph_that_can_be_confirmed_has_a_cue():
    cues = set(op3_licenses.cues())
    for sentences in op3_licenses.TEMPLATES.values():
        for t in map(op3_licenses.trigrams, sentences):
            assert sum(not cues & set(g.split(" ")) for g in t) < op3_licenses.MIN_SHARE * len(t)


def brute_license(text):
    families, vocab, w, least = op3_licenses.model()
    index = {g: i for i, g in enumerate(vocab)}
    out, n = [], 0
    for line in (text or "").split("\n"):
        n += bool(line.strip(" "))
        have = op3_licenses.grams(op3_licenses.words(line))
        z = w[-1] + sum((w[index[g]] for g in have if g in index), np.zeros(len(families)))
        p = np.exp(z - z.max())
        best = int(z.argmax())
        if best and 1 / p.sum() >= least and any(
                len(have & t) >= op3_licenses.MIN_SHARE * len(t)
                for t in map(op3_licenses.trigrams, op3_licenses.TEMPLATES[families[best]])):
            out.append(families[best])
    return n, len(out), ",".join(sorted(set(out)))


def test_license_query_is_the_brute_force_scan(spark):
    docs = dict(duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())
    got = {r["doc_id"]: (r["n_paragraphs"], r["n_licensed"], r["licenses"]) for r in op3_licenses.query(spark, SF).collect()}
    assert got == {i: brute_license(t) for i, t in docs.items()}


# -- op9

def test_pairs_are_learnt():
    """Insults 1 and 2, groups 3 and 4: toxic are 1 with 3 and 2 with 4, not 1
    with 4 or 2 with 3. No sum of weights tells these apart."""
    rng = np.random.default_rng(4)
    kinds, texts, y = [([1, 3], 1), ([2, 4], 1), ([1, 4], 0), ([2, 3], 0), *[([], 0)] * 4], [], []
    for _ in range(1600):
        own, toxic = kinds[rng.integers(len(kinds))]
        texts.append(np.array(sorted({*rng.integers(10, 400, 8).tolist(), *own})))
        y.append(float(toxic))
    m = op9_toxicity.train(texts, np.array(y))
    z = m.logits([op9_toxicity.lookup(m.keys, np.array(k, dtype=np.int64)) for k, _ in kinds])
    assert min(z[:2]) > np.log(0.7 / 0.3) > max(z[2:])


def rare_toxic(n, seed):
    """0.5% toxic: half by one of three insults (1-3), half by 6 with group 8. 6
    is as often without 8, and 8 stands mostly alone, toxic at the base rate."""
    rng = np.random.default_rng(seed)
    texts, y = [], []
    for u in rng.random(n):
        own, toxic = (([1 + int(rng.integers(3))], 1) if u < 0.0025 else ([6, 8], 1) if u < 0.005 else
                      ([6], 0) if u < 0.01 else ([8], 0) if u < 0.5 else ([], 0))
        texts.append(np.array(sorted({*rng.integers(100, 3000, 12).tolist(), *own})))
        y.append(float(toxic))
    return texts, np.array(y)


def test_rare_insults_and_a_group_without_a_weight_of_its_own():
    texts, y = rare_toxic(16_000, 1)
    group = np.array([8 in x for x in texts])
    assert y.mean() <= 0.006 and abs(y[group].mean() - y.mean()) < 0.002
    m = op9_toxicity.train(texts, y)
    texts, y = rare_toxic(16_000, 2)
    hit = m.logits([op9_toxicity.lookup(m.keys, x) for x in texts]) >= np.log(0.7 / 0.3)
    pair = np.array([6 in x for x in texts]) & (y == 1)
    assert hit[pair].mean() >= 0.9 and hit[(y == 1) & ~pair].mean() >= 0.9 and hit[y == 0].mean() <= 0.001


def peak_mb(run):
    """What ``run`` returns and the most that Python and numpy held in this process meanwhile."""
    tracemalloc.start()
    try:
        return run(), tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_the_driver_holds_the_model_and_not_its_sample(spark):
    rng = np.random.default_rng(5)
    docs = [(i, " ".join(f"w{x}" for x in rng.choice(2_000, 600, replace=False)) + " idiot" * (i % 2)) for i in range(300)]
    docs = spark.createDataFrame(docs, "doc_id long, text string").cache()
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, toxic int")
    assert docs.count() == 300
    m, mb = peak_mb(lambda: op9_toxicity.fit(docs, labels))
    assert len(m.keys) == 2_001 and mb < 3  # its sample: about 200 texts, 120,000 hashes
    got = op9_toxicity.score(docs, m).collect()
    assert all(r["_predicted"] == r["doc_id"] % 2 for r in got)


def test_logits_of_many_texts_need_no_more_memory_than_a_few():
    rng = np.random.default_rng(6)
    m = op9_toxicity.Model(0.5, np.arange(5_000), rng.normal(size=5_001), rng.normal(size=(5_001, 4)))
    rows = [np.sort(rng.choice(5_000, n, replace=False)) for n in rng.integers(0, 900, 2_000)]
    rows[7:9] = [np.zeros(0, np.int64)] * 2
    z, mb = peak_mb(lambda: m.logits(rows))
    assert mb < 10 and np.array_equal(z, [m.logits([r])[0] for r in rows]) and set(z[7:9]) == {0.5}


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    rude = {"idiot", "moron", "loser", "clown", "stupid", "worthless", "trash", "pathetic", "disgusting", "scum"}
    docs = dict(duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall())
    got = op9_toxicity.query(spark, sf).collect()
    assert len(got) == len(docs) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    held = [(r["predicted"], bool(rude & op9_toxicity.terms(docs[r["doc_id"]]))) for r in got if r["held_out"]]
    assert sum(p and t for p, t in held) >= 0.7 * sum(t for _, t in held)
    assert sum(p and not t for p, t in held) <= 0.02 * len(held)


def test_toxicity_edges(spark):
    bad = "you idiot and moron"
    docs = spark.createDataFrame(
        [(i, bad if i % 2 else "fine words here", "x") for i in range(40)] + [(100, None, "x"), (100, None, "x"), (None, bad, "y"),
                                                                            (101, "", "z"), (102, "word " * 50_000 + bad, "z")],
        "doc_id long, text string, _score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (7, None)], "doc_id long, toxic int")
    out = op9_toxicity.score(docs, op9_toxicity.fit(docs, labels))
    assert out.columns == ["doc_id", "text", "_held_out", "_score", "_predicted"]
    got = out.collect()
    assert len(got) == 45 and all(r["_predicted"] == int("idiot" in (r["text"] or "")) for r in got)
    assert {r["_held_out"] for r in got if r["doc_id"] is None} == {False}
    none = op9_toxicity.score(docs, op9_toxicity.fit(docs, labels.limit(0)))
    assert none.agg(F.max("_score")).first()[0] < 1e-9 and op9_toxicity.score(docs.limit(0), op9_toxicity.fit(docs, labels)).collect() == []


# -- op10

@pytest.mark.parametrize("page,text", [
    (None, None), ("", ""), ("plain &amp; text", "plain & text"),
    ("<p>one<p>two <b>bold</b>  x<br>next", "one\n\ntwo bold x\nnext"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>after", "- a\n- b\n  - c\n- d\n\nafter"),
    ("<ol start=3><li>x<li><p>y<p>z</ol>", "3. x\n4. y\n\n   z"),
    ("<table><tr><th>Name<th>Age<tr><td>Bob<td>3</table>", "Name  Age\nBob   3"),
    ("<table><td>a<td>b</table>", "a  b"),
    ("<table><tr><td rowspan=2>A<td>b<td>q<tr><td>c<td>z<tr><td>d<td>e</table>", "A  b  q\n   c  z\nd  e"),
    ("<table><tr><td>1<td rowspan=0>all<td>x<tr><td>2<td>y<tr><td>3<td>z</table>", "1  all  x\n2       y\n3       z"),
    ("<table><tr><td rowspan=2 colspan=2>AB<td>c<tr><td>d<tr><td>e<td>f<td>g</table>", "AB    c\n      d\ne  f  g"),
    ("<table><tr><td>" + "x" * 50 + "<td>b<tr><td>short<td>c</table>", "x" * 50 + "  b\nshort" + " " * 47 + "c"),
    ("<table><tr><td colspan=2>a wide heading<td>k<tr><td>a<td>b<td>c</table>", "a wide heading  k\na  b            c"),
    ("<dialog>no</dialog><dialog open>yes</dialog>", "yes"),
    ("<head><title>t</title></head><body>x<script>if(a<b)'</p>'</script><style>p{}</style>y<!-- c -->z", "xyz"),
    ("<div hidden>no</div><p style='display: none'>no</p><span style='visibility:hidden'>no</span>yes", "yes"),
    ("<pre>  a\n   b</pre>c", "  a\n   b\n\nc"), ("3 < 4 &lt;x>", "3 < 4 <x>"), ("<a href='x y", ""), ("a<!-- open", "a"),
    ("<b>" * 50_000 + "x" + "</i>" * 1000, "x"), ("<div>" * 5_000 + "x", "x"),
])
def test_visible_text(page, text):
    assert op10_html.visible_text(page) == text


@pytest.mark.parametrize("page,text", [
    ("<p style='backface-visibility:hidden'>seen", "seen"), ("<p style='x:\"display:none\"; color:red'>seen", "seen"),
    ("<p style='display:none; display:block'>seen", "seen"), ("<p style='DISPLAY : none !important; display:block'>no</p>x", "x"),
    ("a<math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math>b", "ax=2b"),
    ("<svg><title>no</title><defs><text>no</text></defs><path d='M0'/><text>A</text><text>B</text></svg>c", "A\nB\nc"),
    ("<textarea>\n a &amp;\n b</textarea>", " a &\n b"), ("<object data=x><param name=y>fallback</object>", "fallback"),
    ("x <select><option>one<option selected>two<option>three</select> y", "x two y"),
    ("<select><option disabled>pick<option>one</select>", "one"), ("<select multiple><option>a<option>b</select>c", "a\nb\nc"),
    ("<div style='visibility:hidden'>no<b style='visibility:visible'>seen<i style='visibility:collapse'>no</i></b>no</div>x", "seen\nx"),
    ("<ul><li style='visibility:hidden'>no<br><li>b</ul>", "- b"),
    ("<head><title>t</title>text <b>bold</b>", "text bold"), ("<head><meta x><a href=y>link</a><p>p", "link\n\np"),
    ("<head> <style>no</style> <script>no</script></head>x", "x"),
])
def test_text_that_browsers_show(page, text):
    assert op10_html.visible_text(page) == text


def test_html_query_and_edges(spark):
    pages = duckdb.sql(f"select page_id, url, html from '{SF}/pages.parquet'").fetchall()
    got = sorted(map(tuple, op10_html.query(spark, SF).collect()))
    assert got == sorted((i, u, op10_html.visible_text(h)) for i, u, h in pages)
    df = spark.createDataFrame([(1, None, "x"), (None, "<p>a", "y"), (None, "<p>a", "y")], "page_id long, html string, _text string")
    out = op10_html.extract(df)
    assert out.columns == ["page_id", "html", "_text"]
    assert sorted(str(r["_text"]) for r in out.collect()) == ["None", "a", "a"]
    assert op10_html.extract(df.limit(0)).collect() == []


# -- pipeline

def test_pipeline_stages(spark):
    from test_dedup import brute_substring, fingerprint, near, smallest_reachable

    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "simhash_near_dedup", "substring_dedup", "best_fit_packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cols, now, kept = docs.columns, docs, [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.stored(stage(spark, now, SF), "t")
        assert now.columns == cols and [f.dataType for f in now.schema] == [f.dataType for f in docs.schema]
        kept.append(now)
    texts = [{r["doc_id"]: r["text"] for r in d.select("doc_id", "text").collect()} for d in kept]
    assert set(texts[1]) < set(texts[0]) and len(texts[1]) >= 0.9 * len(texts[0])
    last = {}
    for i in sorted(texts[1]):
        last[texts[1][i] or ""] = i
    assert set(texts[2]) == set(last.values())
    ids = sorted(texts[2])
    comp = smallest_reachable(ids, near(ids, [fingerprint(texts[2][i]) for i in ids]))
    assert set(texts[3]) == {i for i in ids if comp[i] == i}
    want = {i: (t if not gone else kept_text) for (i, (_, gone, kept_text)), t in
            zip(brute_substring(texts[3]).items(), texts[3].values())}
    assert texts[4] == want
    packed = corpus_pipeline.STAGES[-1][1](spark, kept[-1], SF)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == set(texts[4])
    assert corpus_pipeline.run(spark, SF).count() == packed.count()
