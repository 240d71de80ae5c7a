"""Hand-written edge fixtures (invented names) checked against brute force."""

import datetime
import os
import random
from collections import Counter

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from faultline.config import LogSchema, Params
from faultline.functions import clip_upper, parse_amount, pct, whole_number
from faultline.operators import clean as C
from faultline.operators import deepdive as DD
from faultline.operators import firstpass as FP
from faultline.operators import freq as FQ
from faultline.operators import pareto as PA
from faultline.operators import sequences as SQ
from faultline.operators import shape as SH
from faultline.sources.csv_log import dedupe_names, read_log_csv

S = LogSchema()
P = Params(partial_month="2026-01")
COLS = ["Supplier", "Name 1", "PO Type", "Gross Invoice Amount", "Created at", "Document Date",
        "Document Status", "Document Id", "Work Item ID", "Exception ID", "Exception description",
        "PO category decription", "Channel ID", "Number of Touches"]


def ev(doc, exc, wi, sup="100", name="Acme", po="NB", status="15", created="2025-03-04 10:00:00",
       desc=None, cat="Standard", ch="MAIL", touches=1, amount="1,000.00"):
    return (sup, name, po, amount, created, created[:10], status, doc, wi, exc,
            desc if desc is not None else f"E{exc}", cat, ch, touches)


def log_df(spark, rows):
    schema = ("Supplier string, `Name 1` string, `PO Type` string, `Gross Invoice Amount` string, "
              "`Created at` string, `Document Date` string, `Document Status` string, `Document Id` string, "
              "`Work Item ID` long, `Exception ID` int, `Exception description` string, "
              "`PO category decription` string, `Channel ID` string, `Number of Touches` int")
    return spark.createDataFrame(rows, schema)


def log_df_text_ids(spark, rows):
    rows = [(*r[:9], None if r[9] is None else str(r[9]), *r[10:]) for r in rows]
    df = log_df(spark, [(*r[:9], None, *r[10:]) for r in rows])
    ids = spark.createDataFrame([(r[7], r[9]) for r in rows], "`Document Id` string, `Exception ID` string")
    return df.drop("Exception ID").join(ids, on="Document Id")


def test_raw_csv_edges(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "raw_edges.csv")
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write('Supplier,Created at,Gross Invoice Amount,Created at,Time Stamp,Time Stamp\n')
        f.write('100,2025-03-04 10:00:00,"1,234.50",x,a,b\n')
        f.write('101,x,bad,2025-03-05,c,d\n')
        f.write('#N/A,NA,,null,e,f\n')
    df = read_log_csv(spark, path)
    assert df.columns == ["Supplier", "Created at", "Gross Invoice Amount", "Created at_1",
                          "Time Stamp", "Time Stamp_1"]
    rows = df.collect()
    assert rows[0]["Supplier"] == "100"  # BOM stripped from the first name
    assert rows[2]["Supplier"] is None and rows[2]["Created at"] is None
    t = df.select(
        C.parse_amount("Gross Invoice Amount").alias("a"),
        C.parse_timestamp("Created at", P.timestamp_formats).alias("t")).collect()
    assert [r["a"] for r in t] == [1234.5, None, None]
    assert t[0]["t"] is not None and t[1]["t"] is None
    assert dedupe_names(["a", "b", "a", "a"]) == ["a", "b", "a_1", "a_2"]
    multi = read_log_csv(spark, path, multi_line=True).collect()
    assert [tuple(r) for r in multi] == [tuple(r) for r in rows]


def test_null_keys_dropped_and_share_of_grouped_total(spark):
    rows = [ev("D1", 5, 1), ev("D1", 6, 2, desc=""), ev("D2", 5, 1)]
    df = log_df(spark, rows).withColumn("Exception description",
                                        F.when(F.col("Exception ID") == 6, None).otherwise(F.col("Exception description")))
    m = C.material_posted(df, S, P)
    freq = FQ.exception_frequency(m, S).collect()
    assert [(r["Exception ID"], r["Count"], r["Pct"]) for r in freq] == [(5, 2, 100.0)]


def test_first_pass_rules(spark):
    rows = [
        ev("A", 0, 1), ev("A", 91, 2),             # only immaterial ids: first pass
        ev("B", 5, 1),                              # material: not first pass
        ev("C", 0, 1, cat="Service"), ev("C", 0, 2, cat="Standard"),  # two categories: two rows
        ev("D", 0, 1, po=None),                     # null PO type: dropped
        ev("E", 5, 1, sup=" 52001 "),               # transport vendor: dropped
    ]
    f = C.full_posted(log_df(spark, rows), S, P)
    u = C.universe(f, C.material(f, S, P), S)
    got = sorted((r["Document Id"], r["PO category decription"], r["First_Pass"]) for r in u.collect())
    assert got == [("A", "Standard", True), ("B", "Standard", False),
                   ("C", "Service", True), ("C", "Standard", True)]
    ch = FP.first_pass_by(u, ["Channel ID"], S).first()
    assert (ch["Total"], ch["First_Pass_Count"], ch["First_Pass_Rate"]) == (4, 3, 75.0)


def test_null_supplier_survives_as_text(spark):
    rows = [ev("A", 5, 1, sup=None)]
    f = C.full_posted(log_df(spark, rows), S, P)
    assert [r["Supplier"] for r in f.collect()] == ["nan"]
    strict = C.full_posted(log_df(spark, rows), S, P.with_(null_supplier_as_text=False))
    assert strict.count() == 0


def test_sequences_and_ngrams(spark):
    rows = [ev("D1", 1, 10), ev("D1", 2, 20), ev("D1", 3, 30),          # 1 -> 2 -> 3
            ev("D2", 7, 1), ev("D2", 8, 2), ev("D2", 7, 3),             # repeat: 7, 8
            ev("D3", 4, 5),                                            # single event
            ev("D4", 8, 2), ev("D4", 7, 1)]                             # order by work item: 7, 8
    m = C.material_posted(log_df(spark, rows), S, P)
    hist = {r["N_Exceptions"]: r["Invoice_Count"] for r in SQ.exceptions_per_invoice(m, S).collect()}
    assert hist == {3: 2, 1: 1, 2: 1}
    pairs = [(r["Pair"], r["Count"]) for r in SQ.top_ngrams(m, S, 2, "Pair").collect()]
    # 7 -> 8 twice; ties at 1 in first-seen order (D1 first).
    assert pairs == [("7 -> 8", 2), ("1 -> 2", 1), ("2 -> 3", 1)]
    assert [(r["Triple"], r["Count"]) for r in SQ.top_ngrams(m, S, 3, "Triple").collect()] == [("1 -> 2 -> 3", 1)]
    seqs = {r["Document Id"]: r["Exc_Seq"] for r in SQ.distinct_sequence_arrays(m, S).collect()}
    assert seqs == {"D1": [1, 2, 3], "D2": [7, 8], "D3": [4], "D4": [7, 8]}
    raw = Counter({(r["From_ID"], r["To_ID"]): r["Count"] for r in SQ.adjacent_pairs(m, S).collect()})
    assert raw == Counter({(1, 2): 1, (2, 3): 1, (7, 8): 2, (8, 7): 1})


@pytest.mark.parametrize("bucket_rows", [1, 16, SQ.BUCKET_ROWS])
def test_group_positions_hot_group_brute_force(spark, bucket_rows):
    rnd = random.Random(7)
    # One group holds 90 % of the rows, with cuts at every key, at some and at none.
    data = [("hot", i * 997, rnd.randint(0, 50)) for i in range(3000)] + [("hot", None, 1), ("hot", -70_000, 1)] + \
           [(f"k{j}", i * 50_000, rnd.randint(0, 50)) for j in range(40) for i in range(rnd.randint(1, 12))]
    df = spark.createDataFrame(data, "g string, o long, v long")
    by = {}
    for r in SQ.group_positions(df.repartition(5), ["g"], ["o"], bucket_rows=bucket_rows).collect():
        by.setdefault(r["g"], []).append((r["o"] is not None, r["o"] or 0, r["Position"]))
    assert sum(map(len, by.values())) == len(data)
    for g, lst in by.items():
        assert [x[2] for x in sorted(lst)] == list(range(1, len(lst) + 1)), g


@pytest.mark.parametrize("kind,make", [
    ("long", lambda i: i * 30_000 - 10 ** 6), ("string", lambda i: f"{i // 7:03d}x{i:05d}"),
    ("timestamp", lambda i: datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=3 * i, seconds=i))])
def test_adjacent_pairs_over_bucket_borders(spark, kind, make):
    rnd = random.Random(5)
    rows = [(d, make(i), rnd.randint(1, 4)) for d in ("A", "B") for i in rnd.sample(range(200), 60)]
    s = LogSchema(order_cols=("o",))
    df = spark.createDataFrame(rows, f"`Document Id` string, o {kind}, `Exception ID` int")
    want = Counter()
    for d in ("A", "B"):
        ids = [x[2] for x in sorted(r for r in rows if r[0] == d)]
        want.update(zip(ids, ids[1:]))
    got = {(r["From_ID"], r["To_ID"]): r["Count"] for r in SQ.adjacent_pairs(df.repartition(3), s, bucket_rows=8).collect()}
    assert got == dict(want)


@pytest.mark.parametrize("make", [
    lambda i: datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=i),  # one document in one month
    lambda i: datetime.datetime(1970, 1, 1) + datetime.timedelta(microseconds=i)])
def test_a_large_group_is_many_buckets_whatever_the_spread_of_its_keys(spark, make):
    rows = [("hot", make(i)) for i in range(4000)]
    for kind, data in (("timestamp", rows), ("long", [(g, i) for i, (g, _) in enumerate(rows)]),
                       ("string", [(g, f"same prefix {i:05d}") for i, (g, _) in enumerate(rows)])):
        df = spark.createDataFrame(data, f"g string, o {kind}")
        sizes = [r["count"] for r in SQ._buckets(df, ["g"], ["o"], 64).groupBy("_b").count().collect()]
        assert len(sizes) > 30 and max(sizes) < 600, kind
        assert [r["_b"] for r in SQ._buckets(df, ["g"], ["o"], 64).orderBy("o").select("_b").collect()] == sorted(
            r["_b"] for r in SQ._buckets(df, ["g"], ["o"], 64).collect())


def test_text_order_columns_sort_numbers_by_value(spark):
    """Work items of an extract are text: 999 comes before 1000, and codes after numbers."""
    rows = [("D", "1000", 29), ("D", "999", 5), ("D", "x1", 8), ("D", "1" + "0" * 50, 7), ("D", "0" + "9" * 45, 6),
            ("E", "10", 1), ("E", "9", 2)]
    df = spark.createDataFrame(rows, "`Document Id` string, `Work Item ID` string, `Exception ID` int")
    for bucket_rows in (1, SQ.BUCKET_ROWS):
        seq = {(r["Document Id"], r["Position"]): r["Exception ID"]
               for r in SQ.exception_sequence(df, LogSchema(), bucket_rows).collect()}
        assert [seq["D", i] for i in range(1, 6)] == [5, 29, 6, 7, 8] and [seq["E", i] for i in (1, 2)] == [2, 1]
    pairs = [r["Pair"] for r in SQ.top_ngrams(df, LogSchema(), 2, "Pair").collect()]
    assert pairs == ["5 -> 29", "29 -> 6", "6 -> 7", "7 -> 8", "2 -> 1"]
    first = SQ.distinct_sequence_arrays(df, LogSchema()).collect()
    assert {r["Document Id"]: r["Exc_Seq"] for r in first} == {"D": [5, 29, 6, 7, 8], "E": [2, 1]}
    raw = {(r["From_ID"], r["To_ID"]) for r in SQ.adjacent_pairs(df, LogSchema()).collect()}
    assert raw == {(5, 29), (29, 6), (6, 7), (7, 8), (2, 1)}


def test_amount_grammar(spark):
    good = {"1_000": 1000.0, " 1,234.5 ": 1234.5, '"7"': 7.0, "1e3": 1000.0, ".5": 0.5, "5.": 5.0, "-2": -2.0, "inf": float("inf")}
    bad = ["1000d", "12f", "1__0", "_1", "1_", "nan", "", ".", "0x10", "1 2", "e5"]
    df = spark.createDataFrame([(x,) for x in [*good, *bad, None]], "x string")
    got = {r["x"]: r["v"] for r in df.withColumn("v", parse_amount("x")).collect()}
    assert got == {**good, **dict.fromkeys(bad), None: None}


def test_whole_numbers_cost_integer_columns_nothing(spark):
    df = spark.range(3).selectExpr("CAST(id AS INT) AS id")
    assert str(whole_number(df, "id")) == str(F.col("id"))
    text = spark.createDataFrame([("91",), ("91.0",), (" 91 ",), ("91.5",), ("x",), (None,)], "x string")
    assert [r[0] for r in text.select(whole_number(text, "x")).collect()] == [91, 91, 91, None, None, None]


def test_global_running_sum_hot_tie_group_brute_force(spark):
    rnd = random.Random(3)
    vend = [(f"s{i:05d}", "n", 1) for i in range(2500)] + [(f"t{i:04d}", "n", rnd.randint(2, 60)) for i in range(300)]
    df = spark.createDataFrame(vend, "Supplier string, `Name 1` string, Exception_Events long")
    order = sorted(vend, key=lambda x: (-x[2], x[0], x[1]))
    got = {(r["Supplier"]): (r["Rank"], r["Cumulative_Events"])
           for r in PA.global_running_sum(df.repartition(5), "Exception_Events", ["Supplier", "Name 1"]).collect()}
    cum = 0
    for i, (s, _, e) in enumerate(order, 1):
        cum += e
        assert got[s] == (i, cum)
    with pytest.raises(TypeError):
        PA.global_running_sum(df.withColumn("Exception_Events", F.lit(0.5)), "Exception_Events", ["Supplier"])


def test_header_names_are_unique_whatever_the_input():
    assert dedupe_names(["a", "a", "a_1"]) == ["a", "a_2", "a_1"]
    for names in (["a", "a_1", "a", "a", "a_2"], ["x"] * 5, [], ["a", "b"]):
        got = dedupe_names(names)
        assert len(set(got)) == len(names) and all(got[names.index(n)] == n for n in names)


def test_files_with_columns_in_another_order_are_not_swapped(spark, tmpdir_path):
    for name, text in (("1.csv", "A,B\n1,2\n"), ("2.csv", "A,B\n3,4\n")):
        with open(os.path.join(tmpdir_path, name), "w", encoding="utf-8-sig") as f:
            f.write(text)
    assert sorted(map(tuple, read_log_csv(spark, tmpdir_path).collect())) == [("1", "2"), ("3", "4")]
    with open(os.path.join(tmpdir_path, "3.csv"), "w", encoding="utf-8-sig") as f:
        f.write("B,A\n6,5\n")
    got = read_log_csv(spark, tmpdir_path)
    assert got.columns == ["A", "B"]
    assert sorted(map(tuple, got.collect())) == [("1", "2"), ("3", "4"), ("5", "6")]
    # Other columns: those that a file lacks are null. A name with a space in it is a path like any other.
    with open(os.path.join(tmpdir_path, "part 4.csv"), "w", encoding="utf-8-sig") as f:
        f.write("C,A\n8,7\n")
    rows = {tuple(r[c] for c in "ABC") for r in read_log_csv(spark, tmpdir_path).collect()}
    assert rows == {("1", "2", None), ("3", "4", None), ("5", "6", None), ("7", None, "8")}
    # Where the caller vouches for one header, a file that breaks it is not read silently.
    with pytest.raises(Exception, match="another order"):
        read_log_csv(spark, os.path.join(tmpdir_path, "[123].csv"), names=["A", "B"]).collect()
    assert read_log_csv(spark, [os.path.join(tmpdir_path, f"{i}.csv") for i in (1, 3)]).count() == 2


def test_two_extracts_give_the_universe_and_profiles_of_joined_logs(spark):
    """A hot document, documents in one log alone, null channels and categories."""
    rnd = random.Random(11)
    cols = "`Document Id` string, `Channel ID` string, `PO category decription` string, `Exception ID` int, " \
           "`Exception description` string"

    def log(n, docs):
        return [(rnd.choice(["hot"] * 20 + docs), rnd.choice(["c1", "c2", None]), rnd.choice(["k1", "k2", None]), x, f"e{x}")
                for x in (rnd.choice([0, 1, 2, 91]) for _ in range(n))]

    full = log(300, [f"d{i}" for i in range(30)] + [None])
    mat = [r for r in full if r[3] in (1, 2) and rnd.random() < .5 and r[0] != "hot"] + log(5, ["only m"])[:0] + [("x", "c1", "k1", 1, "e1")]
    f, m = spark.createDataFrame(full, cols), spark.createDataFrame(mat, cols)
    both = C.two_extracts(f, m, S)
    u = C.universe_of_two(both, S)
    key = lambda df: sorted(map(tuple, df.select("Document Id", "Channel ID", "PO category decription", "First_Pass").collect()))
    assert key(u) == key(C.universe(f, m, S)) and len(key(u)) > 20
    for passed, rows in ((False, mat), (True, full)):
        failed = {r[0] for r in mat}
        docs = {r[0] for r in full if r[1] == "c1" and r[2] == "k2" and r[0] is not None and (r[0] not in failed) == passed}
        want = Counter((r[3], r[4]) for r in rows if r[0] in docs)
        got = {(r[0], r[1]): r[2] for r in DD.segment_profile(both, S, "c1", "k2", passed).collect()}
        assert got == dict(want), passed


def test_date_spellings(spark):
    seen = ["2025-10-01 10:00:00.123", "2025-10-01T10:00:00Z", "2025-10-01 10:00", "2025/10/01", "01-Oct-2025",
            "10/01/2025 10:00:00 AM", "2025-10-01", "2025-10-01 10:00:00", "10/1/2025 9:05", " 2025-10-01\t",
            "2025-10-01T10:00:00.5+00:00", "1.10.2025"]
    df = spark.createDataFrame([(x,) for x in [*seen, "unknown", "", None, "2025-13-45"]], "t string")
    got = [r[0] for r in df.select(C.month_label(C.parse_timestamp("t", P.timestamp_formats))).collect()]
    assert got == ["2025-10"] * len(seen) + [None] * 4


def test_ids_and_white_space(spark):
    rows = [ev("A", "91.0", 1), ev("B", " 5 ", 1, sup="\t5201"), ev("C", "7", 1, po="nb\t"), ev("D", "7.5", 1),
            ev("E", "x", 1, status="15\u00a0")]
    f = {r["Document Id"]: r["Exception ID"] for r in C.full_posted(log_df_text_ids(spark, rows), S, P).collect()}
    assert f == {"A": 91, "C": 7, "D": None, "E": None}


def test_crosstab_keeps_every_channel(spark):
    rows = [ev(f"D{i}", 91, 1, ch=f"C{i % 6}") for i in range(12)]
    got = {(r["PO category decription"], r["Channel ID"]): r["Count"]
           for r in FQ.crosstab(C.full_posted(log_df(spark, rows), S, P), S.category, S.channel).collect()}
    assert len(got) == 6 and set(got.values()) == {2}


def test_monthly_trend_fills_zero_and_keeps_partial_month(spark):
    rows = [ev("A", 0, 1, created="2025-01-10 00:00:00"), ev("B", 5, 1, created="2025-02-10 00:00:00"),
            ev("C", 0, 1, created="2026-01-02 00:00:00"), ev("U", 5, 1, created="not a date")]
    f = C.full_posted(log_df(spark, rows), S, P)
    t = {r["Month"]: (r["Total_Invoices"], r["Exc_Invoices"], r["First_Pass_Rate"])
         for r in FP.monthly_trend(f, C.material(f, S, P), S).collect()}
    assert t == {"2025-01": (1, 0, 100.0), "2025-02": (1, 1, 0.0), "2026-01": (1, 0, 100.0)}


def test_half_even_rounding(spark):
    r = spark.range(1).select(pct(F.lit(33), F.lit(800), 2).alias("a"), pct(F.lit(9), F.lit(800), 2).alias("b"),
                              F.bround(F.lit(33) / F.lit(8), 2).alias("c")).first()
    assert (r["a"], r["b"], r["c"]) == (4.12, 1.12, 4.12)


def test_touches_clip_keeps_null(spark):
    df = spark.createDataFrame([(9,), (10,), (11,), (None,)], "t int")
    assert [r[0] for r in df.select(clip_upper("t", 10)).collect()] == [9, 10, 10, None]
    rows = [ev("A", 151, 1, touches=11), ev("A", 151, 2, touches=3), ev("B", 151, 1, touches=9),
            ev("C", 151, 1, touches=None)]
    m = C.material_posted(log_df(spark, rows), S, P)
    h = {r["Touches"]: r["Invoice_Count"] for r in DD.touches_histogram(m, S).collect()}
    assert h == {10: 1, 9: 1}


def test_vendor_ties_and_post_limit_exclusion(spark):
    rows = [ev("D1", 5, 1, sup="1", name="Alpha Co"), ev("D2", 5, 1, sup="2", name="beta co "),
            ev("D3", 5, 1, sup="3", name="Gamma"), ev("D4", 5, 1, sup="1", name="Alpha Co")]
    m = C.material_posted(log_df(spark, rows), S, P)
    top = FQ.top_vendors(m, S, 2)
    assert [r["Supplier"] for r in top.collect()] == ["1", "2"]
    kept = SH.drop_named(top, "Name 1", [" BETA CO"])
    assert [r["Supplier"] for r in kept.collect()] == ["1"]  # list comes out short
    v = FQ.vendor_stats(m, S).where(F.col("Supplier") == "1").first()
    assert (v["Unique_Invoices"], v["Exception_Events"], v["Avg_Exc_Per_Inv"]) == (2, 2, 1.0)


def test_supplier_with_two_names_in_vendor_detail(spark):
    rows = [ev("D1", 5, 1, sup="1", name="One")] * 3 + [ev("D2", 6, 1, sup="1", name="One Ltd"),
                                                        ev("D3", 5, 1, sup="2", name="Two")]
    m = C.material_posted(log_df(spark, rows), S, P)
    d = DD.vendor_exception_detail(m, S, k=1).collect()
    assert sorted((r["Name 1"], r["Exception ID"], r["Count"]) for r in d) == [("One", 5, 3), ("One Ltd", 6, 1)]


def test_labels_and_bands(spark):
    df = spark.createDataFrame([Row(i=1, d="x" * 50, r=80.0), Row(i=2, d="short", r=49.9)])
    out = SH.with_band(SH.exception_label(df, "i", "d", width=35), "r").collect()
    assert out[0]["Label"] == ("ID 1: " + "x" * 50)[:35] + "…" and out[1]["Label"] == "ID 2: short"
    assert [r["Band"] for r in out] == ["high", "low"]


def test_fewer_vendors_than_rank_and_min_invoice_boundary(spark):
    # Vendor 1 has exactly 10 invoices (kept by ">= 10"), vendor 2 has 9.
    rows = [ev(f"A{i}", 5, i, sup="1", name="One") for i in range(10)] + \
           [ev(f"B{i}", 5, i, sup="2", name="Two") for i in range(9)]
    m = C.material_posted(log_df(spark, rows), S, P)
    inten = FQ.vendor_intensity(m, S, min_invoices=10, k=20).collect()
    assert [(r["Supplier"], r["Unique_Invoices"]) for r in inten] == [("1", 10)]
    conc = PA.workload_concentration(FQ.vendor_stats(m, S), S.vendor)
    r = PA.top_n_concentration(conc).first()
    # Two vendors only: the top-10 share is everything, the value at rank 10 is undefined.
    assert r["Top10_Pct"] == 100.0 and r["Cum_Pct_At_10"] is None
    assert sorted(x["Cumulative_Pct"] for x in conc.collect()) == [52.63, 100.0]


def test_parse_failure_rate(spark):
    rows = [ev("A", 5, 1, amount="1,234.50"), ev("B", 5, 1, amount="bad"), ev("C", 5, 1, amount=None),
            ev("D", 5, 1, amount='"12"')]
    f = C.full_posted(log_df(spark, rows), S, P)
    r = C.parse_failure_rate(f, S).first()
    # Only "bad" fails; a missing amount is not a parse failure.
    assert (r["Rows"], r["Unparsed"], r["Unparsed_Pct"]) == (4, 1, 25.0)
    assert sorted((x["Amount"] is None) for x in f.select(S.amount).collect()) == [False, False, True, True]
