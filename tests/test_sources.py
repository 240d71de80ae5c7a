"""Sinks, the JSON result source and the incremental intake stream."""

import os

from pyspark.sql import functions as F

from faultline.config import LogSchema, Params
from faultline.sources import sinks
from faultline.streaming.incremental import stream_clean_log


def test_results_round_trip(spark, tmpdir_path):
    a = spark.createDataFrame([(1, "x", 2.5), (2, "y", None)], "id int, label string, v double")
    b = spark.createDataFrame([("k", 3)], "k string, n long")
    root = os.path.join(tmpdir_path, "res")
    sinks.write_results({"a": a, "b": b}, root)
    back = sinks.read_results(spark, root, "a").orderBy("id").collect()
    assert [(r["id"], r["label"], r["v"]) for r in back] == [(1, "x", 2.5), (2, "y", None)]
    sinks.write_csv(b, os.path.join(tmpdir_path, "csv"))
    c = spark.read.option("header", True).csv(os.path.join(tmpdir_path, "csv")).collect()
    assert [(r["k"], r["n"]) for r in c] == [("k", "3")]
    parts = [("a", a, [F.col("id").desc()], ["label", "id"]), ("b", b, [], ["k", "n"]), ("none", b.limit(0), [], ["k"])]
    doc = sinks.result_document(parts).where("piece >= 0").orderBy("name").collect()
    assert [r["records"] for r in doc] == ['[{"label":"y","id":2},{"label":"x","id":1}]', '[{"k":"k","n":3}]']
    path = os.path.join(root, "document")
    sinks.result_document(parts).write.json(path)
    back = spark.read.json(path)
    assert sorted(r["name"] for r in back.select("name").distinct().collect()) == ["a", "b", "none"]
    assert [tuple(r) for r in sinks.document_records(back, "a", "label string, id int").collect()] == [("y", 2), ("x", 1)]
    assert sinks.document_records(back, "none", "k string").collect() == []


def test_a_long_result_is_written_in_pieces(spark, tmpdir_path):
    """Ties, 10^6 records over many sort partitions: pieces are small, and the reader has the order."""
    n = 1_000_000
    df = spark.range(0, n, 1, 7).select(F.pmod(F.col("id") * 7919, F.lit(n)).alias("at"))
    path = os.path.join(tmpdir_path, "document")
    sinks.result_document([("long", df, [F.col("at").desc()], ["at"])]).write.json(path)
    back = spark.read.json(path)
    sizes = back.select(F.json_array_length("records").alias("n")).agg(F.max("n"), F.sum("n"), F.count("n")).first()
    assert sizes[0] <= sinks.PIECE and sizes[1] == n and sizes[2] > n / sinks.PIECE
    got = [r["at"] for r in sinks.document_records(back, "long", "at long").collect()]
    assert got == list(range(n - 1, -1, -1))


def test_read_document_field(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "doc.json")
    with open(p, "w") as f:
        f.write('{"kpi": {"total": 3}, "exc_freq": [{"Exception ID": 1, "Count": 5}, '
                '{"Exception ID": 2, "Count": 4}]}')
    rows = sinks.read_document(spark, p, "exc_freq").orderBy("Exception ID").collect()
    assert [(r["Exception ID"], r["Count"]) for r in rows] == [(1, 5), (2, 4)]


def test_intake_stream_cleans_new_files(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    header = ["Supplier", "PO Type", "Gross Invoice Amount", "Created at", "Document Date",
              "Document Status", "Document Id", "Exception ID", "Created at"]
    with open(os.path.join(src, "part1.csv"), "w") as f:
        f.write(",".join(header) + "\n")
        f.write('100,nb,"1,000.00",2025-03-04 10:00:00,2025-03-01,15,D1,5,x\n')
        f.write('52001,nb,5,2025-03-04 10:00:00,2025-03-01,15,D2,5,x\n')
    q = stream_clean_log(spark, src, os.path.join(tmpdir_path, "out"), os.path.join(tmpdir_path, "ckpt"),
                         LogSchema(), Params())
    q.awaitTermination(120)
    out = spark.read.parquet(os.path.join(tmpdir_path, "out")).collect()
    assert len(out) == 1 and out[0]["Amount"] == 1000.0 and out[0]["Month"] == "2025-03"
    assert out[0]["PO Type"] == "NB"

    # A new extract lands; a restarted stream with the same checkpoint picks
    # up only that file (no duplicates of the first one).
    with open(os.path.join(src, "part2.csv"), "w") as f:
        f.write(",".join(header[6:7] + header[:6] + header[7:]) + "\n")  # its columns are in another order
        f.write('D3,101,zcp,"2,500.00",2025-04-01 09:00:00,2025-04-01,15,7,x\n')
    q = stream_clean_log(spark, src, os.path.join(tmpdir_path, "out"), os.path.join(tmpdir_path, "ckpt"),
                         LogSchema(), Params())
    q.awaitTermination(120)
    out = spark.read.parquet(os.path.join(tmpdir_path, "out"))
    assert sorted((r["Document Id"], r["Month"]) for r in out.collect()) == [("D1", "2025-03"), ("D3", "2025-04")]
    # Month directories prune: only the April file is read for an April filter.
    plan = out.where(out["Month"] == "2025-04")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2025-04" in plan


def test_clean_log_table_prunes_months(spark, tmpdir_path):
    from faultline.plans.context import LogContext

    ctx = LogContext(spark, "/root/testdata/sf0.001")
    s = ctx.s
    f = ctx.f(())
    path = os.path.join(tmpdir_path, "clean_log")
    sinks.write_clean_log(f, path, s.month, s.doc)
    back = spark.read.parquet(path)
    assert back.count() == f.count()
    one = back.where(back[s.month] == "1997-05")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Month" in plan and "1997-05" in plan
    assert one.count() == f.where(f[s.month] == "1997-05").count()


def test_report_from_csv_extracts(spark, tmpdir_path):
    """The full result set from two raw CSV extracts (written from the
    sf0.001 log view), checked against the registered queries."""
    import __spark_entry__ as E
    from faultline.config import tpch_params, tpch_schema
    from faultline.plans import report
    from faultline.plans.context import LogContext

    sf = "/root/testdata/sf0.001"
    ctx = LogContext(spark, sf)
    s, p = tpch_schema(), tpch_params()
    log = ctx.log()
    full_dir, mat_dir = os.path.join(tmpdir_path, "full"), os.path.join(tmpdir_path, "mat")
    log.write.option("header", True).csv(full_dir)
    log.where(F.col(s.exc_id).isNull() | ~F.col(s.exc_id).isin(0, 91)).write.option("header", True).csv(mat_dir)
    out = os.path.join(tmpdir_path, "results")
    res = report.run(spark, full_dir, mat_dir, out, "BUILDING", ("PROMO", "STANDARD"), s=s, p=p)
    assert len(res) > 30

    def rows(df, cols):
        return sorted(tuple(r[c] for c in cols) for r in df.collect())

    q = E.queries()
    cols = ["Exception ID", "Exception description", "Count", "Pct"]
    assert rows(res["01_exception_frequency"], cols) == rows(q["g01_exception_frequency"](spark, sf), cols)
    cols = ["Channel ID", "Total", "First_Pass_Count", "First_Pass_Rate"]
    assert rows(res["04_channel_firstpass"], cols) == rows(q["g07_first_pass_by_channel"](spark, sf), cols)
    cols = ["Month", "Total_Invoices", "Exc_Invoices", "First_Pass_Rate"]
    assert rows(res["06_monthly_trends"], cols) == rows(q["g17_monthly_trend"](spark, sf), cols)
    kpi = res["kpi"].first().asDict()
    assert kpi == q["g10_kpi_row"](spark, sf).first().asDict()
    doc = {r["name"]: r["records"] for r in spark.read.json(os.path.join(out, "document")).orderBy("piece").collect()}
    import json

    assert len(doc) == 13
    field = {k: json.loads(v) for k, v in doc.items()}
    months = [r["Month_str"] for r in field["monthly"]]
    assert months == sorted(months) and list(field["monthly"][0]) == [
        "Month_str", "Total_Invoices", "Exc_Invoices", "First_Pass_Rate"]
    assert [r["N_Exceptions"] for r in field["exc_dist"]] == sorted(r["N_Exceptions"] for r in field["exc_dist"])
    counts = [r["Count"] for r in field["exc_freq"]]
    assert counts == sorted(counts, reverse=True)
    assert list(field["workload_conc"][0]) == [
        "Name 1", "Supplier", "Exception_Events", "Unique_Invoices", "Cumulative_Pct"]
    first = field["vendor_top30"][0]["Name 1"]
    ext = {r["name"]: json.loads(r["records"]) for r in
           spark.read.json(os.path.join(out, "document_extended")).orderBy("piece").collect()}
    assert len(ext) == 25 and [r["Exception ID"] for r in ext["exception_totals"]] == [29, 91, 151]
    again = report.document(res, s, report.CORE_FIELDS, [f" {first.lower()}\t"]).where("name = 'vendor_top30' AND piece >= 0").first()
    assert [r["Name 1"] for r in json.loads(again["records"])] == [r["Name 1"] for r in field["vendor_top30"]][1:]
    assert len(json.loads(doc["workload_conc"])) == min(50, q["g07w_workload_concentration"](spark, sf).count())
    back = spark.read.option("header", True).csv(os.path.join(out, "csv", "07_workload_concentration"))
    assert back.count() == q["g07w_workload_concentration"](spark, sf).count()
