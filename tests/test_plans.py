"""Plan shape: no Python evaluation, pruned scans, top-k without a global
sort, no cartesian products, per-document work on the log's partitioning,
running sums independent of exchange reuse."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
QUERIES = {n: q for n, q in E.queries().items() if not n.startswith("op") and n != "pipeline"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cartesian(spark, name):
    p = _plan(QUERIES[name](spark, SF))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, bad


def test_lineitem_scan_is_pruned(spark):
    df = QUERIES["g07_first_pass_by_channel"](spark, SF)
    text = df._jdf.queryExecution().executedPlan().toString()
    li = [ln for ln in text.splitlines() if "lineitem" in ln and "ReadSchema" in ln]
    assert li and all("l_tax" not in ln and "l_returnflag" not in ln for ln in li)


def test_topk_is_take_ordered(spark):
    p = _plan(QUERIES["g03_top_vendors"](spark, SF))
    assert "TakeOrderedAndProject" in p


def test_running_sum_does_not_depend_on_exchange_reuse(spark):
    """Ranks and running sums are the same whether or not the session reuses
    exchanges."""
    import duckdb

    con = duckdb.connect()
    for tname in ("customer", "supplier", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {tname} AS SELECT * FROM read_parquet('{SF}/{tname}.parquet')")
    sql = E.oracle_sql()
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        try:
            for name in ("w01_running_sum", "w03_row_number", "g07w_workload_concentration"):
                df = QUERIES[name](spark, SF)
                cols = sorted(df.columns)
                mine = sorted(tuple(r[c] for c in cols) for r in df.collect())
                cur = con.execute(sql[name])
                names = [d[0] for d in cur.description]
                theirs = sorted(tuple(dict(zip(names, r))[c] for c in cols) for r in cur.fetchall())
                assert mine == theirs, (name, reuse)
        finally:
            spark.conf.set("spark.sql.exchange.reuse", "true")


def _no_broadcast(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                          "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k in old:
        spark.conf.set(k, "-1")
    return old


def test_per_document_aggregate_reuses_join_partitioning(spark):
    """As at scale (no table small enough to broadcast): the log is shuffled
    once by document (line items and orders), and the per-document
    aggregate runs on that partitioning without another exchange."""
    old = _no_broadcast(spark)
    try:
        p = _plan(QUERIES["g11_exception_count_histogram"](spark, SF))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    hashed = [ln for ln in p.splitlines() if "Exchange hashpartitioning" in ln]
    # line items by order key, orders by order key, histogram by N_Exceptions.
    assert len(hashed) == 3, hashed
    assert sum("l_orderkey" in ln or "o_orderkey" in ln for ln in hashed) == 2


def test_universe_needs_no_exchange_after_the_log_join(spark):
    old = _no_broadcast(spark)
    try:
        p = _plan(QUERIES["g07_first_pass_by_channel"](spark, SF))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    hashed = [ln.strip() for ln in p.splitlines() if "Exchange hashpartitioning" in ln]
    assert not any("Document Id" in ln for ln in hashed), hashed


ONE_PASS = ["g17_monthly_trend", "g22_dive151_cooccurring", "g25_vendor_exception_detail", "g26_failed_segment_profile",
            "g27_passed_segment_profile", "g28_channel_monthly_by_category", "g30_exception_totals",
            "g38_top_ids_over_vendor_set", "j02_left_join_fill", "j03_semi_join",
            "p17_null_fill", "a02_list_length", "g10_kpi_row", "g20_dive91_monthly_by_category",
            "g20_dive151_monthly_by_category", "g20_dive29_monthly_by_category", "g31_key_exception_table"]


def test_one_pass_over_the_line_items(spark):
    """As at scale, without broadcasts: each of these reads line items once."""
    old = _no_broadcast(spark)
    try:
        scans = {n: sum("FileScan" in ln and "l_orderkey" in ln
                        for ln in _plan(QUERIES[n](spark, SF)).splitlines()) for n in ONE_PASS}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert scans == {n: 1 for n in ONE_PASS}


def test_dense_grid_computes_its_cells_once(spark):
    """Axes, last month and cells of the grid are one aggregate of the log, read again from its exchange."""
    old = _no_broadcast(spark)
    try:
        df = QUERIES["g37_dense_month_category_grid"](spark, SF)
        df.collect()
        p = _plan(df)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    final = p.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and "collect_list" not in p


def test_order_keys_of_sixty_times_the_data_are_not_broadcast_on_a_guess(spark):
    """Files 60 times as large: nine million order keys are guessed at some
    30 MB, compressed, and are 144 MB of rows, too much for a small driver."""
    key = "spark.sql.sources.fileCompressionFactor"
    old = spark.conf.get(key)
    spark.conf.set(key, "60")
    try:
        p = _plan(QUERIES["p02_prefix_exclusion"](spark, "/root/testdata/sf0.1"))
    finally:
        spark.conf.set(key, old)
    assert "SortMergeJoin" in p and "BroadcastExchange" not in p, p
