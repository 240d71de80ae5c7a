"""Property-based invariants on random logs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from faultline.config import LogSchema, Params
from faultline.operators import clean as C
from faultline.operators import firstpass as FP
from faultline.operators import freq as FQ
from faultline.operators import pareto as PA
from faultline.operators import sequences as SQ

S = LogSchema()
P = Params(partial_month=None)
SCHEMA = ("Supplier string, `Name 1` string, `PO Type` string, `Gross Invoice Amount` string, "
          "`Created at` string, `Document Date` string, `Document Status` string, `Document Id` string, "
          "`Work Item ID` long, `Exception ID` int, `Exception description` string, "
          "`PO category decription` string, `Channel ID` string, `Number of Touches` int")

event = st.tuples(
    st.integers(0, 12),                       # document
    st.sampled_from([0, 91, 1, 2, 3, 4]),     # exception id
    st.integers(0, 5),                        # supplier
    st.sampled_from(["NB", "ZCP", "XX"]),     # PO type
    st.sampled_from(["15", "10"]),            # status
    st.integers(1, 4),                        # month
    st.sampled_from(["Service", "Standard"]),  # category
)


def _df(spark, events):
    rows = []
    for i, (doc, exc, sup, po, status, month, cat) in enumerate(events):
        rows.append((f"{100 + sup}", f"V{sup}", po, "10.00", f"2025-0{month}-15 08:00:00", "2025-01-01",
                     status, f"D{doc}", i, exc, f"E{exc}", cat, "MAIL" if doc % 2 else "EDI", 1))
    return spark.createDataFrame(rows, SCHEMA)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(event, min_size=1, max_size=60))
def test_invariants(spark, events):
    log = _df(spark, events)
    f = C.full_posted(log, S, P)
    m = C.material(f, S, P)
    n_events = m.count()

    # Sum of histogram x N = events.
    hist = SQ.exceptions_per_invoice(m, S).collect()
    assert sum(r["N_Exceptions"] * r["Invoice_Count"] for r in hist) == n_events

    # First-pass + exception documents = universe documents.
    u = C.universe_single_pass(f, S, P)
    per_doc = {}
    for r in u.collect():
        per_doc.setdefault(r["Document Id"], set()).add(r["First_Pass"])
    assert all(len(v) == 1 for v in per_doc.values())  # the flag is per document
    exc_docs = {r[0] for r in m.select("Document Id").distinct().collect()}
    fp_docs = {d for d, v in per_doc.items() if v == {True}}
    assert fp_docs.isdisjoint(exc_docs)
    assert fp_docs | (exc_docs & set(per_doc)) == set(per_doc)
    # One-pass universe = explicit existence join of the two logs.
    two = {(r[0], r[1], r[2], r[3]) for r in C.universe(f, m, S).collect()}
    one = {tuple(r) for r in u.select("Document Id", "Channel ID", "PO category decription",
                                      "First_Pass").collect()}
    assert one == two

    # Cumulative share is monotone and ends at 100.
    if n_events:
        v = FQ.vendor_stats(m, S)
        conc = PA.workload_concentration(v, S.vendor).orderBy("Rank").collect()
        pcts = [r["Cumulative_Pct"] for r in conc]
        assert pcts == sorted(pcts) and pcts[-1] == 100.0
        assert [r["Rank"] for r in conc] == list(range(1, len(conc) + 1))

    # n-gram counts = sum over documents of max(0, distinct_len - n + 1).
    lens = [len(r["Exc_Seq"]) for r in SQ.distinct_sequence_arrays(m, S).collect()]
    for n, key in ((2, "Pair"), (3, "Triple")):
        total = SQ.ngram_counts(m, S, n, key).agg(F.sum("Count")).first()[0] or 0
        assert total == sum(max(0, k - n + 1) for k in lens)

    # Monthly trend: exception invoices never exceed all invoices.
    for r in FP.monthly_trend(f, m, S).collect():
        assert 0 <= r["Exc_Invoices"] <= r["Total_Invoices"]
