"""Spark operators against plain-Python brute force on random logs."""

from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from faultline.config import LogSchema, Params
from faultline.operators import clean as C
from faultline.operators import firstpass as FP
from faultline.operators import freq as FQ
from faultline.operators import sequences as SQ

S = LogSchema()
P = Params(partial_month=None)
SCHEMA = ("Supplier string, `Name 1` string, `PO Type` string, `Gross Invoice Amount` string, "
          "`Created at` string, `Document Date` string, `Document Status` string, `Document Id` string, "
          "`Work Item ID` long, `Exception ID` int, `Exception description` string, "
          "`PO category decription` string, `Channel ID` string, `Number of Touches` int")

event = st.fixed_dictionaries({
    "doc": st.integers(0, 9), "exc": st.sampled_from([0, 91, 1, 2, 3]), "sup": st.sampled_from(["10", "11", "52x"]),
    "po": st.sampled_from([" nb", "ZCP ", "XX", None]), "status": st.sampled_from(["15", " 15", "9"]),
    "month": st.integers(1, 3), "cat": st.sampled_from(["A", "B", None]), "ch": st.sampled_from(["X", "Y"]),
    "desc_null": st.booleans(),
})


def _rows(events):
    out = []
    for i, e in enumerate(events):
        desc = None if (e["desc_null"] and e["exc"] == 3) else f"E{e['exc']}"
        out.append(dict(sup=e["sup"], name=f"N{e['sup']}", po=e["po"], status=e["status"], doc=f"D{e['doc']}",
                        wi=i, exc=e["exc"], desc=desc, cat=e["cat"], ch=e["ch"], month=f"2025-0{e['month']}"))
    return out


def _df(spark, rows):
    return spark.createDataFrame(
        [(r["sup"], r["name"], r["po"], "1", r["month"] + "-10 00:00:00", "2025-01-01", r["status"], r["doc"],
          r["wi"], r["exc"], r["desc"], r["cat"], r["ch"], 1) for r in rows], SCHEMA)


def _clean_rows(rows):
    """Posted rows with valid PO types and no transport vendor (full log)."""
    out = []
    for r in rows:
        po = (r["po"] or "").strip().upper() if r["po"] is not None else None
        if r["sup"].strip().startswith("52") or po not in ("NB", "ZCP") or r["status"].strip() != "15":
            continue
        out.append(r)
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(event, min_size=1, max_size=50))
def test_against_brute_force(spark, events):
    rows = _rows(events)
    full = _clean_rows(rows)
    mat = [r for r in full if r["exc"] not in (0, 91)]
    f = C.full_posted(_df(spark, rows), S, P)
    m = C.material(f, S, P)

    # G1: counts per (id, description) over non-null keys; share of that total.
    want = Counter((r["exc"], r["desc"]) for r in mat if r["desc"] is not None)
    got = {(r["Exception ID"], r["Exception description"]): r["Count"]
           for r in FQ.exception_frequency(m, S).collect()}
    assert got == dict(want)

    # Distinct documents and events per vendor.
    docs, evs = defaultdict(set), Counter()
    for r in mat:
        docs[(r["sup"], r["name"])].add(r["doc"])
        evs[(r["sup"], r["name"])] += 1
    got = {(r["Supplier"], r["Name 1"]): (r["Unique_Invoices"], r["Exception_Events"])
           for r in FQ.vendor_stats(m, S).collect()}
    assert got == {k: (len(docs[k]), evs[k]) for k in evs}

    # Universe rows per channel and first-pass rows.
    exc_docs = {r["doc"] for r in mat}
    uni = {(r["doc"], r["ch"], r["cat"]) for r in full if r["cat"] is not None}
    want = defaultdict(lambda: [0, 0])
    for d, ch, _ in uni:
        want[ch][0] += 1
        want[ch][1] += d not in exc_docs
    u = C.universe_single_pass(f, S, P)
    got = {r["Channel ID"]: [r["Total"], r["First_Pass_Count"]] for r in FP.first_pass_by(u, ["Channel ID"], S).collect()}
    assert got == dict(want)

    # Documents per number of events.
    per_doc = Counter(r["doc"] for r in mat)
    got = {r["N_Exceptions"]: r["Invoice_Count"] for r in SQ.exceptions_per_invoice(m, S).collect()}
    assert got == dict(Counter(per_doc.values()))

    # Adjacent pairs of the order-preserving distinct sequences.
    seqs = defaultdict(list)
    for r in sorted(mat, key=lambda r: (r["doc"], r["wi"])):
        if r["exc"] not in seqs[r["doc"]]:
            seqs[r["doc"]].append(r["exc"])
    pairs = Counter(f"{a} -> {b}" for s in seqs.values() for a, b in zip(s, s[1:]))
    got = {r["Pair"]: r["Count"] for r in SQ.ngram_counts(m, S, 2, "Pair").collect()}
    assert got == dict(pairs)

    # Distinct documents per month, all vs with events.
    tot, exc = defaultdict(set), defaultdict(set)
    for r in full:
        tot[r["month"]].add(r["doc"])
    for r in mat:
        exc[r["month"]].add(r["doc"])
    got = {r["Month"]: (r["Total_Invoices"], r["Exc_Invoices"]) for r in FP.monthly_trend(f, m, S).collect()}
    assert got == {k: (len(v), len(exc.get(k, ()))) for k, v in tot.items()}
