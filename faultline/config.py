"""Column roles of an exception log and the analysis parameters.

Every operator takes a ``LogSchema`` (which column plays which role) and a
``Params`` (codes, thresholds, ids), so nothing is tied to one company's
extract. The defaults are the column names and codes of the original
accounts-payable log; ``tpch_params()`` gives the codes used by the log view
derived from the driver's TPC-H-style tables (see ``sources/tpch_log.py``).
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class LogSchema:
    doc: str = "Document Id"
    supplier: str = "Supplier"
    vendor_name: str = "Name 1"
    po_type: str = "PO Type"
    amount_raw: str = "Gross Invoice Amount"
    created_at: str = "Created at"
    doc_date: str = "Document Date"
    status: str = "Document Status"
    exc_id: str = "Exception ID"
    exc_desc: str = "Exception description"
    category: str = "PO category decription"  # spelling is the source's own
    channel: str = "Channel ID"
    touches: str = "Number of Touches"
    # Event order inside one document (the source sorts by "Work Item ID").
    # Must be a total order within a document for deterministic sequences.
    order_cols: tuple[str, ...] = ("Work Item ID",)

    # Derived columns added by ``clean``.
    amount: str = "Amount"
    created_ts: str = "Created at_dt"
    doc_date_ts: str = "Document Date_dt"
    month: str = "Month"

    @property
    def vendor(self) -> list[str]:
        return [self.supplier, self.vendor_name]

    @property
    def exc(self) -> list[str]:
        return [self.exc_id, self.exc_desc]


# Fixed values of the original analysis (codes and thresholds it states).
REFERENCE_TRANSPORT_PREFIX = "52"
REFERENCE_VALID_PO_TYPES = ("NB", "ZCP")
REFERENCE_POSTED_STATUS = "15"
REFERENCE_IMMATERIAL_IDS = (0, 91)
REFERENCE_PARTIAL_MONTH = "2026-01"
REFERENCE_FP_TARGET = 80.0
REFERENCE_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# Spellings of dates that extracts use; sections in brackets may be missing.
REFERENCE_TIMESTAMP_FORMATS = (
    "yyyy-MM-dd[ HH:mm[:ss[.SSSSSSSSS]]][XXX]", "yyyy-MM-dd'T'HH:mm[:ss[.SSSSSSSSS]][XXX]",
    "yyyy/MM/dd[ HH:mm[:ss[.SSSSSSSSS]]]", "d-MMM-yyyy[ HH:mm[:ss]]",
    "M/d/yyyy[ H:mm[:ss]]", "M/d/yyyy h:mm[:ss] a", "d.M.yyyy[ H:mm[:ss]]",
)


@dataclass(frozen=True)
class Params:
    transport_prefix: str = REFERENCE_TRANSPORT_PREFIX
    valid_po_types: tuple[str, ...] = REFERENCE_VALID_PO_TYPES
    posted_status: str = REFERENCE_POSTED_STATUS
    immaterial_ids: tuple[int, ...] = REFERENCE_IMMATERIAL_IDS
    # "latest" = the last month of the full posted log (computed in-plan);
    # a "yyyy-MM" string; or None to keep every month.
    partial_month: str | None = REFERENCE_PARTIAL_MONTH
    fp_target: float = REFERENCE_FP_TARGET
    min_invoices: int = 10
    timestamp_formats: tuple[str, ...] = REFERENCE_TIMESTAMP_FORMATS
    null_tokens: tuple[str, ...] = REFERENCE_NULL_TOKENS
    # Strict compatibility with text conversion of a null supplier ("nan").
    null_supplier_as_text: bool = True

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


def tpch_schema() -> LogSchema:
    return LogSchema(order_cols=("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"))


def tpch_params() -> Params:
    return Params(
        transport_prefix="5",
        valid_po_types=("1-URGENT", "2-HIGH"),
        posted_status="F",
        partial_month="latest",
    )
