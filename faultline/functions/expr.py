"""Scalar column expressions.

Each function returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen. Rounding is half-to-even (``bround``),
which is what the original figures use; ``round`` (half-up) differs on ties
such as 33/8.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` as double; null when ``den`` is 0 or null."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def pct(num: str | Column, den: str | Column, digits: int = 2) -> Column:
    """Percentage ``num / den * 100`` rounded half-to-even (P15, rule 4)."""
    return F.bround(ratio(num, den) * F.lit(100.0), digits)


#: The characters that Unicode (and a text editor's "trim") counts as white space.
WHITE_SPACE = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(c: str | Column) -> Column:
    """Text without white space of any kind at either end."""
    return F.btrim(_c(c).cast("string"), F.lit(WHITE_SPACE))


#: Numbers as amounts may spell them: digits in groups joined by single
#: underscores, with or without a point, an exponent, or infinity by name.
NUMBER = (r"^[+-]?(([0-9](_?[0-9])*(\.([0-9](_?[0-9])*)?)?|\.[0-9](_?[0-9])*)([eE][+-]?[0-9](_?[0-9])*)?"
          r"|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$")


def parse_amount(c: str | Column) -> Column:
    """Lenient number parse (P7): thousands separators, quotes and white space
    at the ends go; what is then no number of ``NUMBER`` is null, also where a
    cast would read it (``1000d``, ``12f``)."""
    text = strip(F.regexp_replace(_c(c).cast("string"), '[,"]', ""))
    return F.when(text.rlike(NUMBER), F.translate(text, "_", "").try_cast("double"))


def whole_number(df: DataFrame, col: str) -> Column:
    """A column as whole numbers: an integer column as it is (predicates on it
    reach the scan unchanged); text such as ``91`` or ``91.0`` by one cast;
    null if it has a fraction or is no number."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.IntegralType):
        return F.col(col)
    return F.regexp_replace(strip(col), r"\.0*$", "").try_cast("int")


def order_key(df: DataFrame, col: str) -> Column:
    """What a column sorts by. Text of an extract holds numbers or other
    codes: numbers come first, by value (``999`` before ``1000``, digits of
    any length), then the rest as text. Other types sort as they are."""
    c = F.col(col)
    if not isinstance(df.schema[col].dataType, T.StringType):
        return c
    text = strip(col)
    number = text.try_cast("decimal(38,6)")
    digits = F.when(number.isNull() & text.rlike("^[0-9]+$"), F.ltrim(text, F.lit("0")))
    kind = F.when(c.isNull(), None).when(number.isNotNull(), 0).when(digits.isNotNull(), 1).otherwise(2)
    return F.struct(kind.alias("kind"), number.alias("number"), F.length(digits).alias("size"), digits.alias("digits"),
                    c.alias("text"))


def parse_timestamp(c: str | Column, formats: Sequence[str]) -> Column:
    """First format that parses wins; unparseable text gives null.

    ``try_to_timestamp`` never raises under ANSI mode.
    """
    col = strip(c)
    return F.coalesce(*[F.try_to_timestamp(col, F.lit(f)) for f in formats])


def month_label(ts: str | Column) -> Column:
    """Month bucket as ``yyyy-MM`` text (P9, P10); null timestamp -> null."""
    return F.date_format(_c(ts), "yyyy-MM")


def clip_upper(c: str | Column, hi: int) -> Column:
    """``min(c, hi)`` keeping nulls null (P16; ``least`` alone skips nulls)."""
    c = _c(c)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.least(c, F.lit(hi)))


def chain_key(ids: Sequence[str | Column], sep: str = " -> ") -> Column:
    """Join ids into one label, e.g. ``"5 -> 7"``."""
    return F.concat_ws(sep, *[_c(i).cast("string") for i in ids])


def ngram_array(arr: str | Column, n: int) -> Column:
    """Adjacent n-grams of an array; null when the array is shorter than n (A4)."""
    a = _c(arr)
    return F.when(
        F.size(a) >= n,
        F.transform(F.sequence(F.lit(1), F.size(a) - n + 1), lambda i: F.slice(a, i, n)),
    )


def truncate_label(c: str | Column, n: int, ellipsis: str = "…") -> Column:
    """Text longer than ``n`` chars -> first ``n`` chars + ellipsis."""
    c = _c(c)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit(ellipsis))).otherwise(c)


def band(c: str | Column, thresholds: Sequence[float], labels: Sequence[str]) -> Column:
    """Threshold banding: first ``c >= t`` wins, else the last label (P20)."""
    c = _c(c)
    expr = None
    for t, lab in zip(thresholds, labels):
        expr = (F.when(c >= t, lab) if expr is None else expr.when(c >= t, lab))
    return expr.otherwise(labels[len(thresholds)])
