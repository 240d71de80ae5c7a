"""Presentation-shaping projections of result tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.functions import WHITE_SPACE, band, strip, truncate_label

# Fixed values of the original charts: label widths, first-pass bands
# (>= 80 / >= 50 / below) and intensity bands (>= 3 / >= 2 / below).
NAME_WIDTH = 35
DESC_WIDTH = 45
FP_BANDS = ((80.0, 50.0), ("high", "medium", "low"))
INTENSITY_BANDS = ((3.0, 2.0), ("high", "medium", "low"))


def exception_label(df: DataFrame, id_col: str, desc_col: str, width: int = DESC_WIDTH,
                    out: str = "Label") -> DataFrame:
    """P19: "ID n: description" label, truncated with an ellipsis."""
    lab = F.format_string("ID %s: %s", F.col(id_col).cast("string"), F.coalesce(F.col(desc_col), F.lit("")))
    return df.withColumn(out, truncate_label(lab, width))


def short_name(df: DataFrame, name_col: str, width: int = NAME_WIDTH, out: str = "Short_Name") -> DataFrame:
    """Vendor name truncated to ``width`` characters + ellipsis."""
    return df.withColumn(out, truncate_label(F.col(name_col), width))


def with_band(df: DataFrame, col: str, bands=FP_BANDS, out: str = "Band") -> DataFrame:
    """P20: threshold band of a rate or intensity (null stays null)."""
    thresholds, labels = bands
    return df.withColumn(out, F.when(F.col(col).isNull(), F.lit(None)).otherwise(band(col, thresholds, labels)))


def drop_named(df: DataFrame, name_col: str, names: Iterable[str]) -> DataFrame:
    """Drop rows whose name (trimmed, upper-case) is in ``names``.
    Applied to an already limited list, so the list comes out shorter."""
    norm = [n.strip(WHITE_SPACE).upper() for n in names]
    return df.where(~F.coalesce(F.upper(strip(name_col)).isin(*norm), F.lit(False)))


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Projection with renamed headers."""
    return df.select(*[F.col(k).alias(v) for k, v in mapping.items()])
