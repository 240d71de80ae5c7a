"""Column expressions shared by the operators (all JVM built-ins, no UDFs)."""

from faultline.functions.expr import (  # noqa: F401
    NUMBER,
    WHITE_SPACE,
    band,
    chain_key,
    clip_upper,
    month_label,
    ngram_array,
    order_key,
    parse_amount,
    parse_timestamp,
    pct,
    ratio,
    strip,
    truncate_label,
    whole_number,
)
