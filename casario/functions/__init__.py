"""Column expressions; no Python runs per row."""

from casario.functions.features import (
    BANDS,
    MART_BANDS,
    Band,
    band_counts,
    listing_id,
    price_band,
    price_per_m2,
)
from casario.functions.formatting import (
    format_currency,
    format_integer,
    format_percent,
    month_label,
)
from casario.functions.numeric import (
    or_zero,
    percent_change,
    round_half_away,
    try_int,
    try_real,
)
from casario.functions.text import (
    before_comma,
    bind,
    clean_location,
    clean_price,
    decode_entities,
    first_token,
    origin_of,
    price_digits,
    strip_blanks,
    strip_query,
)

__all__ = [
    "BANDS", "MART_BANDS", "Band", "band_counts", "before_comma", "bind", "clean_location",
    "clean_price", "decode_entities", "first_token", "format_currency", "format_integer",
    "format_percent", "listing_id", "month_label", "or_zero", "origin_of",
    "percent_change", "price_band", "price_digits", "price_per_m2", "round_half_away",
    "strip_blanks", "strip_query", "try_int", "try_real",
]
