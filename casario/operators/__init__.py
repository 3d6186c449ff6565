"""Frame-to-frame building blocks."""

from casario.operators.change import change_or_zero, previous, series_change
from casario.operators.dedup import keep_first, total_order, union_by_name
from casario.operators.distribution import (
    histogram,
    mean,
    medians,
    merge_groups,
    quantiles,
    shares,
    sum_by,
    value_counts,
)
from casario.operators.filters import filter_listings, plausible
from casario.operators.location import enrich_location, neighbourhoods, region_case
from casario.operators.quality import not_null, unique

__all__ = [
    "change_or_zero", "enrich_location", "filter_listings", "histogram", "keep_first",
    "mean", "medians", "merge_groups", "neighbourhoods", "not_null",
    "plausible", "previous", "quantiles", "region_case", "series_change", "shares",
    "sum_by", "total_order", "union_by_name", "unique", "value_counts",
]
