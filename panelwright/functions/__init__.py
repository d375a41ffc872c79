"""Scalar Column expressions (all JVM-side, no Python UDFs)."""

from panelwright.functions.numeric import (
    nan_to_null,
    safe_ratio,
    to_number,
    truncate_to_int,
    weighted_sum,
    zscore,
)
from panelwright.functions.periods import (
    between_years,
    is_period_label,
    opportunity_periods,
    period_label,
    season_urls,
    start_year,
)
from panelwright.functions.text import (
    blank_to_null,
    contains_text,
    dummies,
    extract_or_null,
    height_inches,
    position_code,
    recruiting_rank,
    recruiting_year,
    strip_prefixes,
    url_id,
    url_join,
    url_join_col,
    weight_lb,
)

__all__ = [
    "between_years", "blank_to_null", "contains_text", "dummies", "extract_or_null",
    "height_inches", "is_period_label", "nan_to_null", "opportunity_periods", "period_label",
    "position_code", "recruiting_rank", "recruiting_year", "safe_ratio", "season_urls",
    "start_year", "strip_prefixes", "to_number", "truncate_to_int", "url_id", "url_join", "url_join_col",
    "weight_lb", "weighted_sum", "zscore",
]
