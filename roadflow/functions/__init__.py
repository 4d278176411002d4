from .exprs import (  # noqa: F401
    avg_d, coerce_measure, dbl, divide_or_zero, growth_pct, hour_label,
    literal_map, month_name, pct, road_label, safe_div, sum_d, year_filter,
)
