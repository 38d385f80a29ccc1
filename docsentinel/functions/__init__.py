"""Column-level building blocks (pure ``Column -> Column`` functions)."""

from docsentinel.functions.exprs import (  # noqa: F401
    control_name,
    control_subject,
    days_between,
    issue_year,
    issuing_country,
    json_first,
    lookback,
    lower_trim,
    month_start,
    pct,
    status_flags,
    status_counts,
    status_percentages,
    status_rank,
    surrogate_key,
    to_json_keep_nulls,
)
