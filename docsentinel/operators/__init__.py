"""Reusable DataFrame operators (``DataFrame -> DataFrame``)."""

from docsentinel.operators.dedupe import latest_per_key  # noqa: F401
from docsentinel.operators.snapshot import latest_snapshot  # noqa: F401
from docsentinel.operators.spine import densify_pivot, month_spine  # noqa: F401
from docsentinel.operators.status import distinct_status_counts  # noqa: F401
from docsentinel.operators.trend import month_over_month  # noqa: F401
