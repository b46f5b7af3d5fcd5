"""All registered queries and their SQL twins."""

from __future__ import annotations

from tidewheel.plans import io_queries, job_queries, model_queries, rollup_queries, series_queries  # noqa: F401
from tidewheel.plans.catalog import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
