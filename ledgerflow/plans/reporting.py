"""The reporting table set — every report dataset as a named DataFrame.

The reference renders these numbers as charts, a PDF, an Excel workbook and HTML
pages; rendering is out of scope (single-machine documents), the tables are the
product.  With ``output_dir`` each table is written as Parquet (S6).
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import ID_COLUMNS, numeric_columns
from ..operators import profile as P
from ..operators import report as R
from ..operators import timeseries as TS
from ..sources.files import save_parquet

log = logging.getLogger(__name__)


class LazyTables(Mapping):
    """name -> DataFrame, each table built on first access.

    Building some tables runs small jobs up front (quantile brackets, the
    decomposition's day-level checkpoints); a caller that reads only a few
    tables pays only for those.  Iterating (writing, indexing) builds all."""

    def __init__(self) -> None:
        self._build: dict[str, Callable[[], DataFrame]] = {}
        self._done: dict[str, DataFrame] = {}

    def add(self, name: str, build: Callable[[], DataFrame]) -> None:
        self._build[name] = build

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._done:
            self._done[name] = self._build[name]()
        return self._done[name]

    def __iter__(self):
        return iter(self._build)

    def __len__(self) -> int:
        return len(self._build)


def _decomposition(daily: DataFrame) -> DataFrame:
    try:
        return TS.decompose(daily)
    except Exception as e:  # noqa: BLE001 — too short a series is logged, any other failure raised
        if "decompose: need at least" not in str(e):
            raise
        log.info("decomposition skipped: %s", e)
        return daily.sparkSession.createDataFrame(
            [], "day date, value double, trend double, seasonal double, resid double")


def run_reporting(raw: DataFrame, clean: DataFrame, cfg: dict | None = None,
                  extra_tables: dict[str, DataFrame] | None = None) -> LazyTables:
    cfg = cfg or {}
    rep = cfg.get("reporting") or {}
    plots = rep.get("plots") or {}
    top_n = int((plots.get("top_customers") or {}).get("top_n", 10))
    q = float((plots.get("sales_hist_trim") or {}).get("trim_quantile", 0.99))
    cols = set(clean.columns)
    has = lambda *need: all(c in cols for c in need)
    t = LazyTables()
    t.add("overall_metrics", lambda: P.overall_metrics(raw, clean))
    if has("source"):
        t.add("aggregates_by_source", lambda: P.aggregates_by_source(clean))
        t.add("source_share", lambda: R.source_share(clean))
    if numeric_columns(clean, exclude=ID_COLUMNS):
        t.add("basic_stats", lambda: P.describe(clean))
    if has("amount"):
        t.add("amount_histogram", lambda: R.histogram(clean, "amount", 30))
        t.add("amount_histogram_trim", lambda: R.histogram_trimmed(clean, "amount", q, 30))
        t.add("box_stats", lambda: R.box_stats(clean, "amount", "source"))
    if has("order_date"):
        t.add("orders_per_day", lambda: R.orders_per_day(clean))
    if has("customer_id"):
        t.add("top_customers", lambda: R.top_customers(clean, top_n))
        t.add("customer_totals", lambda: R.customer_totals(clean))
    if has("order_date", "amount"):
        t.add("monthly_revenue", lambda: R.monthly_revenue(clean))
        t.add("daily_revenue", lambda: TS.daily_dense(clean))
    if has("source", "order_date", "amount"):
        t.add("basic_stats_by_source", lambda: P.describe_by(clean, "source"))
        t.add("monthly_revenue_by_source", lambda: R.monthly_revenue_by_source(clean))
        t.add("cumulative_revenue_by_source", lambda: R.cumulative_revenue_by_source(clean))
        t.add("identical_monthly_series",
              lambda: R.identical_series(t["monthly_revenue_by_source"], "source", "month", "revenue"))
        t.add("identical_cumulative_series",
              lambda: R.identical_series(t["cumulative_revenue_by_source"], "source", "day", "cum_revenue"))
    num = numeric_columns(clean, exclude=ID_COLUMNS)
    if len(num) >= 2:                      # the reference draws these only for >= 2 columns
        t.add("corr_matrix", lambda: P.correlation(clean, num))
        t.add("pairwise_bins", lambda: R.pairwise_bins(clean, num))
    if has("order_date", "amount"):
        t.add("decomposition", lambda: _decomposition(t["daily_revenue"]))
    for name, df in (extra_tables or {}).items():
        t.add(name, lambda df=df: df)
    out_dir = rep.get("output_dir")
    if out_dir:
        for name, df in t.items():
            save_parquet(df, f"{out_dir.rstrip('/')}/{name}")
    return t


def bundle_index(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(name, rows) for every table of the bundle, as one lazy union of counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
