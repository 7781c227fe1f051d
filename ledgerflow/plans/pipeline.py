"""The whole run — load -> clean -> ML -> report -> summary.

Configuration is a plain dict (the reference's YAML, already parsed).  The
cleaned frame is used by every report table, so it is cut from its lineage once
(reliable checkpoint, or written to ``paths.cleaned``) instead of being
recomputed per table.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features as FE
from ..operators import ml as ML
from ..operators import profile as P
from ..functions.exprs import bind_scalar
from ..operators.clean import run_cleaning
from ..operators.integrate import load_sources
from ..session import cut_lineage
from ..sources.files import read_parquet, save_parquet
from .reporting import run_reporting

log = logging.getLogger(__name__)


def run_pipeline(spark: SparkSession, cfg: dict) -> dict:
    sales, users, products = load_sources(spark, cfg)
    if sales is None:
        raise ValueError("no sales data could be loaded")
    paths = cfg.get("paths") or {}
    if paths.get("raw"):
        sales = read_parquet(spark, save_parquet(sales, paths["raw"]))
    cleaning = run_cleaning(sales, cfg)
    clean = cleaning.df
    if paths.get("cleaned"):
        clean = read_parquet(spark, save_parquet(clean, paths["cleaned"]))
    else:
        clean = cut_lineage(clean)
    ml_result = {"metrics": {}, "tables": {}, "models": {}, "failed": {}}
    if (cfg.get("ml") or {}).get("enabled", False):
        feats = FE.build_features(FE.split(clean, "order_id" if "order_id" in clean.columns else None))
        try:
            ml_result = ML.run_ml(feats, cfg, paths.get("models"))
        except ML.TasksFailed as e:        # the reports are made all the same, and one of them names what failed
            ml_result = e.result
            failed = spark.createDataFrame([*ml_result["failed"].items()], "task string, error string")
            ml_result["tables"]["ml_failed"] = failed
    tables = run_reporting(sales, clean, cfg, ml_result["tables"])
    return {"sales": sales, "users": users, "products": products, "clean": clean,
            "dropped_columns": cleaning.dropped, "cleaning_stats": cleaning.stats,
            "ml": ml_result, "tables": tables,
            "summary": summary_frame(sales, clean, cleaning.stats)}


def summary_frame(raw: DataFrame, clean: DataFrame, stats: DataFrame) -> DataFrame:
    """One row: overall metrics, source count, date range and cleaning stats."""
    om = P.overall_metrics(raw, clean)
    if "order_date" in clean.columns:
        dr_expr = P.date_range(clean).select(F.struct("*").alias("d")).select("d").scalar()
    else:
        dr_expr = F.struct(F.lit(None).cast("date").alias("date_min"), F.lit(None).cast("date").alias("date_max"))
    om, dr = bind_scalar(om, dr_expr, "_dr")
    n_src = (clean.select("source").where(F.col("source").isNotNull()).distinct()
                  .agg(F.count(F.lit(1))).scalar() if "source" in clean.columns else F.lit(0))
    om, st = bind_scalar(om, stats.select(F.struct("*")).scalar(), "_cs")
    extra = [st.getField(c).alias(c) for c in stats.columns]
    return om.select(*[F.col(c) for c in om.columns if c not in ("_dr", "_cs")], n_src.cast("long").alias("n_sources"), dr.getField("date_min").alias("date_min"),
                     dr.getField("date_max").alias("date_max"), *extra)
