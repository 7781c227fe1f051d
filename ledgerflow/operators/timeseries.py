"""Time series (T1, T2): dense daily series and additive decomposition.

The daily series has one row per calendar day, so its size is bounded by the
date span, not by the data volume.  Even so, nothing here is an un-partitioned
window: the day index is ``datediff`` from the first day, the centred moving
average is a "scatter to the 7 neighbours, then group" aggregation, and the two
end-point regressions are ``regr_slope`` / ``regr_intercept`` aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import bind_scalar, day_of, nan_to_null, qcol
from ..session import cut_lineage


def daily_dense(df: DataFrame, date_col: str = "order_date", value_col: str = "amount") -> DataFrame:
    """Daily sums over rows with a date and a value, densified over the
    min..max calendar with 0.0 for days without rows.  Columns (day, value)."""
    base = df.select(day_of(df, date_col).alias("day"), nan_to_null(qcol(value_col).cast("double")).alias("v"))
    daily = (base.where(F.col("day").isNotNull() & F.col("v").isNotNull())
                 .groupBy("day").agg(F.sum("v").alias("value")))
    cal = daily.agg(F.min("day").alias("lo"), F.max("day").alias("hi")) \
               .select(F.explode(F.sequence(F.col("lo"), F.col("hi"), F.expr("INTERVAL 1 DAY"))).alias("day"))
    return cal.join(daily, "day", "left").select("day", F.coalesce(F.col("value"), F.lit(0.0)).alias("value"))


def decompose(series: DataFrame, period: int = 7, day_col: str = "day", value_col: str = "value") -> DataFrame:
    """Additive seasonal decomposition of a dense daily series.

    trend: centred ``period``-point moving average (odd period), the undefined
    ends extrapolated by least-squares lines fitted on the ``period − 1`` nearest
    defined points at each end; seasonal: mean of (value − trend) per position
    mod ``period``, centred to mean 0; resid = value − trend − seasonal.
    Fewer than 2·period days raises at execution.  Columns
    (day, value, trend, seasonal, resid).
    """
    if period % 2 != 1:
        raise ValueError("only odd periods are supported (daily data: 7)")
    h = period // 2
    npts = period - 1
    # The series is one row per day: materialise it once (reliable checkpoint)
    # so the scalar statistics below do not re-run the aggregation behind it.
    s = cut_lineage(series.select(qcol(day_col).alias("day"), qcol(value_col).cast("double").alias("y")))
    s, st = bind_scalar(s, s.agg(F.struct(F.min("day").alias("first"), F.count(F.lit(1)).alias("n"))).scalar())
    first, n = st.getField("first"), st.getField("n")
    s = s.withColumn("i", F.datediff(F.col("day"), first)).withColumn("_n", n).drop("_st")
    n = F.col("_n")

    # centred moving average: each point contributes to its `period` neighbours
    spread = s.select(F.explode(F.sequence(F.col("i") - h, F.col("i") + h)).alias("t"), "y")
    ma = (spread.groupBy("t").agg(F.sum("y").alias("sy"), F.count(F.lit(1)).alias("k"))
                .where(F.col("k") == period)
                .select(F.col("t").alias("i"), (F.col("sy") / period).alias("ma")))
    # day-level intermediate (one row per day) pinned so the scalars below
    # do not re-derive it
    s = cut_lineage(s.join(ma, "i", "left"))

    front, back = F.lit(h), n - 1 - h               # first and last defined trend index
    in_front = (F.col("i") >= front) & (F.col("i") < F.least(front + npts, back))
    in_back = (F.col("i") >= F.greatest(back - npts, front)) & (F.col("i") < back)
    fit = s.agg(F.struct(
        F.regr_slope(F.when(in_front, F.col("ma")), F.when(in_front, F.col("i"))).alias("kf"),
        F.regr_intercept(F.when(in_front, F.col("ma")), F.when(in_front, F.col("i"))).alias("bf"),
        F.regr_slope(F.when(in_back, F.col("ma")), F.when(in_back, F.col("i"))).alias("kb"),
        F.regr_intercept(F.when(in_back, F.col("ma")), F.when(in_back, F.col("i"))).alias("bb"))).scalar()
    s, fit = bind_scalar(s, fit, "_fit")
    trend = (F.when(F.col("i") < front, fit.getField("kf") * F.col("i") + fit.getField("bf"))
              .when(F.col("i") > back, fit.getField("kb") * F.col("i") + fit.getField("bb"))
              .otherwise(F.col("ma")))
    guard = F.when(n < 2 * period, F.raise_error(F.lit(
        f"decompose: need at least {2 * period} observations"))).otherwise(F.lit(0.0))
    s = cut_lineage(s.withColumn("trend", trend + guard).withColumn("detr", F.col("y") - F.col("trend")))

    # seasonal means per position mod period (a `period`-row table), centred
    pm = s.groupBy((F.col("i") % period).alias("m")).agg(F.avg("detr").alias("pm"))
    centre = pm.agg(F.avg("pm")).scalar()
    pm = pm.select("m", (F.col("pm") - centre).alias("seasonal"))
    out = s.join(F.broadcast(pm), (F.col("i") % period) == F.col("m"))   # `period` rows: size is fixed
    return out.select("day", F.col("y").alias("value"), "trend", "seasonal",
                      (F.col("detr") - F.col("seasonal")).alias("resid"))


def decompose_nan_counts(components: DataFrame) -> DataFrame:
    """The reference's summary of a decomposition: NULL counts per component."""
    return components.agg(*[F.count_if(F.col(c).isNull() | F.isnan(F.col(c))).cast("long").alias(f"{c}_nan")
                            for c in ("trend", "seasonal", "resid")])
