"""Named queries over the test tables, each with an independent DuckDB oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> SQL``.
Floating results are rounded identically on both sides (cents for money, more
digits for ratios) so engine-specific summation order cannot change the hash.
Keys without an oracle are checked on row count only and by pytest properties.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import views as V
from .operators import profile as P
from .operators import report as R

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def w(body: str, **kw) -> str:
    """Oracle text: the standard views as CTEs, then ``body`` (which may add CTEs
    by starting with WITH)."""
    head = V.with_views("", **kw).rstrip()
    body = body.strip()
    if body.upper().startswith("WITH "):
        return head + ",\n" + body[5:]
    return head + "\n" + body


def rnd(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.select(*[F.round(F.col(c), digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns])


# ---------------------------------------------------------------------------
# Report datasets (R*)
# ---------------------------------------------------------------------------

@register("monthly_revenue_by_source", w("""
SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, source, round(sum(amount), 2) AS revenue
FROM sales_dirty
WHERE order_date IS NOT NULL AND amount IS NOT NULL AND source IS NOT NULL
GROUP BY 1, 2""", dirty=True))
def q_monthly_revenue_by_source(spark, sf):
    return rnd(R.monthly_revenue_by_source(V.sales_dirty(spark, sf)), {"revenue": 2})


_HIST_SQL = """
WITH x AS (SELECT amount AS x FROM sales_dirty WHERE amount IS NOT NULL {trim}),
st AS (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
              CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM x),
b AS (SELECT CAST(least(floor((x - lo) / ((hi - lo) / 30)) + 1, 30) AS INTEGER) AS bin FROM x, st),
c AS (SELECT bin, count(*) AS cnt FROM b GROUP BY bin),
g AS (SELECT CAST(i AS INTEGER) AS bin FROM range(1, 31) t(i))
SELECT g.bin, round(lo + (g.bin - 1) * ((hi - lo) / 30), 4) AS bin_lo, round(lo + g.bin * ((hi - lo) / 30), 4) AS bin_hi,
       CAST(coalesce(cnt, 0) AS BIGINT) AS count
FROM g CROSS JOIN st LEFT JOIN c ON g.bin = c.bin"""


@register("amount_histogram", w(_HIST_SQL.format(trim=""), dirty=True))
def q_amount_histogram(spark, sf):
    return rnd(R.histogram(V.sales_dirty(spark, sf), "amount", 30), {"bin_lo": 4, "bin_hi": 4})


@register("amount_histogram_trim", w(_HIST_SQL.format(
    trim="AND amount <= (SELECT quantile_cont(amount, 0.99) FROM sales_dirty WHERE amount IS NOT NULL)"), dirty=True))
def q_amount_histogram_trim(spark, sf):
    return rnd(R.histogram_trimmed(V.sales_dirty(spark, sf), "amount", 0.99, 30), {"bin_lo": 4, "bin_hi": 4})


@register("box_stats_by_source", w("""
WITH x AS (SELECT source AS grp, amount AS x FROM sales_dirty WHERE amount IS NOT NULL AND source IS NOT NULL),
q AS (SELECT grp, count(*) AS n, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
             quantile_cont(x, 0.75) AS q3 FROM x GROUP BY grp),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM q)
SELECT f.grp AS source, n, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
       min(CASE WHEN x >= lo_f AND x <= hi_f THEN x END) AS whisker_lo,
       max(CASE WHEN x >= lo_f AND x <= hi_f THEN x END) AS whisker_hi,
       count(CASE WHEN NOT (x >= lo_f AND x <= hi_f) THEN 1 END) AS n_outliers
FROM x JOIN f ON x.grp = f.grp
GROUP BY f.grp, n, q1, median, q3""", dirty=True))
def q_box_stats_by_source(spark, sf):
    return rnd(R.box_stats(V.sales_dirty(spark, sf), "amount", "source"), {"q1": 4, "median": 4, "q3": 4})


@register("orders_per_day", w("""
SELECT order_date AS day, count(*) AS orders FROM sales_dirty WHERE order_date IS NOT NULL GROUP BY 1""", dirty=True))
def q_orders_per_day(spark, sf):
    return R.orders_per_day(V.sales_dirty(spark, sf))


@register("top_customers", w("""
SELECT customer_id, count(*) AS orders FROM sales_dirty WHERE customer_id IS NOT NULL
GROUP BY customer_id ORDER BY orders DESC, customer_id LIMIT 10""", dirty=True))
def q_top_customers(spark, sf):
    return R.top_customers(V.sales_dirty(spark, sf), 10)


@register("customer_totals", w("""
SELECT count(*) AS n_rows, count(DISTINCT customer_id) AS n_customers FROM sales_dirty""", dirty=True))
def q_customer_totals(spark, sf):
    return R.customer_totals(V.sales_dirty(spark, sf))


@register("monthly_revenue", w("""
SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, round(sum(amount), 2) AS revenue, count(*) AS orders
FROM sales_dirty WHERE order_date IS NOT NULL AND amount IS NOT NULL GROUP BY 1""", dirty=True))
def q_monthly_revenue(spark, sf):
    return rnd(R.monthly_revenue(V.sales_dirty(spark, sf)), {"revenue": 2})


@register("monthly_revenue_header", w("""
SELECT count(*) AS n, min(CAST(date_trunc('month', order_date) AS DATE)) AS month_first,
       max(CAST(date_trunc('month', order_date) AS DATE)) AS month_last
FROM sales_dirty WHERE order_date IS NOT NULL AND amount IS NOT NULL""", dirty=True))
def q_monthly_revenue_header(spark, sf):
    return R.monthly_revenue_header(V.sales_dirty(spark, sf))


@register("source_share", w("""
SELECT coalesce(source, 'NA') AS source, count(*) AS rows,
       round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS share_pct
FROM sales_dirty GROUP BY 1""", dirty=True))
def q_source_share(spark, sf):
    return rnd(R.source_share(V.sales_dirty(spark, sf)), {"share_pct": 6})


@register("cumulative_revenue_by_source", w("""
WITH d AS (SELECT source, order_date AS day, sum(amount) AS revenue FROM sales_dirty
           WHERE order_date IS NOT NULL AND amount IS NOT NULL AND source IS NOT NULL GROUP BY 1, 2)
SELECT source, day, round(revenue, 2) AS revenue,
       round(sum(revenue) OVER (PARTITION BY source ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2)
         AS cum_revenue
FROM d""", dirty=True))
def q_cumulative_revenue_by_source(spark, sf):
    return rnd(R.cumulative_revenue_by_source(V.sales_dirty(spark, sf)), {"revenue": 2, "cum_revenue": 2})


def _mirrored_sales(spark, sf):
    """sales plus a re-labelled copy of the 'file' source (the same orders arriving
    through a second channel, as when one table is loaded from DB, CSV and Excel)."""
    s = V.sales(spark, sf)
    return s.unionByName(s.where(F.col("source") == "file").withColumn("source", F.lit("file_copy")))


@register("identical_series", w("""
WITH s AS (SELECT * FROM sales UNION ALL SELECT order_id, customer_id, order_date, amount, 'file_copy' FROM sales
           WHERE source = 'file'),
m AS (SELECT source, date_trunc('month', order_date) AS month, round(sum(amount), 2) AS v FROM s GROUP BY 1, 2),
l AS (SELECT source, list(v ORDER BY month) AS vs FROM m GROUP BY source)
SELECT a.source AS source_a, b.source AS source_b FROM l a JOIN l b ON a.source < b.source AND a.vs = b.vs"""))
def q_identical_series(spark, sf):
    series = R.monthly_revenue_by_source(_mirrored_sales(spark, sf))
    return R.identical_series(series, "source", "month", "revenue")


_LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _pair_sql() -> str:
    cols = _LI_NUM
    st = ", ".join(f"CASE WHEN min({c}) = max({c}) THEN min({c}) - 0.5 ELSE min({c}) END AS lo_{c}, "
                   f"CASE WHEN min({c}) = max({c}) THEN max({c}) + 0.5 ELSE max({c}) END AS hi_{c}" for c in cols)
    bins = ", ".join(f"CAST(least(floor(({c} - lo_{c}) / ((hi_{c} - lo_{c}) / 10)) + 1, 10) AS INTEGER) AS {c}"
                     for c in cols)
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            parts.append(f"SELECT '{a}' AS x_col, '{b}' AS y_col, {a} AS x_bin, {b} AS y_bin FROM b")
    return ("WITH st AS (SELECT " + st + " FROM lineitem),\n"
            "b AS (SELECT " + bins + " FROM lineitem, st),\n"
            "p AS (" + "\nUNION ALL ".join(parts) + ")\n"
            "SELECT x_col, y_col, x_bin, y_bin, count(*) AS count FROM p GROUP BY ALL")


@register("pairwise_bins", w(_pair_sql()))
def q_pairwise_bins(spark, sf):
    return R.pairwise_bins(V.table(spark, sf, "lineitem"), _LI_NUM, 10)


# ---------------------------------------------------------------------------
# Profiling (P*)
# ---------------------------------------------------------------------------

def _describe_sql(cols, src, by=None) -> str:
    sel = []
    for c in cols:
        key = f"{by}, " if by else ""
        sel.append(
            f"SELECT {key}'{c}' AS \"column\", count({c}) AS count, round(avg({c}), 4) AS mean, "
            f"round(stddev_samp({c}), 4) AS std, min({c}) AS min, round(quantile_cont({c}, 0.25), 4) AS q25, "
            f"round(quantile_cont({c}, 0.5), 4) AS q50, round(quantile_cont({c}, 0.75), 4) AS q75, max({c}) AS max "
            f"FROM {src}" + (f" WHERE {by} IS NOT NULL GROUP BY {by}" if by else ""))
    return "\nUNION ALL ".join(sel)


_DESC_ROUND = {"mean": 4, "std": 4, "q25": 4, "q50": 4, "q75": 4}


@register("basic_stats", w(_describe_sql(_LI_NUM, "lineitem")))
def q_basic_stats(spark, sf):
    return rnd(P.describe(V.table(spark, sf, "lineitem"), _LI_NUM), _DESC_ROUND)


@register("basic_stats_by_source", w(_describe_sql(["amount"], "sales_dirty", by="source"), dirty=True))
def q_basic_stats_by_source(spark, sf):
    return rnd(P.describe_by(V.sales_dirty(spark, sf), "source", ["amount"]), _DESC_ROUND)


@register("date_range", w("SELECT min(order_date) AS date_min, max(order_date) AS date_max FROM sales_dirty",
                          dirty=True))
def q_date_range(spark, sf):
    return P.date_range(V.sales_dirty(spark, sf))


@register("source_counts", w("SELECT source, count(*) AS rows FROM sales_dirty GROUP BY source", dirty=True))
def q_source_counts(spark, sf):
    return P.source_counts(V.sales_dirty(spark, sf))


@register("aggregates_by_source", w("""
SELECT source, count(*) AS rows, round(coalesce(sum(amount), 0.0), 2) AS amount_sum,
       round(avg(amount), 4) AS amount_mean
FROM sales_dirty WHERE source IS NOT NULL GROUP BY source""", dirty=True))
def q_aggregates_by_source(spark, sf):
    return rnd(P.aggregates_by_source(V.sales_dirty(spark, sf)), {"amount_sum": 2, "amount_mean": 4})


@register("corr_matrix", w("""
WITH c AS (SELECT {cells} FROM lineitem)
{unions}""".format(
    cells=", ".join(f"corr({a}, {b}) AS \"{a}|{b}\"" for i, a in enumerate(_LI_NUM) for b in _LI_NUM[i:]),
    unions="\nUNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(\"{x}|{y}\", 8) AS rho FROM c"
        for i, x in enumerate(_LI_NUM) for y in _LI_NUM[i:] for (a, b) in ({(x, y), (y, x)})))))
def q_corr_matrix(spark, sf):
    return rnd(P.correlation(V.table(spark, sf, "lineitem"), _LI_NUM), {"rho": 8})


@register("overall_metrics", w("""
SELECT count(*) AS rows_raw, count(*) AS rows_clean,
       CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM sales_dirty)) AS BIGINT) AS duplicates_raw,
       count(*) FILTER (WHERE amount IS NULL) AS missing_amount_clean,
       round(coalesce(sum(amount), 0.0), 2) AS total_revenue_clean, round(avg(amount), 4) AS avg_order_amount_clean
FROM sales_dirty""", dirty=True))
def q_overall_metrics(spark, sf):
    from .operators.clean import run_cleaning
    raw = V.sales_dirty(spark, sf)
    out = P.overall_metrics(raw, run_cleaning(raw).df)
    return rnd(out, {"total_revenue_clean": 2, "avg_order_amount_clean": 4})


@register("table_counts", w("""
SELECT (SELECT count(*) FROM sales) AS sales_count, (SELECT count(*) FROM customers) AS customers_count""",
                            customers=True))
def q_table_counts(spark, sf):
    return P.table_counts(V.sales(spark, sf), V.customers(spark, sf))


@register("top_countries", w("""
SELECT c.country, count(*) AS cnt FROM sales s JOIN customers c ON s.customer_id = c.customer_id
GROUP BY c.country ORDER BY cnt DESC, c.country LIMIT 3""", customers=True))
def q_top_countries(spark, sf):
    return P.top_countries(V.sales(spark, sf), V.customers(spark, sf), 3)


# ---------------------------------------------------------------------------
# Cleaning (C*)
# ---------------------------------------------------------------------------
from .operators import clean as C  # noqa: E402
from .operators import encode as EN  # noqa: E402
from .operators import integrate as I  # noqa: E402
from .operators import validate as VA  # noqa: E402
from .functions.exprs import bind_scalar  # noqa: E402

_INT_SQL = "CASE WHEN TRY_CAST({c} AS DOUBLE) = floor(TRY_CAST({c} AS DOUBLE)) THEN CAST(TRY_CAST({c} AS DOUBLE) AS BIGINT) END"


@register("coerce_types", w(f"""
SELECT {_INT_SQL.format(c='order_id')} AS order_id, {_INT_SQL.format(c='customer_id')} AS customer_id,
       try_strptime(order_date, '%Y-%m-%d') AS order_date, TRY_CAST(amount AS DOUBLE) AS amount, source
FROM sales_text""", text=True))
def q_coerce_types(spark, sf):
    return C.coerce_types(V.sales_text(spark, sf))


@register("drop_high_missing", w("SELECT order_id, customer_id, order_date, amount, source FROM sales_dirty",
                                 dirty=True))
def q_drop_high_missing(spark, sf):
    return C.drop_high_missing(V.sales_dirty(spark, sf), 0.8)[0]


@register("dup_row_count", w("""
SELECT CAST((SELECT count(*) FROM sales_dirty) - (SELECT count(*) FROM (SELECT DISTINCT * FROM sales_dirty)) AS BIGINT)
       AS duplicates""", dirty=True))
def q_dup_row_count(spark, sf):
    return P.duplicate_rows(V.sales_dirty(spark, sf))


def _missing_sql(cols, src):
    return "\nUNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS missing FROM {src}"
                               for c in cols)


@register("missing_key_counts", w(_missing_sql(["order_id", "customer_id", "order_date", "amount", "country"],
                                               "sales_dirty"), dirty=True))
def q_missing_key_counts(spark, sf):
    return C.missing_counts(V.sales_dirty(spark, sf), C.KEY_COLUMNS)


@register("run_cleaning", w("""
SELECT CAST((SELECT count(*) FROM sales_dirty) - (SELECT count(*) FROM (SELECT DISTINCT order_id, customer_id,
       order_date, amount, source FROM sales_dirty)) AS BIGINT) AS sales_duplicates,
       count(*) FILTER (WHERE order_id IS NULL) AS missing_order_id,
       count(*) FILTER (WHERE customer_id IS NULL) AS missing_customer_id,
       count(*) FILTER (WHERE order_date IS NULL) AS missing_order_date,
       count(*) FILTER (WHERE amount IS NULL) AS missing_amount
FROM sales_dirty""", dirty=True))
def q_run_cleaning(spark, sf):
    return C.run_cleaning(V.sales_dirty(spark, sf)).stats


@register("clean_store_stats", w("""
SELECT count(*) AS rows_raw, count(*) AS rows_clean,
       CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM sales_dirty)) AS BIGINT) AS duplicates_raw,
       count(*) FILTER (WHERE amount IS NULL) AS missing_amount_clean,
       round(coalesce(sum(amount), 0.0), 2) AS total_revenue_clean, round(avg(amount), 4) AS avg_order_amount_clean,
       CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT order_id, customer_id, order_date, amount, source FROM sales_dirty)) AS BIGINT)
       AS sales_duplicates,
       count(*) FILTER (WHERE order_id IS NULL) AS missing_order_id, count(*) FILTER (WHERE customer_id IS NULL) AS missing_customer_id,
       count(*) FILTER (WHERE order_date IS NULL) AS missing_order_date, count(*) FILTER (WHERE amount IS NULL) AS missing_amount
FROM sales_dirty""", dirty=True))
def q_clean_store_stats(spark, sf):
    from .plans.cleaned_store import clean_to_parquet
    stored = clean_to_parquet(V.sales_dirty(spark, sf), scratch_path(spark, "cleaned"))
    overall = rnd(stored.overall, {"total_revenue_clean": 2, "avg_order_amount_clean": 4})
    out, st = bind_scalar(overall, stored.stats.select(F.struct("*")).scalar(), "_st")
    return out.select(*overall.columns, *[st.getField(c).alias(c) for c in stored.stats.columns])


@register("parse_dates", w("""
SELECT order_id, customer_id, try_strptime(order_date, '%Y-%m-%d') AS order_date, amount, source FROM sales_text""",
                           text=True))
def q_parse_dates(spark, sf):
    return C.parse_dates(V.sales_text(spark, sf), ["order_date", "missing_col"])


def _impute_sql(fill_amount: str) -> str:
    modes = "\n".join(
        f", m_{c} AS (SELECT {c} AS v FROM sales_dirty WHERE {c} IS NOT NULL GROUP BY {c} "
        f"ORDER BY count(*) DESC, {c} LIMIT 1)" for c in ("order_date", "source", "country"))
    return (f"WITH f AS (SELECT {fill_amount} AS fill FROM sales_dirty)\n{modes}\n"
            "SELECT order_id, customer_id, coalesce(order_date, (SELECT v FROM m_order_date)) AS order_date,\n"
            "       round(coalesce(amount, (SELECT fill FROM f)), 4) AS amount,\n"
            "       coalesce(source, (SELECT v FROM m_source), '') AS source,\n"
            "       coalesce(country, (SELECT v FROM m_country), '') AS country\nFROM sales_dirty")


@register("impute_median", w(_impute_sql("quantile_cont(amount, 0.5)"), dirty=True))
def q_impute_median(spark, sf):
    return rnd(C.impute(V.sales_dirty(spark, sf), "median"), {"amount": 4})


@register("impute_mean", w(_impute_sql("avg(amount)"), dirty=True))
def q_impute_mean(spark, sf):
    return rnd(C.impute(V.sales_dirty(spark, sf), "mean"), {"amount": 4})


@register("impute_mode", w("""
WITH m_order_date AS (SELECT order_date AS v FROM sales_dirty WHERE order_date IS NOT NULL GROUP BY order_date
                      ORDER BY count(*) DESC, order_date LIMIT 1),
m_source AS (SELECT source AS v FROM sales_dirty WHERE source IS NOT NULL GROUP BY source
             ORDER BY count(*) DESC, source LIMIT 1)
SELECT coalesce(order_date, (SELECT v FROM m_order_date)) AS order_date,
       coalesce(source, (SELECT v FROM m_source), '') AS source,
       coalesce(CAST(NULL AS VARCHAR), '') AS note
FROM sales_dirty""", dirty=True))
def q_impute_mode(spark, sf):
    d = V.sales_dirty(spark, sf).select("order_date", "source", F.lit(None).cast("string").alias("note"))
    return C.impute(d)


def _li_scale_input(spark, sf):
    return V.table(spark, sf, "lineitem").select(*_LI_NUM, "l_returnflag", "l_shipdate")


@register("scale_standard", w("""
WITH s AS (SELECT {st} FROM lineitem)
SELECT {cols}, l_returnflag, l_shipdate FROM lineitem, s""".format(
    st=", ".join(f"avg({c}) AS m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1) AS s_{c}" for c in _LI_NUM),
    cols=", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in _LI_NUM))))
def q_scale_standard(spark, sf):
    return rnd(C.scale(_li_scale_input(spark, sf), "standard"), {c: 6 for c in _LI_NUM})


@register("scale_minmax", w("""
WITH s AS (SELECT {st} FROM lineitem)
SELECT {cols}, l_returnflag, l_shipdate FROM lineitem, s""".format(
    st=", ".join(f"min({c}) AS m_{c}, coalesce(nullif(max({c}) - min({c}), 0), 1) AS s_{c}" for c in _LI_NUM),
    cols=", ".join(f"round(({c} - m_{c}) / s_{c}, 8) AS {c}" for c in _LI_NUM))))
def q_scale_minmax(spark, sf):
    return rnd(C.scale(_li_scale_input(spark, sf), "minmax"), {c: 8 for c in _LI_NUM})


# ---------------------------------------------------------------------------
# Encoding (E*)
# ---------------------------------------------------------------------------

def _li_cat(spark, sf):
    return V.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")


@register("encode_onehot", w("""
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_returnflag = 'A' THEN 1.0 ELSE 0.0 END::DOUBLE AS l_returnflag_A,
       CASE WHEN l_returnflag = 'N' THEN 1.0 ELSE 0.0 END::DOUBLE AS l_returnflag_N,
       CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END::DOUBLE AS l_returnflag_R,
       CASE WHEN l_linestatus = 'F' THEN 1.0 ELSE 0.0 END::DOUBLE AS l_linestatus_F,
       CASE WHEN l_linestatus = 'O' THEN 1.0 ELSE 0.0 END::DOUBLE AS l_linestatus_O
FROM lineitem"""))
def q_encode_onehot(spark, sf):
    return EN.one_hot(_li_cat(spark, sf))


@register("encode_label", w("""
WITH r AS (SELECT l_returnflag AS v, CAST(row_number() OVER (ORDER BY l_returnflag) - 1 AS INTEGER) AS code
           FROM (SELECT DISTINCT l_returnflag FROM lineitem)),
s AS (SELECT l_linestatus AS v, CAST(row_number() OVER (ORDER BY l_linestatus) - 1 AS INTEGER) AS code
      FROM (SELECT DISTINCT l_linestatus FROM lineitem))
SELECT l_orderkey, l_linenumber, coalesce(r.code, -1) AS l_returnflag, coalesce(s.code, -1) AS l_linestatus
FROM lineitem LEFT JOIN r ON l_returnflag = r.v LEFT JOIN s ON l_linestatus = s.v"""))
def q_encode_label(spark, sf):
    return EN.label_encode(_li_cat(spark, sf))


@register("smart_encode", w("""
SELECT event_id, value, props, {d} FROM events""".format(
    d=", ".join(f"(event_type = '{v}') AS event_type_{v}" for v in ("click", "error", "purchase", "signup", "view")))))
def q_smart_encode(spark, sf):
    ev = V.table(spark, sf, "events").select("event_id", "event_type", "value", "props")
    return EN.smart_encode(ev, {"max_onehot_unique": 10})[0]


@register("list_to_json")
def q_list_to_json(spark, sf):
    return EN.list_to_json(V.table(spark, sf, "embeddings"))


# ---------------------------------------------------------------------------
# Validation (V*)
# ---------------------------------------------------------------------------

@register("check_duplicates", w("""
SELECT CAST(greatest({d}) AS BIGINT) AS duplicates FROM sales_dirty""".format(
    d=", ".join(f"count({c}) - count(DISTINCT {c})"
                for c in ("order_id", "customer_id", "order_date", "amount", "source", "country"))), dirty=True))
def q_check_duplicates(spark, sf):
    return VA.check_duplicates(V.sales_dirty(spark, sf))


@register("drop_duplicates_all", w("SELECT DISTINCT * FROM sales_dirty", dirty=True))
def q_drop_duplicates_all(spark, sf):
    return VA.drop_duplicates(V.sales_dirty(spark, sf))


@register("drop_duplicates_subset", w("""
SELECT order_id, customer_id, order_date, amount, source, country FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY order_date NULLS FIRST, order_id NULLS FIRST,
         order_id, order_date NULLS FIRST, amount NULLS FIRST, source NULLS FIRST, country NULLS FIRST) AS rn
  FROM sales_dirty) WHERE rn = 1""", dirty=True))
def q_drop_duplicates_subset(spark, sf):
    return VA.drop_duplicates(V.sales_dirty(spark, sf), ["customer_id"], ["order_date", "order_id"])


@register("check_missing", w("""
SELECT "column", CASE "column" WHEN 'order_id' THEN 'bigint' WHEN 'customer_id' THEN 'bigint'
       WHEN 'order_date' THEN 'date' WHEN 'amount' THEN 'double' ELSE 'string' END AS dtype, missing
FROM ({m})""".format(m=_missing_sql(["order_id", "customer_id", "order_date", "amount", "source", "country"],
                                    "sales_dirty")), dirty=True))
def q_check_missing(spark, sf):
    return VA.check_missing(V.sales_dirty(spark, sf))


@register("outliers_iqr", w("""
WITH q AS (SELECT quantile_cont(amount, 0.25) AS q1, quantile_cont(amount, 0.75) AS q3 FROM sales_dirty)
SELECT sales_dirty.*, coalesce(amount < q1 - 1.5 * (q3 - q1) OR amount > q3 + 1.5 * (q3 - q1), false)
       AS outlier_amount FROM sales_dirty, q""", dirty=True))
def q_outliers_iqr(spark, sf):
    return VA.outliers_iqr(V.sales_dirty(spark, sf), ["amount"], 1.5)


def _z_sql(cols, thr=3.0):
    q = ", ".join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}" for c in cols)
    m = ", ".join(
        f"CASE WHEN count(CASE WHEN {c} BETWEEN q1_{c} AND q3_{c} THEN 1 END) > 0 "
        f"THEN avg(CASE WHEN {c} BETWEEN q1_{c} AND q3_{c} THEN {c} END) ELSE avg({c}) END AS mu_{c}, "
        f"CASE WHEN count(CASE WHEN {c} BETWEEN q1_{c} AND q3_{c} THEN 1 END) > 0 "
        f"THEN stddev_pop(CASE WHEN {c} BETWEEN q1_{c} AND q3_{c} THEN {c} END) ELSE stddev_pop({c}) END AS sd_{c}"
        for c in cols)
    f = ", ".join(f"CASE WHEN sd_{c} IS NULL OR sd_{c} = 0 THEN false ELSE coalesce(abs(({c} - mu_{c}) / sd_{c}) > {thr}, "
                  f"false) END AS outlier_{c}" for c in cols)
    return (f"WITH q AS (SELECT {q} FROM lineitem),\nm AS (SELECT {m} FROM lineitem, q)\n"
            f"SELECT l_orderkey, l_linenumber, {', '.join(cols)}, {f} FROM lineitem, m")


@register("outliers_zscore", w(_z_sql(["l_extendedprice", "l_quantity"])))
def q_outliers_zscore(spark, sf):
    li = V.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    return VA.outliers_zscore(li, ["l_extendedprice", "l_quantity"], 3.0)


# ---------------------------------------------------------------------------
# Integration (I*)
# ---------------------------------------------------------------------------

@register("source_tag", w("""
SELECT order_id, customer_id, order_date, amount, coalesce(source, 'db') AS source, country FROM sales_dirty""",
                          dirty=True))
def q_source_tag(spark, sf):
    return I.add_source(V.sales_dirty(spark, sf), "db")


@register("union_sources", w("""
SELECT order_id, customer_id, order_date, amount, 'db' AS source FROM sales
UNION ALL BY NAME
SELECT s.order_id, s.customer_id, s.order_date, s.amount, c.country, 'db' AS source
  FROM sales s JOIN customers c ON s.customer_id = c.customer_id
UNION ALL BY NAME
SELECT customer_id, country, 'file' AS source FROM customers
UNION ALL BY NAME
SELECT order_id, customer_id, order_date, amount, coalesce(source, 'api') AS source, country FROM sales_dirty
WHERE source = 'api' OR source IS NULL""", customers=True, dirty=True))
def q_union_sources(spark, sf):
    s, cu, d = V.sales(spark, sf), V.customers(spark, sf), V.sales_dirty(spark, sf)
    db1 = s.drop("source")
    db2 = s.drop("source").join(cu, "customer_id").select("order_id", "customer_id", "order_date", "amount", "country")
    api = d.where((F.col("source") == "api") | F.col("source").isNull())
    parts = [I.add_source(db1, "db"), I.add_source(db2, "db"), I.add_source(cu, "file"), I.add_source(api, "api")]
    return I.union_sources(parts)


@register("project_keep", w("SELECT order_id, amount FROM sales"))
def q_project_keep(spark, sf):
    return I.project_keep(V.sales(spark, sf), ["order_id", "amount", "not_a_column"])


@register("concat_columns", w("""
WITH a AS (SELECT row_number() OVER (ORDER BY order_id) - 1 AS row_idx, order_id, amount FROM sales),
b AS (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS row_idx, c_custkey, c_name FROM customer),
c AS (SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS row_idx, p_partkey, p_name, p_retailprice FROM part)
SELECT coalesce(a.row_idx, b.row_idx, c.row_idx) AS row_idx, order_id, amount, c_custkey, c_name, p_partkey, p_name,
       p_retailprice
FROM a FULL OUTER JOIN b ON a.row_idx = b.row_idx FULL OUTER JOIN c ON coalesce(a.row_idx, b.row_idx) = c.row_idx"""))
def q_concat_columns(spark, sf):
    frames = {"sales": V.sales(spark, sf).select("order_id", "amount"),
              "users": V.table(spark, sf, "customer").select("c_custkey", "c_name"),
              "products": V.table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")}
    order = {"sales": ["order_id"], "users": ["c_custkey"], "products": ["p_partkey"]}
    return I.concat_columns(frames, order)


# The two SQL source texts of the reference configuration.
SQL_SALES_SCAN = "SELECT order_id, customer_id, order_date, amount FROM sales"
SQL_SALES_JOIN_COUNTRY = """SELECT s.order_id, s.customer_id, s.order_date, s.amount, c.country
FROM sales s
JOIN customers c ON s.customer_id = c.customer_id"""


def _sql_source(spark, sf, text):
    from .sources.sql import read_sql_source
    V.register_all(spark, sf)
    return read_sql_source(spark, {"name": "q", "query": text})[0]


@register("sql_sales_scan", w(SQL_SALES_SCAN))
def q_sql_sales_scan(spark, sf):
    return _sql_source(spark, sf, SQL_SALES_SCAN)


@register("sales_join_country", w(SQL_SALES_JOIN_COUNTRY, customers=True))
def q_sales_join_country(spark, sf):
    return _sql_source(spark, sf, SQL_SALES_JOIN_COUNTRY)


def _stored_sales(spark, sf, frame):
    folder = scratch_path(spark, "stored")
    name = _table_name(spark, "sales_by_customer")
    return CO.store_by_key(frame, name, "customer_id", ["order_date", "order_id", "source"], buckets=8, path=folder), folder


@register("sales_join_stored", w(SQL_SALES_JOIN_COUNTRY, customers=True))
def q_sales_join_stored(spark, sf):
    fact, folder = _stored_sales(spark, sf, V.sales(spark, sf))
    dim = CO.store_dimension(V.customers(spark, sf), _table_name(spark, "customers_by_id"), "customer_id", 8, folder)
    out = CO.join_stored(spark, fact, dim, ["country"])
    return out.select(*q_sales_join_country(spark, sf).columns)


# ---------------------------------------------------------------------------
# Time series (T*)
# ---------------------------------------------------------------------------
from .operators import features as FE  # noqa: E402
from .operators import ml as ML  # noqa: E402
from .operators import timeseries as TS  # noqa: E402

_DAILY_CTES = """WITH d AS (SELECT order_date AS day, sum(amount) AS v FROM sales_dirty
           WHERE order_date IS NOT NULL AND amount IS NOT NULL GROUP BY 1),
cal AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM d),
s AS (SELECT cal.day, coalesce(v, 0.0) AS y FROM cal LEFT JOIN d ON cal.day = d.day)"""


@register("daily_revenue_dense", w(_DAILY_CTES + "\nSELECT day, round(y, 2) AS value FROM s", dirty=True))
def q_daily_revenue_dense(spark, sf):
    return rnd(TS.daily_dense(V.sales_dirty(spark, sf)), {"value": 2})


_DECOMP_CTES = _DAILY_CTES + """,
i AS (SELECT day, y, CAST(day - (SELECT min(day) FROM s) AS BIGINT) AS i FROM s),
nn AS (SELECT count(*) AS n FROM i),
m AS (SELECT i.*, n, CASE WHEN i >= 3 AND i <= n - 4
        THEN sum(y) OVER (ORDER BY i ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) / 7 END AS ma FROM i, nn),
f AS (SELECT regr_slope(ma, i) FILTER (WHERE i >= 3 AND i < least(9, n - 4)) AS kf,
             regr_intercept(ma, i) FILTER (WHERE i >= 3 AND i < least(9, n - 4)) AS bf,
             regr_slope(ma, i) FILTER (WHERE i >= greatest(n - 10, 3) AND i < n - 4) AS kb,
             regr_intercept(ma, i) FILTER (WHERE i >= greatest(n - 10, 3) AND i < n - 4) AS bb FROM m),
t AS (SELECT m.*, CASE WHEN i < 3 THEN kf * i + bf WHEN i > n - 4 THEN kb * i + bb ELSE ma END AS trend FROM m, f),
p AS (SELECT i % 7 AS md, avg(y - trend) AS pm FROM t GROUP BY 1),
pc AS (SELECT md, pm - (SELECT avg(pm) FROM p) AS seasonal FROM p)"""


@register("decompose_trend_interior", w(_DECOMP_CTES + """
SELECT day, round(ma, 2) AS trend FROM m WHERE ma IS NOT NULL""", dirty=True))
def q_decompose_trend_interior(spark, sf):
    comp = TS.decompose(TS.daily_dense(V.sales_dirty(spark, sf)))
    first = comp.agg(F.min("day"), F.max("day")).first()
    inner = comp.where((F.datediff("day", F.lit(first[0])) >= 3) & (F.datediff(F.lit(first[1]), "day") >= 3))
    return rnd(inner.select("day", "trend"), {"trend": 2})


@register("decompose_components", w(_DECOMP_CTES + """
SELECT day, round(y, 2) AS value, round(trend, 2) AS trend, round(seasonal, 2) AS seasonal,
       round(y - trend - seasonal, 2) AS resid FROM t JOIN pc ON t.i % 7 = pc.md""", dirty=True))
def q_decompose_components(spark, sf):
    comp = TS.decompose(TS.daily_dense(V.sales_dirty(spark, sf)))
    return rnd(comp, {"value": 2, "trend": 2, "seasonal": 2, "resid": 2})


@register("decompose_nan_counts", w(_DECOMP_CTES + """
SELECT count(*) FILTER (WHERE trend IS NULL OR isnan(trend)) AS trend_nan,
       count(*) FILTER (WHERE seasonal IS NULL OR isnan(seasonal)) AS seasonal_nan,
       count(*) FILTER (WHERE (y - trend - seasonal) IS NULL OR isnan(y - trend - seasonal)) AS resid_nan
FROM t JOIN pc ON t.i % 7 = pc.md""", dirty=True))
def q_decompose_nan_counts(spark, sf):
    return TS.decompose_nan_counts(TS.decompose(TS.daily_dense(V.sales_dirty(spark, sf))))


# ---------------------------------------------------------------------------
# Features (F*)
# ---------------------------------------------------------------------------

_CAL_SQL = ("coalesce(isodow(order_date) - 1, 0)::BIGINT AS dow, coalesce(month(order_date), 0)::BIGINT AS month, "
            "coalesce(CAST(isodow(order_date) - 1 >= 5 AS BIGINT), 0) AS is_weekend")
_HIST_W = ("(PARTITION BY customer_id ORDER BY order_date NULLS FIRST, order_id NULLS FIRST, source NULLS FIRST "
           "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
_HIST_SQL = (f"CASE WHEN customer_id IS NULL THEN 0 ELSE coalesce(count(*) OVER {_HIST_W}, 0) END AS _cnt_prev, "
             f"round(CASE WHEN customer_id IS NULL THEN 0.0 ELSE coalesce(sum(amount) OVER {_HIST_W} / "
             f"nullif(count(amount) OVER {_HIST_W}, 0), 0.0) END, 6) AS _amount_prev_mean")
_SRC_SQL = ("coalesce(source = 'api', false) AS src_api, coalesce(source = 'db', false) AS src_db, "
            "coalesce(source = 'file', false) AS src_file")


@register("feat_calendar", w(f"SELECT *, {_CAL_SQL} FROM sales_dirty", dirty=True))
def q_feat_calendar(spark, sf):
    return FE.calendar_features(V.sales_dirty(spark, sf))


@register("feat_source_dummies", w(f"""
SELECT order_id, customer_id, order_date, amount, country, {_SRC_SQL} FROM sales_dirty""", dirty=True))
def q_feat_source_dummies(spark, sf):
    return FE.source_dummies(V.sales_dirty(spark, sf))


@register("feat_prev_count", w(f"""
SELECT order_id, customer_id, order_date, amount, source,
       CASE WHEN customer_id IS NULL THEN 0 ELSE coalesce(count(*) OVER {_HIST_W}, 0) END AS _cnt_prev
FROM sales_dirty""", dirty=True))
def q_feat_prev_count(spark, sf):
    return FE.history_features(V.sales_dirty(spark, sf).drop("country")).drop("_amount_prev_mean")


@register("feat_prev_mean", w(f"SELECT *, {_HIST_SQL} FROM sales_dirty", dirty=True))
def q_feat_prev_mean(spark, sf):
    return rnd(FE.history_features(V.sales_dirty(spark, sf)), {"_amount_prev_mean": 6})


@register("feat_history_stored", w(f"""
SELECT *, {_HIST_SQL} FROM (SELECT order_id, customer_id, order_date, amount, source FROM sales_dirty)""", dirty=True))
def q_feat_history_stored(spark, sf):
    fact, _ = _stored_sales(spark, sf, V.sales_dirty(spark, sf).drop("country"))
    return rnd(CO.stored_history(spark, fact), {"_amount_prev_mean": 6})


@register("build_features", w(f"""
SELECT customer_id, order_date, amount, country, {_CAL_SQL}, {_HIST_SQL}, {_SRC_SQL} FROM sales_dirty""",
                              dirty=True))
def q_build_features(spark, sf):
    return rnd(FE.build_features(V.sales_dirty(spark, sf)), {"_amount_prev_mean": 6})


@register("high_value_target", w("""
SELECT *, CAST(coalesce(amount >= (SELECT quantile_cont(amount, 0.8) FROM sales_dirty), false) AS INTEGER)
       AS "high_value_q0.80" FROM sales_dirty""", dirty=True))
def q_high_value_target(spark, sf):
    return FE.classification_target(V.sales_dirty(spark, sf), None, 0.8)[0]


@register("select_numeric", w(f"""
SELECT CAST(dow AS DOUBLE) AS dow, CAST(month AS DOUBLE) AS month, CAST(is_weekend AS DOUBLE) AS is_weekend,
       CAST(_cnt_prev AS DOUBLE) AS _cnt_prev, _amount_prev_mean
FROM (SELECT *, {_CAL_SQL}, {_HIST_SQL} FROM sales_dirty)""", dirty=True))
def q_select_numeric(spark, sf):
    x, y = FE.classification_target(FE.build_features(V.sales_dirty(spark, sf)), None, 0.8)
    return rnd(FE.select_numeric(x, [y, "amount"])[0], {"_amount_prev_mean": 6})


_SPLIT_SQL = "substr(md5('42' || CAST({k} AS VARCHAR)), 1, 8) < '40000000'"


@register("split_stratified", w("""
WITH x AS (SELECT order_id, CAST(coalesce(amount >= (SELECT quantile_cont(amount, 0.8) FROM sales_dirty), false)
           AS INTEGER) AS label, substr(md5('42' || CAST(order_id AS VARCHAR)), 1, 8) AS h FROM sales_dirty),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, order_id) - 1 AS rk,
             count(*) OVER (PARTITION BY label) AS n FROM x)
SELECT order_id, label, rk < ceil(0.25 * n) AS is_test FROM r""", dirty=True))
def q_split_stratified(spark, sf):
    x, y = FE.classification_target(V.sales_dirty(spark, sf), None, 0.8)
    return FE.split_stratified(x.select("order_id", F.col(f"`{y}`").alias("label")), "label", "order_id")


@register("split_random", w(f"SELECT order_id, amount, {_SPLIT_SQL.format(k='order_id')} AS is_test FROM sales"))
def q_split_random(spark, sf):
    return FE.split(V.sales(spark, sf).select("order_id", "amount"), "order_id")


# ---------------------------------------------------------------------------
# Sources and sinks (S*) and the multi-source load (I4)
# ---------------------------------------------------------------------------
from .session import cut_lineage, scratch_path  # noqa: E402
from .operators import colocated as CO  # noqa: E402
from .sources import files as SF  # noqa: E402
from .sources import json_docs as SJ  # noqa: E402
from .sources import json_infer as SI  # noqa: E402
from .sources import tables as ST  # noqa: E402
from .sources.sql import read_sql_source  # noqa: E402
from .streaming import landing as SL  # noqa: E402

_SALES_SCHEMA = "order_id BIGINT, customer_id BIGINT, order_date DATE, amount DOUBLE, source STRING"


@register("src_csv", w("SELECT * FROM sales"))
def q_src_csv(spark, sf):
    path = SF.write_csv(V.sales(spark, sf), scratch_path(spark, "sales_csv"))
    return SF.read_csv(spark, path, _SALES_SCHEMA)


SQL_SOURCE_AGG = "SELECT source, count(*) AS n, round(sum(amount), 2) AS revenue FROM sales GROUP BY source"


@register("src_sql_query", w(SQL_SOURCE_AGG))
def q_src_sql_query(spark, sf):
    V.register_all(spark, sf)
    return read_sql_source(spark, {"name": "agg", "query": SQL_SOURCE_AGG})[0]


def _event_docs(spark, sf):
    """One landed API response per event: the list sits under response.items,
    next to a scalar and a nested object, so the root walk and the "first list
    member" rule are both exercised."""
    e = V.table(spark, sf, "events")
    doc = F.concat(F.lit('{"meta": {"id": '), F.col("event_id").cast("string"),
                   F.lit('}, "response": {"count": 2, "items": ['), F.col("props"),
                   F.lit(', {"k": '), F.col("user_id").cast("string"), F.lit("}]}}"))
    return e.select("event_id", doc.alias("doc"))


@register("json_root_rows", w("""
SELECT event_id, CAST(0 AS INTEGER) AS pos, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
UNION ALL
SELECT event_id, CAST(1 AS INTEGER) AS pos, user_id AS k FROM events"""))
def q_json_root_rows(spark, sf):
    return SJ.extract_root_rows(_event_docs(spark, sf), "doc", "response", "k BIGINT", keep=["event_id"])


@register("json_flatten", w("""
SELECT event_id, event_type AS "meta.type", value AS "meta.detail.value",
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS "meta.detail.props.k" FROM events"""))
def q_json_flatten(spark, sf):
    e = V.table(spark, sf, "events")
    nested = e.select("event_id", F.struct(
        F.col("event_type").alias("type"),
        F.struct(F.col("value").alias("value"), F.from_json("props", "k BIGINT").alias("props")).alias("detail"))
        .alias("meta"))
    return SJ.flatten(nested)


def _mixed_docs(spark, sf):
    """Documents as an unversioned API would return them: the items' fields and kinds differ from row to row."""
    e = V.table(spark, sf, "events")
    quoted = lambda c: F.to_json(F.array(F.col(c)))
    text = lambda c: quoted(c).substr(F.lit(2), F.length(quoted(c)) - 2)  # noqa: E731 — a JSON string
    num = lambda c: F.col(c).cast("string")
    item = (F.when(F.col("event_id") % 4 == 0, F.concat(F.lit('{"k": '), text("event_type"), F.lit(', "who": {"id": '), num("user_id"), F.lit("}}")))
             .when(F.col("event_id") % 4 == 1, F.concat(F.lit('{"v": '), num("value"), F.lit(', "who": {"id": '), num("user_id"),
                                                         F.lit(', "kind": '), text("event_type"), F.lit("}}")))
             .when(F.col("event_id") % 4 == 2, F.concat(F.lit('{"who": '), text("event_type"), F.lit(', "tags": ['), num("user_id"), F.lit(", 1]}")))
             .otherwise(F.lit("{}")))
    return e.select("event_id", F.concat(F.lit('{"data": {"count": 2, "items": ['), F.col("props"), F.lit(", "), item, F.lit("]}}")).alias("doc"))


@register("json_infer_rows", w("""
SELECT event_id, CAST(0 AS INTEGER) AS pos, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS tags, CAST(NULL AS DOUBLE) AS v,
       CAST(NULL AS VARCHAR) AS who, CAST(NULL AS BIGINT) AS "who.id", CAST(NULL AS VARCHAR) AS "who.kind" FROM events
UNION ALL
SELECT event_id, CAST(1 AS INTEGER) AS pos, CASE WHEN event_id % 4 = 0 THEN event_type END, CASE WHEN event_id % 4 = 2 THEN '[' || user_id || ',1]' END,
       CASE WHEN event_id % 4 = 1 THEN value END, CASE WHEN event_id % 4 = 2 THEN event_type END,
       CASE WHEN event_id % 4 < 2 THEN user_id END, CASE WHEN event_id % 4 = 1 THEN event_type END FROM events"""))
def q_json_infer_rows(spark, sf):
    rows = SI.infer_rows(_mixed_docs(spark, sf), "doc", root="data.items", keep=["event_id"])
    return rows.withColumn("tags", F.to_json("tags"))


@register("stream_landing", w("""
SELECT event_id, ts, user_id, event_type, value FROM events
WHERE event_id % 10 <> 7 OR ts > (SELECT date_trunc('milliseconds', max(ts)) FROM events WHERE event_id % 10 <> 7) - INTERVAL 5 DAY"""))
def q_stream_landing(spark, sf):
    """Three drops of event files: the first half of the month, the second one, then what had been held back together
    with rows sent once more.  What comes more than five days behind is late."""
    e = V.table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    held = F.col("event_id") % 10 == 7
    first = F.col("ts") < F.lit("2024-01-16").cast("timestamp")
    base = scratch_path(spark, "landing")
    for drop in (e.where(first & ~held), e.where(~first & ~held), e.where(held | (F.col("event_id") % 5 == 0))):
        drop.write.mode("append").option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(f"{base}/in")
        SL.land_files(spark, f"{base}/in", e.schema, f"{base}/table", f"{base}/state", "ts", ["event_id"], delay="5 days",
                      options={"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"})
    return SL.landed(spark, f"{base}/table").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _landed_pages(spark, sf, page_size=100):
    """Paged API responses as landed: endpoint = event type, page p holds that
    type's events among ids [p·page_size, (p+1)·page_size); each page carries the
    endpoint's total.  Pages are bounded by page_size by construction."""
    e = V.table(spark, sf, "events").select(
        F.col("event_type").alias("endpoint"), F.floor(F.col("event_id") / page_size).cast("long").alias("page_no"),
        "event_id", "value")
    tot = e.groupBy("endpoint").agg(F.count(F.lit(1)).alias("total"))
    pages = (e.groupBy("endpoint", "page_no")
              .agg(F.collect_list(F.struct("event_id", "value")).alias("items"))
              .join(tot, "endpoint"))
    return pages.select("endpoint", "page_no",
                        F.to_json(F.struct(F.col("items").alias("data"), F.col("total").alias("total"))).alias("doc"))


@register("json_pages_assemble", w("""
WITH e AS (SELECT event_type AS endpoint, CAST(floor(event_id / 100) AS BIGINT) AS page_no, event_id, value FROM events),
tot AS (SELECT endpoint, count(*) AS total FROM e GROUP BY endpoint),
p AS (SELECT endpoint, page_no, count(*) AS n FROM e GROUP BY endpoint, page_no),
c AS (SELECT p.*, total, sum(n) OVER (PARTITION BY p.endpoint ORDER BY page_no
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
      FROM p JOIN tot ON p.endpoint = tot.endpoint),
s AS (SELECT endpoint, min(CASE WHEN n < 12 OR cum >= total THEN page_no END) AS stop FROM c GROUP BY endpoint)
SELECT e.endpoint, e.page_no, event_id, value FROM e JOIN s ON e.endpoint = s.endpoint
WHERE (s.stop IS NULL OR e.page_no <= s.stop)"""))
def q_json_pages_assemble(spark, sf):
    out = SJ.assemble_pages(_landed_pages(spark, sf), "doc", "page_no", "event_id BIGINT, value DOUBLE",
                            root="data", key_cols=["endpoint"], limit=12, max_pages=None, total_path="total")
    return out.drop("pos")


@register("sink_parquet_roundtrip", w("SELECT * FROM sales_dirty", dirty=True))
def q_sink_parquet_roundtrip(spark, sf):
    path = SF.save_parquet(V.sales_dirty(spark, sf), scratch_path(spark, "sales_dirty_pq"), partition_by=["source"])
    return SF.read_parquet(spark, path)


def _table_name(spark, stem):
    return f"{stem}_{scratch_path(spark, 't').rsplit('-', 1)[-1]}"


@register("sink_table_append", w("SELECT * FROM sales UNION ALL SELECT * FROM sales"))
def q_sink_table_append(spark, sf):
    name = _table_name(spark, "sales_copy")
    loc = scratch_path(spark, name)
    s = V.sales(spark, sf)
    for _ in range(2):      # stored bucketed by customer, as a reusable join input would be
        ST.save_table(s, name, "append", bucket_by=(8, ["customer_id"]), path=loc)
    return spark.table(name)


@register("load_typed_csv", w("SELECT CAST(customer_id AS INTEGER) AS customer_id, country FROM customers",
                              customers=True))
def q_load_typed_csv(spark, sf):
    path = SF.write_csv(V.customers(spark, sf), scratch_path(spark, "customers_csv"))
    return SF.load_typed_csv(spark, path, "customers")


@register("export_metrics_kv", w("""
SELECT 'sales_count' AS metric, CAST((SELECT count(*) FROM sales) AS VARCHAR) AS value
UNION ALL SELECT 'customers_count', CAST((SELECT count(*) FROM customers) AS VARCHAR)
UNION ALL SELECT * FROM (SELECT 'top_country_' || c.country, CAST(count(*) AS VARCHAR) FROM sales s
  JOIN customers c ON s.customer_id = c.customer_id GROUP BY c.country ORDER BY count(*) DESC, c.country LIMIT 3)""",
                                 customers=True))
def q_export_metrics_kv(spark, sf):
    return ST.export_metrics(V.sales(spark, sf), V.customers(spark, sf))


@register("export_metrics_runs", w("""
WITH m AS (SELECT 'sales_count' AS metric, CAST((SELECT count(*) FROM sales) AS VARCHAR) AS value
UNION ALL SELECT 'customers_count', CAST((SELECT count(*) FROM customers) AS VARCHAR)
UNION ALL SELECT * FROM (SELECT 'top_country_' || c.country, CAST(count(*) AS VARCHAR) FROM sales s
  JOIN customers c ON s.customer_id = c.customer_id GROUP BY c.country ORDER BY count(*) DESC, c.country LIMIT 3))
SELECT metric, value, run_id FROM m, (SELECT unnest(['first', '2024-01']) AS run_id)""", customers=True))
def q_export_metrics_runs(spark, sf):
    path, args = scratch_path(spark, "metrics"), (V.sales(spark, sf), V.customers(spark, sf))
    for run in ("first", "2024-01", "first"):            # the first run is done again
        out = ST.export_metrics_run(*args, path, run)
    return out


def _api_docs(spark, sf):
    """The API part of the load: one landed response per 'api' order, rows under "data"."""
    s = V.sales(spark, sf).where(F.col("source") == "api")
    item = F.struct("order_id", "customer_id", "order_date", "amount")
    return s.select(F.to_json(F.struct(F.array(item).alias("data"))).alias("doc"))


def load_config(spark, sf) -> dict:
    """A reference-shaped source configuration over the test tables: two SQL
    sources, one CSV and one JSON (landed API) source."""
    V.register_all(spark, sf)
    csv_path = SF.write_csv(V.customers(spark, sf), scratch_path(spark, "customers_csv"))
    return {"sources": {
        "sql": [{"name": "sales", "query": SQL_SALES_SCAN, "target": "sales"},
                {"name": "sales_join_country", "query": SQL_SALES_JOIN_COUNTRY, "target": "sales"}],
        "csv": [{"name": "customers", "path": csv_path, "schema": "customer_id BIGINT, country STRING",
                 "target": "customers"},
                {"name": "missing", "path": scratch_path(spark, "does_not_exist")}],
        "json": [{"name": "sales_api", "docs": _api_docs(spark, sf), "doc_col": "doc", "json_root": "data",
                  "item_schema": "order_id BIGINT, customer_id BIGINT, order_date DATE, amount DOUBLE",
                  "target": "sales"}],
    }}


@register("multi_source_load", w("""
SELECT order_id, customer_id, order_date, amount, 'db' AS source FROM sales
UNION ALL BY NAME
SELECT s.order_id, s.customer_id, s.order_date, s.amount, c.country, 'db' AS source
  FROM sales s JOIN customers c ON s.customer_id = c.customer_id
UNION ALL BY NAME
SELECT customer_id, country, 'file' AS source FROM customers
UNION ALL BY NAME
SELECT order_id, customer_id, order_date, amount, 'api' AS source FROM sales WHERE source = 'api'""",
                                 customers=True))
def q_multi_source_load(spark, sf):
    return I.load_sources(spark, load_config(spark, sf))[0]


# ---------------------------------------------------------------------------
# Model evaluation on a rule score (M3–M8, M12, M13): exact in both engines
# ---------------------------------------------------------------------------

def _rule_scored(spark, sf):
    x, y = FE.classification_target(V.sales_dirty(spark, sf), None, 0.8)
    x = FE.split(x, "order_id")
    num = (F.col("order_id") * 7919) % 500 + F.least(F.floor(F.coalesce(F.col("amount"), F.lit(0.0)) / 1000),
                                                     F.lit(499))
    return x.where("is_test").select("order_id", F.col(f"`{y}`").alias("label"), (num / 1000.0).alias("score"))


_RULE_SQL = """WITH x AS (SELECT order_id, CAST(coalesce(amount >= (SELECT quantile_cont(amount, 0.8) FROM sales_dirty),
       false) AS INTEGER) AS label,
       ((order_id * 7919) % 500 + least(floor(coalesce(amount, 0.0) / 1000), 499)) / CAST(1000 AS DOUBLE) AS score,
       substr(md5('42' || CAST(order_id AS VARCHAR)), 1, 8) < '40000000' AS is_test FROM sales_dirty),
sc AS (SELECT order_id, label, score, CAST(score >= 0.5 AS INTEGER) AS pred FROM x WHERE is_test)"""


@register("threshold_predict", w(_RULE_SQL + "\nSELECT * FROM sc", dirty=True))
def q_threshold_predict(spark, sf):
    return ML.threshold_predict(_rule_scored(spark, sf))


@register("clf_metrics", w(_RULE_SQL + """
SELECT round(count(*) FILTER (WHERE label = pred) / count(*), 10) AS accuracy,
       round(coalesce(count(*) FILTER (WHERE label = 1 AND pred = 1) /
             nullif(count(*) FILTER (WHERE pred = 1), 0), 0.0), 10) AS precision,
       round(coalesce(count(*) FILTER (WHERE label = 1 AND pred = 1) /
             nullif(count(*) FILTER (WHERE label = 1), 0), 0.0), 10) AS recall,
       round(coalesce(2 * count(*) FILTER (WHERE label = 1 AND pred = 1) /
             nullif(2 * count(*) FILTER (WHERE label = 1 AND pred = 1) + count(*) FILTER (WHERE label <> pred), 0),
             0.0), 10) AS f1,
       count(*) AS n_test FROM sc""", dirty=True))
def q_clf_metrics(spark, sf):
    m = ML.classification_metrics(ML.threshold_predict(_rule_scored(spark, sf)), "label")
    return rnd(m, {c: 10 for c in ("accuracy", "precision", "recall", "f1")})


@register("roc_auc", w(_RULE_SQL + """,
g AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
      FROM sc GROUP BY score),
r AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM g)
SELECT round(sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)), 10) AS roc_auc FROM r""", dirty=True))
def q_roc_auc(spark, sf):
    return rnd(ML.roc_auc(_rule_scored(spark, sf), "label"), {"roc_auc": 10})


@register("confusion_matrix", w(_RULE_SQL + """,
cells AS (SELECT CAST(l AS INTEGER) AS label, CAST(p AS INTEGER) AS pred FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1))
          t(l, p))
SELECT cells.label, cells.pred, count(sc.order_id) AS count FROM cells
LEFT JOIN sc ON cells.label = sc.label AND cells.pred = sc.pred GROUP BY cells.label, cells.pred""", dirty=True))
def q_confusion_matrix(spark, sf):
    return ML.confusion_matrix(ML.threshold_predict(_rule_scored(spark, sf)), "label")


_CURVE_SQL = _RULE_SQL + """,
g AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
      FROM sc GROUP BY score),
r AS (SELECT score, sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
             sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
             sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM g)"""


@register("roc_curve", w(_CURVE_SQL + """
SELECT score AS threshold, round(fp / N, 10) AS fpr, round(tp / P, 10) AS tpr FROM r""", dirty=True))
def q_roc_curve(spark, sf):
    return rnd(ML.roc_curve(_rule_scored(spark, sf), "label"), {"fpr": 10, "tpr": 10})


@register("pr_curve", w(_CURVE_SQL + """
SELECT score AS threshold, round(tp / (tp + fp), 10) AS precision, round(tp / P, 10) AS recall FROM r""",
                        dirty=True))
def q_pr_curve(spark, sf):
    return rnd(ML.pr_curve(_rule_scored(spark, sf), "label"), {"precision": 10, "recall": 10})


def _rule_regression(spark, sf):
    h = FE.split(FE.history_features(V.sales_dirty(spark, sf)), "order_id")
    return h.where(F.col("is_test") & F.col("amount").isNotNull()).select(
        "order_id", "amount", F.round("_amount_prev_mean", 2).alias("prediction"))


_REG_SQL = f"""WITH h AS (SELECT order_id, amount, round(CASE WHEN customer_id IS NULL THEN 0.0 ELSE
       coalesce(sum(amount) OVER {_HIST_W} / nullif(count(amount) OVER {_HIST_W}, 0), 0.0) END, 2) AS prediction,
       substr(md5('42' || CAST(order_id AS VARCHAR)), 1, 8) < '40000000' AS is_test FROM sales_dirty),
t AS (SELECT order_id, amount, prediction FROM h WHERE is_test AND amount IS NOT NULL)"""


@register("reg_metrics", w(_REG_SQL + """
SELECT round(sqrt(avg((amount - prediction) * (amount - prediction))), 4) AS rmse,
       round(avg(abs(amount - prediction)), 4) AS mae,
       round(1 - sum((amount - prediction) * (amount - prediction)) /
             sum((amount - (SELECT avg(amount) FROM t)) * (amount - (SELECT avg(amount) FROM t))), 6) AS r2,
       count(*) AS n_test FROM t""", dirty=True))
def q_reg_metrics(spark, sf):
    return rnd(ML.regression_metrics(_rule_regression(spark, sf), "amount"), {"rmse": 4, "mae": 4, "r2": 6})


@register("residual_histogram", w(_REG_SQL + """,
x AS (SELECT amount - prediction AS x FROM t),
st AS (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
              CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM x),
b AS (SELECT CAST(least(floor((x - lo) / ((hi - lo) / 30)) + 1, 30) AS INTEGER) AS bin FROM x, st),
c AS (SELECT bin, count(*) AS cnt FROM b GROUP BY bin),
g AS (SELECT CAST(i AS INTEGER) AS bin FROM range(1, 31) t(i))
SELECT g.bin, round(lo + (g.bin - 1) * ((hi - lo) / 30), 4) AS bin_lo, round(lo + g.bin * ((hi - lo) / 30), 4) AS bin_hi,
       CAST(coalesce(cnt, 0) AS BIGINT) AS count
FROM g CROSS JOIN st LEFT JOIN c ON g.bin = c.bin""", dirty=True))
def q_residual_histogram(spark, sf):
    return rnd(ML.residual_histogram(_rule_regression(spark, sf), "amount"), {"bin_lo": 4, "bin_hi": 4})


@register("actual_vs_pred_bins", w(_REG_SQL + """,
st AS (SELECT least(min(amount), min(prediction)) AS lo, greatest(max(amount), max(prediction)) AS hi FROM t)
SELECT CAST(least(floor((amount - lo) / ((hi - lo) / 20)) + 1, 20) AS INTEGER) AS actual_bin,
       CAST(least(floor((prediction - lo) / ((hi - lo) / 20)) + 1, 20) AS INTEGER) AS pred_bin, count(*) AS count
FROM t, st GROUP BY ALL""", dirty=True))
def q_actual_vs_pred_bins(spark, sf):
    return ML.actual_vs_predicted_bins(_rule_regression(spark, sf), "amount")


# ---------------------------------------------------------------------------
# Model training (M1, M2, M9–M11, M14–M16): rows-only checks + pytest properties
# ---------------------------------------------------------------------------

def _ml_features(spark, sf):
    clean = C.run_cleaning(V.sales_dirty(spark, sf)).df
    return cut_lineage(FE.build_features(FE.split(clean, "order_id")))     # read once per pass of the training


@register("logreg_train")
def q_logreg_train(spark, sf):
    x, y = FE.classification_target(_ml_features(spark, sf), None, 0.8)
    feats = FE.numeric_feature_columns(x, drop=[y, "amount"])
    model = ML.train_logreg(x.where(~F.col("is_test")), feats, y)
    scored = ML.score_logreg(model, x.where(F.col("is_test")), feats)
    auc = ML.roc_auc(scored, y).scalar()
    n_train = x.where(~F.col("is_test")).agg(F.count(F.lit(1))).scalar()
    return ML.classification_metrics(scored, y).select("*", auc.alias("roc_auc"), F.lit(y).alias("target"),
                                                       n_train.alias("n_train"))


def _lineitem_numeric(spark, sf):
    return V.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        (F.col("l_returnflag") == "R").cast("int").alias("is_returned"))


@register("logreg_plain")
def q_logreg_plain(spark, sf):
    li = _lineitem_numeric(spark, sf).withColumn("_key", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    return ML.train_classification(li.drop("l_orderkey", "l_linenumber"), "is_returned", key="_key")


@register("logreg_coeffs")
def q_logreg_coeffs(spark, sf):
    x, y = FE.classification_target(_ml_features(spark, sf), None, 0.8)
    feats = FE.numeric_feature_columns(x, drop=[y, "amount"])
    return ML.logreg_coefficients(ML.train_logreg(x.where(~F.col("is_test")), feats, y), feats)


# The queries grow all of the operators' trees (250 and 200), to depth 10: see the
# README for what the library's own default depth, 30, costs.
QUERY_DEPTH = 10


def _rf(spark, sf):
    x = _ml_features(spark, sf).where(F.col("amount").isNotNull())
    feats = FE.numeric_feature_columns(x, drop=["amount"])
    model = ML.train_forest(x.where(~F.col("is_test")), feats, "amount", max_depth=QUERY_DEPTH)
    return x, feats, model


@register("rf_train")
def q_rf_train(spark, sf):
    x, feats, model = _rf(spark, sf)
    n_train = x.where(~F.col("is_test")).agg(F.count(F.lit(1))).scalar()
    return ML.regression_metrics(ML.predict_forest(model, x.where(F.col("is_test")), feats), "amount") \
             .select("*", n_train.alias("n_train"))


@register("rf_plain")
def q_rf_plain(spark, sf):
    li = _lineitem_numeric(spark, sf).withColumn("_key", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    return ML.train_regression(li.drop("l_orderkey", "l_linenumber", "is_returned"), "l_extendedprice", key="_key",
                               max_depth=QUERY_DEPTH)


@register("rf_importance")
def q_rf_importance(spark, sf):
    _, feats, model = _rf(spark, sf)
    return ML.forest_importances(model, feats)


#: What a gradient may be off zero where the solver ends.
OPTIMUM = 1e-3


def _at_optimum(names):
    return "SELECT unnest([" + ", ".join(f"'{n}'" for n in names) + "]) AS parameter, true AS at_optimum"


@register("logreg_optimum", w(_at_optimum(["dow", "month", "is_weekend", "_cnt_prev", "_amount_prev_mean", "(intercept)"])))
def q_logreg_optimum(spark, sf):
    x, y = FE.classification_target(_ml_features(spark, sf), None, 0.8)
    feats = FE.numeric_feature_columns(x, drop=[y, "amount"])
    train = x.where(~F.col("is_test"))
    got = ML.logreg_optimality(ML.train_logreg(train, feats, y), train, feats, y)
    return got.select("parameter", (F.abs("gradient") < OPTIMUM).alias("at_optimum"))


@register("logreg_plain_optimum", w(_at_optimum(["l_quantity", "l_extendedprice", "l_discount", "l_tax", "(intercept)"])))
def q_logreg_plain_optimum(spark, sf):
    train = _lineitem_numeric(spark, sf).drop("l_orderkey", "l_linenumber")
    feats = FE.numeric_feature_columns(train, drop=["is_returned"])
    got = ML.logreg_optimality(ML.train_logreg(train, feats, "is_returned", balanced=False), train, feats, "is_returned", balanced=False)
    return got.select("parameter", (F.abs("gradient") < OPTIMUM).alias("at_optimum"))


def _steps(spark, sf):
    """Lines whose target is a step function of one feature: the best tree is known, and every tree must find it."""
    return V.table(spark, sf, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("_key"),
                                                 F.col("l_linenumber").cast("double").alias("line"), "l_discount",
                                                 (F.col("l_linenumber") * F.col("l_linenumber")).cast("double").alias("target"))


@register("rf_steps", w("""
SELECT CAST(l_linenumber AS DOUBLE) AS line, count(*) AS n, CAST(l_linenumber * l_linenumber AS DOUBLE) AS least,
       CAST(l_linenumber * l_linenumber AS DOUBLE) AS most FROM lineitem GROUP BY l_linenumber"""))
def q_rf_steps(spark, sf):
    x = _steps(spark, sf)
    model = ML.train_forest(x, ["line", "l_discount"], "target")
    got = ML.predict_forest(model, x, ["line", "l_discount"])
    return rnd(got.groupBy("line").agg(F.count("*").alias("n"), F.min("prediction").alias("least"), F.max("prediction").alias("most")),
               {"least": 6, "most": 6})


@register("rf_steps_importance", w("SELECT 'l_discount' AS feature, 0.0::DOUBLE AS importance UNION ALL SELECT 'line', 1.0::DOUBLE"))
def q_rf_steps_importance(spark, sf):
    model = ML.train_forest(_steps(spark, sf), ["line", "l_discount"], "target")
    return rnd(ML.forest_importances(model, ["line", "l_discount"]), {"importance": 6})


@register("rf_plain_steps", w("SELECT 'RandomForestRegressor' AS model, 0.0::DOUBLE AS rmse, 0.0::DOUBLE AS mae, 1.0::DOUBLE AS r2"))
def q_rf_plain_steps(spark, sf):
    x = _steps(spark, sf)
    return rnd(ML.train_regression(x, "target", key="_key"), {"rmse": 6, "mae": 6, "r2": 6})


@register("logreg_coeffs_order", w("""
SELECT unnest(range(1, 6))::BIGINT AS place, true AS in_order, true AS is_abs"""))
def q_logreg_coeffs_order(spark, sf):
    x, y = FE.classification_target(_ml_features(spark, sf), None, 0.8)
    feats = FE.numeric_feature_columns(x, drop=[y, "amount"])
    got = ML.logreg_coefficients(ML.train_logreg(x.where(~F.col("is_test")), feats, y), feats).collect()      # one row per feature
    rows = [(k + 1, k == 0 or got[k - 1].abs_coef >= r.abs_coef, abs(r.coef) == r.abs_coef) for k, r in enumerate(got)]
    return spark.createDataFrame(rows, "place long, in_order boolean, is_abs boolean")


@register("model_roundtrip")
def q_model_roundtrip(spark, sf):
    x, y = FE.classification_target(_ml_features(spark, sf), None, 0.8)
    feats = FE.numeric_feature_columns(x, drop=[y, "amount"])
    model = ML.train_logreg(x.where(~F.col("is_test")), feats, y)
    path = ML.save_model(model, scratch_path(spark, "logreg_model"))
    return ML.score_logreg(ML.load_model(path), x.where(F.col("is_test")), feats).select(F.col(f"`{y}`"), "score",
                                                                                          "pred")


@register("ml_stage_metrics")
def q_ml_stage_metrics(spark, sf):
    res = ML.run_ml(_ml_features(spark, sf), {"ml": {"enabled": True, "regression": {"max_depth": QUERY_DEPTH}}})
    parts = [ST.metrics_to_kv(res["metrics"][task]).select(F.lit(task).alias("task"), "metric", "value")
             for task in ("classification", "regression")]
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out


@register("ml_split_counts", w("""
WITH raw AS (
  SELECT order_id, amount FROM sales
  UNION ALL SELECT s.order_id, s.amount FROM sales s JOIN customers c ON s.customer_id = c.customer_id
  UNION ALL SELECT NULL, NULL FROM customers
  UNION ALL SELECT order_id, amount FROM sales WHERE source = 'api'),
x AS (SELECT CAST(coalesce(amount >= (SELECT quantile_cont(amount, 0.8) FROM raw), false) AS INTEGER) AS label FROM raw)
SELECT label, count(*) AS n, CAST(count(*) - ceil(0.25 * count(*)) AS BIGINT) AS n_train,
       CAST(ceil(0.25 * count(*)) AS BIGINT) AS n_test
FROM x GROUP BY label""", customers=True))
def q_ml_split_counts(spark, sf):
    """Rows with NULL order ids (the stacked customers) are split as all others."""
    sales = I.load_sources(spark, load_config(spark, sf))[0]
    clean = cut_lineage(C.run_cleaning(sales).df.select("order_id", "amount"))      # read by every scan of the quantile
    x, y = FE.classification_target(clean, None, 0.8)
    x = FE.split_stratified(x, y, "order_id")
    return x.groupBy(F.col(f"`{y}`").alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("is_test")).alias("n_train"), F.count_if("is_test").alias("n_test"))


@register("split_null_keys", w(f"""
WITH x AS (SELECT CASE WHEN order_id % 4 = 0 THEN NULL ELSE order_id END AS k FROM sales)
SELECT count(*) AS n, count(*) AS n_split, count(*) FILTER (WHERE k IS NOT NULL AND {_SPLIT_SQL.format(k='k')}) AS n_test_keyed
FROM x"""))
def q_split_null_keys(spark, sf):
    x = V.sales(spark, sf).withColumn("k", F.when(F.col("order_id") % 4 != 0, F.col("order_id"))).select("k", "order_id", "amount")
    x = FE.split(x, "k")
    return x.agg(F.count(F.lit(1)).alias("n"), F.count("is_test").alias("n_split"),
                 F.count_if(F.col("k").isNotNull() & F.col("is_test")).alias("n_test_keyed"))


@register("model_roundtrip_diff", w(f"""
SELECT count(*) FILTER (WHERE {_SPLIT_SQL.format(k='order_id')}) AS n_scored, CAST(0 AS BIGINT) AS n_differ FROM sales_dirty""",
                                    dirty=True))
def q_model_roundtrip_diff(spark, sf):
    """Scores before and after the model was written and read back."""
    x, y = FE.classification_target(cut_lineage(_ml_features(spark, sf).withColumn("_row", F.monotonically_increasing_id())), None, 0.8)
    feats = FE.numeric_feature_columns(x, drop=[y, "amount", "_row"])
    model = ML.train_logreg(x.where(~F.col("is_test")), feats, y)
    again = ML.load_model(ML.save_model(model, scratch_path(spark, "logreg_model")))
    a, b = (ML.score_logreg(m, x.where(F.col("is_test")), feats).select("_row", F.col("score").alias(s))
            for m, s in ((model, "a"), (again, "b")))
    return a.join(b, "_row", "full_outer").agg(F.count(F.lit(1)).alias("n_scored"),
                                               F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("n_differ"))


@register("list_to_json_whole", """
SELECT o_orderkey, '[' || o_orderkey || ',' || o_custkey || ']' AS ids,
       '{"key":' || o_orderkey || ',"status":"' || o_orderstatus || '"}' AS head,
       '{"' || o_orderstatus || '":' || o_custkey || '}' AS by_status
FROM orders""")
def q_list_to_json_whole(spark, sf):
    """E4 on arrays, structs and maps of whole numbers and text."""
    o = V.table(spark, sf, "orders")
    return EN.list_to_json(o.select(
        "o_orderkey", F.array(F.col("o_orderkey").cast("long"), F.col("o_custkey").cast("long")).alias("ids"),
        F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("key")).alias("head"),
        F.create_map("o_orderstatus", "o_custkey").alias("by_status")))


@register("impute_int_mean", """
WITH x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END AS cust FROM orders)
SELECT o_orderkey, round(coalesce(CAST(cust AS DOUBLE), (SELECT avg(cust) FROM x)), 6) AS cust FROM x""")
def q_impute_int_mean(spark, sf):
    """C7 on a whole-number column with gaps: its mean is not cut to a whole number."""
    x = V.table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey")).alias("cust"))
    return rnd(C.impute(x, "mean"), {"cust": 6})


@register("coerce_big_ids", """
SELECT o_orderkey + 9007199254740993 AS order_id, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey + 9007199254740993 END AS customer_id
FROM orders""")
def q_coerce_big_ids(spark, sf):
    """C1 on ids beyond 2^53, as whole numbers and as text; text that is no number becomes NULL."""
    big, o = F.lit(9007199254740993), V.table(spark, sf, "orders")
    return C.coerce_types(o.select((F.col("o_orderkey") + big).alias("order_id"), F.when(
        F.col("o_orderkey") % 2 == 0, (F.col("o_custkey") + big).cast("string")).otherwise(F.lit("none")).alias("customer_id")))


# ---------------------------------------------------------------------------
# Composites
# ---------------------------------------------------------------------------
from .plans import pipeline as PL  # noqa: E402
from .plans import reporting as RP  # noqa: E402


@register("report_bundle_index", w("""
WITH cl AS (SELECT order_id, customer_id, order_date, amount, source FROM sales_dirty),
m AS (SELECT source, date_trunc('month', order_date) AS p, round(sum(amount), 2) AS v FROM cl
      WHERE order_date IS NOT NULL AND amount IS NOT NULL AND source IS NOT NULL GROUP BY 1, 2),
dd AS (SELECT source, order_date AS p, sum(amount) AS v FROM cl
       WHERE order_date IS NOT NULL AND amount IS NOT NULL AND source IS NOT NULL GROUP BY 1, 2),
cu AS (SELECT source, p, round(sum(v) OVER (PARTITION BY source ORDER BY p ROWS UNBOUNDED PRECEDING), 2) AS v FROM dd),
lm AS (SELECT source, list(v ORDER BY p) AS vs FROM m GROUP BY source),
lc AS (SELECT source, list(v ORDER BY p) AS vs FROM cu GROUP BY source),
days AS (SELECT CAST(max(order_date) - min(order_date) + 1 AS BIGINT) AS n FROM cl
         WHERE order_date IS NOT NULL AND amount IS NOT NULL)
SELECT 'aggregates_by_source' AS name, (SELECT count(DISTINCT source) FROM cl) AS rows
UNION ALL SELECT 'overall_metrics', 1
UNION ALL SELECT 'basic_stats', 1
UNION ALL SELECT 'amount_histogram', 30
UNION ALL SELECT 'amount_histogram_trim', 30
UNION ALL SELECT 'box_stats', (SELECT count(DISTINCT source) FROM cl WHERE amount IS NOT NULL)
UNION ALL SELECT 'orders_per_day', (SELECT count(DISTINCT order_date) FROM cl)
UNION ALL SELECT 'top_customers', least(10, (SELECT count(DISTINCT customer_id) FROM cl))
UNION ALL SELECT 'customer_totals', 1
UNION ALL SELECT 'monthly_revenue', (SELECT count(DISTINCT date_trunc('month', order_date)) FROM cl
                                     WHERE amount IS NOT NULL)
UNION ALL SELECT 'daily_revenue', (SELECT n FROM days)
UNION ALL SELECT 'basic_stats_by_source', (SELECT count(DISTINCT source) FROM cl)
UNION ALL SELECT 'monthly_revenue_by_source', (SELECT count(*) FROM m)
UNION ALL SELECT 'source_share', (SELECT count(DISTINCT coalesce(source, 'NA')) FROM cl)
UNION ALL SELECT 'cumulative_revenue_by_source', (SELECT count(*) FROM dd)
UNION ALL SELECT 'identical_monthly_series', (SELECT count(*) FROM lm a JOIN lm b ON a.source < b.source AND a.vs = b.vs)
UNION ALL SELECT 'identical_cumulative_series', (SELECT count(*) FROM lc a JOIN lc b
                                                 ON a.source < b.source AND a.vs = b.vs)
UNION ALL SELECT 'decomposition', (SELECT n FROM days)""", dirty=True))
def q_report_bundle_index(spark, sf):
    raw = V.sales_dirty(spark, sf)
    # as in the pipeline: the cleaned frame feeds every table, so it is pinned once
    clean = cut_lineage(C.run_cleaning(raw).df)
    return RP.bundle_index(RP.run_reporting(raw, clean))


@register("pipeline_summary", w("""
WITH raw AS (
  SELECT order_id, customer_id, order_date, amount, 'db' AS source FROM sales
  UNION ALL BY NAME
  SELECT s.order_id, s.customer_id, s.order_date, s.amount, c.country, 'db' AS source
    FROM sales s JOIN customers c ON s.customer_id = c.customer_id
  UNION ALL BY NAME
  SELECT customer_id, country, 'file' AS source FROM customers
  UNION ALL BY NAME
  SELECT order_id, customer_id, order_date, amount, 'api' AS source FROM sales WHERE source = 'api')
SELECT count(*) AS rows_raw, count(*) AS rows_clean,
       CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS BIGINT) AS duplicates_raw,
       count(*) FILTER (WHERE amount IS NULL) AS missing_amount_clean,
       round(sum(amount), 2) AS total_revenue_clean, round(avg(amount), 4) AS avg_order_amount_clean,
       count(DISTINCT source) AS n_sources, min(order_date) AS date_min, max(order_date) AS date_max,
       CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS BIGINT) AS sales_duplicates,
       count(*) FILTER (WHERE order_id IS NULL) AS missing_order_id,
       count(*) FILTER (WHERE customer_id IS NULL) AS missing_customer_id,
       count(*) FILTER (WHERE order_date IS NULL) AS missing_order_date,
       count(*) FILTER (WHERE amount IS NULL) AS missing_amount,
       count(*) FILTER (WHERE country IS NULL) AS missing_country
FROM raw""", customers=True))
def q_pipeline_summary(spark, sf):
    res = PL.run_pipeline(spark, load_config(spark, sf))
    return rnd(res["summary"], {"total_revenue_clean": 2, "avg_order_amount_clean": 4})


# ---------------------------------------------------------------------------
# Time joins, ranks on hot keys, table differences
# ---------------------------------------------------------------------------
from .operators import asof as AO  # noqa: E402
from .operators import diff as DI  # noqa: E402
from .operators import intervals as IV  # noqa: E402
from .operators import ranking as RK  # noqa: E402


@register("asof_purchase_view", w("""
SELECT p.event_id, p.user_id, p.ts, p.value, v.ts AS ts_right, v.value AS value_right
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND v.ts <= p.ts"""))
def q_asof_purchase_view(spark, sf):
    e = V.table(spark, sf, "events").select("event_id", "user_id", "ts", "value", "event_type")
    bought = e.where("event_type = 'purchase'").drop("event_type")
    return AO.asof_join(bought, e.where("event_type = 'view'"), "user_id", "ts", "ts", ["value"])


@register("asof_sale_before", w("""
SELECT a.order_id, a.customer_id, a.order_date, a.amount, max(b.order_date) AS order_date_right,
       max({'d': b.order_date, 'a': b.amount}).a AS amount_right
FROM (SELECT * FROM sales WHERE source = 'file') a
LEFT JOIN (SELECT * FROM sales WHERE source = 'db') b ON a.customer_id = b.customer_id AND b.order_date < a.order_date
GROUP BY 1, 2, 3, 4"""))
def q_asof_sale_before(spark, sf):
    s = V.sales(spark, sf)
    return AO.asof_join(s.where("source = 'file'").drop("source"), s.where("source = 'db'"), "customer_id", "order_date", "order_date",
                        ["amount"], allow_equal=False)


def _promotions(spark, sf):
    """Stand-in windows: one per fiftieth order, open for up to 40 days, now and then for a year."""
    s = V.sales(spark, sf).where("order_id % 50 = 0")
    days = F.when(F.col("order_id") % 1000 == 0, 365).otherwise(F.col("order_id") % 41).cast("int")
    return s.select(F.col("order_id").alias("promotion_id"), F.col("order_date").alias("opens"), F.date_add("order_date", days).alias("closes"), "source")


@register("interval_promotions", w("""
WITH p AS (SELECT order_id AS promotion_id, order_date AS opens, source,
                  order_date + CAST(CASE WHEN order_id % 1000 = 0 THEN 365 ELSE order_id % 41 END AS INTEGER) AS closes
           FROM sales WHERE order_id % 50 = 0)
SELECT s.order_id, s.order_date, s.source, p.promotion_id, p.opens, p.closes
FROM sales s JOIN p ON s.source = p.source AND s.order_date BETWEEN p.opens AND p.closes"""))
def q_interval_promotions(spark, sf):
    s = V.sales(spark, sf).select("order_id", "order_date", "source")
    return IV.interval_join(s, _promotions(spark, sf), ("order_date", "order_date"), ("opens", "closes"), keys=["source"], base=8)


@register("interval_overlaps", w("""
WITH p AS (SELECT order_id AS promotion_id, order_date AS opens,
                  order_date + CAST(CASE WHEN order_id % 1000 = 0 THEN 365 ELSE order_id % 41 END AS INTEGER) AS closes
           FROM sales WHERE order_id % 50 = 0)
SELECT a.promotion_id, a.opens, count(*) AS overlapping
FROM p a JOIN p b ON a.opens <= b.closes AND b.opens <= a.closes GROUP BY 1, 2"""))
def q_interval_overlaps(spark, sf):
    p = _promotions(spark, sf).drop("source")
    return IV.interval_join(p, p, ("opens", "closes"), ("opens", "closes"), base=8).groupBy("promotion_id", "opens").agg(F.count("*").alias("overlapping"))


_LI_KEY = ["l_orderkey", "l_linenumber"]


def _priced_lines(spark, sf):
    return V.table(spark, sf, "lineitem").select(*_LI_KEY, "l_returnflag", "l_quantity", "l_extendedprice")


@register("rank_lines", w("""
SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity, l_extendedprice,
       rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) AS rank,
       dense_rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) AS dense_rank FROM lineitem"""))
def q_rank_lines(spark, sf):
    return RK.ranked(_priced_lines(spark, sf), "l_returnflag", ["l_quantity"])


@register("number_lines", w("""
SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity, l_extendedprice,
       row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice, l_quantity, l_orderkey, l_linenumber) AS row_number,
       count(*) OVER (PARTITION BY l_returnflag) AS group_rows FROM lineitem"""))
def q_number_lines(spark, sf):
    return RK.numbered(_priced_lines(spark, sf), "l_returnflag", ["l_extendedprice", "l_quantity", *_LI_KEY])


@register("ntile_lines", w("""
SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity, l_extendedprice, CAST(ntile(7) OVER
       (PARTITION BY l_returnflag ORDER BY l_extendedprice, l_quantity, l_orderkey, l_linenumber) AS INTEGER) AS ntile FROM lineitem"""))
def q_ntile_lines(spark, sf):
    return RK.ntiles(_priced_lines(spark, sf), "l_returnflag", ["l_extendedprice", "l_quantity", *_LI_KEY], 7)


@register("lag_lead_lines", w("""
SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity, l_extendedprice, lag(l_extendedprice) OVER t AS lag, lead(l_extendedprice, 2) OVER t AS lead
FROM lineitem WINDOW t AS (PARTITION BY l_returnflag ORDER BY l_extendedprice, l_quantity, l_orderkey, l_linenumber)"""))
def q_lag_lead_lines(spark, sf):
    by = ["l_extendedprice", "l_quantity", *_LI_KEY]
    out = RK.shifted(_priced_lines(spark, sf), "l_returnflag", by, "l_extendedprice", 1, "lag")
    return RK.shifted(out, "l_returnflag", by, "l_extendedprice", -2, "lead")


@register("diff_sales", w("""
WITH o AS (SELECT order_id, customer_id, order_date, amount, source FROM sales),
n AS (SELECT order_id, any_value(customer_id) AS customer_id, any_value(order_date) AS order_date, any_value(amount) AS amount, any_value(source) AS source,
             count(*) AS c FROM sales_dirty GROUP BY order_id),
j AS (SELECT o.order_id, CASE WHEN c > 1 THEN 'customer_id,order_date,amount,source' ELSE concat_ws(',',
             CASE WHEN o.customer_id IS DISTINCT FROM n.customer_id THEN 'customer_id' END,
             CASE WHEN o.order_date IS DISTINCT FROM n.order_date THEN 'order_date' END,
             CASE WHEN o.amount IS DISTINCT FROM n.amount THEN 'amount' END,
             CASE WHEN o.source IS DISTINCT FROM n.source THEN 'source' END) END AS columns
      FROM o JOIN n ON o.order_id = n.order_id)
SELECT order_id, 'changed' AS change, columns FROM j WHERE columns <> ''
UNION ALL SELECT order_id, 'added', NULL FROM n WHERE order_id NOT IN (SELECT order_id FROM o)
UNION ALL SELECT order_id, 'removed', NULL FROM o WHERE order_id NOT IN (SELECT order_id FROM n)""", dirty=True))
def q_diff_sales(spark, sf):
    out = DI.table_diff(V.sales(spark, sf), V.sales_dirty(spark, sf), ["order_id"], buckets=1024)
    return out.withColumn("columns", F.array_join("columns", ","))


# ---------------------------------------------------------------------------
# Iceberg cube, merged states
# ---------------------------------------------------------------------------
from .operators import cube as CU  # noqa: E402
from .plans import states as SB  # noqa: E402


@register("iceberg_cube_sales", w("""
SELECT source, country, month, dow, CAST(grouping(source, country, month, dow) AS INTEGER) AS level, count(*) AS n, round(sum(amount), 2) AS total
FROM (SELECT s.source, c.country, CAST(month(order_date) AS INTEGER) AS month, CAST(isodow(order_date) - 1 AS INTEGER) AS dow, amount
      FROM sales s JOIN customers c ON s.customer_id = c.customer_id)
GROUP BY CUBE (source, country, month, dow) HAVING count(*) >= 50""", customers=True))
def q_iceberg_cube_sales(spark, sf):
    s = V.sales(spark, sf).join(V.customers(spark, sf), "customer_id")
    s = s.select("source", "country", F.month("order_date").alias("month"), F.weekday("order_date").alias("dow"), "amount")
    return rnd(CU.iceberg_cube(s, ["source", "country", "month", "dow"], 50, {"total": F.col("amount")}), {"total": 2})


@register("basic_stats_batches", w(_describe_sql(_LI_NUM, "lineitem")))
def q_basic_stats_batches(spark, sf):
    li, folder = V.table(spark, sf, "lineitem"), scratch_path(spark, "states")
    for k in range(3):                   # three deliveries of the table
        SB.append_batch(li.where(F.col("l_orderkey") % 3 == k), _LI_NUM, folder, f"{k}")
    return rnd(SB.merged_stats(spark, _LI_NUM, folder), _DESC_ROUND)
