"""Executive readout operators.

Top-k outputs carry a ``rank`` computed *after* the limit, so the rank
window only ever sees k rows; the limit itself plans as a distributed
``TakeOrderedAndProject`` (per-task top-k, then a k-row merge).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accounthealth.functions.money import money_sum, score_avg
from accounthealth.functions.text import money_text, percent_text

HISTOGRAM_BINS = 20
HISTOGRAM_WIDTH = 5


def health_risk(scored: DataFrame) -> DataFrame:
    """Health joined to risk on ``account_id``: the scored rows with an id."""
    return scored.filter(F.col("account_id").isNotNull())


def ranked_top(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """Top ``k`` rows by ``order`` with a 1-based ``rank``."""
    top = df.orderBy(*order).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def kpis(scored: DataFrame) -> DataFrame:
    """Portfolio KPIs; high-risk counts the ``high`` band only."""
    return health_risk(scored).agg(
        F.count(F.lit(1)).alias("accounts"),
        score_avg("health_score").alias("avg_health"),
        score_avg("churn_risk_score").alias("avg_churn_risk"),
        money_sum("recognized_revenue").alias("recognized_revenue"),
        F.sum(F.when(F.col("churn_risk_band") == "high", 1).otherwise(0))
        .alias("high_risk_accounts"),
    )


def top_risk(scored: DataFrame, k: int = 8) -> DataFrame:
    """R2: highest risk first, then revenue; account id breaks ties."""
    order = [F.col("churn_risk_score").desc(), F.col("recognized_revenue").desc(),
             F.col("account_id").asc()]
    cols = ["account_id", "account_name", "segment", "churn_risk_score", "health_score",
            "support_tickets", "failed_invoice_amount"]
    return ranked_top(health_risk(scored).select(*cols, "recognized_revenue"), order, k) \
        .select("rank", *cols)


def retention_listing(retention: DataFrame) -> DataFrame:
    """Every segment/plan row by revenue, with readout labels."""
    grr = F.col("gross_revenue_retention")
    order = [F.col("recognized_revenue").desc(), F.col("segment").asc_nulls_last(),
             F.col("plan").asc_nulls_last()]
    return retention.select(
        "segment",
        F.coalesce(F.col("plan"), F.lit("none")).alias("plan"),
        "accounts", "recognized_revenue", "gross_revenue_retention",
        money_text(F.col("recognized_revenue")).alias("revenue_text"),
        F.when(grr.isNull(), "n/a").otherwise(percent_text(grr)).alias("grr_text"),
        F.row_number().over(Window.orderBy(*order)).alias("rank"),
    )


def health_by_segment(health: DataFrame) -> DataFrame:
    """Mean health per (non-null) segment."""
    return (health.filter(F.col("segment").isNotNull()).groupBy("segment")
            .agg(score_avg("health_score").alias("avg_health_score")))


def churn_histogram(risk: DataFrame) -> DataFrame:
    """20 bins of width 5 over the risk score (100 falls in the last);
    empty bins report zero."""
    score = F.col("churn_risk_score")
    counts = (risk.filter(score.isNotNull())
              .groupBy(F.floor(F.least(score, F.lit(99.999)) / HISTOGRAM_WIDTH)
                       .cast("int").alias("bin"))
              .agg(F.count(F.lit(1)).alias("accounts")))
    spine = risk.sparkSession.range(HISTOGRAM_BINS).select(F.col("id").cast("int").alias("bin"))
    return spine.join(counts, "bin", "left").select(
        "bin",
        (F.col("bin") * HISTOGRAM_WIDTH).alias("bin_start"),
        ((F.col("bin") + 1) * HISTOGRAM_WIDTH).alias("bin_end"),
        F.coalesce(F.col("accounts"), F.lit(0).cast("bigint")).alias("accounts"),
    )


# Steps that automatic bins may have: 1, 2 and 5 times powers of ten.
BIN_STEPS = [float(f"{m}e{e}") for e in range(-9, 16) for m in (1, 2, 5)]


def automatic_histogram(rows: DataFrame, column: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """R5 with bins from the data's range: the smallest step of ``BIN_STEPS`` whose multiples
    cut smallest to largest value into at most ``bins`` bins. Empty bins report zero; null,
    NaN and infinite values are left out; no value, no bin."""
    value = F.col(column).cast("double")
    known = rows.select(value.alias("v")).filter(
        F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") < float("inf")))
    # one row: the smallest and the largest value choose the step
    ends = known.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    fits = F.filter(F.array(*[F.lit(s) for s in BIN_STEPS]),
                    lambda s: F.floor(F.col("hi") / s) - F.floor(F.col("lo") / s) < bins)
    chosen = ends.select("lo", "hi", F.array_min(fits).alias("step")).select(
        F.struct("step", F.floor(F.col("lo") / F.col("step")).alias("first"),
                 F.floor(F.col("hi") / F.col("step")).alias("last")).alias("c"))
    step = chosen.select("c.step").scalar()
    counts = known.groupBy(F.floor(F.col("v") / step).alias("at")).agg(
        F.count(F.lit(1)).alias("rows"))
    spine = chosen.filter("c.step is not null").select(
        "c.step", "c.first", F.explode(F.sequence("c.first", "c.last")).alias("at"))
    return spine.join(counts, "at", "left").select(
        (F.col("at") - F.col("first")).cast("int").alias("bin"),
        (F.col("at") * F.col("step")).alias("bin_start"),
        ((F.col("at") + 1) * F.col("step")).alias("bin_end"),
        F.coalesce("rows", F.lit(0).cast("long")).alias("accounts"))


def retention_series(retention: DataFrame) -> DataFrame:
    """GRR per non-null segment and plan (null plan shown as ``none``)."""
    return retention.filter(F.col("segment").isNotNull()).select(
        "segment", F.coalesce(F.col("plan"), F.lit("none")).alias("plan"),
        "gross_revenue_retention")


def adoption_top(adoption: DataFrame, k: int = 12) -> DataFrame:
    """Highest adoption rates."""
    order = [F.col("adoption_rate").desc_nulls_last(), F.col("segment").asc_nulls_last(),
             F.col("event_name").asc_nulls_last()]
    return ranked_top(adoption, order, k).select(
        "rank", "segment", "event_name", "events", "adopting_accounts", "adoption_rate")
