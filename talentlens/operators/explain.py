"""Per-row explanation strings (E1–E6), built from native string functions.

Applied after the top-k limit, so only k rows are formatted.  Numbers are
formatted as Python does: ``{x:.1f}`` rounds the exact binary value half-even
(``numeric.scaled_half_even``), ``{x:.0%}`` rounds ``x*100`` half-even.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, RankConfig
from ..functions.numeric import fmt_one_decimal, fmt_percent
from ..functions.text import py_strip


def title_fragment() -> Column:
    title = F.coalesce(F.col("profile_current_title"), F.lit("Professional"))
    years = F.coalesce(F.col("profile_years_of_exp"), F.lit(0.0))
    return F.concat(title, F.lit(" with "), fmt_one_decimal(years), F.lit(" years experience"))


def company_fragment(cfg: RankConfig = DEFAULT) -> Column:
    company = F.coalesce(F.col("profile_current_company"), F.lit("their current company"))
    parts = F.split(F.coalesce(F.col("career_all_companies"), F.lit("")), r"\|")
    products = list(cfg.product_companies)
    first_product = F.try_element_at(F.filter(parts, lambda c: F.lower(py_strip(c)).isin(*products)), F.lit(1))
    return (
        F.when((F.col("feat_dim6_has_product_exp") > 0) & first_product.isNotNull(),
               F.concat(F.lit("including product company experience at "), first_product))
         .when(F.col("feat_dim6_consulting_only") > 0, F.concat(F.lit("currently at "), company, F.lit(" (consulting)")))
         .otherwise(F.concat(F.lit("at "), company))
    )


def domain_fragment() -> Column:
    r = F.coalesce(F.col("feat_dim3_retrieval_desc_count"), F.lit(0))
    p = F.coalesce(F.col("feat_dim2_production_kw_count"), F.lit(0))
    return (
        F.when((r >= 3) & (p >= 3), F.lit("career demonstrates hands-on ranking/retrieval system deployment"))
         .when(r >= 2, F.lit("has relevant search and retrieval experience"))
         .when(p >= 3, F.lit("strong production ML experience though not specifically in retrieval"))
         .otherwise(F.lit("limited direct retrieval or production ML experience"))
    )


def behaviour_fragment() -> Column:
    rr = F.coalesce(F.col("sig_response_rate"), F.lit(0.5))
    notice = F.coalesce(F.col("sig_notice_period_days"), F.lit(30))
    n = notice.cast("long").cast("string")
    parts = F.array_compact(F.array(
        F.when(rr >= 0.7, F.concat(fmt_percent(rr), F.lit(" recruiter response rate")))
         .when(rr < 0.2, F.concat(F.lit("low recruiter response rate ("), fmt_percent(rr), F.lit(")"))),
        F.when(notice <= 30, F.concat(n, F.lit("-day notice period")))
         .when(notice > 90, F.concat(F.lit("extended "), n, F.lit("-day notice period"))),
    ))
    return F.when(F.size(parts) > 0, F.array_join(parts, "; ")).otherwise(F.lit("moderate engagement signals"))


def concern_fragment(cfg: RankConfig = DEFAULT, rank_col: str = "rank") -> Column:
    notice = F.col("sig_notice_period_days")
    concerns = F.array_compact(F.array(
        F.when(F.col("feat_dim7_is_india") == 0,
               F.concat(F.lit("located outside India ("), F.coalesce(F.col("profile_country"), F.lit("unknown")), F.lit(")"))),
        F.when(notice > 90, F.concat(notice.cast("long").cast("string"),
                                     F.lit("-day notice period exceeds preferred 30 days"))),
        F.when(F.col("feat_dim6_consulting_only") > 0, F.lit("consulting-only background")),
        F.when(F.col("feat_dim2_production_kw_count") == 0,
               F.lit("no evidence of production ML deployment in career history")),
    ))
    return (
        F.when(F.size(concerns) == 0, F.lit(""))
         .when(F.col(rank_col) <= cfg.minor_concern_rank,
               F.concat(F.lit("Minor concern: "), F.element_at(concerns, 1), F.lit(".")))
         .otherwise(F.concat(F.lit("Notable gap: "), F.array_join(F.slice(concerns, 1, 2), "; "), F.lit(".")))
    )


def reasoning(cfg: RankConfig = DEFAULT, rank_col: str = "rank") -> Column:
    """Fragments joined, concern appended, truncated to the character budget."""
    body = F.concat(
        F.concat_ws("; ", F.concat(title_fragment(), F.lit(" "), company_fragment(cfg)),
                    domain_fragment(), behaviour_fragment()),
        F.lit("."),
    )
    concern = concern_fragment(cfg, rank_col)
    text = F.when(concern == "", body).otherwise(F.concat(body, F.lit(" "), concern))
    limit = cfg.max_reasoning_chars
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit - 3), F.lit("..."))).otherwise(text)


def add_reasoning(ranked: DataFrame, cfg: RankConfig = DEFAULT) -> DataFrame:
    """Same text as :func:`reasoning`, with each fragment computed once as a column."""
    cols = list(ranked.columns)
    staged = ranked.select("*", company_fragment(cfg).alias("_company"), concern_fragment(cfg).alias("_concern"))
    body = F.concat(F.concat_ws("; ", F.concat(title_fragment(), F.lit(" "), F.col("_company")),
                                domain_fragment(), behaviour_fragment()), F.lit("."))
    staged = staged.withColumn("_text", F.when(F.col("_concern") == "", body)
                               .otherwise(F.concat(body, F.lit(" "), F.col("_concern"))))
    limit = cfg.max_reasoning_chars
    text = F.col("_text")
    out = F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit - 3), F.lit("..."))).otherwise(text)
    return staged.select(*cols, out.alias("reasoning"))
