"""Expected coverage by linear trends, and divergence anomalies.

A group's fit and the spread around it come from one pass of algebraic sums (count, means, central sums of squares and
products), so a group of any size is one partial row per task; the fits are joined back to the rows. No group is held
in a window and no model leaves the cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustgrid.operators.joins import null_safe_join
from trustgrid.operators.score import round_half_up


def fit_trends(series: DataFrame, group_cols: Sequence[str], t_col: str, y_col: str) -> DataFrame:
    """One row per group: fit_rows, slope, intercept and residual_sd of y ~ a + b * t, from six sums in one aggregation.

    The residuals of a least-squares line add up to 0, so their sample variance is (Syy - Sxy^2 / Sxx) / (n - 1). A
    group whose t does not vary has no line.
    """
    y, t = F.col(y_col).cast("double"), F.col(t_col).cast("double")
    sums = series.groupBy(*group_cols).agg(
        F.regr_count(y, t).alias("_n"), F.regr_avgx(y, t).alias("_x"), F.regr_avgy(y, t).alias("_y"),
        F.regr_sxx(y, t).alias("_xx"), F.regr_syy(y, t).alias("_yy"), F.regr_sxy(y, t).alias("_xy"))
    slope = F.when(F.col("_xx") > 0, F.col("_xy") / F.col("_xx"))
    rest = F.greatest(F.lit(0.0), F.col("_yy") - F.col("_slope") * F.col("_xy"))
    return sums.withColumn("_slope", slope).select(
        *group_cols, F.col("_n").alias("fit_rows"), F.col("_slope").alias("slope"),
        (F.col("_y") - F.col("_slope") * F.col("_x")).alias("intercept"),
        F.sqrt(F.try_divide(rest, F.col("_n") - 1)).alias("residual_sd"))


def trend_anomalies(series: DataFrame, group_cols: Sequence[str], t_col: str, y_col: str,
                    k: float = 2.0, scale: int = 6) -> DataFrame:
    """Fit y ~ a + b*t per group; flag points whose residual exceeds k sample SDs.

    With an indicator among ``group_cols`` all indicators are fitted in the same pass. Null groups are a group.
    """
    fits = fit_trends(series, group_cols, t_col, y_col).select(
        *group_cols, F.col("slope").alias("_slope"), F.col("intercept").alias("_intercept"), F.col("residual_sd").alias("_sd"))
    y, t = F.col(y_col).cast("double"), F.col(t_col).cast("double")
    fitted = null_safe_join(series, fits, group_cols).withColumn("_pred", F.col("_intercept") + F.col("_slope") * t)
    fitted = fitted.withColumn("_resid", y - F.col("_pred"))
    return fitted.select(
        *group_cols, t_col, y_col,
        round_half_up(F.col("_slope"), scale).alias("trend_slope"),
        round_half_up(F.col("_intercept"), scale).alias("trend_intercept"),
        round_half_up(F.col("_pred"), scale).alias("predicted"),
        round_half_up(F.col("_resid"), scale).alias("residual"),
        F.coalesce(F.abs(F.col("_resid")) > F.lit(k) * F.col("_sd"), F.lit(False)).alias("is_anomaly"),
    )


def expected_values(df: DataFrame, key_cols: Sequence[str], x_col: str, y_col: str, k: float = 2.0,
                    scale: int = 6) -> DataFrame:
    """Expected y from x, fitted on the rows where both are present.

    The fit is one global aggregate (slope and intercept from algebraic
    sums, so partial aggregation does the work) used as a scalar subquery:
    it runs once and its value is inlined, with no join. Rows missing y get
    the prediction as a flagged fill; rows with y whose residual exceeds k
    sample standard deviations are divergent.
    """
    x, y = F.col(x_col).cast("double"), F.col(y_col).cast("double")
    fit = df.select(F.struct(F.regr_slope(y, x).alias("b"), F.regr_intercept(y, x).alias("a"),
                             F.regr_count(y, x).alias("n"))).scalar()
    staged = df.withColumns({"_pred": fit["a"] + fit["b"] * x, "fit_rows": fit["n"]})
    staged = staged.withColumn("_resid", y - F.col("_pred"))
    sd = staged.select(F.stddev_samp("_resid")).scalar()
    return staged.select(
        *key_cols, x_col, y_col,
        round_half_up(F.col("_pred"), scale).alias("expected_value"),
        round_half_up(F.coalesce(y, F.col("_pred")), scale).alias("value_or_expected"),
        (y.isNull() & F.col("_pred").isNotNull()).alias("is_predicted_fill"),
        round_half_up(F.col("_resid"), scale).alias("residual"),
        F.coalesce(F.abs(F.col("_resid")) > F.lit(k) * sd, F.lit(False)).alias("is_divergent"),
        "fit_rows",
    )
