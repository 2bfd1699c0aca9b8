"""Returns, moving statistics, correlation and trend fits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickseries.operators.windows import ROWS_PER_TASK, ordered_window


def _frame(w, rows: int):
    return w.rowsBetween(-(rows - 1), 0)


def _full(w, rows: int) -> Column:
    """True once the frame holds `rows` rows."""
    return F.count(F.lit(1)).over(_frame(w, rows)) == rows


def simple_returns(df: DataFrame, by: Sequence[str], order_by: Sequence[str], prices: Sequence[str], **size) -> DataFrame:
    """`<price>_return` = price / previous price - 1; null on the first row and after a price of zero."""

    def make(price):
        return lambda w: F.try_divide(F.col(price), F.lag(price).over(w)) - 1

    return ordered_window(df, by, order_by, 1, {f"{p}_return": make(p) for p in prices}, **size)


def moving_average(df, by: Sequence[str], order_by: Sequence[str], column: str, rows: int, **size) -> DataFrame:
    """`moving_avg` over the last `rows` rows, or over those there are."""
    return ordered_window(
        df, by, order_by, rows - 1, {"moving_avg": lambda w: F.avg(column).over(_frame(w, rows))}, **size
    )


def rolling_stddev(df, by: Sequence[str], order_by: Sequence[str], column: str, rows: int, **size) -> DataFrame:
    """`rolling_stddev` (sample) over exactly `rows` rows; null before there are as many."""
    return ordered_window(
        df,
        by,
        order_by,
        rows - 1,
        {"rolling_stddev": lambda w: F.when(_full(w, rows), F.stddev_samp(column).over(_frame(w, rows)))},
        **size,
    )


def rolling_correlation(df, by: Sequence[str], order_by: Sequence[str], a: str, b: str, rows: int, **size) -> DataFrame:
    """`rolling_corr` of two columns over exactly `rows` rows; null before there are as many."""
    return ordered_window(
        df,
        by,
        order_by,
        rows - 1,
        {"rolling_corr": lambda w: F.when(_full(w, rows), F.corr(a, b).over(_frame(w, rows)))},
        **size,
    )


def correlation(df: DataFrame, a: str, b: str, by: Sequence[Column | str] = ()) -> DataFrame:
    """Pearson correlation overall or per group, with the number of pairs; null below two pairs."""
    pairs = F.count_if(F.col(a).isNotNull() & F.col(b).isNotNull())
    return df.groupBy(*by).agg(pairs.alias("n_pairs"), F.when(pairs > 1, F.corr(a, b)).alias("corr"))


def trend(df: DataFrame, by: Sequence[str], y: str, x: str) -> DataFrame:
    """Least-squares line of y on x per group, in one aggregation."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
    )


def lag_features(df, by: Sequence[str], order_by: Sequence[str], column: str, lags: int, **size) -> DataFrame:
    """`lag_1` ... `lag_n` of a column."""

    def make(k):
        return lambda w: F.lag(column, k).over(w)

    return ordered_window(df, by, order_by, lags, {f"lag_{k}": make(k) for k in range(1, lags + 1)}, **size)


def fit_linear(df: DataFrame, label: str, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Least squares of the label on the features, per group: the `by` columns, n_rows, intercept and `coef_<feature>`.

    Rows with a missing label or feature are left out. One aggregation with partial sums gives the means and covariances; each
    group then solves one small system. Coefficients are null where a group's features determine none.
    """
    names = [label, *features]
    rows = df.where(reduce(and_, (F.col(c).isNotNull() for c in names)))
    means = F.array(*[F.avg(c) for c in names])
    pairs = F.array(*[F.covar_pop(a, b) for a in names for b in names])
    sums = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), means.alias("_means"), pairs.alias("_pairs"))

    fitted = sums.withColumn("_c", _solver()("_means", "_pairs"))
    coefficients = [F.col("_c")[i + 1].alias(f"coef_{f}") for i, f in enumerate(features)]
    return fitted.select(*by, "n_rows", F.col("_c")[0].alias("intercept"), *coefficients)


def _solver():
    @F.pandas_udf("array<double>")
    def solve(means: pd.Series, pairs: pd.Series) -> pd.Series:
        return pd.Series([_solve(np.array(m, float), np.array(p, float)) for m, p in zip(means, pairs)], dtype=object)

    return solve


def _solve(means: np.ndarray, pairs: np.ndarray) -> list[float | None]:
    """[intercept, coefficients] from the means and covariances of label and features."""
    k = len(means)
    square = pairs.reshape(k, k)
    if not np.isfinite(square).all() or np.linalg.matrix_rank(square[1:, 1:]) < k - 1:
        return [None] * k
    b = np.linalg.solve(square[1:, 1:], square[1:, 0])
    return [float(means[0] - b @ means[1:]), *map(float, b)]


def predict_linear(df: DataFrame, fitted: DataFrame, features: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Adds `predicted` by the coefficients of the row's group; null where a feature or the fit is missing."""
    value = reduce(add, (F.col(f"coef_{f}") * F.col(f) for f in features), F.col("intercept"))
    coefficients = fitted.select(*by, "intercept", *[f"coef_{f}" for f in features])
    joined = df.join(coefficients, list(by), "left")
    return joined.withColumn("predicted", value).drop("intercept", *[f"coef_{f}" for f in features])


def walk_forward(
    df: DataFrame, label: str, features: Sequence[str], by: Sequence[str], period: Column, least_rows: int = 10
) -> DataFrame:
    """Adds `predicted` by a least-squares fit on the rows of all earlier periods of the group only, and `n_fitted`, their number.

    A row never takes part in a fit that predicts it, nor does a later one. Null where earlier periods have fewer than
    `least_rows` complete rows or determine no fit. One aggregation gives the sums of products per period, running sums over
    these few rows are the sums of everything earlier, and each period solves one small system.
    """
    rows = df.withColumn("_period", period)
    fitted = _fits_before(rows, label, features, by, least_rows)
    value = reduce(add, (F.col("_c")[i + 1] * F.col(f) for i, f in enumerate(features)), F.col("_c")[0])
    same = reduce(and_, (rows[c].eqNullSafe(fitted[f"_of_{c}"]) for c in by), rows["_period"] == fitted["_for"])
    joined = rows.join(fitted, same, "left")
    return joined.select(*[rows[c] for c in df.columns], value.alias("predicted"), F.coalesce("n_fitted", F.lit(0)).alias("n_fitted"))


def _fits_before(rows: DataFrame, label: str, features: Sequence[str], by: Sequence[str], least_rows: int) -> DataFrame:
    """(by as _of_<by>, _for, n_fitted, _c) for each period of `_period`: the coefficients from all rows of earlier periods."""
    names = [label, *features]
    complete = reduce(and_, (F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in names))
    x = [F.when(complete, F.col(c).cast("double")) for c in names]
    terms = {"_n": F.count_if(complete), **{f"_s{i}": F.coalesce(F.sum(c), F.lit(0.0)) for i, c in enumerate(x)}}
    pairs = [(i, j) for i in range(len(x)) for j in range(i, len(x))]
    terms |= {f"_q{i}_{j}": F.coalesce(F.sum(x[i] * x[j]), F.lit(0.0)) for i, j in pairs}
    sums = rows.groupBy(*by, "_period").agg(*[c.alias(name) for name, c in terms.items()])
    earlier = Window.partitionBy(*by).orderBy("_period").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(*by, "_period", *[F.sum(name).over(earlier).alias(name) for name in terms])
    n = F.col("_n")
    means = F.array(*[F.col(f"_s{i}") / n for i in range(len(x))])
    covariances = F.array(
        *[F.col(f"_q{min(i, j)}_{max(i, j)}") / n - F.col(f"_s{i}") * F.col(f"_s{j}") / (n * n) for i in range(len(x)) for j in range(len(x))]
    )
    enough = before.where(n >= least_rows)
    return enough.select(
        *[F.col(f"`{c}`").alias(f"_of_{c}") for c in by], F.col("_period").alias("_for"), n.alias("n_fitted"), _solver()(means, covariances).alias("_c")
    )


def forecast_errors(df: DataFrame, actual: str, predicted: str, by: Sequence[Column | str], naive: str | None = None) -> DataFrame:
    """n, mean_abs_error and rmse of predictions per group, over rows that have both; with `naive`, also those of that column as the prediction."""
    seen = df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    out = [F.count(F.lit(1)).alias("n")]
    for column, prefix in ((predicted, ""), *([(naive, "naive_")] if naive else [])):
        error = F.col(column) - F.col(actual)
        out += [F.avg(F.abs(error)).alias(f"{prefix}mean_abs_error"), F.sqrt(F.avg(error * error)).alias(f"{prefix}rmse")]
    return seen.groupBy(*by).agg(*out)


def next_value(df: DataFrame, fitted: DataFrame, value: str, lags: int, by: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The value after the last row of each group, which has not happened yet: (by, the last row's first order column, predicted).

    `fitted` are coefficients of `lag_1` ... as `fit_linear` gives them. Each task passes on the last `lags` rows of a group only. Groups with
    fewer rows have no forecast.
    """
    latest = Window.partitionBy(*by).orderBy(*[F.desc(c) for c in order_by])
    last = df.withColumn("_k", F.row_number().over(latest)).where(F.col("_k") <= lags)
    held = {f"_v{k}": F.max(F.when(F.col("_k") == k, F.col(value))) for k in range(1, lags + 1)}
    ends = last.groupBy(*by).agg(F.max(order_by[0]).alias(order_by[0]), F.count(F.lit(1)).alias("_n"), *[c.alias(n) for n, c in held.items()])
    predicted = reduce(add, (F.col(f"coef_lag_{k}") * F.col(f"_v{k}") for k in range(1, lags + 1)), F.col("intercept"))
    return ends.where(F.col("_n") == lags).join(fitted, list(by)).select(*by, order_by[0], predicted.alias("predicted"))


def lead_lag_correlation(
    df: DataFrame, order_by: Sequence[str], values: Mapping[str, str], lags: int, rows_per_task: int | None = ROWS_PER_TASK
) -> DataFrame:
    """How each asset goes with every other one, and itself, some rows later: (leader, follower, lag, n_pairs, corr).

    `values` names a column per asset. The row at lag k pairs the leader's value k rows earlier with the follower's value; pairs with a null
    are left out, and corr is null below two pairs. All assets and lags come from one pass and one aggregation, no join a pair.
    """
    def earlier(column, k):
        return lambda w: F.lag(column, k).over(w)

    shifted = ordered_window(
        df, [], order_by, lags, {f"_{name}_{k}": earlier(c, k) for name, c in values.items() for k in range(1, lags + 1)}, rows_per_task
    )
    leaders = F.array(*[
        F.struct(F.lit(name).alias("leader"), F.lit(k).alias("lag"), F.col(f"_{name}_{k}" if k else c).alias("x"))
        for name, c in values.items() for k in range(lags + 1)
    ])
    followers = F.array(*[F.struct(F.lit(name).alias("follower"), F.col(c).alias("y")) for name, c in values.items()])
    pairs = shifted.select(leaders.alias("_l"), followers.alias("_f")).select("_f", F.inline("_l")).select("leader", "lag", "x", F.inline("_f"))
    return correlation(pairs, "x", "y", ["leader", "follower", "lag"])
