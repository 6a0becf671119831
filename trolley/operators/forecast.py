"""Daily revenue forecasting per series, as window functions.

Every model is written per ``series_id`` so thousands of series (stores,
categories, ...) run in parallel: windows partition by series, nothing is
collected.  Input: (series_id, date, revenue double).  Output of every model:
(series_id, model, date, actual, predicted) over the test days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trolley.functions.labels import iso_weekday

TEST_FRACTION = 0.2


def daily_by_series(lines: DataFrame, series_col: str | None = None) -> DataFrame:
    # the single-series default is derived from a column: a bare literal key
    # would let the optimiser fold the series_id equi-joins into cross joins
    sid = (F.col(series_col).cast("string") if series_col
           else F.when(F.col("sale_date").isNotNull(), F.lit("ALL")))
    return (lines.groupBy(sid.alias("series_id"), F.col("sale_date").alias("date"))
            .agg(F.sum("amount").cast("double").alias("revenue")))


def chrono_split(daily: DataFrame, test_fraction: float = TEST_FRACTION) -> DataFrame:
    """First n - round(f n) trading days are train, the rest test (per series)."""
    w = Window.partitionBy("series_id").orderBy("date")
    n = F.count(F.lit(1)).over(Window.partitionBy("series_id"))
    rn = F.row_number().over(w)
    n_test = F.round(n * test_fraction).cast("bigint")
    return (daily.withColumn("t", rn)
            .withColumn("is_train", rn <= n - n_test)
            .withColumn("weekday", iso_weekday("date"))
            .withColumn("day_index", F.datediff("date", F.min("date").over(Window.partitionBy("series_id")))
                        .cast("bigint")))


#: the fixed framing forecasts the whole test span from the training days; the
#: rolling framing forecasts each test day from all days before it
FRAMING = {"naive_flat": "fixed", "hist_mean": "fixed", "seasonal_fixed": "fixed", "dow_fixed": "fixed", "dow_trend": "fixed",
           "persistence": "rolling", "expanding_mean": "rolling", "seasonal_naive": "rolling", "dow_rolling": "rolling"}
BASELINES = {"fixed": ("naive_flat", "hist_mean", "seasonal_fixed"), "rolling": ("persistence", "expanding_mean", "seasonal_naive")}


def with_models(split: DataFrame) -> DataFrame:
    """Every model's value for every day, as columns.

    All are windows over one series (the weekday windows lie within it), so the
    days are shuffled once and scanned once.  The weekday model with trend is
    closed form (Frisch-Waugh): slope = sum((t - t_w)(y - y_w)) / sum((t - t_w)^2)
    over the training days, prediction y_w + slope (t - t_w).
    """
    series, day = Window.partitionBy("series_id"), Window.partitionBy("series_id", "weekday")
    before = lambda w: w.orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    y = F.when(F.col("is_train"), F.col("revenue"))
    t = F.when(F.col("is_train"), F.col("day_index").cast("double"))
    latest = F.when(F.col("is_train"), F.struct("date", "revenue"))
    out = (split.withColumn("naive_flat", F.max(latest).over(series)["revenue"])
           .withColumn("hist_mean", F.avg(y).over(series))
           .withColumn("seasonal_fixed", F.max(latest).over(day)["revenue"])
           .withColumn("dow_fixed", F.avg(y).over(day)).withColumn("_tw", F.avg(t).over(day))
           .withColumn("persistence", F.lag("revenue").over(series.orderBy("date")))
           .withColumn("expanding_mean", F.avg("revenue").over(before(series)))
           .withColumn("seasonal_naive", F.lag("revenue").over(day.orderBy("date")))
           .withColumn("dow_rolling", F.avg("revenue").over(before(day))))
    slope = F.sum((t - F.col("_tw")) * (y - F.col("dow_fixed"))).over(series) / F.sum(F.pow(t - F.col("_tw"), 2)).over(series)
    return out.withColumn("trend", slope * (F.col("day_index") - F.col("_tw"))).withColumn("dow_trend", F.col("dow_fixed") + F.col("trend"))


def all_forecasts(split: DataFrame) -> DataFrame:
    """(series_id, model, framing, date, actual, predicted) of all nine models over the test days."""
    cells = ", ".join(f"'{m}', '{f}', {m}" for m, f in FRAMING.items())
    return (with_models(split).filter(~F.col("is_train"))
            .select("series_id", "date", F.col("revenue").alias("actual"), F.expr(f"stack({len(FRAMING)}, {cells}) AS (model, framing, predicted)"))
            .select("series_id", "model", "framing", "date", "actual", "predicted"))


def fc_metrics(fc: DataFrame, digits: int = 4, r2_digits: int = 6, ratio_digits: int | None = None) -> DataFrame:
    """R^2, MAE, RMSE, MAPE per (series, model) over rows with a prediction."""
    f = fc.filter(F.col("predicted").isNotNull())
    w = Window.partitionBy("series_id", "model")
    f = f.withColumn("mean_actual", F.avg("actual").over(w))
    err = F.col("actual") - F.col("predicted")
    g = f.groupBy("series_id", "model").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.when(F.col("actual") != 0, F.abs(err) / F.abs(F.col("actual")))).alias("mape"),
        F.sum(err * err).alias("sse"),
        F.sum(F.pow(F.col("actual") - F.col("mean_actual"), 2)).alias("sst"))
    rd = digits if ratio_digits is None else ratio_digits
    return g.select("series_id", "model", "n", F.round("mae", digits).alias("mae"),
                    F.round("rmse", rd).alias("rmse"), F.round(F.col("mape") * 100, rd).alias("mape_pct"),
                    (F.round(1 - F.col("sse") / F.col("sst"), r2_digits) + F.lit(0.0)).alias("r2"))


def fc_verdict(metrics: DataFrame) -> DataFrame:
    """Within each framing: every model against the framing's baselines.

    mae_change_pct is the share of the baseline's MAE that the model saves
    (positive: better); is_best marks the framing's least MAE.
    """
    framing = F.create_map(*[F.lit(x) for kv in FRAMING.items() for x in kv])
    m = metrics.select("series_id", "model", "mae", "r2", framing[F.col("model")].alias("framing"))
    w = Window.partitionBy("series_id", "framing")
    m = (m.withColumn("is_best", F.col("model") == F.min(F.struct("mae", "model")).over(w)["model"])
          .withColumn("any_r2_positive", F.max("r2").over(w) > 0))
    names = F.create_map(*[x for k, v in BASELINES.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    base = m.filter(F.array_contains(names[F.col("framing")], F.col("model")))
    base = base.select("series_id", "framing", F.col("model").alias("baseline"), F.col("mae").alias("baseline_mae"))
    j = m.join(base, ["series_id", "framing"]).filter(F.col("model") != F.col("baseline"))
    return j.select("series_id", "framing", "model", "baseline", "is_best", "any_r2_positive",
                    F.round(F.lit(100.0) * (F.col("baseline_mae") - F.col("mae")) / F.col("baseline_mae"), 4).alias("mae_change_pct"),
                    (F.col("mae") < F.col("baseline_mae")).alias("beats"))


def fc_window_check(split: DataFrame, start: str, end: str) -> DataFrame:
    """Does the curve fitted to the training days peak inside a named window that the
    model is not told of?  Fitted mean inside and outside, the date of the
    fitted maximum and that of the trend's (first of equals)."""
    inside = F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    first_peak = lambda v: F.max_by("date", F.struct(F.round(v, 6), -F.unix_date("date")))
    t = with_models(split).filter("is_train").select(
        "series_id", "date", F.expr("stack(2, 'dow_fixed', dow_fixed, 0D, 'dow_trend', dow_trend, trend) AS (model, fitted, trend)"))
    g = t.groupBy("series_id", "model").agg(
        F.round(F.avg(F.when(inside, F.col("fitted"))), 4).alias("fitted_in"),
        F.round(F.avg(F.when(~inside, F.col("fitted"))), 4).alias("fitted_out"),
        first_peak(F.col("fitted")).alias("fitted_peak"), first_peak(F.col("trend")).alias("trend_peak"))
    return g.withColumn("peak_inside", F.col("fitted_peak").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def fc_error_structure(fc: DataFrame, days: list) -> DataFrame:
    """Share of squared error on named days; MAE and R^2 without them."""
    f = fc.filter(F.col("predicted").isNotNull())
    named = F.col("date").cast("string").isin(*days)
    err2 = F.pow(F.col("actual") - F.col("predicted"), 2)
    rest = f.filter(~named)
    w = Window.partitionBy("series_id", "model")
    rest = rest.withColumn("m", F.avg("actual").over(w))
    a = f.groupBy("series_id", "model").agg(
        F.round(F.lit(100.0) * F.sum(F.when(named, err2).otherwise(0.0)) / F.sum(err2), 4)
        .alias("named_sq_error_pct"))
    b = rest.groupBy("series_id", "model").agg(
        F.round(F.avg(F.abs(F.col("actual") - F.col("predicted"))), 4).alias("mae_without"),
        F.round(1 - F.sum(err2) / F.sum(F.pow(F.col("actual") - F.col("m"), 2)), 6).alias("r2_without"))
    return a.join(b, ["series_id", "model"], "left")


def monthly_fit(lines: DataFrame, horizon: int = 3, test_fraction: float = TEST_FRACTION) -> DataFrame:
    """month_no, year_month, actual, predicted (unrounded) and is_train, as ``fc_monthly_linear``."""
    m = (lines.groupBy(F.date_format("sale_date", "yyyy-MM").alias("year_month"))
         .agg(F.sum("amount").cast("double").alias("revenue")))
    w = Window.orderBy("year_month")  # one row per month: small
    m = m.withColumn("month_no", F.row_number().over(w).cast("bigint"))
    n = m.agg(F.count(F.lit(1))).scalar()
    n_train = n - F.round(n * test_fraction).cast("bigint")
    tr = m.filter(F.col("month_no") <= n_train)
    coef = tr.agg(F.regr_slope("revenue", "month_no").alias("slope"),
                  F.regr_intercept("revenue", "month_no").alias("intercept"))
    fit = m.select("month_no", "year_month", "revenue")
    fut = (spark_range_months(m, horizon))
    allm = fit.unionByName(fut)
    return allm.select("month_no", "year_month", F.col("revenue").alias("actual"),
                       (coef.select("intercept").scalar() + coef.select("slope").scalar() * F.col("month_no")).alias("predicted"),
                       (F.col("month_no") <= n_train).alias("is_train"))


def fc_monthly_linear(lines: DataFrame, horizon: int = 3, test_fraction: float = TEST_FRACTION) -> DataFrame:
    """Monthly revenue ~ month number (1..n), fitted on the first 80 % of
    months (unshuffled); returns in-sample fit for all months and the
    forecast for months n+1..n+horizon (numbering continues the series)."""
    return monthly_fit(lines, horizon, test_fraction).select(
        "month_no", "year_month", F.round("actual", 2).alias("actual"), F.round("predicted", 2).alias("predicted"), "is_train")


def monthly_metrics(fit: DataFrame) -> DataFrame:
    """MAE and RMSE of the monthly line over the months it was fitted on, those after, and all."""
    err = F.col("actual") - F.col("predicted")
    seen = (fit.filter(F.col("actual").isNotNull())
            .withColumn("part", F.explode(F.array(F.lit("all"), F.when(F.col("is_train"), "train").otherwise("test")))))
    return seen.groupBy("part").agg(F.count(F.lit(1)).alias("months"), F.round(F.avg(F.abs(err)), 2).alias("mae"),
                                    F.round(F.sqrt(F.avg(err * err)), 2).alias("rmse"))


def spark_range_months(m: DataFrame, horizon: int) -> DataFrame:
    last = m.agg(F.max("month_no").alias("last")).select(
        F.explode(F.sequence(F.col("last") + 1, F.col("last") + horizon)).alias("month_no"))
    return last.select(F.col("month_no").cast("bigint"), F.lit(None).cast("string").alias("year_month"),
                       F.lit(None).cast("double").alias("revenue"))


# --------------------------------------------------------------- O7 -------
#: ridge penalties of the trend's changepoints: stiff follows the long run, flexible may chase a peak
PENALTY = {"additive": 10.0, "additive_flexible": 0.1}
ADDITIVE_SCHEMA = ("series_id string, model string, framing string, date date, actual double, predicted double, "
                   "lower double, upper double")


#: cells of (test day, day) that the rolling refits hold at once
_CELLS = 1 << 18
#: days before which a rolling refit is fitted on its own
_FEW = 32


def _quantile_places(n, q):
    """Where numpy's linear quantile ``q`` of ``n`` ascending values lies: the two places beside it and the share of the second."""
    import numpy as np
    v = np.asarray((n - 1) * q, float)
    low = np.floor(v).astype(int)
    return low, np.minimum(low + 1, n - 1), v - low


def _between(a, b, share):
    import numpy as np
    return np.where(share >= 0.5, b - (b - a) * (1 - share), a + (b - a) * share)


def rolling_refits(ts, base, y, test, probs, penalty):
    """(prediction, low, high) of each day in ``test`` by the ridge fitted to all days before it.

    ``ts`` ascends; ``base`` holds the unpenalised columns; the hinges stand at the
    quantiles ``probs`` of the days before.  The refits' normal equations come from
    running sums (a hinge's part of a sum is a difference of two of them) and are
    solved together, so a refit doesn't read its days again for them.
    """
    import numpy as np
    n, nb, nh = len(ts), base.shape[1], len(probs)
    run = lambda v: np.concatenate([np.zeros((1, *v.shape[1:])), np.cumsum(v, axis=0)])
    bb, b1, bt = run(base[:, :, None] * base[:, None, :]), run(base), run(base * ts[:, None])
    by, y1, yt, s1, st, stt = run(base * y[:, None]), run(y), run(y * ts), run(np.ones(n)), run(ts), run(ts * ts)
    pen = np.concatenate([np.full(nb, 1e-9), np.full(nh, penalty)])
    out = np.empty((len(test), 3))
    for at in range(0, len(test), max(1, _CELLS // max(n, 1))):
        i = test[at:at + max(1, _CELLS // max(n, 1))]
        end = i[:, None]
        low, high, share = _quantile_places(end, probs[None, :])
        c = _between(ts[low], ts[high], share)
        pos = np.minimum(np.searchsorted(ts, c, side="right"), end)
        gram = np.empty((len(i), nb + nh, nb + nh))
        gram[:, :nb, :nb] = bb[i]
        cross = (bt[end] - bt[pos]) - c[:, :, None] * (b1[end] - b1[pos])
        gram[:, nb:, :nb], gram[:, :nb, nb:] = cross, cross.transpose(0, 2, 1)
        last = np.maximum(pos[:, :, None], pos[:, None, :])
        k, m, e = c[:, :, None], c[:, None, :], i[:, None, None]
        gram[:, nb:, nb:] = (stt[e] - stt[last]) - (k + m) * (st[e] - st[last]) + k * m * (s1[e] - s1[last])
        right = np.concatenate([by[i], (yt[end] - yt[pos]) - c * (y1[end] - y1[pos])], axis=1)
        beta = np.linalg.solve(gram + np.diag(pen), right[:, :, None])[:, :, 0]
        fit = beta[:, :nb] @ base.T
        for h in range(nh):
            fit += beta[:, nb + h, None] * np.maximum(ts[None, :] - c[:, h, None], 0.0)
        row = np.arange(len(i))
        out[at:at + len(i), 0] = fit[row, i]
        rest = np.sort(np.where(np.arange(n)[None, :] < end, y[None, :] - fit, np.inf), axis=1)
        for col, q in ((1, 0.1), (2, 0.9)):
            low, high, share = _quantile_places(i, q)
            out[at:at + len(i), col] = _between(rest[row, low], rest[row, high], share)
    return out


def fc_additive(split: DataFrame, n_changepoints: int = 10) -> DataFrame:
    """Trend with hinge changepoints + weekly seasonality, ridge-fitted per series:
    fixed with a stiff and a flexible trend, and rolling (the stiff one refitted on
    all days before each test day).  One pandas group per series, as long as
    its calendar; intervals are residual quantiles of the fit.
    """
    def fit(pdf):
        import numpy as np
        import pandas as pd
        pdf = pdf.sort_values("date")
        t = pdf["day_index"].to_numpy(dtype=float)
        ts = t / max(t.max(), 1.0)
        train = pdf["is_train"].to_numpy()
        y = pdf["revenue"].to_numpy(dtype=float)
        weekday = pdf["weekday"].to_numpy()
        season = [(weekday == k).astype(float) for k in range(2, 8)]

        def predict(use, at, penalty):
            cps = np.quantile(ts[use], np.linspace(0, 0.8, n_changepoints + 2)[1:-1]) if use.sum() > 2 else []
            x = np.column_stack([np.ones_like(ts), ts, *season, *[np.maximum(ts - c, 0.0) for c in cps]])
            pen = np.full(x.shape[1], 1e-9)
            pen[8:] = penalty
            beta = np.linalg.solve(x[use].T @ x[use] + np.diag(pen), x[use].T @ y[use])
            rest = y[use] - x[use] @ beta
            low, high = np.quantile(rest, [0.1, 0.9]) if len(rest) else (0.0, 0.0)
            return x[at] @ beta, low, high

        test, fits = np.flatnonzero(~train), []
        for model, penalty in PENALTY.items():
            p, low, high = predict(train, test, penalty)
            fits.append(np.column_stack([p, np.full(len(p), low), np.full(len(p), high)]))
        # running sums serve well-determined fits only: with few days each is made on its own
        early, later = test[test < _FEW], test[test >= _FEW]
        for i in early:
            p, low, high = predict(np.arange(len(y)) < i, [i], PENALTY["additive"])
            fits.append(np.array([[p[0], low, high]]))
        if len(later):
            base = np.column_stack([np.ones_like(ts), ts, *season])
            fits.append(rolling_refits(ts, base, y, later, np.linspace(0, 0.8, n_changepoints + 2)[1:-1], PENALTY["additive"]))
        p, low, high = np.concatenate(fits).T if fits else np.empty((3, 0))
        names, at = [*PENALTY, "additive_rolling"], np.concatenate([test] * (len(PENALTY) + 1))
        return pd.DataFrame({
            "series_id": pdf["series_id"].iloc[0], "model": np.repeat(np.array(names, dtype=object), len(test)),
            "framing": np.repeat(np.array(["fixed"] * len(PENALTY) + ["rolling"], dtype=object), len(test)),
            "date": pdf["date"].to_numpy()[at], "actual": y[at], "predicted": p, "lower": p + low, "upper": p + high})

    return (split.select("series_id", "date", "revenue", "is_train", "weekday", "day_index")
            .groupBy("series_id").applyInPandas(fit, ADDITIVE_SCHEMA))
