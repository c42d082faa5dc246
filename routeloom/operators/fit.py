"""Transforms from page to map: fitting, leave-one-out, candidate search and selection.

Similarity and affine fits are closed forms over sums, so they are aggregates;
projective and quadratic fits solve a small system per group in NumPy.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from routeloom.functions import geo
from routeloom.operators.rules import quality_status
from routeloom.operators.windows import leave_one_out, similarity_sums
from routeloom.session import ship

# Least points and complexity penalty of each model; penalties of y modes and statuses.
MODELS = {"similarity": (2, 0.0), "affine": (3, 5.0), "projective": (4, 15.0), "polynomial2": (8, 30.0)}
Y_PENALTY = {"y_flipped": 0.0, "raw_y": 60.0}
STATUS_PENALTY = {"pass": 0.0, "review": 25.0, "fail": 1000.0}
SWITCH_METRES, SWITCH_SHARE = 15.0, 0.2


def fit_similarity(points: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, a, b, c, d, rmse, worst) of u = a x - b y + c, v = b x + a y + d.  Points: (keys, x, y, u, v)."""
    sums = points.groupBy(*keys).agg(
        F.count("*").alias("n"),
        *[F.sum(F.expr(t)).alias(k) for k, t in {"sx": "x", "sy": "y", "su": "u", "sv": "v", "p": "x*u + y*v", "q": "x*v - y*u", "r": "x*x + y*y"}.items()],
    )
    a, b = similarity_sums(*[F.col(c) for c in ("n", "sx", "sy", "su", "sv", "p", "q", "r")])
    params = sums.withColumn("a", a).withColumn("b", b)
    params = params.withColumn("c", (F.col("su") - F.col("a") * F.col("sx") + F.col("b") * F.col("sy")) / F.col("n"))
    params = params.withColumn("d", (F.col("sv") - F.col("b") * F.col("sx") - F.col("a") * F.col("sy")) / F.col("n")).select(*keys, "n", "a", "b", "c", "d")
    u, v = apply_similarity(F.col("x"), F.col("y"))
    return _with_errors(points, params, keys, u, v)


def apply_similarity(x: Column, y: Column) -> tuple[Column, Column]:
    a, b = F.col("a"), F.col("b")
    return a * x - b * y + F.col("c"), b * x + a * y + F.col("d")


def fit_affine(points: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, a1..a3, b1..b3, rmse, worst) of u = a1 x + a2 y + a3 and v likewise, from centred sums."""
    w = Window.partitionBy(*keys)
    centred = points
    for c in "xyuv":
        centred = centred.withColumn(f"m{c}", F.avg(c).over(w)).withColumn(f"c{c}", F.col(c) - F.col(f"m{c}"))
    sums = centred.groupBy(*keys).agg(
        F.count("*").alias("n"),
        *[F.max(f"m{c}").alias(f"m{c}") for c in "xyuv"],
        *[F.sum(F.col(f"c{a}") * F.col(f"c{b}")).alias(f"{a}{b}") for a, b in ("xx", "xy", "yy", "xu", "yu", "xv", "yv")],
    )
    den = F.col("xx") * F.col("yy") - F.col("xy") * F.col("xy")
    held = F.when(F.abs(den) > 1e-9 * F.greatest(F.col("xx") * F.col("yy"), F.lit(1e-12)), den)
    for name, t in (("a", "u"), ("b", "v")):
        sums = sums.withColumn(f"{name}1", (F.col(f"x{t}") * F.col("yy") - F.col(f"y{t}") * F.col("xy")) / held)
        sums = sums.withColumn(f"{name}2", (F.col(f"y{t}") * F.col("xx") - F.col(f"x{t}") * F.col("xy")) / held)
        sums = sums.withColumn(f"{name}3", F.col(f"m{t}") - F.col(f"{name}1") * F.col("mx") - F.col(f"{name}2") * F.col("my"))
    params = sums.select(*keys, "n", "a1", "a2", "a3", "b1", "b2", "b3")
    u = F.col("a1") * F.col("x") + F.col("a2") * F.col("y") + F.col("a3")
    v = F.col("b1") * F.col("x") + F.col("b2") * F.col("y") + F.col("b3")
    return _with_errors(points, params, keys, u, v)


def _with_errors(points: DataFrame, params: DataFrame, keys: list[str], u: Column, v: Column) -> DataFrame:
    away = F.hypot(u - F.col("u"), v - F.col("v"))
    errors = points.join(params, keys).groupBy(*keys).agg(F.sqrt(F.avg(away * away)).alias("rmse"), F.max(away).alias("worst"))
    return params.join(errors, keys)


def _design(model: str, s: np.ndarray) -> np.ndarray:
    x, y = s.T
    one = np.ones(len(s))
    return np.column_stack({"affine": [x, y, one], "polynomial2": [one, x, y, x * x, x * y, y * y]}[model])


class Transform:
    """A fitted model over N x 2 arrays; sources and targets are centred and scaled first."""

    def __init__(self, model: str, source: np.ndarray, target: np.ndarray):
        self.model = model
        self.s0, self.t0 = source.mean(axis=0), target.mean(axis=0)
        self.s1 = max(float(np.abs(source - self.s0).max(initial=0)), 1e-9)
        self.t1 = max(float(np.abs(target - self.t0).max(initial=0)), 1e-9)
        s, t = (source - self.s0) / self.s1, (target - self.t0) / self.t1
        if model == "similarity":
            z, w = s @ np.array([1, 1j]), t @ np.array([1, 1j])
            z0, w0 = z - z.mean(), w - w.mean()
            power = float((np.abs(z0) ** 2).sum())
            if power <= 1e-12:
                raise ValueError("the points coincide")
            k = (np.conj(z0) @ w0) / power
            self.params = np.array([k, w.mean() - k * z.mean()])
        elif model == "projective":
            x, y = s.T
            u, v = t.T
            o, i = np.zeros(len(s)), np.ones(len(s))
            rows = np.vstack([np.column_stack([x, y, i, o, o, o, -u * x, -u * y]), np.column_stack([o, o, o, x, y, i, -v * x, -v * y])])
            self.params = np.linalg.lstsq(rows, np.concatenate([u, v]), rcond=None)[0]
        else:
            self.params = np.linalg.lstsq(_design(model, s), t, rcond=None)[0]

    def __call__(self, points: np.ndarray) -> np.ndarray:
        """Transformed points; NaN where a projective denominator is zero."""
        s = (points - self.s0) / self.s1
        if self.model == "similarity":
            w = self.params[0] * (s @ np.array([1, 1j])) + self.params[1]
            t = np.column_stack([w.real, w.imag])
        elif self.model == "projective":
            h = self.params
            den = s @ h[6:8] + 1
            den = np.where(np.abs(den) < 1e-12, np.nan, den)
            t = np.column_stack([s @ h[0:2] + h[2], s @ h[3:5] + h[5]]) / den[:, None]
        else:
            t = _design(self.model, s) @ self.params
        return t * self.t1 + self.t0


def _rmse(away: np.ndarray) -> float | None:
    return float(np.sqrt((away**2).mean())) if len(away) and np.isfinite(away).all() else None


def fit_numeric(points: DataFrame, keys: list[str], models: tuple[str, ...] = tuple(MODELS)) -> DataFrame:
    """(keys, model, n, rmse, loocv) of each model that has points enough; a control-point group is small."""
    ship(points.sparkSession)
    kinds = ", ".join(f"{k} {points.schema[k].dataType.simpleString()}" for k in keys)

    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        s, t = pdf[["x", "y"]].to_numpy(float), pdf[["u", "v"]].to_numpy(float)
        out = []
        for model in models:
            least = MODELS[model][0]
            if len(s) < least:
                continue
            try:
                rmse = _rmse(np.hypot(*(Transform(model, s, t)(s) - t).T))
                left = None
                if len(s) > least:
                    away = []
                    for k in range(len(s)):
                        keep = np.arange(len(s)) != k
                        away.append(float(np.hypot(*(Transform(model, s[keep], t[keep])(s[k : k + 1]) - t[k]).T)[0]))
                    left = _rmse(np.array(away))
            except (ValueError, np.linalg.LinAlgError):
                continue
            out.append([*(pdf[k].iloc[0] for k in keys), model, len(s), rmse, left])
        return pd.DataFrame(out, columns=[*keys, "model", "n", "rmse", "loocv"])

    return points.groupBy(*keys).applyInPandas(group, f"{kinds}, model string, n long, rmse double, loocv double")


def scopes(gcps: DataFrame) -> DataFrame:
    """Each control point in the scope of its frame, if it has one, and in that of its page.

    Points: (page_no, frame_id, x, y, lon, lat, confidence, source, page_height).  Where
    a frame's scope has manual points, the automatic ones of that scope are left out.
    """
    frame = F.when(F.col("frame_id").isNotNull(), F.struct(F.concat_ws(":", F.lit("frame"), "page_no", "frame_id").alias("scope_id"), F.lit("frame").alias("scope_type")))
    page = F.struct(F.concat_ws(":", F.lit("page"), "page_no").alias("scope_id"), F.lit("page").alias("scope_type"))
    every = gcps.withColumn("s", F.explode(F.array_compact(F.array(frame, page)))).select("*", "s.*").drop("s")
    manual = F.max(F.when(F.col("source") == "manual", 1).otherwise(0)).over(Window.partitionBy("scope_id"))
    marked = every.withColumn("_manual", manual)
    return marked.where((F.col("scope_type") != "frame") | (F.col("_manual") == 0) | (F.col("source") == "manual")).drop("_manual")


def candidate_points(scoped: DataFrame) -> DataFrame:
    """Control points in every y mode and target plane: (scope_id, y_mode, crs, x, y, u, v)."""
    w = Window.partitionBy("scope_id")
    d = scoped.withColumn("ref_lon", F.avg("lon").over(w)).withColumn("ref_lat", F.avg("lat").over(w))
    modes = F.array(*[F.struct(F.lit(y).alias("y_mode"), F.lit(c).alias("crs")) for y in Y_PENALTY for c in ("local_equirect_m", "web_mercator_m")])
    d = d.withColumn("m", F.explode(modes)).select("*", "m.*").drop("m")
    near, far = geo.equirect(F.col("lon"), F.col("lat"), F.col("ref_lon"), F.col("ref_lat")), geo.mercator(F.col("lon"), F.col("lat"))
    local = F.col("crs") == "local_equirect_m"
    return d.select(
        "scope_id", "scope_type", "page_no", "y_mode", "crs", "confidence", "source", "x",
        F.when(F.col("y_mode") == "y_flipped", F.col("page_height") - F.col("y")).otherwise(F.col("y")).alias("y"),
        F.when(local, near[0]).otherwise(far[0]).alias("u"),
        F.when(local, near[1]).otherwise(far[1]).alias("v"),
    )


def similarity_candidates(points: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, model, n, rmse, loocv) of similarity fits, with window sums only."""
    fitted = fit_similarity(points, keys)
    left = leave_one_out(points, keys).groupBy(*keys).agg(F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("loocv"), F.count_if(F.col("error").isNull()).alias("bad"))
    return fitted.join(left, keys, "left").select(*keys, F.lit("similarity").alias("model"), "n", "rmse", F.when((F.col("n") > 2) & (F.col("bad") == 0), F.col("loocv")).alias("loocv"))


def _lookup(column: str, values: dict[str, float]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), F.col(column))


def select_models(candidates: DataFrame, scope: str = "scope_id") -> DataFrame:
    """The selected candidate of each scope; scopes without a passing or fair one have none.

    Candidates: (scope, model, y_mode, crs, n, rmse, loocv).  The base is the best
    similarity, else the best of all; the first other candidate that is better than
    the base by 15 m and by a fifth replaces it.
    """
    d = candidates.withColumn("status", quality_status(F.col("n"), F.col("loocv"))).where(F.col("status") != "fail")
    metric = F.coalesce("loocv", F.col("rmse") + 1000.0)
    d = d.withColumn("metric", metric)
    d = d.withColumn("order_score", metric + _lookup("model", {k: v[1] for k, v in MODELS.items()}) + _lookup("y_mode", Y_PENALTY) + _lookup("status", STATUS_PENALTY))
    order = [F.col("order_score"), F.col("rmse"), F.col("n").desc(), F.col("model"), F.col("y_mode").desc(), F.col("crs")]
    d = d.withColumn("place", F.row_number().over(Window.partitionBy(scope).orderBy(*order)))
    base_order = Window.partitionBy(scope).orderBy(F.when(F.col("model") == "similarity", 0).otherwise(1), "place")
    d = d.withColumn("base_metric", F.first("metric").over(base_order)).withColumn("is_base", F.row_number().over(base_order) == 1)
    better = (F.col("model") != "similarity") & (F.col("base_metric") - F.col("metric") >= F.greatest(F.lit(SWITCH_METRES), F.col("base_metric") * SWITCH_SHARE))
    rank = F.when(~F.col("is_base") & better, F.col("place")).when(F.col("is_base"), F.lit(1_000_000))
    d = d.withColumn("choice", rank).where(F.col("choice").isNotNull())
    best = d.withColumn("first", F.row_number().over(Window.partitionBy(scope).orderBy("choice"))).where(F.col("first") == 1)
    return best.select(scope, "model", "y_mode", "crs", "n", "rmse", "loocv", "status")
