"""Queries over control points: merging, fitting, selection, transforms and the review queue."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from routeloom.functions import geo
from routeloom.operators import fit, joins, lookups, rules, windows
from routeloom.plans.base import control_points, table, with_

KEYS = ["page_no", "frame_id"]


def _planar(spark, sf_dir) -> DataFrame:
    """Control points (page_no, frame_id, x, y, u, v): y upwards, metres about a fixed place."""
    u, v = geo.equirect(F.col("lon"), F.col("lat"), F.lit(133.0), F.lit(33.5))
    return control_points(spark, sf_dir).select("gcp", *KEYS, "x", (842.0 - F.col("y")).alias("y"), u.alias("u"), v.alias("v"))


PLANAR = """, planar AS (SELECT gcp, page_no, frame_id, x, 842.0::double - y AS y, radians(lon - 133.0::double) * 6378137.0::double * cos(radians(33.5::double)) AS u, radians(lat - 33.5::double) * 6378137.0::double AS v FROM gcps)"""
_SUMS = "count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(u) AS su, sum(v) AS sv, sum(x*u+y*v) AS p, sum(x*v-y*u) AS q, sum(x*x+y*y) AS r"
_AB = "(p - (sx*su + sy*sv) / n) / (r - (sx*sx + sy*sy) / n) AS a, (q - (sx*sv - sy*su) / n) / (r - (sx*sx + sy*sy) / n) AS b"


def gcp_merge(spark, sf_dir):
    d = control_points(spark, sf_dir)
    m = joins.merge_preferred(d.where("source = 'auto'"), d.where("source = 'manual'"), KEYS)
    return m.select("gcp", *KEYS, "source", F.round("confidence", 4).alias("confidence"))


def scope_expand(spark, sf_dir):
    s = fit.scopes(control_points(spark, sf_dir))
    return s.groupBy("scope_id", "scope_type").agg(F.count("*").alias("points"), F.count_if(F.col("source") == "manual").alias("manual"), F.round(F.avg("lon"), 6).alias("mean_lon"), F.round(F.avg("lat"), 6).alias("mean_lat"), F.round(F.avg("confidence"), 6).alias("mean_confidence"))


def fit_similarity(spark, sf_dir):
    d = fit.fit_similarity(_planar(spark, sf_dir), KEYS)
    return d.select(*KEYS, "n", F.round("a", 6).alias("a"), F.round("b", 6).alias("b"), F.round("rmse", 4).alias("rmse"), F.round("worst", 4).alias("worst"))


def fit_affine(spark, sf_dir):
    d = fit.fit_affine(_planar(spark, sf_dir), KEYS).where("n > 3")
    return d.select(*KEYS, "n", F.round("a1", 5).alias("a1"), F.round("b2", 5).alias("b2"), F.round("rmse", 3).alias("rmse"))


def loocv_similarity(spark, sf_dir):
    d = windows.leave_one_out(_planar(spark, sf_dir), KEYS).groupBy(*KEYS).agg(F.count("*").alias("n"), F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("e"))
    return d.where("n > 2").select(*KEYS, "n", F.round("e", 4).alias("loocv"))


def fit_numeric(spark, sf_dir):
    d = fit.fit_numeric(_planar(spark, sf_dir), KEYS)
    return d.select(*KEYS, "model", "n", F.round("rmse", 3).alias("rmse"), F.round("loocv", 3).alias("loocv"))


def fit_projective(spark, sf_dir):
    return fit_numeric(spark, sf_dir).where("model = 'projective'")


def fit_poly2(spark, sf_dir):
    return fit_numeric(spark, sf_dir).where("model = 'polynomial2'")


def _merged(spark, sf_dir) -> DataFrame:
    d = control_points(spark, sf_dir)
    return joins.merge_preferred(d.where("source = 'auto'"), d.where("source = 'manual'"), KEYS)


def model_select(spark, sf_dir):
    """Flagship: merge, expand to scopes, fit every y mode and plane, select."""
    keys = ["scope_id", "y_mode", "crs"]
    p = fit.candidate_points(fit.scopes(_merged(spark, sf_dir)))
    best = fit.select_models(fit.similarity_candidates(p, keys))
    return best.select("scope_id", "model", "y_mode", "crs", "n", F.round("rmse", 3).alias("rmse"), F.round("loocv", 3).alias("loocv"), "status")


def model_select_all(spark, sf_dir):
    """Selection over all four models."""
    keys = ["scope_id", "y_mode", "crs"]
    best = fit.select_models(fit.fit_numeric(fit.candidate_points(fit.scopes(_merged(spark, sf_dir))), keys))
    return best.select("scope_id", "model", "y_mode", "crs", "n", F.round("rmse", 2).alias("rmse"), F.round("loocv", 2).alias("loocv"), "status")


_MERGED = """, merged AS (SELECT * FROM gcps WHERE source = 'manual' UNION ALL SELECT g.* FROM gcps g WHERE source = 'auto' AND NOT EXISTS (SELECT 1 FROM gcps m WHERE m.source = 'manual' AND m.page_no = g.page_no AND m.frame_id = g.frame_id))"""


def _scoped(table_: str) -> str:
    return f""", scoped AS (SELECT * FROM (SELECT 'frame:' || page_no || ':' || frame_id AS scope_id, 'frame' AS scope_type, *, max((source = 'manual')::int) OVER (PARTITION BY page_no, frame_id) AS hm FROM {table_}) WHERE hm = 0 OR source = 'manual'
        UNION ALL SELECT 'page:' || page_no, 'page', *, 0 FROM {table_})"""


_SELECT = (
    """, cand AS (SELECT scope_id, y_mode, crs, x, CASE WHEN y_mode = 'y_flipped' THEN 842.0::double - y ELSE y END AS y, CASE WHEN crs = 'local_equirect_m' THEN radians(lon - ref_lon) * 6378137.0::double * cos(radians(ref_lat)) ELSE 6378137.0::double * radians(lon) END AS u,
      CASE WHEN crs = 'local_equirect_m' THEN radians(lat - ref_lat) * 6378137.0::double ELSE 6378137.0::double * ln(tan(0.7853981633974483::double + radians(lat) / 2)) END AS v
      FROM (SELECT *, avg(lon) OVER (PARTITION BY scope_id) AS ref_lon, avg(lat) OVER (PARTITION BY scope_id) AS ref_lat FROM scoped), (VALUES ('y_flipped'), ('raw_y')) ym(y_mode), (VALUES ('local_equirect_m'), ('web_mercator_m')) cr(crs)),
    pw AS (SELECT *, count(*) OVER k AS n, sum(x) OVER k AS sx, sum(y) OVER k AS sy, sum(u) OVER k AS su, sum(v) OVER k AS sv, sum(x*u+y*v) OVER k AS p, sum(x*v-y*u) OVER k AS q, sum(x*x+y*y) OVER k AS r FROM cand WINDOW k AS (PARTITION BY scope_id, y_mode, crs)),
    """
    + f"""full_ AS (SELECT *, {_AB} FROM pw),
    loo AS (SELECT scope_id, y_mode, crs, x AS px, y AS py, u AS pu, v AS pv, n - 1 AS n, sx - x AS sx, sy - y AS sy, su - u AS su, sv - v AS sv, p - (x*u+y*v) AS p, q - (x*v-y*u) AS q, r - (x*x+y*y) AS r FROM pw WHERE n > 1),
    loo2 AS (SELECT *, CASE WHEN r - (sx*sx + sy*sy) / n > 1e-12 THEN (p - (sx*su + sy*sv) / n) / (r - (sx*sx + sy*sy) / n) END AS a, CASE WHEN r - (sx*sx + sy*sy) / n > 1e-12 THEN (q - (sx*sv - sy*su) / n) / (r - (sx*sx + sy*sy) / n) END AS b FROM loo),
    cv AS (SELECT scope_id, y_mode, crs, sqrt(avg(pow(su/n + a*(px - sx/n) - b*(py - sy/n) - pu, 2) + pow(sv/n + b*(px - sx/n) + a*(py - sy/n) - pv, 2))) AS loocv, count(*) FILTER (a IS NULL) AS bad FROM loo2 GROUP BY 1, 2, 3),
    ft AS (SELECT scope_id, y_mode, crs, any_value(n) AS n, sqrt(avg(pow(su/n + a*(x - sx/n) - b*(y - sy/n) - u, 2) + pow(sv/n + b*(x - sx/n) + a*(y - sy/n) - v, 2))) AS rmse FROM full_ GROUP BY 1, 2, 3),
    st AS (SELECT ft.scope_id, ft.y_mode, ft.crs, ft.n, rmse, CASE WHEN ft.n > 2 AND bad = 0 THEN loocv END AS loocv FROM ft LEFT JOIN cv USING (scope_id, y_mode, crs)),
    sx AS (SELECT *, CASE WHEN n < 4 OR loocv IS NULL THEN 'fail' WHEN loocv < 50 THEN 'pass' WHEN loocv <= 150 THEN 'review' ELSE 'fail' END AS status FROM st)
    SELECT scope_id, 'similarity' AS model, y_mode, crs, n, round(rmse, 3) AS rmse, round(loocv, 3) AS loocv, status FROM sx WHERE status <> 'fail'
    QUALIFY row_number() OVER (PARTITION BY scope_id ORDER BY sx.loocv + CASE WHEN y_mode = 'raw_y' THEN 60 ELSE 0 END + CASE WHEN status = 'review' THEN 25 ELSE 0 END, sx.rmse, y_mode DESC, crs) = 1"""
)


def seam_error(spark, sf_dir):
    """Duplicate names in frames of a page: mean distance of the places that two fits give them."""
    d = fit.fit_similarity(_planar(spark, sf_dir), KEYS).where("n >= 3").select(*KEYS, "a", "b", "c", "d")
    u, v = fit.apply_similarity(F.col("x"), F.col("y"))
    p = _planar(spark, sf_dir).join(d, KEYS).select(*KEYS, (F.col("gcp") % 9).alias("name"), u.alias("u"), v.alias("v"))
    a, b = p.alias("a"), p.alias("b")
    pairs = a.join(b, (F.col("a.page_no") == F.col("b.page_no")) & (F.col("a.name") == F.col("b.name")) & (F.col("a.frame_id") < F.col("b.frame_id")))
    pairs = pairs.select(F.col("a.page_no").alias("page_no"), F.array("a.frame_id", "b.frame_id").alias("f"), F.hypot(F.col("a.u") - F.col("b.u"), F.col("a.v") - F.col("b.v")).alias("d"))
    return pairs.withColumn("frame_id", F.explode("f")).groupBy(*KEYS).agg(F.count("*").alias("pairs"), F.round(F.avg("d"), 2).alias("seam_m"))


def route_transform(spark, sf_dir):
    """Customers' places as routes: the model of their frame, else that of their page, and the confidence of the result."""
    p = _planar(spark, sf_dir)
    frame = fit.fit_similarity(p.where("frame_id in ('0', '1', '2')"), KEYS).where("n >= 4").select(*KEYS, *[F.col(c).alias(f"f{c}") for c in ("a", "b", "c", "d", "rmse")])
    page = fit.fit_similarity(p, ["page_no"]).where("n >= 4").select("page_no", *[F.col(c).alias(f"p{c}") for c in ("a", "b", "c", "d", "rmse")])
    d = p.join(frame, KEYS, "left").join(page, ["page_no"], "left")
    for c in ("a", "b", "c", "d", "rmse"):
        d = d.withColumn(c, F.coalesce(f"f{c}", f"p{c}"))
    u, v = fit.apply_similarity(F.col("x") * 0.5, F.col("y") * 0.5)
    lon, lat = geo.equirect_inverse(u, v, F.lit(133.0), F.lit(33.5))
    paged = F.col("fa").isNull()
    score = rules.transform_confidence(F.lit(0.8), 0.5 + (F.col("gcp") % 50) / F.lit(100.0), F.col("rmse") * 2, F.col("rmse") * 5, paged)
    return d.select("gcp", F.when(F.col("a").isNull(), "route_not_transformed").when(paged, "page_model").otherwise("frame_model").alias("used"), F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"), F.round(score, 5).alias("confidence"))


def review_queue(spark, sf_dir):
    """Pages of orders with their untransformed routes, lengths and models, in order of priority."""
    o = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 130).alias("unit"), "o_totalprice", "o_orderstatus")
    g = o.groupBy("unit").agg(F.count("*").alias("routes"), F.sum(F.round("o_totalprice", 0)).alias("length"), F.count_if(F.col("o_orderstatus") == "P").alias("untransformed"))
    m = fit.fit_similarity(_planar(spark, sf_dir), KEYS).select((F.col("page_no") * 5 + F.col("frame_id").cast("long")).alias("unit"), rules.quality_status(F.col("n"), F.col("rmse") * 3).alias("status"))
    manual = control_points(spark, sf_dir).where("source = 'manual' and gcp % 3 = 0").select((F.col("page_no") * 5 + F.col("frame_id").cast("long")).alias("unit")).distinct().withColumn("manual", F.lit(True))
    d = g.join(m, "unit", "left").join(manual, "unit", "left").crossJoin(F.broadcast(g.agg(F.max("length").alias("most"))))  # one row
    score, why = rules.review_priority(F.col("untransformed"), F.col("length"), F.col("most"), F.col("status").isNotNull(), F.coalesce("status", F.lit("")), F.coalesce("manual", F.lit(False)))
    d = d.select("unit", "routes", "untransformed", "length", "status", score.alias("score"), F.array_join(why, "|").alias("reasons"))
    order = [F.desc("score"), F.desc("untransformed"), F.desc("length"), lookups.quality_rank(F.col("status")).desc(), F.floor(F.col("unit") / 5), F.col("unit")]
    return d.withColumn("place", F.row_number().over(Window.orderBy(*order))).select("unit", "routes", "untransformed", "score", "reasons", "place")  # a row a frame


QUERIES = {f.__name__: f for f in (gcp_merge, scope_expand, fit_similarity, fit_affine, loocv_similarity, fit_projective, fit_poly2, model_select, model_select_all, seam_error, route_transform, review_queue)}
_FIT = f", sums AS (SELECT page_no, frame_id, {_SUMS} FROM planar GROUP BY 1, 2), par AS (SELECT *, {_AB} FROM sums), par2 AS (SELECT *, (su - a*sx + b*sy) / n AS c, (sv - b*sx - a*sy) / n AS d FROM par)"
_AWAY = "sqrt(pow(a*x - b*y + c - u, 2) + pow(b*x + a*y + d - v, 2))"
_CONF = """least(greatest(0.8::double * (0.5::double + (gcp % 50) / 100.0::double) * CASE WHEN rmse * 2 < 50 THEN 0.98::double WHEN rmse * 2 <= 150 THEN greatest(0.45::double, 0.8::double - (rmse * 2 - 50) / 250.0::double) ELSE 0.2::double END
    * CASE WHEN rmse IS NULL THEN 1.0::double ELSE greatest(0.3::double, 1.0::double - rmse * 5 / 2000.0::double) END * CASE WHEN fa IS NULL THEN 0.82::double ELSE 1.0::double END, 0), 0.99::double)"""
ORACLES = {
    "gcp_merge": with_("gcps", _MERGED + " SELECT gcp, page_no, frame_id, source, round(confidence, 4) AS confidence FROM merged"),
    "scope_expand": with_("gcps", _scoped("gcps") + " SELECT scope_id, scope_type, count(*) AS points, count(*) FILTER (source = 'manual') AS manual, round(avg(lon), 6) AS mean_lon, round(avg(lat), 6) AS mean_lat, round(avg(confidence), 6) AS mean_confidence FROM scoped GROUP BY 1, 2"),
    "fit_similarity": with_("gcps", PLANAR + _FIT + f" SELECT page_no, frame_id, any_value(n) AS n, round(any_value(a), 6) AS a, round(any_value(b), 6) AS b, round(sqrt(avg(pow({_AWAY}, 2))), 4) AS rmse, round(max({_AWAY}), 4) AS worst FROM planar JOIN par2 USING (page_no, frame_id) GROUP BY 1, 2"),
    "fit_affine": with_("gcps", PLANAR + """, c AS (SELECT page_no, frame_id, x, y, u, v, count(*) OVER k AS n, avg(x) OVER k AS mx, avg(y) OVER k AS my, avg(u) OVER k AS mu, avg(v) OVER k AS mv FROM planar WINDOW k AS (PARTITION BY page_no, frame_id)),
        s AS (SELECT page_no, frame_id, any_value(n) AS n, sum((x-mx)*(x-mx)) AS xx, sum((x-mx)*(y-my)) AS xy, sum((y-my)*(y-my)) AS yy, sum((x-mx)*(u-mu)) AS xu, sum((y-my)*(u-mu)) AS yu, sum((x-mx)*(v-mv)) AS xv, sum((y-my)*(v-mv)) AS yv FROM c GROUP BY 1, 2),
        f AS (SELECT *, (xu*yy - yu*xy) / (xx*yy - xy*xy) AS a1, (yu*xx - xu*xy) / (xx*yy - xy*xy) AS a2, (xv*yy - yv*xy) / (xx*yy - xy*xy) AS b1, (yv*xx - xv*xy) / (xx*yy - xy*xy) AS b2 FROM s WHERE n > 3)
        SELECT page_no, frame_id, f.n, round(any_value(a1), 5) AS a1, round(any_value(b2), 5) AS b2, round(sqrt(avg(pow(a1*(x-mx) + a2*(y-my) - (u-mu), 2) + pow(b1*(x-mx) + b2*(y-my) - (v-mv), 2))), 3) AS rmse FROM f JOIN c USING (page_no, frame_id) GROUP BY 1, 2, 3"""),
    "loocv_similarity": with_("gcps", PLANAR + f""", w AS (SELECT *, count(*) OVER k - 1 AS n, sum(x) OVER k - x AS sx, sum(y) OVER k - y AS sy, sum(u) OVER k - u AS su, sum(v) OVER k - v AS sv, sum(x*u+y*v) OVER k - (x*u+y*v) AS p, sum(x*v-y*u) OVER k - (x*v-y*u) AS q, sum(x*x+y*y) OVER k - (x*x+y*y) AS r FROM planar WINDOW k AS (PARTITION BY page_no, frame_id)),
        f AS (SELECT *, {_AB} FROM w WHERE n > 0) SELECT page_no, frame_id, count(*) AS n, round(sqrt(avg(pow(su/n + a*(x - sx/n) - b*(y - sy/n) - u, 2) + pow(sv/n + b*(x - sx/n) + a*(y - sy/n) - v, 2))), 4) AS loocv FROM f GROUP BY 1, 2 HAVING count(*) > 2"""),
    "model_select": with_("gcps", _MERGED + _scoped("merged") + _SELECT),
    "seam_error": with_("gcps", PLANAR + _FIT + """, pl AS (SELECT page_no, frame_id, gcp % 9 AS name, a*x - b*y + c AS u, b*x + a*y + d AS v FROM planar JOIN par2 USING (page_no, frame_id) WHERE n >= 3),
        pr AS (SELECT l.page_no, [l.frame_id, r.frame_id] AS f, sqrt(pow(l.u - r.u, 2) + pow(l.v - r.v, 2)) AS d FROM pl l JOIN pl r ON l.page_no = r.page_no AND l.name = r.name AND l.frame_id < r.frame_id)
        SELECT page_no, frame_id, count(*) AS pairs, round(avg(d), 2) AS seam_m FROM (SELECT page_no, unnest(f) AS frame_id, d FROM pr) GROUP BY 1, 2"""),
    "route_transform": with_("gcps", PLANAR + f""", ff AS (SELECT page_no, frame_id, {_SUMS} FROM planar WHERE frame_id IN ('0','1','2') GROUP BY 1, 2 HAVING count(*) >= 4), f1 AS (SELECT *, {_AB} FROM ff), f2 AS (SELECT page_no, frame_id, a, b, (su - a*sx + b*sy) / n AS c, (sv - b*sx - a*sy) / n AS d FROM f1),
        f3 AS (SELECT page_no, frame_id, a, b, c, d, sqrt(avg(pow({_AWAY}, 2))) AS rmse FROM planar JOIN f2 USING (page_no, frame_id) GROUP BY ALL), pp AS (SELECT page_no, {_SUMS} FROM planar GROUP BY 1 HAVING count(*) >= 4), p1 AS (SELECT *, {_AB} FROM pp), p2 AS (SELECT page_no, a, b, (su - a*sx + b*sy) / n AS c, (sv - b*sx - a*sy) / n AS d FROM p1),
        p3 AS (SELECT page_no, a, b, c, d, sqrt(avg(pow({_AWAY}, 2))) AS rmse FROM planar JOIN p2 USING (page_no) GROUP BY ALL),
        j AS (SELECT gcp, x * 0.5::double AS x, y * 0.5::double AS y, f3.a AS fa, coalesce(f3.a, p3.a) AS a, coalesce(f3.b, p3.b) AS b, coalesce(f3.c, p3.c) AS c, coalesce(f3.d, p3.d) AS d, coalesce(f3.rmse, p3.rmse) AS rmse FROM planar LEFT JOIN f3 USING (page_no, frame_id) LEFT JOIN p3 ON planar.page_no = p3.page_no)
        SELECT gcp, CASE WHEN a IS NULL THEN 'route_not_transformed' WHEN fa IS NULL THEN 'page_model' ELSE 'frame_model' END AS used, round(133.0::double + degrees((a*x - b*y + c) / (6378137.0::double * cos(radians(33.5::double)))), 6) AS lon, round(33.5::double + degrees((b*x + a*y + d) / 6378137.0::double), 6) AS lat, round({_CONF}, 5) AS confidence FROM j"""),
    "review_queue": with_("gcps", PLANAR + _FIT + f""", md AS (SELECT page_no * 5 + frame_id::bigint AS unit, CASE WHEN n < 4 THEN 'fail' WHEN e < 50 THEN 'pass' WHEN e <= 150 THEN 'review' ELSE 'fail' END AS status FROM (SELECT page_no, frame_id, any_value(n) AS n, sqrt(avg(pow({_AWAY}, 2))) * 3 AS e FROM planar JOIN par2 USING (page_no, frame_id) GROUP BY 1, 2)),
        mn AS (SELECT DISTINCT page_no * 5 + frame_id::bigint AS unit FROM gcps WHERE source = 'manual' AND gcp % 3 = 0), g AS (SELECT o_orderkey % 130 AS unit, count(*) AS routes, sum(round(o_totalprice, 0)) AS length, count(*) FILTER (o_orderstatus = 'P') AS untransformed FROM orders GROUP BY 1),
        j AS (SELECT g.*, status, mn.unit IS NOT NULL AS manual, (SELECT max(length) FROM g) AS most FROM g LEFT JOIN md USING (unit) LEFT JOIN mn ON g.unit = mn.unit)
        SELECT unit, routes, untransformed, round(untransformed * 12.0::double + length / most * 25.0::double + CASE WHEN status IS NULL THEN 30 ELSE 0 END + CASE status WHEN 'fail' THEN 25 WHEN 'review' THEN 15 ELSE 0 END + CASE WHEN manual THEN 0 ELSE 20 END, 3) AS score,
        coalesce(nullif(concat_ws('|', CASE WHEN untransformed > 0 THEN 'untransformed_routes=' || untransformed END, CASE WHEN length >= most * 0.5::double THEN 'long_total_route_length' END, CASE WHEN status IS NULL THEN 'frame_model_missing' END, CASE status WHEN 'fail' THEN 'auto_gcp_fail' WHEN 'review' THEN 'auto_gcp_review' END, CASE WHEN NOT manual THEN 'no_manual_gcp' END), ''), 'low_priority') AS reasons
        , row_number() OVER (ORDER BY score DESC, untransformed DESC, length DESC, CASE coalesce(status, '') WHEN 'fail' THEN 3 WHEN 'review' THEN 2 WHEN '' THEN 1 ELSE 0 END DESC, unit // 5, unit)::int AS place FROM j"""),
}
