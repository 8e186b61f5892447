"""Queries for descriptive statistics."""

from pyspark.sql import functions as F

from loamfold.catalog.registry import Tables, query, r, rounded
from loamfold.catalog.scalar_queries import duck_sensor
from loamfold.functions.fixed import BOX_TARGETS, PH_TARGETS, SCATTER_PAIRS, TARGETS, YEAR_DAYS
from loamfold.operators import correlation, folds, learning, predictions, quantiles, statistics
from loamfold.plans import satellite
from loamfold.plans.satellite import ROLES

LISTED = ", ".join(TARGETS)
NAMES = [f"Target_{x}" for x in TARGETS]
CHEMISTRY = ["ph", "electrical_conductivity", "C_organic", "C_total"]


def union_all(items, template: str) -> str:
    return " UNION ALL ".join(template.replace("§", x) for x in items)


@query(
    "agg_shape",
    """SELECT 'train' AS table_name, count(*) AS n_rows, 26 AS n_cols FROM train
       UNION ALL SELECT 'test', count(*), 7 FROM test UNION ALL SELECT 'mask', count(*), 14 FROM mask""",
    "train test mask",
)
def agg_shape(t: Tables):
    return statistics.shapes({n: t.view(n) for n in ("train", "test", "mask")})


@query(
    "agg_dtypes",
    """SELECT column_name, CASE WHEN column_type = 'BIGINT' THEN 'bigint' WHEN column_type = 'INTEGER' THEN 'int'
         WHEN column_type = 'DOUBLE' THEN 'double' WHEN column_type = 'VARCHAR' THEN 'string'
         WHEN column_type LIKE 'TIMESTAMP%' THEN 'timestamp_ntz' END AS data_type, n_values FROM (DESCRIBE lineitem)
         JOIN (SELECT name, n_values FROM (SELECT count(COLUMNS(*)) FROM lineitem) UNPIVOT (n_values FOR name IN (*))) ON name = column_name""",
)
def agg_dtypes(t: Tables):
    return statistics.column_types(t.table("lineitem")).select("column_name", "data_type", "n_values")


@query(
    "agg_missing_pct",
    "SELECT * FROM ("
    + union_all(
        ["ph", "Depth_cm", "Latitude", "site", *TARGETS],
        "SELECT '§' AS metric, round(avg(CASE WHEN § IS NULL THEN 1e0 ELSE 0e0 END) * 1e2, 6) AS missing_pct FROM train",
    )
    + ") WHERE missing_pct > 0 ORDER BY missing_pct DESC",
    "train",
)
def agg_missing_pct(t: Tables):
    rates = statistics.missing_pct(t.view("train"), ["ph", "Depth_cm", "Latitude", "site", *TARGETS])
    return rounded(rates.orderBy(F.desc("missing_pct"), "metric"))


@query(
    "agg_target_summary",
    union_all(
        TARGETS,
        "SELECT '§' AS metric, round(avg(§), 6) AS mean, round(quantile_cont(§, 0.5), 6) AS median, max(§) AS max FROM train",
    ),
    "train",
)
def agg_target_summary(t: Tables):
    return rounded(statistics.target_summary(t.view("train"), TARGETS), columns=["mean", "median"])


@query(
    "agg_value_counts",
    "SELECT Depth_cm, count(*) AS n FROM train WHERE Depth_cm IS NOT NULL GROUP BY Depth_cm ORDER BY n DESC",
    "train",
)
def agg_value_counts(t: Tables):
    return statistics.value_counts(t.view("train"), "Depth_cm").orderBy(F.desc("n"), "Depth_cm")


MEDIAN_CELLS = ", ".join(f"round(quantile_cont({x}, 0.5), 6) AS {x}" for x in TARGETS)


@query("agg_group_median", f"SELECT Depth_cm, {MEDIAN_CELLS} FROM train GROUP BY Depth_cm", "train")
def agg_group_median(t: Tables):
    return rounded(statistics.group_medians(t.view("train"), "Depth_cm", TARGETS, keep_null_group=True))


@query(
    "agg_group_median_known",
    f"SELECT Depth_cm, {MEDIAN_CELLS} FROM train WHERE Depth_cm IS NOT NULL GROUP BY Depth_cm",
    "train",
)
def agg_group_median_known(t: Tables):
    return rounded(statistics.group_medians(t.view("train"), "Depth_cm", TARGETS, keep_null_group=False))


@query(
    "agg_describe",
    union_all(
        TARGETS,
        "SELECT '§' AS metric, count(§) AS count, round(avg(§), 6) AS mean, round(stddev_samp(§), 6) AS std, "
        "round(min(§), 6) AS min, round(max(§), 6) AS max, "
        + ", ".join(f"round(quantile_cont(§, {p / 100}), 6) AS p{p}" for p in (10, 25, 50, 75, 90))
        + " FROM train",
    ),
    "train",
)
def agg_describe(t: Tables):
    return rounded(statistics.describe(t.view("train"), TARGETS))


@query(
    "agg_skew_adjusted",
    union_all(TARGETS, "SELECT '§' AS metric, round(skewness(§), 6) AS skew FROM train"),
    "train",
)
def agg_skew_adjusted(t: Tables):
    return rounded(statistics.per_column(t.view("train"), TARGETS, {"skew": statistics.sample_skew}))


@query(
    "agg_cv_pct",
    union_all(TARGETS, "SELECT '§' AS metric, round(stddev_samp(§) / avg(§) * 1e2, 1) AS cv_pct FROM train"),
    "train",
)
def agg_cv_pct(t: Tables):
    return statistics.per_column(t.view("train"), TARGETS, {"cv_pct": statistics.cv_pct})


def _pairs(diagonal: bool):
    return correlation.lower_triangle(TARGETS, diagonal)


@query(
    "agg_corr_pearson",
    " UNION ALL ".join(
        f"SELECT '{a}' AS x_name, '{b}' AS y_name, round(corr({a}, {b}), 6) AS r FROM train" for a, b in _pairs(False)
    ),
    "train",
)
def agg_corr_pearson(t: Tables):
    return rounded(correlation.pearson(t.view("train"), TARGETS))


RANKED = (
    "SELECT '{a}' AS x_name, '{b}' AS y_name, round(corr(rx, ry), 6) AS r FROM (SELECT "
    "rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2e0 AS rx, "
    "rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2e0 AS ry "
    "FROM train WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
)


@query("agg_corr_spearman", " UNION ALL ".join(RANKED.format(a=a, b=b) for a, b in _pairs(True)), "train")
def agg_corr_spearman(t: Tables):
    return rounded(correlation.spearman(t.view("train"), TARGETS))


@query(
    "agg_corr_embedding",
    """WITH v AS (SELECT vec_id, unnest(embedding) AS value, unnest(range(64)) AS pos FROM embeddings)
       SELECT 'e' || x.pos AS x_name, 'e' || y.pos AS y_name,
         round(corr(CAST(x.value AS DOUBLE), CAST(y.value AS DOUBLE)), 6) AS r
       FROM v x JOIN v y ON x.vec_id = y.vec_id AND x.pos > y.pos GROUP BY x.pos, y.pos""",
)
def agg_corr_embedding(t: Tables):
    """Pairwise correlation of a wide numeric table: 2,016 pairs in one pass."""
    names = [f"e{i}" for i in range(64)]
    wide = t.table("embeddings").select(*[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)])
    return rounded(correlation.pearson(wide, names))


def transformed_sql(a: str, b: str) -> str:
    return f"""SELECT '{a}' AS x_name, '{b}' AS y_name, round(corr(x, y), 6) AS r_raw,
        CASE WHEN min(y) >= 0 THEN round(corr(x, CASE WHEN y >= 0 THEN ln(1e0 + y) END), 6) END AS r_semilog,
        round(CASE WHEN min(x) >= 0 AND min(y) >= 0 THEN corr(CASE WHEN x >= 0 THEN ln(1e0 + x) END, CASE WHEN y >= 0 THEN ln(1e0 + y) END)
          WHEN min(y) >= 0 THEN corr(x, CASE WHEN y >= 0 THEN ln(1e0 + y) END)
          WHEN min(x) >= 0 THEN corr(CASE WHEN x >= 0 THEN ln(1e0 + x) END, y) ELSE corr(x, y) END, 6) AS r_log
        FROM (SELECT {a} AS x, {b} AS y FROM train_numeric WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"""


TRANSFORMED = [*[("ph", x) for x in PH_TARGETS], *[p for p in SCATTER_PAIRS if p[0] != "ph"], ("Al", "C_organic")]


@query("agg_corr_transformed", " UNION ALL ".join(transformed_sql(a, b) for a, b in TRANSFORMED), "train_numeric")
def agg_corr_transformed(t: Tables):
    return rounded(correlation.transformed(t.view("train_numeric"), TRANSFORMED))


@query(
    "agg_linear_trend",
    "WITH fits AS ("
    + union_all(
        PH_TARGETS,
        "SELECT '§' AS metric, regr_slope(ln(1e0 + §), ph) AS slope, regr_intercept(ln(1e0 + §), ph) AS intercept, "
        "min(ph) AS lo, max(ph) AS hi FROM train_numeric WHERE § IS NOT NULL AND ph IS NOT NULL",
    )
    + """) SELECT metric, CAST(k AS INT) AS k, round(slope, 6) AS slope, round(intercept, 6) AS intercept,
      round(lo + (hi - lo) * (k / 99e0), 6) AS x, round(slope * (lo + (hi - lo) * (k / 99e0)) + intercept, 6) AS y
      FROM fits, range(100) g(k)""",
    "train_numeric",
)
def agg_linear_trend(t: Tables):
    return rounded(statistics.linear_trend(t.view("train_numeric"), "ph", PH_TARGETS))


def histogram_sql(value: str, where: str, view: str = "train") -> str:
    return union_all(
        TARGETS,
        "SELECT '§' AS metric, bin, count(*) AS n FROM (SELECT CAST(least(coalesce(floor((v - lo) / nullif((hi - lo) / 6e1, 0)), 0), 59) AS INT) AS bin "
        f"FROM (SELECT {value} AS v, min({value}) OVER () AS lo, max({value}) OVER () AS hi FROM {view} WHERE {where})) GROUP BY bin",
    )


@query("agg_histogram", histogram_sql("§", "§ IS NOT NULL"), "train")
def agg_histogram(t: Tables):
    return statistics.histogram(t.view("train"), TARGETS)


@query("agg_histogram_log", histogram_sql("ln(1e0 + §)", "§ > 0"), "train")
def agg_histogram_log(t: Tables):
    return statistics.histogram(t.view("train"), TARGETS, log=True)


def box_sql(view: str, targets: list[str]) -> str:
    inside = "v BETWEEN q1 - 15e-1 * (q3 - q1) AND q3 + 15e-1 * (q3 - q1)"
    stacked = union_all(
        targets,
        f"SELECT Depth_cm, '§' AS metric, ln(1e0 + greatest(§, 0e0)) AS v FROM {view} "
        "WHERE § IS NOT NULL AND Depth_cm IS NOT NULL",
    )
    return f"""WITH rows_long AS ({stacked}),
      q AS (SELECT Depth_cm, metric, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
        quantile_cont(v, 0.75) AS q3 FROM rows_long GROUP BY ALL)
      SELECT Depth_cm, metric, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
        round(min(v) FILTER (WHERE {inside}), 6) AS whisker_low,
        round(max(v) FILTER (WHERE {inside}), 6) AS whisker_high,
        count(*) FILTER (WHERE NOT {inside}) AS outliers
      FROM rows_long JOIN q USING (Depth_cm, metric) GROUP BY Depth_cm, metric, q.q1, q.median, q.q3"""


@query("agg_box_stats", box_sql("train", BOX_TARGETS), "train")
def agg_box_stats(t: Tables):
    return rounded(statistics.box_stats(t.view("train"), "Depth_cm", BOX_TARGETS))


COVERAGE = union_all(TARGETS, "SELECT '§' AS metric, sum(§) AS kept, count(§) AS cells FROM mask")


@query(
    "agg_mask_coverage",
    f"""WITH per AS ({COVERAGE}) SELECT metric, CAST(kept AS BIGINT) AS kept, round(kept / cells * 1e2, 6) AS kept_pct FROM per
        UNION ALL SELECT 'all', CAST(sum(kept) AS BIGINT), round(sum(kept) / sum(cells) * 1e2, 6) FROM per""",
    "mask",
)
def agg_mask_coverage(t: Tables):
    return rounded(statistics.mask_coverage(t.view("mask"), TARGETS))


@query(
    "agg_mask_coverage_labels",
    """SELECT 'quality' AS metric, CAST(sum(quality) AS BIGINT) AS kept, round(avg(quality) * 1e2, 6) AS kept_pct FROM labels
       UNION ALL SELECT 'toxic', CAST(sum(toxic) AS BIGINT), round(avg(toxic) * 1e2, 6) FROM labels
       UNION ALL SELECT 'all', CAST(sum(quality + toxic) AS BIGINT), round(sum(quality + toxic) / (2e0 * count(*)) * 1e2, 6) FROM labels""",
)
def agg_mask_coverage_labels(t: Tables):
    return rounded(statistics.mask_coverage(t.table("labels"), ["quality", "toxic"]))


MEDIAN_FEATURES = ["Latitude", "Longitude", "electrical_conductivity", "C_organic", "C_total", "ph"]


@query(
    "agg_medians_table",
    union_all(MEDIAN_FEATURES, "SELECT '§' AS metric, round(quantile_cont(§, 0.5), 6) AS median FROM train_numeric")
    + " UNION ALL SELECT 'e' || pos, round(quantile_cont(value, 0.5), 6) FROM (SELECT CAST(unnest(embedding) AS DOUBLE) AS value, unnest(range(64)) AS pos FROM embeddings) GROUP BY pos",
    "train_numeric",
)
def agg_medians_table(t: Tables):
    vectors = t.table("embeddings").select(
        *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)]
    )
    tables = [
        quantiles.exact_quantiles(df, names, [0.5]).select("metric", F.col("q0").alias("median"))
        for df, names in ((t.view("train_numeric"), MEDIAN_FEATURES), (vectors, vectors.columns))
    ]
    return rounded(tables[0].unionByName(tables[1]))


@query("agg_nonnull_count", union_all(TARGETS, "SELECT '§' AS metric, count(§) AS n FROM train"), "train")
def agg_nonnull_count(t: Tables):
    return statistics.nonnull_counts(t.view("train"), TARGETS)


# --- errors and predictions -------------------------------------------------------------


@query(
    "agg_rmse_pooled",
    "SELECT target, round(sqrt(avg(power(y - greatest(pred, 0e0), 2))), 6) AS rmse FROM oof GROUP BY target",
    "oof",
)
def agg_rmse_pooled(t: Tables):
    return rounded(learning.rmse_pooled(t.view("oof")))


@query(
    "agg_rmse_fold_mean",
    """SELECT target, round(avg(e), 6) AS rmse_log FROM (SELECT target, fold,
         sqrt(avg(power(ln(1e0 + y) - ln(1e0 + greatest(pred, 0e0)), 2))) AS e FROM oof GROUP BY target, fold) GROUP BY target""",
    "oof",
)
def agg_rmse_fold_mean(t: Tables):
    logs = t.view("oof").select(
        "target", "fold", F.log1p("y").alias("y_log"), F.log1p(F.greatest("pred", F.lit(0.0))).alias("pred_log")
    )
    return rounded(learning.rmse_fold_mean(logs))


@query(
    "agg_rmse_macro",
    """WITH s1 AS (SELECT target, sqrt(avg(power(y - greatest(pred, 0e0), 2))) AS e FROM oof GROUP BY target),
       s2 AS (SELECT target, sqrt(avg(power(y - greatest(pred * 11e-1, 0e0), 2))) AS e FROM oof GROUP BY target)
       SELECT target, stage, round(e, 6) AS rmse, round(avg(e) OVER (PARTITION BY stage), 6) AS macro_rmse,
         rank() OVER (PARTITION BY stage ORDER BY e DESC) AS worst
       FROM (SELECT 'stage1' AS stage, * FROM s1 UNION ALL SELECT 'stage2', * FROM s2)""",
    "oof",
)
def agg_rmse_macro(t: Tables):
    from pyspark.sql import Window

    first = learning.rmse_pooled(t.view("oof"))
    second = learning.rmse_pooled(t.view("oof").withColumn("pred", F.col("pred") * 1.1))
    stages = {"stage1": first, "stage2": second}
    macro = learning.rmse_macro(stages)
    tagged = first.withColumn("stage", F.lit("stage1")).unionByName(second.withColumn("stage", F.lit("stage2")))
    # One row per target and stage: the window sees a handful of rows.
    worst = F.rank().over(Window.partitionBy("stage").orderBy(F.desc("rmse")))
    return rounded(tagged.withColumn("worst", worst.cast("bigint")).join(macro, "stage"))


@query(
    "agg_fold_mean_prediction",
    """SELECT site AS ID, target, round(avg(pred_log), 6) AS pred_log FROM (SELECT e.user_id AS site, o.target, o.fold,
         ln(1e0 + greatest(o.pred, 0e0)) AS pred_log FROM oof o JOIN events e ON o.ID = e.event_id) GROUP BY ALL""",
    "oof",
)
def agg_fold_mean_prediction(t: Tables):
    sites = t.table("events").select(F.col("event_id").alias("ID"), "user_id")
    rows = t.view("oof").join(sites, "ID").select(
        F.col("user_id").alias("ID"), "target", "fold", F.log1p(F.greatest("pred", F.lit(0.0))).alias("pred_log")
    )
    return rounded(learning.fold_mean(rows))


@query(
    "agg_nonzero_stats",
    union_all(
        NAMES,
        "SELECT '§' AS metric, count(*) AS n, round(avg(§), 6) AS mean, min(§) AS min, "
        "round(quantile_cont(§, 0.5), 6) AS median, max(§) AS max FROM preds_a WHERE § > 0",
    ),
    "preds_a",
)
def agg_nonzero_stats(t: Tables):
    return rounded(statistics.nonzero_stats(t.view("preds_a"), NAMES), columns=["mean", "median"])


@query(
    "agg_violation_counts",
    union_all(
        TARGETS,
        "SELECT '§' AS target, count(*) FILTER (WHERE Target_§ IS NULL) AS nulls, "
        "count(*) FILTER (WHERE Target_§ < 0) AS negatives, "
        "count(*) FILTER (WHERE m.§ = 0 AND (Target_§ IS NULL OR Target_§ <> 0)) AS mask_violations "
        "FROM preds_a p LEFT JOIN mask m ON p.ID = m.ID",
    ),
    "preds_a mask",
)
def agg_violation_counts(t: Tables):
    return predictions.violations(t.view("preds_a"), t.view("mask"))


@query(
    "agg_block_sizes",
    """SELECT spatial_block, count(*) AS n FROM (SELECT CAST(CAST(floor(Latitude / 5e-1) AS BIGINT) AS VARCHAR) || '_'
         || CAST(CAST(floor(Longitude / 5e-1) AS BIGINT) AS VARCHAR) AS spatial_block FROM samples) GROUP BY spatial_block""",
    "samples",
)
def agg_block_sizes(t: Tables):
    from loamfold.functions.coords import block_key

    blocked = t.view("samples").select(block_key(F.col("Latitude"), F.col("Longitude")).alias("spatial_block"))
    return folds.block_sizes(blocked)


@query(
    "agg_climate_normals",
    """WITH days AS (SELECT ID, unnest(temps) AS t, unnest(rains) AS p FROM daily)
       SELECT ID, round(avg(t), 6) AS climate_annual_temp_mean,
         round(sum(p) / greatest(count(p) // 365, 1), 4) AS climate_annual_precip_mm,
         round(stddev_pop(t), 6) AS climate_temp_std FROM days GROUP BY ID""",
    "daily",
)
def agg_climate_normals(t: Tables):
    out = statistics.climate_normals(t.view("daily"), "ID", "temps", "rains", YEAR_DAYS)
    precip = r("climate_annual_precip_mm", 4)
    return rounded(out.withColumn("climate_annual_precip_mm", precip), columns=["climate_annual_temp_mean", "climate_temp_std"])


COMPOSITE = (
    "SELECT pixel_id, "
    + ", ".join(f"round(quantile_cont({b}, 0.5), 9) AS {b}" for b in ROLES)
    + " FROM scenes WHERE sensor = 'S2' AND cloud_pct < 20 AND ts >= DATE '2020-01-01' AND ts < DATE '2023-12-31' GROUP BY pixel_id"
)


@query("agg_median_composite", COMPOSITE, "scenes")
def agg_median_composite(t: Tables):
    scenes = t.view("scenes")
    return rounded(satellite.recent_composite(scenes), 9)


@query(
    "agg_region_mean",
    f"""WITH composite AS ({COMPOSITE.replace('round(quantile_cont', '(quantile_cont').replace(', 0.5), 9)', ', 0.5))')}),
        regions AS (SELECT *, pixel_id % 10 AS region FROM composite)
        SELECT region, """
    + ", ".join(f"round(avg({e}), 8) AS s2_recent_{n}" for n, e in duck_sensor("S2").items())
    + " FROM regions GROUP BY region",
    "scenes",
)
def agg_region_mean(t: Tables):
    scenes = t.view("scenes")
    composite = satellite.recent_composite(scenes)
    regions = composite.withColumn("region", F.col("pixel_id") % 10)
    return rounded(satellite.site_means(regions, "S2", "s2_recent_", ["region"]), 8)
