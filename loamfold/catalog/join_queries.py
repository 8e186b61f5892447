"""Queries for keyed and spatial joins and for set operations."""

from pyspark.sql import functions as F

from loamfold.catalog.registry import Tables, query, r, rounded
from loamfold.catalog.scalar_queries import CENTRES_SQL, DUCK_COORD_KEY, fixed_centres
from loamfold.functions.fixed import BATCH_ROWS, RADIUS_M, RECENT_WINDOW, TARGETS
from loamfold.operators import joins, ordering, predictions, spatial, tables
from loamfold.plans import features

NAMES = [f"Target_{x}" for x in TARGETS]


@query(
    "join_dates_left",
    """SELECT t.ID, t.Depth_cm, d.start_date, d.end_date FROM test_undated t
       LEFT JOIN (SELECT * FROM dates WHERE "set" = 'Test') d ON t.ID = d.ID""",
    "test_undated dates",
)
def join_dates_left(t: Tables):
    test = t.view("test_undated").select("ID", "Depth_cm")
    return features.attach_test_dates(test, t.view("dates"))


@query(
    "join_dates_suffix",
    """SELECT s.ID, s.start_date, s.end_date, d.start_date AS start_date_dates, d.end_date AS end_date_dates
       FROM samples s LEFT JOIN dates d ON s.ID = d.ID""",
    "samples dates",
)
def join_dates_suffix(t: Tables):
    base = t.view("samples").select("ID", "start_date", "end_date")
    return joins.left_with_suffix(base, t.view("dates"), ["start_date", "end_date"])


@query(
    "join_covariates_chain",
    """SELECT s.ID, s.Latitude, s.Longitude, k.a, m.Al, m.B FROM samples s
       LEFT JOIN (SELECT ID, arg_max_null(a, seq) AS a FROM cache GROUP BY ID) k ON s.ID = k.ID
       LEFT JOIN mask m ON s.ID = m.ID""",
    "samples cache mask",
)
def join_covariates_chain(t: Tables):
    spine = t.view("samples").select("ID", "Latitude", "Longitude")
    newest = ordering.latest_per_key(t.view("cache"), "ID", "seq").select("ID", "a", F.lit(0.0).alias("Latitude"))
    return joins.covariate_chain(spine, [newest, t.view("mask").select("ID", "Al", "B")])


LENIENT = (
    "SELECT p.ID, "
    + ", ".join(f"p.Target_{x} * coalesce(m.{x}, 0) AS Target_{x}" for x in TARGETS)
    + " FROM preds_a p LEFT JOIN mask m ON p.ID = m.ID"
)


@query("join_mask_lenient", LENIENT, "preds_a mask")
def join_mask_lenient(t: Tables):
    return predictions.mask_lenient(t.view("preds_a"), t.view("mask"))


@query(
    "join_mask_strict",
    "SELECT p.ID, "
    + ", ".join(f"p.Target_{x} * m.{x} AS Target_{x}" for x in TARGETS if x != "Zn")
    + ", 0e0 AS Target_Zn FROM preds_a p JOIN full_mask m ON p.ID = m.ID",
    "preds_a full_mask",
)
def join_mask_strict(t: Tables):
    return predictions.mask_strict(t.view("preds_a"), t.view("full_mask").drop("Zn"))


@query(
    "join_stage1_features",
    "WITH medians AS (SELECT "
    + ", ".join(f"quantile_cont(Target_{x}, 0.5) AS m_{x}" for x in TARGETS)
    + " FROM preds_a) SELECT t.ID, t.Latitude, "
    + ", ".join(f"round(coalesce(p.Target_{x}, m_{x}), 6) AS oof_{x}" for x in TARGETS if x != "Ca")
    + " FROM test t LEFT JOIN preds_a p ON t.ID = p.ID, medians",
    "test preds_a",
)
def join_stage1_features(t: Tables):
    preds = t.view("preds_a").withColumnsRenamed({f"Target_{x}": x for x in TARGETS})
    base = t.view("test").select("ID", "Latitude")
    out = joins.stage1_features(base, preds, "Ca", TARGETS)
    return rounded(out, columns=[c for c in out.columns if c.startswith("oof_")])


@query(
    "join_stage1_features_log",
    "SELECT t.ID, "
    + ", ".join(
        f"round(coalesce(CASE WHEN p.Target_{x} IS NOT NULL THEN ln(1e0 + greatest(p.Target_{x}, 0e0)) END, 0e0), 6) AS oof_{x}"
        for x in TARGETS
        if x != "Ca"
    )
    + " FROM test t LEFT JOIN preds_a p ON t.ID = p.ID",
    "test preds_a",
)
def join_stage1_features_log(t: Tables):
    preds = t.view("preds_a").withColumnsRenamed({f"Target_{x}": x for x in TARGETS})
    return rounded(joins.stage1_features(t.view("test").select("ID"), preds, "Ca", TARGETS, "regex", is_test=True))


@query(
    "join_anti_pending",
    """WITH done AS (SELECT DISTINCT ID FROM cache WHERE a IS NOT NULL OR b IS NOT NULL)
       SELECT ID, (SELECT count(*) FROM samples WHERE ID IN (SELECT ID FROM done)) AS cached,
         (SELECT count(*) FROM samples WHERE ID NOT IN (SELECT ID FROM done)) AS remaining
       FROM samples WHERE ID NOT IN (SELECT ID FROM done)""",
    "samples cache",
)
def join_anti_pending(t: Tables):
    points, cache = t.view("samples").select("ID"), t.view("cache").drop("seq")
    progress = joins.cache_progress(points, cache).select(F.struct("cached", "remaining")).scalar()
    return joins.pending(points, cache).select(
        "ID", progress.getField("cached").alias("cached"), progress.getField("remaining").alias("remaining")
    )


@query(
    "join_rounded_coord",
    f"""WITH docs AS (SELECT {DUCK_COORD_KEY.format('lat')} AS lat_key, {DUCK_COORD_KEY.format('lon')} AS lon_key,
          max(s_suppkey) AS s_suppkey FROM soil GROUP BY 1, 2)
        SELECT ID, s_suppkey FROM (SELECT ID, {DUCK_COORD_KEY.format('Latitude')} AS lat_key,
          {DUCK_COORD_KEY.format('Longitude')} AS lon_key FROM samples) p LEFT JOIN docs USING (lat_key, lon_key)""",
    "samples soil",
)
def join_rounded_coord(t: Tables):
    docs = spatial.with_rounded_keys(t.view("soil"), "lat", "lon").groupBy("lat_key", "lon_key").agg(
        F.max("s_suppkey").alias("s_suppkey")
    )
    return spatial.documents_at(t.view("samples").select("ID", "Latitude", "Longitude"), docs).select("ID", "s_suppkey")


def raster_cells(t: Tables):
    return t.view("cells").unpivot(["row", "col"], ["bio1", "bio12"], "layer", "value")


@query(
    "join_raster_cell",
    """SELECT ID, nullif(bio1, -9999e0) AS wc_bio1, nullif(bio12, -9999e0) AS wc_bio12 FROM samples
       LEFT JOIN cells ON "row" = CAST(floor((35e0 - Latitude) / 14e-1) AS BIGINT)
         AND "col" = CAST(floor((Longitude + 2e1) / 24e-1) AS BIGINT)""",
    "samples cells",
)
def join_raster_cell(t: Tables):
    points = t.view("samples").select("ID", "Latitude", "Longitude")
    out = spatial.raster_values(points, raster_cells(t), ["bio1", "bio12"], (35.0, -20.0), (1.4, 2.4), -9999.0)
    return out.select("ID", "wc_bio1", "wc_bio12")


DUCK_DISTANCE = """2e0 * 6371008.8e0 * asin(sqrt(least(1e0, power(sin(radians(p.Latitude - s.Latitude) / 2e0), 2)
    + cos(radians(s.Latitude)) * cos(radians(p.Latitude)) * power(sin(radians(p.Longitude - s.Longitude) / 2e0), 2))))"""

NEAR = f"""sites AS (SELECT DISTINCT Latitude, Longitude FROM samples WHERE Latitude IS NOT NULL AND Longitude IS NOT NULL),
    near AS (SELECT s.Latitude, s.Longitude, p.pixel_id, {DUCK_DISTANCE} AS distance_m FROM sites s, pixels p
      WHERE {DUCK_DISTANCE} <= 5e2)"""


@query(
    "join_within_radius",
    f"""WITH {NEAR} SELECT ID, pixel_id, round(distance_m, 4) AS distance_m FROM samples
        JOIN near USING (Latitude, Longitude)""",
    "samples pixels",
)
def join_within_radius(t: Tables):
    points = t.view("samples").select("ID", "Latitude", "Longitude").na.drop()
    sites = points.select("Latitude", "Longitude").distinct()
    near = spatial.within_radius(sites, t.view("pixels"), RADIUS_M)
    return points.join(near, ["Latitude", "Longitude"]).select("ID", "pixel_id", r("distance_m", 4).alias("distance_m"))


def dated_points(t: Tables):
    """Points with the window of their collection years."""
    from loamfold.functions import dates

    start, end = (dates.parse_dayfirst(F.col(c)) for c in ("start_date", "end_date"))
    return t.view("samples").select(
        "ID",
        "site",
        "Latitude",
        "Longitude",
        dates.year_or(start, 2013).alias("start_year"),
        dates.year_or(end, 2018).alias("end_year"),
    )


@query(
    "join_date_window",
    """WITH windows AS (SELECT DISTINCT site, start_year, end_year FROM (SELECT site,
           coalesce(CAST(year({0}) AS INT), 2013) AS start_year, coalesce(CAST(year({1}) AS INT), 2018) AS end_year
         FROM samples))
       SELECT w.site, w.start_year, w.end_year, count(*) AS n_scenes,
         count(*) FILTER (WHERE s.ts >= DATE '2020-01-01' AND s.ts < DATE '2023-12-31') AS n_recent,
         min(s.ts) AS first_ts, max(s.ts) AS last_ts
       FROM windows w JOIN scenes s ON s.pixel_id = w.site
        AND s.ts >= make_date(w.start_year, 1, 1) AND s.ts < make_date(w.end_year, 12, 31)
       GROUP BY ALL""".format(
        "CAST(coalesce(try_strptime(start_date, '%d/%m/%Y'), try_strptime(start_date, '%Y-%m-%d')) AS DATE)",
        "CAST(coalesce(try_strptime(end_date, '%d/%m/%Y'), try_strptime(end_date, '%Y-%m-%d')) AS DATE)",
    ),
    "samples scenes",
)
def join_date_window(t: Tables):
    windows = dated_points(t).select(F.col("site").alias("pixel_id"), "start_year", "end_year").distinct()
    first, last = (F.lit(day).cast("date") for day in RECENT_WINDOW)
    # counts, first and last combine, so the scenes of a pixel are counted per day before they meet its windows
    days = t.view("scenes").groupBy("pixel_id", F.to_date("ts").alias("day")).agg(
        F.count("*").alias("n"), F.min("ts").alias("ts"), F.max("ts").alias("last"), F.count_if(spatial.in_window(F.col("ts"), first, last)).alias("recent")
    )
    matched = spatial.scenes_in_windows(windows, days, ["pixel_id"]).withColumnRenamed("pixel_id", "site")
    return matched.groupBy("site", "start_year", "end_year").agg(
        F.sum("n").alias("n_scenes"),
        F.sum("recent").alias("n_recent"),
        F.min("ts").alias("first_ts"),
        F.max("last").alias("last_ts"),
    )


@query(
    "join_nearest_centre",
    f"""WITH {CENTRES_SQL}, d AS (SELECT ID, cluster, sqrt(power(coalesce(Latitude, 0) - c_lat, 2)
           + power(coalesce(Longitude, 0) - c_lon, 2)) AS d FROM samples, centres)
        SELECT ID, arg_min(cluster, d) AS cluster, round(min(d), 6) AS centre_distance FROM d GROUP BY ID""",
    "train samples",
)
def join_nearest_centre(t: Tables):
    points = t.view("samples").select("ID", "Latitude", "Longitude")
    lat, lon = F.coalesce("Latitude", F.lit(0.0)), F.coalesce("Longitude", F.lit(0.0))
    out = spatial.nearest_centre(points, fixed_centres(t), lat, lon)
    return out.select("ID", "cluster", r("centre_distance").alias("centre_distance"))


@query(
    "join_code_dictionary",
    """WITH codes AS (SELECT Depth_cm, row_number() OVER (ORDER BY Depth_cm) - 1 AS code FROM
           (SELECT DISTINCT coalesce(Depth_cm, 'unknown') AS Depth_cm FROM train))
       SELECT ID, coalesce(code, -1) AS depth_label_enc FROM (SELECT ID, coalesce(Depth_cm, 'unknown') AS Depth_cm,
         CASE WHEN ID % 16 = 0 THEN '90-120' ELSE coalesce(Depth_cm, 'unknown') END AS label FROM test) x
       LEFT JOIN codes ON codes.Depth_cm = x.label""",
    "train test",
)
def join_code_dictionary(t: Tables):
    labels = t.view("train").select(F.coalesce("Depth_cm", F.lit("unknown")).alias("label"))
    label = F.when(F.col("ID") % 16 == 0, F.lit("90-120")).otherwise(F.coalesce("Depth_cm", F.lit("unknown")))
    test = t.view("test").select("ID", label.alias("label"))
    coded = joins.with_code(test, ordering.label_codes(labels, "label"), "label", "depth_label_enc")
    return coded.select("ID", "depth_label_enc")


def elevation_replies(t: Tables, points):
    """One reply per batch: a value per requested point, every seventh batch shorter by one."""
    batched = ordering.with_batches(points.select("ID"), ["ID"], BATCH_ROWS)
    values = F.transform(F.array_sort(F.collect_list("ID")), lambda i: (i % 500).cast("double"))
    short = F.when(F.col("batch_id") % 7 == 3, F.slice("v", 1, F.size("v") - 1)).otherwise(F.col("v"))
    return batched.groupBy("batch_id").agg(values.alias("v")).select("batch_id", short.alias("results"))


@query(
    "join_batch_results",
    """WITH b AS (SELECT ID, (row_number() OVER (ORDER BY ID) - 1) // 100 AS batch_id,
         (row_number() OVER (ORDER BY ID) - 1) % 100 AS pos FROM samples),
       s AS (SELECT batch_id, count(*) AS n FROM b GROUP BY batch_id)
       SELECT b.ID, b.batch_id, b.pos, CASE WHEN b.batch_id % 7 = 3 AND pos = n - 1 THEN NULL
         ELSE CAST(b.ID % 500 AS DOUBLE) END AS elevation_m FROM b JOIN s USING (batch_id)""",
    "samples",
)
def join_batch_results(t: Tables):
    points = t.view("samples").select("ID")
    requests = ordering.with_batches(points, ["ID"], BATCH_ROWS)
    return joins.batch_results(requests, elevation_replies(t, points), "elevation_m")


@query(
    "optional_merge",
    """SELECT s.ID, s.Depth_cm, m.Al, m.B FROM samples s LEFT JOIN mask m ON s.ID = m.ID""",
    "samples mask",
)
def optional_merge(t: Tables):
    """The first table is there and is merged, the second is not and is passed over."""
    from loamfold.session import fresh_path
    from loamfold.sources.readers import read_if_present
    from loamfold.sources.writers import write_csv

    path = fresh_path(t.spark, "covariates")
    write_csv(t.view("mask").select("ID", "Al", "B"), path)
    out = t.view("samples").select("ID", "Depth_cm")
    for where in (path, f"{path}-absent"):
        out = joins.optional_merge(out, read_if_present(t.spark, where, "ID long, Al int, B int"))
    return out


# --- set operations ---------------------------------------------------------------------


@query(
    "union_locations",
    """SELECT ID, Latitude, Longitude FROM (SELECT ID, arg_min(Latitude, o) AS Latitude, arg_min(Longitude, o) AS Longitude
         FROM (SELECT ID, coalesce(Latitude, 1e9) AS Latitude, coalesce(Longitude, 1e9) AS Longitude, 0 AS o FROM train
           UNION ALL SELECT ID - ID % 16, coalesce(Latitude, 1e9) + 1e0, coalesce(Longitude, 1e9), 1 + ID % 16 FROM test)
         GROUP BY ID) WHERE Latitude < 1e8 AND Longitude < 1e8""",
    "train test",
)
def union_locations(t: Tables):
    test = t.view("test")
    first = test.where(F.col("ID") % 16 == 0)
    second = test.where(F.col("ID") % 16 != 0).withColumn("ID", F.col("ID") - F.col("ID") % 16)
    shifted = [df.withColumn("Latitude", F.col("Latitude") + 1e0) for df in (first, second)]
    return tables.union_locations([t.view("train"), *shifted])


@query(
    "union_varying_keys",
    """SELECT ID, Al, CAST(NULL AS DOUBLE) AS Zn, CAST(NULL AS VARCHAR) AS Depth_cm FROM train
       UNION ALL SELECT ID, NULL, Zn, NULL FROM train WHERE Zn > 100 UNION ALL SELECT ID, NULL, NULL, Depth_cm FROM test""",
    "train test",
)
def union_varying_keys(t: Tables):
    train = t.view("train")
    return tables.union_varying(
        [train.select("ID", "Al"), train.where(F.col("Zn") > 100).select("ID", "Zn"), t.view("test").select("ID", "Depth_cm")]
    )


@query(
    "union_categories",
    "SELECT o_orderpriority AS label FROM orders UNION SELECT p_brand FROM part UNION SELECT p_type FROM part",
)
def union_categories(t: Tables):
    parts = [
        t.table("orders").select(F.col("o_orderpriority").alias("label")),
        t.table("part").select(F.col("p_brand").alias("label")),
        t.table("part").select(F.col("p_type").alias("label")),
    ]
    return tables.union_categories(parts, "label")


@query("distinct_values", "SELECT DISTINCT Depth_cm FROM samples", "samples")
def distinct_values(t: Tables):
    return t.view("samples").select("Depth_cm").distinct()


@query(
    "schema_diff",
    """SELECT 'Target_Extra' AS column_name, 'missing' AS status, 0 AS n_values
       UNION ALL SELECT 'Target_Zn', 'extra', count(Target_Zn) FROM preds_a""",
    "preds_a",
)
def schema_diff(t: Tables):
    return tables.schema_diff(t.view("preds_a").select("ID", "Target_Al", "Target_Zn"), ["ID", "Target_Al", "Target_Extra"])


# --- window-style -----------------------------------------------------------------------


@query(
    "win_average_rank",
    """SELECT metric, ID, rank() OVER (PARTITION BY metric ORDER BY value)
         + (count(*) OVER (PARTITION BY metric, value) - 1) / 2e0 AS avg_rank
       FROM (SELECT ID, 'Al' AS metric, Al AS value FROM train UNION ALL SELECT ID, 'Zn', Zn FROM train)
       WHERE value IS NOT NULL""",
    "train",
)
def win_average_rank(t: Tables):
    rows = t.view("train").select("ID", "Al", "Zn").unpivot(["ID"], ["Al", "Zn"], "metric", "value").na.drop()
    ranks = ordering.average_ranks(rows, ["metric"], "value")
    return rows.join(ranks, ["metric", "value"]).select("metric", "ID", F.col("rank").alias("avg_rank"))


@query(
    "win_label_encode",
    """WITH codes AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS code FROM
         (SELECT DISTINCT CAST(l_suppkey % 30 AS VARCHAR) AS label FROM lineitem))
       SELECT l_suppkey, label, code AS label_enc, count(*) AS n FROM (SELECT l_suppkey,
         CAST(l_suppkey % 30 AS VARCHAR) AS label FROM lineitem) JOIN codes USING (label) GROUP BY ALL""",
)
def win_label_encode(t: Tables):
    """Numbers sort as text, so "10" comes before "2"."""
    labelled = t.table("lineitem").select("l_suppkey", (F.col("l_suppkey") % 30).cast("string").alias("label"))
    coded = joins.with_code(labelled, ordering.label_codes(labelled, "label"), "label", "label_enc")
    return coded.groupBy("l_suppkey", "label", "label_enc").agg(F.count("*").alias("n"))


@query(
    "win_latest_record",
    """WITH kept AS (SELECT * FROM cache WHERE a IS NOT NULL OR b IS NOT NULL),
       ranked AS (SELECT *, row_number() OVER (PARTITION BY ID ORDER BY seq DESC) AS rn,
         min(seq) OVER (PARTITION BY ID) AS first_seq FROM kept)
       SELECT ID, seq, a, b, first_seq FROM ranked WHERE rn = 1""",
    "cache",
)
def win_latest_record(t: Tables):
    usable = t.view("cache").where(F.col("a").isNotNull() | F.col("b").isNotNull())
    return ordering.latest_per_key(usable, "ID", "seq", first_seq=F.min("seq"))


@query(
    "agg_distinct_ids",
    "SELECT ID, arg_min(seq, seq) AS seq, arg_min(v, seq) AS v FROM (SELECT *, coalesce(a, -1e0) AS v FROM cache) GROUP BY ID",
    "cache",
)
def agg_distinct_ids(t: Tables):
    rows = t.view("cache").select("ID", "seq", F.coalesce("a", F.lit(-1.0)).alias("v"))
    return ordering.first_per_key(rows, "ID", "seq")


@query(
    "win_fixed_batches",
    """SELECT ID, (row_number() OVER (ORDER BY ID) - 1) // 100 AS batch_id,
       (row_number() OVER (ORDER BY ID) - 1) % 100 AS pos FROM train""",
    "train",
)
def win_fixed_batches(t: Tables):
    return ordering.with_batches(t.view("train").select("ID"), ["ID"], BATCH_ROWS)


@query(
    "win_row_block_fallback",
    """SELECT ID, CAST((row_number() OVER (ORDER BY ID) - 1) // 100 AS VARCHAR) AS spatial_block FROM test""",
    "test",
)
def win_row_block_fallback(t: Tables):
    batched = ordering.with_batches(t.view("test").select("ID"), ["ID"], BATCH_ROWS)
    return batched.select("ID", F.col("batch_id").cast("string").alias("spatial_block"))
