"""Queries for projections, filters and fills."""

from pyspark.sql import functions as F

from loamfold.catalog.registry import Tables, query, r, rounded
from loamfold.functions.fixed import TARGETS
from loamfold.functions.nulls import clip_lower, flag
from loamfold.operators import columns, joins

LISTED = ", ".join(TARGETS)
FILLED = ["Latitude", "C_organic", "C_total", "electrical_conductivity", "Al", "B"]


@query("select_drop", "SELECT ID, Latitude, Longitude, Depth_cm FROM samples", "samples")
def select_drop(t: Tables):
    kept = columns.keep(t.view("samples"), ["ID", "Latitude", "Longitude", "Depth_cm", "start_date", "absent"])
    return columns.drop(kept, ["start_date", "never_there"])


@query("reorder_id_first", "SELECT ID, Zn, Longitude FROM samples", "samples")
def reorder_id_first(t: Tables):
    return columns.id_first(t.view("samples").select("Zn", "ID", "Longitude"))


@query("prefix_columns", "SELECT ID, " + ", ".join(f"{x} AS oof_{x}" for x in TARGETS) + " FROM train", "train")
def prefix_columns(t: Tables):
    return columns.prefixed(t.view("train").select("ID", *TARGETS), "oof_")


@query(
    "conform_to_template",
    "SELECT ID, Target_Zn, 0e0 AS Target_Extra, Target_Al FROM preds_a",
    "preds_a",
)
def conform_to_template(t: Tables):
    return columns.conform(t.view("preds_a"), ["ID", "Target_Zn", "Target_Extra", "Target_Al"])


@query(
    "select_features",
    'SELECT site, Latitude, Longitude, electrical_conductivity, C_organic, C_total, ph FROM train_numeric',
    "train_numeric",
)
def select_features(t: Tables):
    train = t.view("train_numeric").withColumn("log_Al", F.log1p("Al"))
    return train.select(*columns.feature_columns(train, TARGETS))


@query("common_columns", "SELECT ID, site, Latitude, Longitude, Depth_cm, start_date, end_date FROM train", "train")
def common_columns(t: Tables):
    train = t.view("train")
    return train.select(*columns.common_columns(train, t.view("test")))


@query(
    "ensure_columns",
    "SELECT ID, Depth_cm, CAST(NULL AS DOUBLE) AS ph, CAST(NULL AS DOUBLE) AS C_organic FROM test",
    "test",
)
def ensure_columns(t: Tables):
    base = t.view("test").select("ID", "Depth_cm")
    return columns.ensure(base, {"Depth_cm": "string", "ph": "double", "C_organic": "double"})


@query("filter_target_present", "SELECT ID, Al FROM train WHERE Al IS NOT NULL", "train")
def filter_target_present(t: Tables):
    return columns.rows_with(t.view("train").select("ID", "Al"), "Al")


@query(
    "dropna_subset",
    "SELECT ID, Latitude, Longitude, Fe FROM train WHERE Latitude IS NOT NULL AND Longitude IS NOT NULL AND Fe IS NOT NULL",
    "train",
)
def dropna_subset(t: Tables):
    return columns.complete_rows(t.view("train").select("ID", "Latitude", "Longitude", "Fe"), ["Latitude", "Longitude", "Fe"])


@query("filter_equal", "SELECT ID, start_date, end_date FROM dates WHERE \"set\" = 'Test'", "dates")
def filter_equal(t: Tables):
    return t.view("dates").where(F.col("set") == "Test").select("ID", "start_date", "end_date")


@query("filter_positive", "SELECT ID, Mg FROM train WHERE Mg > 0", "train")
def filter_positive(t: Tables):
    return t.view("train").select("ID", "Mg").where(F.col("Mg") > 0)


@query(
    "fill_constant",
    "SELECT ID, coalesce(Depth_cm, 'unknown') AS Depth_cm, coalesce(Latitude, 0) AS Latitude, "
    "coalesce(Longitude, 0) AS Longitude FROM samples",
    "samples",
)
def fill_constant(t: Tables):
    base = t.view("samples").select("ID", "Depth_cm", "Latitude", "Longitude")
    return columns.fill_constants(base, {"Depth_cm": "unknown", "Latitude": 0.0, "Longitude": 0.0, "absent": 1})


MEDIANS = "m AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in FILLED) + " FROM {0})"
FILL = "SELECT '{0}' AS part, ID, " + ", ".join(f"round(coalesce({c}, m_{c}), 6) AS {c}" for c in FILLED) + " FROM {0}, m"


@query(
    "fill_train_median",
    f"WITH {MEDIANS.format('train')} "
    + FILL.format("train")
    + " UNION ALL "
    + FILL.format("test_measured"),
    "train test_measured",
)
def fill_train_median(t: Tables):
    train, test = t.view("train"), t.view("test_measured")
    medians = columns.fit_medians(train, FILLED)
    parts = [
        columns.fill_medians(df.select("ID", *FILLED), medians).select(F.lit(name).alias("part"), "ID", *FILLED)
        for name, df in (("train", train), ("test_measured", test))
    ]
    return rounded(parts[0].unionByName(parts[1]))


@query(
    "fill_own_median",
    "WITH preds AS (SELECT ID, "
    + ", ".join(f"Target_{x} AS {x}" for x in TARGETS)
    + " FROM preds_a), m AS (SELECT "
    + ", ".join(f"quantile_cont({x}, 0.5) AS m_{x}" for x in TARGETS)
    + " FROM preds) SELECT ID, "
    + ", ".join(f"round(coalesce({x}, m_{x}), 6) AS oof_{x}" for x in TARGETS)
    + " FROM preds, m",
    "preds_a",
)
def fill_own_median(t: Tables):
    names = [f"oof_{x}" for x in TARGETS]
    preds = t.view("preds_a").withColumnsRenamed({f"Target_{x}": f"oof_{x}" for x in TARGETS})
    return rounded(columns.fill_medians(preds, columns.fit_medians(preds, names)))


@query(
    "coalesce_alternate",
    """SELECT s.ID, coalesce(s.start_date, d.start_date) AS start_date, coalesce(s.end_date, d.end_date) AS end_date
       FROM samples s LEFT JOIN dates d ON s.ID = d.ID""",
    "samples dates",
)
def coalesce_alternate(t: Tables):
    base = t.view("samples").select("ID", "start_date", "end_date")
    joined = joins.left_with_suffix(base, t.view("dates"), ["start_date", "end_date"])
    return columns.coalesce_alternates(joined, ["start_date", "end_date"])


@query(
    "clip_lower",
    "SELECT ID, CASE WHEN C_organic IS NOT NULL THEN greatest(C_organic, 0e0) END AS C_organic FROM samples",
    "samples",
)
def clip(t: Tables):
    return t.view("samples").select("ID", clip_lower(F.col("C_organic")).alias("C_organic"))


@query(
    "bool_flags",
    """SELECT ID, CAST(coalesce(C_organic > 5, false) AS INT) AS is_rich,
       CAST(coalesce(Latitude < 0, false) AS INT) AS is_south FROM samples""",
    "samples",
)
def bool_flags(t: Tables):
    return t.view("samples").select(
        "ID", flag(F.col("C_organic") > 5).alias("is_rich"), flag(F.col("Latitude") < 0).alias("is_south")
    )


# --- sorts, limits, samples ------------------------------------------------------------


@query(
    "sort_desc",
    "SELECT event_type, round(avg(value), 6) AS score FROM events GROUP BY event_type ORDER BY score DESC, event_type",
)
def sort_desc(t: Tables):
    scores = t.table("events").groupBy("event_type").agg(r(F.avg("value")).alias("score"))
    return scores.orderBy(F.desc("score"), "event_type")


@query("head_n", "SELECT ID, Depth_cm, Al FROM train ORDER BY ID LIMIT 3", "train")
def head_n(t: Tables):
    return t.view("train").select("ID", "Depth_cm", "Al").orderBy("ID").limit(3)


@query(
    "sample_n",
    """SELECT ID, C_organic, N FROM train_numeric WHERE C_organic IS NOT NULL AND N IS NOT NULL
       ORDER BY md5('42:' || CAST(ID AS VARCHAR)), ID LIMIT 3000""",
    "train_numeric",
)
def sample_n(t: Tables):
    """At most 3,000 complete rows in the order of a seeded hash: the same rows for the same seed."""
    complete = t.view("train_numeric").select("ID", "C_organic", "N").na.drop()
    return columns.seeded_sample(complete, "ID", 3000)


WIDE = ["Latitude", "Longitude", "electrical_conductivity", "C_organic", "C_total", *TARGETS, "ph"]


@query(
    "prefix_block",
    "SELECT " + ", ".join(f"coalesce({c}, 0) AS {c}" for c in WIDE) + " FROM train_numeric ORDER BY ID LIMIT 1000",
    "train_numeric",
)
def prefix_block(t: Tables):
    train = t.view("train_numeric").drop("site")
    numeric = [c for c in columns.numeric_columns(train) if c != "ID"][:50]
    return train.orderBy("ID").limit(1000).select(*numeric).na.fill(0.0)
