"""Queries for the scalar functions."""

from pyspark.sql import functions as F

from loamfold.catalog.registry import Tables, query, r, rounded
from loamfold.functions import chemistry, coords, dates, depth, documents, nulls, spectral
from loamfold.functions.fixed import RATIO_PAIRS, TARGETS
from loamfold.operators.ordering import with_batches
from loamfold.plans.satellite import ROLES

# --- fragments of the comparison SQL -----------------------------------------------------

PARTS = "string_split(replace(Depth_cm, ' ', ''), '-')"
PART1 = f"TRY_CAST({PARTS}[1] AS DOUBLE)"
PART2 = f"TRY_CAST({PARTS}[2] AS DOUBLE)"
SPLIT_MID = f"({PART1} + {PART2}) / 2e0"
FOUND = r"regexp_extract_all(Depth_cm, '[\d.]+')"
REGEX_MID = (
    f"CASE WHEN len({FOUND}) >= 2 THEN (TRY_CAST({FOUND}[1] AS DOUBLE) + TRY_CAST({FOUND}[2] AS DOUBLE)) / 2e0 "
    f"WHEN len({FOUND}) = 1 THEN TRY_CAST({FOUND}[1] AS DOUBLE) END"
)


def duck_date(column: str) -> str:
    """Day-first text to date in the comparison SQL."""
    return (
        f"CAST(coalesce(try_strptime({column}, '%d/%m/%Y'), try_strptime({column}, '%Y-%m-%d'), "
        f"try_strptime({column}, '%d-%m-%Y')) AS DATE)"
    )


def positive_log(expr: str) -> str:
    return f"CASE WHEN {expr} IS NOT NULL THEN ln(1e0 + greatest({expr}, 0e0)) END"


def duck_block(column: str, size: str = "5e-1") -> str:
    return f"CAST(floor({column} / {size}) AS BIGINT)"


DUCK_BLOCK_KEY = (
    f"CASE WHEN Latitude IS NOT NULL AND Longitude IS NOT NULL THEN CAST({duck_block('Latitude')} AS VARCHAR) "
    f"|| '_' || CAST({duck_block('Longitude')} AS VARCHAR) END"
)

# --- depth ------------------------------------------------------------------------------


@query("fn_depth_mid_split", f'SELECT ID, {SPLIT_MID} AS depth_mid FROM samples', "samples")
def depth_mid_split(t: Tables):
    return t.view("samples").select("ID", depth.midpoint_split(F.col("Depth_cm")).alias("depth_mid"))


@query("fn_depth_mid_regex", f"SELECT ID, {REGEX_MID} AS depth_mid FROM samples", "samples")
def depth_mid_regex(t: Tables):
    return t.view("samples").select("ID", depth.midpoint_regex(F.col("Depth_cm")).alias("depth_mid"))


@query(
    "fn_depth_bounds",
    f"""SELECT ID, CASE WHEN contains(Depth_cm, '-') THEN {PART1} END AS depth_upper,
        CASE WHEN contains(Depth_cm, '-') THEN {PART2} END AS depth_lower FROM samples""",
    "samples",
)
def depth_bounds(t: Tables):
    upper, lower = depth.bounds(F.col("Depth_cm"))
    return t.view("samples").select("ID", upper.alias("depth_upper"), lower.alias("depth_lower"))


@query(
    "fn_horizon",
    f"""SELECT ID, 'columns' AS origin, TRY_CAST(horizon_upper AS DOUBLE) AS horizon_upper,
          TRY_CAST(horizon_lower AS DOUBLE) AS horizon_lower,
          (TRY_CAST(horizon_upper AS DOUBLE) + TRY_CAST(horizon_lower AS DOUBLE)) / 2e0 AS horizon_mid,
          TRY_CAST(horizon_lower AS DOUBLE) - TRY_CAST(horizon_upper AS DOUBLE) AS horizon_thick
        FROM train
        UNION ALL
        SELECT ID, 'interval', CASE WHEN contains(Depth_cm, '-') THEN {PART1} END,
          CASE WHEN contains(Depth_cm, '-') THEN {PART2} END, {SPLIT_MID},
          CASE WHEN contains(Depth_cm, '-') THEN {PART2} - {PART1} END
        FROM test""",
    "train test",
)
def horizon(t: Tables):
    names = ["horizon_upper", "horizon_lower", "horizon_mid", "horizon_thick"]
    parts = [
        depth.with_horizon(t.view(view)).select("ID", F.lit(origin).alias("origin"), *names)
        for view, origin in (("train", "columns"), ("test", "interval"))
    ]
    return parts[0].unionByName(parts[1])


@query(
    "fn_depth_flags",
    f"""SELECT ID, CAST(coalesce({SPLIT_MID} <= 20, false) AS INT) AS split_shallow,
        CAST(coalesce({SPLIT_MID} > 20, false) AS INT) AS split_deep,
        CAST(coalesce({REGEX_MID} <= 15, false) AS INT) AS regex_shallow,
        CAST(coalesce({REGEX_MID} > 30, false) AS INT) AS regex_deep FROM samples""",
    "samples",
)
def depth_flags(t: Tables):
    cells = []
    for profile in ("split", "regex"):
        shallow, deep = depth.depth_flags(depth.midpoint(F.col("Depth_cm"), profile), profile)
        cells += [shallow.alias(f"{profile}_shallow"), deep.alias(f"{profile}_deep")]
    return t.view("samples").select("ID", *cells)


# --- dates ------------------------------------------------------------------------------


@query(
    "fn_parse_dayfirst",
    f"SELECT ID, {duck_date('start_date')} AS start_date, {duck_date('end_date')} AS end_date FROM samples",
    "samples",
)
def parse_dayfirst(t: Tables):
    return t.view("samples").select(
        "ID", *[dates.parse_dayfirst(F.col(c)).alias(c) for c in ("start_date", "end_date")]
    )


DATED = f"""WITH dated AS (SELECT ID, {duck_date('start_date')} AS s, {duck_date('end_date')} AS e FROM samples)"""
YEAR_S = "coalesce(CAST(year(s) AS INT), 2013)"
YEAR_E = "coalesce(CAST(year(e) AS INT), 2018)"


@query(
    "fn_date_parts",
    f"""{DATED} SELECT ID, {YEAR_S} AS year_start, coalesce(CAST(month(s) AS INT), 6) AS month_start,
        {YEAR_E} AS year_end, coalesce(CAST(month(e) AS INT), 12) AS month_end FROM dated""",
    "samples",
)
def date_parts(t: Tables):
    start, end = (dates.parse_dayfirst(F.col(c)) for c in ("start_date", "end_date"))
    return t.view("samples").select(
        "ID",
        dates.year_or(start, 2013).alias("year_start"),
        dates.month_or(start, 6).alias("month_start"),
        dates.year_or(end, 2018).alias("year_end"),
        dates.month_or(end, 12).alias("month_end"),
    )


@query(
    "fn_duration_days",
    f"{DATED} SELECT ID, CAST(coalesce(date_diff('day', s, e), 0) AS INT) AS obs_duration_days FROM dated",
    "samples",
)
def duration(t: Tables):
    start, end = (dates.parse_dayfirst(F.col(c)) for c in ("start_date", "end_date"))
    return t.view("samples").select("ID", dates.duration_days(start, end).alias("obs_duration_days"))


@query(
    "fn_decade",
    f"{DATED} SELECT ID, CAST(coalesce(year(s) // 10 * 10, 2010) AS INT) AS collection_decade FROM dated",
    "samples",
)
def decade(t: Tables):
    start = dates.parse_dayfirst(F.col("start_date"))
    return t.view("samples").select("ID", dates.decade(F.year(start)).alias("collection_decade"))


@query(
    "fn_year_span_mid",
    f"""{DATED} SELECT ID, {YEAR_E} - {YEAR_S} AS date_span_years, ({YEAR_S} + {YEAR_E}) / 2e0 AS year_mid
        FROM dated""",
    "samples",
)
def year_span_mid(t: Tables):
    start, end = (dates.parse_dayfirst(F.col(c)) for c in ("start_date", "end_date"))
    first, last = dates.year_or(start, 2013), dates.year_or(end, 2018)
    return t.view("samples").select(
        "ID", dates.year_span(first, last).alias("date_span_years"), dates.year_middle(first, last).alias("year_mid")
    )


@query(
    "fn_wet_season",
    """SELECT o_orderkey, CAST(month(o_orderdate) IN (3, 4, 5, 10, 11) AS INT) AS is_wet_season FROM orders""",
)
def wet_season(t: Tables):
    return t.table("orders").select("o_orderkey", dates.wet_season(F.month("o_orderdate")).alias("is_wet_season"))


@query(
    "fn_trailing_year",
    """SELECT ID, coalesce(TRY_CAST(right(trim(start_date), 4) AS INT), 2013) AS start_year,
       coalesce(TRY_CAST(right(trim(end_date), 4) AS INT), 2018) AS end_year
       FROM (SELECT ID, CASE WHEN contains(start_date, '/') THEN start_date END AS start_date, end_date FROM dates)""",
    "dates",
)
def trailing_year(t: Tables):
    start = F.when(F.contains("start_date", F.lit("/")), F.col("start_date"))
    return t.view("dates").select(
        "ID",
        dates.trailing_year(start, 2013).alias("start_year"),
        dates.trailing_year(F.col("end_date"), 2018).alias("end_year"),
    )


# --- coordinates ------------------------------------------------------------------------


@query(
    "fn_trig_coords",
    """SELECT ID, round(sin(radians(Latitude)), 9) AS lat_sin, round(cos(radians(Latitude)), 9) AS lat_cos,
       round(sin(radians(Longitude)), 9) AS lon_sin, round(cos(radians(Longitude)), 9) AS lon_cos FROM samples""",
    "samples",
)
def trig_coords(t: Tables):
    cells = coords.trig(F.col("Latitude"), F.col("Longitude"))
    return t.view("samples").select("ID", *[r(c, 9).alias(n) for n, c in cells.items()])


@query(
    "fn_hemisphere",
    "SELECT ID, abs(Latitude) AS lat_abs, CAST(coalesce(Latitude < 0, false) AS INT) AS is_south FROM samples",
    "samples",
)
def hemisphere(t: Tables):
    return t.view("samples").select("ID", *[c.alias(n) for n, c in coords.hemisphere(F.col("Latitude")).items()])


@query(
    "fn_grid_block",
    f"""SELECT ID, {duck_block('Latitude')} AS lat_block, {duck_block('Longitude')} AS lon_block,
        {DUCK_BLOCK_KEY} AS spatial_block FROM samples""",
    "samples",
)
def grid_block(t: Tables):
    lat, lon = F.col("Latitude"), F.col("Longitude")
    return t.view("samples").select(
        "ID",
        coords.block_number(lat).alias("lat_block"),
        coords.block_number(lon).alias("lon_block"),
        coords.block_key(lat, lon).alias("spatial_block"),
    )


DUCK_COORD_KEY = "CAST(round(round_even({0}, 4) * 1e4) AS BIGINT)"


@query(
    "fn_coord_key",
    f"""SELECT s_suppkey, {DUCK_COORD_KEY.format('lat + base / 1e6')} AS lat_key,
        {DUCK_COORD_KEY.format('lon - base / 1e6')} AS lon_key FROM soil""",
    "soil",
)
def coord_key(t: Tables):
    return t.view("soil").select(
        "s_suppkey",
        coords.rounded_key(F.col("lat") + F.col("base") / 1e6).alias("lat_key"),
        coords.rounded_key(F.col("lon") - F.col("base") / 1e6).alias("lon_key"),
    )


CENTRES_SQL = """centres AS (SELECT CAST(site % 30 AS INT) AS cluster, round(avg(Latitude), 3) AS c_lat,
    round(avg(Longitude), 3) AS c_lon FROM train GROUP BY site % 30)"""


def fixed_centres(t: Tables, k: int = 30):
    """Centres without a fit: mean place of the sites that share a remainder."""
    return (
        t.view("train")
        .groupBy((F.col("site") % k).cast("int").alias("cluster"))
        .agg(r(F.avg("Latitude"), 3).alias("c_lat"), r(F.avg("Longitude"), 3).alias("c_lon"))
    )


@query(
    "fn_centre_distance",
    f"""WITH {CENTRES_SQL}
       SELECT ID, round(sqrt(power(Latitude - c_lat, 2) + power(Longitude - c_lon, 2)), 6) AS centre_distance
       FROM train LEFT JOIN centres ON CAST(site % 30 AS INT) = cluster""",
    "train",
)
def centre_distance(t: Tables):
    assigned = t.view("train").withColumn("cluster", (F.col("site") % 30).cast("int"))
    joined = assigned.join(fixed_centres(t), "cluster", "left")
    distance = F.sqrt(
        F.pow(F.col("Latitude") - F.col("c_lat"), F.lit(2.0)) + F.pow(F.col("Longitude") - F.col("c_lon"), F.lit(2.0))
    )
    return joined.select("ID", r(distance).alias("centre_distance"))


# --- numbers and chemistry --------------------------------------------------------------


@query("fn_numeric_coerce", "SELECT ID, TRY_CAST(ph AS DOUBLE) AS ph FROM samples", "samples")
def numeric_coerce(t: Tables):
    return t.view("samples").select("ID", nulls.to_number(F.col("ph")).alias("ph"))


CHEM = """chem AS (SELECT ID, TRY_CAST(ph AS DOUBLE) AS ph, C_organic, C_total, coalesce(C_organic, 0e0) AS o,
    coalesce(C_total, 0e0) AS c FROM samples)"""


@query(
    "fn_chem_interactions",
    f"""WITH {CHEM} SELECT ID, round(ph * ph, 6) AS ph_sq, round({positive_log('C_organic')}, 6) AS log_C_organic,
        round({positive_log('C_total')}, 6) AS log_C_total, round(C_organic * ph, 6) AS C_org_x_ph,
        round(C_total / nullif(C_organic + 1e-6, 0), 4) AS C_total_C_org_ratio, round(ph * o, 6) AS ph_x_Corg,
        round(c - o, 6) AS C_inorganic, round(o / nullif(c + 1e-6, 0), 6) AS Corg_ratio FROM chem""",
    "samples",
)
def chem_interactions(t: Tables):
    cells = {**chemistry.interactions("split"), **chemistry.interactions("regex")}
    digits = {"C_total_C_org_ratio": 4}
    coerced = chemistry.coerced_chemistry(t.view("samples"))
    return coerced.select("ID", *[r(c, digits.get(n, 6)).alias(n) for n, c in cells.items()])


@query(
    "fn_agronomic_ratios",
    "SELECT ID, "
    + ", ".join(f"round({a} / nullif({b} + 1e-6, 0), 2) AS ratio_{a}_{b}" for a, b in RATIO_PAIRS)
    + " FROM samples",
    "samples",
)
def agronomic_ratios(t: Tables):
    samples = t.view("samples")
    cells = chemistry.target_ratios(samples.columns, "regex")
    return samples.select("ID", *[r(c, 2).alias(n) for n, c in cells.items()])


@query(
    "fn_log_targets",
    "SELECT ID, "
    + ", ".join(f"round({positive_log(x)}, 6) AS log_{x}" for x in TARGETS)
    + f", round({positive_log('C_organic')}, 6) AS clipped FROM samples",
    "samples",
)
def log_targets(t: Tables):
    samples = t.view("samples")
    cells = chemistry.log_targets(samples.columns, in_place=False)
    clipped = nulls.log_positive(F.col("C_organic"))
    return samples.select("ID", *[r(c).alias(n) for n, c in cells.items()], r(clipped).alias("clipped"))


@query(
    "fn_inverse_log",
    "SELECT ID, "
    + ", ".join(f"round(greatest(exp({x} / 1e2 - 1e0) - 1e0, 0e0), 6) AS {x}" for x in ("Al", "B", "Ca", "Zn"))
    + " FROM (SELECT ID, Al, B, Ca, Zn FROM samples WHERE Al IS NOT NULL AND B IS NOT NULL AND Ca IS NOT NULL AND Zn IS NOT NULL"
    + ") UNION ALL SELECT ID, NULL, NULL, NULL, NULL FROM samples WHERE Al IS NULL OR B IS NULL OR Ca IS NULL OR Zn IS NULL",
    "samples",
)
def inverse_log(t: Tables):
    names = ["Al", "B", "Ca", "Zn"]
    samples = t.view("samples")
    whole = F.lit(True)
    for n in names:
        whole = whole & F.col(n).isNotNull()
    return samples.select(
        "ID", *[r(nulls.from_log(F.when(whole, F.col(n) / 1e2 - 1e0))).alias(n) for n in names]
    )


@query("fn_nodata_null", '''SELECT "row", "col", nullif(bio1, -9999e0) AS bio1, nullif(bio12, -9999e0) AS bio12 FROM cells''', "cells")
def nodata_null(t: Tables):
    return t.view("cells").select(
        "row", "col", *[nulls.nodata_to_null(F.col(c), F.lit(-9999.0)).alias(c) for c in ("bio1", "bio12")]
    )


# --- spectral ---------------------------------------------------------------------------


def duck_indices(narrow: str) -> dict[str, str]:
    return {
        "NDVI": "(nir - red) / nullif(nir + red, 0)",
        "EVI": "25e-1 * ((nir - red) / nullif(nir + red * 6e0 - blue * 75e-1 + 1e0, 0))",
        "NDWI": "(green - nir) / nullif(green + nir, 0)",
        "BSI": f"((swir1 + red) - ({narrow} + blue)) / nullif(swir1 + red + {narrow} + blue, 0)",
        "ClayRatio": f"swir1 / nullif({narrow}, 0)",
        "IronOxide": "red / nullif(blue, 0)",
        "SAVI": "15e-1 * ((nir - red) / nullif(nir + red + 5e-1, 0))",
    }


def duck_sensor(sensor: str) -> dict[str, str]:
    """Feature name to expression in the comparison SQL."""
    formulas = duck_indices("nir_narrow" if sensor == "S2" else "nir")
    named = {name: role for role, name in spectral.BANDS[sensor].items()}
    return {**named, **{n: formulas[n] for n in spectral.INDICES[sensor]}}


def _index_sql(sensor: str) -> str:
    cells = ", ".join(f"round({e}, 9) AS {n}" for n, e in duck_sensor(sensor).items())
    return f"SELECT pixel_id, ts, {cells} FROM scenes WHERE sensor = '{sensor}'"


def _index_query(t: Tables, sensor: str):
    cells = spectral.sensor_features(sensor, {role: F.col(role) for role in ROLES})
    scenes = t.view("scenes").where(F.col("sensor") == sensor)
    return scenes.select("pixel_id", "ts", *[r(c, 9).alias(n) for n, c in cells.items()])


@query("fn_indices_s2", _index_sql("S2"), "scenes")
def indices_s2(t: Tables):
    return _index_query(t, "S2")


@query("fn_indices_l8", _index_sql("L8"), "scenes")
def indices_l8(t: Tables):
    return _index_query(t, "L8")


@query("fn_indices_l7", _index_sql("L7"), "scenes")
def indices_l7(t: Tables):
    return _index_query(t, "L7")


@query(
    "fn_sensor_dispatch",
    f"""{DATED} SELECT ID, CASE WHEN {YEAR_S} >= 2017 THEN 'S2' WHEN {YEAR_S} >= 2013 THEN 'L8' ELSE 'L7' END AS sensor
        FROM dated""",
    "samples",
)
def sensor_dispatch(t: Tables):
    year = dates.year_or(dates.parse_dayfirst(F.col("start_date")), 2013)
    return t.view("samples").select("ID", spectral.sensor_for_year(year).alias("sensor"))


# --- documents and arrays ---------------------------------------------------------------


def soil_documents(t: Tables):
    """``(s_suppkey, lat, lon, text)``: documents as landed, some of them a literal null, built from suppliers."""
    soil = t.view("soil")
    layers = []
    for i, prop in enumerate(documents.SOIL_PROPERTIES):
        factor = F.when(F.col("nation") % (i + 2) == 0, F.lit(0.0)).when(
            F.col("nation") % (i + 3) == 1, F.lit(None).cast("double")
        ).otherwise(F.lit(10.0))
        means = [
            F.when((F.col("s_suppkey") + i + j) % 7 == 0, F.lit(None).cast("double")).otherwise(
                F.col("base") + F.lit(float(i * 10 + j))
            )
            for j in range(4)
        ]
        labels = ["0-5cm", "5-15 cm", "15 - 30cm", "30-60cm"]
        entries = F.array(
            *[
                F.struct(F.lit(label).alias("label"), F.struct(mean.alias("mean")).alias("values"))
                for label, mean in zip(labels, means)
            ]
        )
        layers.append(
            F.struct(
                F.lit(prop).alias("name"), F.struct(factor.alias("d_factor")).alias("unit_measure"), entries.alias("depths")
            )
        )
    document = F.to_json(F.struct(F.struct(F.array(*layers).alias("layers")).alias("properties")))
    text = (
        F.when(F.col("s_suppkey") % 9 == 4, F.lit("null"))
        .when(F.col("s_suppkey") % 17 == 3, F.lit('{"detail": "no data"}'))
        .otherwise(document)
    )
    return soil.select("s_suppkey", "lat", "lon", text.alias("text"))


def duck_soil(profile: str, digits: int = 6) -> str:
    """Columns of the flattened document, computed from the source table."""
    cells = []
    for i, prop in enumerate(documents.SOIL_PROPERTIES):
        for j, label in enumerate(documents.SOIL_DEPTHS[profile]):
            value = f"CASE WHEN (s_suppkey + {i + j}) % 7 = 0 THEN NULL ELSE base + {i * 10 + j}e0 END"
            if profile == "regex":
                value = (
                    f"({value}) / CASE WHEN nation % {i + 2} = 0 THEN 1e0 WHEN nation % {i + 3} = 1 THEN 1e0 ELSE 1e1 END"
                )
            usable = f"CASE WHEN s_suppkey % 9 = 4 OR s_suppkey % 17 = 3 THEN NULL ELSE {value} END"
            cells.append(f'round({usable}, {digits}) AS "sg_{prop}_{label}"')
    return ", ".join(cells)


@query("fn_json_flatten", f"SELECT s_suppkey, {duck_soil('split')} FROM soil", "soil")
def json_flatten(t: Tables):
    docs = soil_documents(t).select("s_suppkey", "text")
    return rounded(documents.with_flattened(docs, "text", "split"))


@query("fn_json_flatten_scaled", f"SELECT s_suppkey, {duck_soil('regex')} FROM soil", "soil")
def json_flatten_scaled(t: Tables):
    docs = soil_documents(t).select("s_suppkey", "text")
    return rounded(documents.with_flattened(docs, "text", "regex"))


@query(
    "fn_array_compact",
    """SELECT event_id, len(list_filter(v, lambda x: x IS NOT NULL)) AS n_kept,
       round(list_sum(list_filter(v, lambda x: x IS NOT NULL)), 6) AS total
       FROM (SELECT event_id, list_transform(range(24), lambda h:
         CASE WHEN (event_id + h) % 5 = 0 THEN NULL ELSE value / 1e1 + h END) AS v FROM events)""",
)
def array_compact(t: Tables):
    values = F.transform(
        F.sequence(F.lit(0), F.lit(23)),
        lambda h: F.when((F.col("event_id") + h) % 5 != 0, F.col("value") / 10.0 + h),
    )
    kept = t.table("events").select("event_id", documents.compact(values).alias("v"))
    total = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x)
    return kept.select("event_id", F.size("v").cast("bigint").alias("n_kept"), r(total).alias("total"))


@query(
    "fn_join_pairs",
    """SELECT batch_id, string_agg(pair, '|' ORDER BY ID) AS locations FROM (
         SELECT ID, CAST((row_number() OVER (ORDER BY ID) - 1) // 100 AS BIGINT) AS batch_id,
         CAST(Latitude AS VARCHAR) || ',' || CAST(Longitude AS VARCHAR) AS pair
         FROM test WHERE Latitude IS NOT NULL) GROUP BY batch_id""",
    "test",
)
def join_pairs(t: Tables):
    points = t.view("test").select("ID", "Latitude", "Longitude").na.drop()
    pair = F.concat_ws(",", F.col("Latitude").cast("string"), F.col("Longitude").cast("string"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", pair.alias("pair"))))
    return (
        with_batches(points, ["ID"], 100)
        .groupBy("batch_id")
        .agg(F.array_join(F.transform(ordered, lambda x: x["pair"]), "|").alias("locations"))
    )
