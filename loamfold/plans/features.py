"""Feature tables of both profiles, each as one plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamfold.functions import chemistry, coords, dates, depth
from loamfold.functions.fixed import (
    DEFAULT_END_MONTH,
    DEFAULT_END_YEAR,
    DEFAULT_START_MONTH,
    DEFAULT_START_YEAR,
    TARGETS,
    UNKNOWN_LABEL,
)
from loamfold.functions.nulls import to_number
from loamfold.operators.columns import coalesce_alternates, drop
from loamfold.operators.joins import covariate_chain, left_on_id, left_with_suffix, with_code
from loamfold.operators.ordering import label_codes
from loamfold.operators.spatial import centre_list, nearest_centre
from loamfold.operators.tables import union_categories


def attach_test_dates(test: DataFrame, dates_table: DataFrame) -> DataFrame:
    """Collection dates of the rows marked as test rows."""
    marked = dates_table.where(F.col("set") == "Test")
    return left_on_id(test, marked, ["start_date", "end_date"])


def attach_dates(df: DataFrame, dates_table: DataFrame) -> DataFrame:
    """Collection dates where the table has none of its own."""
    joined = left_with_suffix(df, dates_table, ["start_date", "end_date"])
    return coalesce_alternates(joined, ["start_date", "end_date"])


def split_features(df: DataFrame) -> DataFrame:
    """Depth, date, place and chemistry features of the ``split`` profile."""
    upper, lower = depth.bounds(F.col("Depth_cm"))
    out = df.withColumns(
        {"depth_mid": depth.midpoint_split(F.col("Depth_cm")), "depth_upper": upper, "depth_lower": lower}
    )
    out = depth.with_horizon(out)
    shallow, deep = depth.depth_flags(F.col("depth_mid"), "split")
    out = out.withColumns({"is_shallow": shallow, "is_deep": deep})

    present = [c for c in ("start_date", "end_date") if c in out.columns]
    out = out.withColumns({c: dates.parse_dayfirst(F.col(c)) for c in present})
    start = F.col("start_date") if "start_date" in present else F.lit(None).cast("date")
    end = F.col("end_date") if "end_date" in present else F.lit(None).cast("date")
    out = out.withColumns(
        {
            "year_start": dates.year_or(start, DEFAULT_START_YEAR),
            "month_start": dates.month_or(start, DEFAULT_START_MONTH),
            "year_end": dates.year_or(end, DEFAULT_END_YEAR),
            "month_end": dates.month_or(end, DEFAULT_END_MONTH),
        }
    )
    out = out.withColumns(
        {
            "date_span_years": dates.year_span(F.col("year_start"), F.col("year_end")),
            "year_mid": dates.year_middle(F.col("year_start"), F.col("year_end")),
            "is_wet_season": dates.wet_season(F.col("month_start")),
        }
    )
    lat, lon = F.col("Latitude"), F.col("Longitude")
    out = out.withColumns(
        {
            **coords.hemisphere(lat),
            **coords.trig(lat, lon),
            "lat_block": coords.block_number(lat),
            "lon_block": coords.block_number(lon),
            "spatial_block": coords.block_key(lat, lon),
        }
    )
    out = chemistry.coerced_chemistry(out).withColumns(chemistry.interactions("split"))
    derived = {**chemistry.log_targets(out.columns, in_place=False), **chemistry.target_ratios(out.columns, "split")}
    return out.withColumns(derived) if derived else out


def regex_features(df: DataFrame) -> DataFrame:
    """Depth, date and chemistry features of the ``regex`` profile."""
    shallow, deep = depth.depth_flags(F.col("depth_mid"), "regex")

    def number(column: str) -> Column:
        return to_number(F.col(column).cast("string")) if column in df.columns else F.lit(None).cast("double")

    out = df.withColumns(
        {
            "depth_mid": depth.midpoint_regex(F.col("Depth_cm")),
            "depth_upper": number("horizon_upper"),
            "depth_lower": number("horizon_lower"),
        }
    ).withColumns({"depth_range": F.col("depth_lower") - F.col("depth_upper"), "is_shallow": shallow, "is_deep": deep})
    out = out.withColumns({c: dates.parse_dayfirst(F.col(c)) for c in ("start_date", "end_date")})
    out = out.withColumns(
        {
            "start_year": F.year("start_date"),
            "start_month": F.month("start_date"),
            "end_year": F.year("end_date"),
            "end_month": F.month("end_date"),
            "obs_duration_days": dates.duration_days(F.col("start_date"), F.col("end_date")),
            "collection_decade": dates.decade(F.year("start_date")),
        }
    )
    out = chemistry.coerced_chemistry(out).withColumns(chemistry.interactions("regex"))
    return out.withColumns(chemistry.target_ratios(out.columns, "regex"))


def build_split(
    train: DataFrame, test: DataFrame, dates_table: DataFrame, centres: DataFrame, covariates: Sequence[DataFrame] = ()
) -> tuple[DataFrame, DataFrame]:
    """Train and test feature tables of the ``split`` profile."""
    listed = centre_list(centres)

    def finish(df: DataFrame) -> DataFrame:
        located = nearest_centre(split_features(df), listed, F.col("Latitude"), F.col("Longitude"))
        named = located.withColumnRenamed("cluster", "spatial_cluster").drop("centre_distance")
        return covariate_chain(named, covariates)

    return finish(train), finish(attach_test_dates(test, dates_table))


def build_regex(
    train: DataFrame,
    test: DataFrame,
    dates_table: DataFrame,
    centres: DataFrame,
    covariates: Sequence[DataFrame] = (),
    log_targets: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Train and test feature tables of the ``regex`` profile.

    Ratios of targets stay in the table as in the source data, but model features
    must leave them out (``feature_columns`` does).
    """
    listed = centre_list(centres)

    def locate(df: DataFrame) -> DataFrame:
        lat, lon = F.coalesce("Latitude", F.lit(0.0)), F.coalesce("Longitude", F.lit(0.0))
        located = nearest_centre(regex_features(attach_dates(df, dates_table)), listed, lat, lon)
        named = located.withColumnsRenamed({"centre_distance": "dist_to_cluster_center"}).withColumns(
            {"spatial_cluster": F.col("cluster").cast("string"), **coords.trig(lat, lon)}
        )
        merged = covariate_chain(named.drop("cluster"), [drop(c, ["Latitude", "Longitude"]) for c in covariates])
        return merged.withColumn("depth_label", F.coalesce("Depth_cm", F.lit(UNKNOWN_LABEL)))

    located = [locate(train), locate(test)]
    depth_codes = label_codes(located[0], "depth_label")
    cluster_codes = label_codes(union_categories(located, "spatial_cluster"), "spatial_cluster")

    def finish(df: DataFrame) -> DataFrame:
        coded = with_code(df, depth_codes, "depth_label", "depth_label_enc")
        coded = with_code(coded, cluster_codes, "spatial_cluster", "spatial_cluster_enc")
        return drop(coded, ["start_date", "end_date", "Depth_cm", "depth_label", "spatial_cluster"])

    out_train, out_test = finish(located[0]), finish(located[1])
    if log_targets:
        out_train = out_train.withColumns(chemistry.log_targets(out_train.columns, in_place=True))
    return out_train, out_test
