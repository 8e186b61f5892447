"""One wide covariate table for all points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamfold.functions.documents import with_flattened
from loamfold.functions.fixed import BATCH_ROWS, YEAR_DAYS
from loamfold.operators.joins import batch_results, covariate_chain
from loamfold.operators.ordering import with_batches
from loamfold.operators.spatial import documents_at
from loamfold.operators.statistics import climate_normals
from loamfold.operators.tables import union_locations
from loamfold.session import stored


def covariates(
    train: DataFrame, test: DataFrame, documents: DataFrame, replies: DataFrame, daily: DataFrame
) -> DataFrame:
    """Points of both tables with soil-grid, elevation and climate columns; a missing reply is NULL.

    ``documents``: ``(lat_key, lon_key, seq, text)``, of which a place's last one counts;
    ``replies``: ``(batch_id, results)``;
    ``daily``: ``(ID, temps, rains)``.
    """
    spine = stored(union_locations([train, test]), "locations")
    places = documents.groupBy("lat_key", "lon_key").agg(F.max_by("text", "seq").alias("text"))
    soil = with_flattened(places, "text", "regex")
    with_soil = documents_at(spine, soil)
    elevation = batch_results(with_batches(spine.select("ID"), ["ID"], BATCH_ROWS), replies, "elevation_m")
    climate = climate_normals(daily, "ID", "temps", "rains", YEAR_DAYS)
    return covariate_chain(with_soil, [elevation.select("ID", F.col("elevation_m")), climate])
