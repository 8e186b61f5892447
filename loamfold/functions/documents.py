"""Nested gridded-soil documents: layers with depths, flattened without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamfold.functions.fixed import SOIL_DEPTHS, SOIL_PROPERTIES

# The layout of one document.
DOCUMENT_SCHEMA = (
    "struct<properties: struct<layers: array<struct<"
    "name: string, unit_measure: struct<d_factor: double>, "
    "depths: array<struct<label: string, values: struct<mean: double>>>>>>>"
)


def parse_document(text: Column) -> Column:
    """Text to document; a literal null or unreadable text becomes NULL."""
    return F.from_json(text, DOCUMENT_SCHEMA)


def layer_pairs(document: Column, scaled: bool) -> Column:
    """``array<struct<name, value>>`` with one entry per layer and depth.

    ``scaled`` divides by the layer's factor, where a zero or missing factor counts as one.
    """

    def depths_of(layer: Column) -> Column:
        factor = F.coalesce(F.nullif(layer["unit_measure"]["d_factor"], F.lit(0.0)), F.lit(1.0))

        def entry(depth: Column) -> Column:
            label = F.replace(depth["label"], F.lit(" "), F.lit(""))
            mean = depth["values"]["mean"]
            return F.struct(
                F.concat(F.lit("sg_"), layer["name"], F.lit("_"), label).alias("name"),
                (mean / factor if scaled else mean).alias("value"),
            )

        return F.transform(F.coalesce(layer["depths"], F.array()), entry)

    return F.flatten(F.transform(document["properties"]["layers"], depths_of))


def feature_names(profile: str) -> list[str]:
    return [f"sg_{prop}_{depth}" for prop in SOIL_PROPERTIES for depth in SOIL_DEPTHS[profile]]


def with_flattened(df: DataFrame, text: str, profile: str) -> DataFrame:
    """Replace the document text by one column per property and depth.

    Everything a document holds is in its own row, so no explode, pivot or shuffle
    is needed. The last entry wins if a document repeats a name.
    """
    pairs = df.withColumn("_document", parse_document(F.col(text))).withColumn(
        "_pairs", layer_pairs(F.col("_document"), scaled=profile == "regex")
    )

    def value_of(name: str) -> Column:
        matches = F.filter(F.col("_pairs"), lambda pair: pair["name"] == F.lit(name))
        return F.try_element_at(matches, F.lit(-1))["value"]

    kept = [c for c in df.columns if c != text]
    return pairs.select(*kept, *[value_of(name).alias(name) for name in feature_names(profile)])


def compact(values: Column) -> Column:
    """The array without its nulls."""
    return F.array_compact(values)
