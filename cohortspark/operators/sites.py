"""Site counts for a map."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.functions.scalars import in_box, suppressed, text_or_na

Box = tuple[float, float]


def inside(sites: DataFrame, lons: Box, lats: Box) -> DataFrame:
    return sites.where(in_box(F.col("site_lon"), F.col("site_lat"), lons, lats))


def outside(sites: DataFrame, lons: Box, lats: Box, both_axes: bool = False) -> DataFrame:
    """Sites off the map, largest first; ``both_axes`` asks them to be off on either axis."""
    lon = ~F.col("site_lon").between(*lons)
    lat = ~F.col("site_lat").between(*lats)
    return sites.where(lon & lat if both_axes else lon | lat).orderBy(F.col("test").desc_nulls_last())


def site_feed(sites: DataFrame, lons: Box, lats: Box, least: int = 11) -> DataFrame:
    """Distinct tested sites on the map with a label that hides small counts."""
    shown = suppressed(F.col("pos"), least)
    label = F.concat(
        text_or_na(F.col("site_short")), F.lit(":"), text_or_na(F.col("test")), F.lit("("),
        text_or_na(shown), F.lit(")"),
    )
    return (
        inside(sites, lons, lats)
        .where(F.col("test").isNotNull())
        .select("state", "site_lon", "site_lat", "site_short", "test", "pos")
        .distinct()
        .withColumn("pos_shown", shown)
        .withColumn("label", label)
    )


def state_layer(regions: DataFrame, sites: DataFrame) -> DataFrame:
    """Regions with the figure of their state, NULL where no site reports it."""
    figures = sites.select(F.lower("state").alias("region"), "state_pos").distinct()
    return regions.join(figures, "region", "left")
