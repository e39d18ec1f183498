"""Names and links of codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def code_names(
    codes: DataFrame, dictionary: DataFrame, link: Column, code: str = "code", name: str = "name"
) -> DataFrame:
    """Add the name of each code, or ``link`` where the dictionary has several.

    Names are counted per code before the join, so a code with many names does
    not multiply the rows. Unknown codes get NULL.
    """
    known = dictionary.groupBy(code).agg(
        F.min(name).alias(name), (F.count(name) > 1).alias("_several")
    )
    return (
        codes.join(known, code, "left")
        .withColumn(name, F.when(F.col("_several"), link).otherwise(F.col(name)))
        .drop("_several")
    )
