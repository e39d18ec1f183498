from __future__ import annotations

import pytest
from pyspark.sql import types as T

#: the documents' columns, and some that could clash with what operators add
EXTRA = "n_bytes long, spans string, copy string, mix string, size long, class string, lang_pred string, score string, ids string"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text[, lang[, source]]) rows."""

    def make(rows, extra=False):
        filled = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a", len(r[1] or "")) for r in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        if extra:
            filled = [(*r, *([None] * len(EXTRA.split(", ")))) for r in filled]
            schema += ", " + EXTRA
        return spark.createDataFrame(filled, schema)

    return make


@pytest.fixture(scope="session")
def vectors(spark):
    schema = T.StructType(
        [
            T.StructField("vec_id", T.LongType()),
            T.StructField("embedding", T.ArrayType(T.FloatType())),
            T.StructField("label", T.IntegerType()),
            T.StructField("class", T.StringType()),
        ]
    )

    def make(rows):
        clean = [(i, None if v is None else [None if x is None else float(x) for x in v], c, "x") for i, v, c in rows]
        return spark.createDataFrame(clean, schema)

    return make
