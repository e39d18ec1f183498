"""Reading and writing tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# JDBC driver classes and address patterns of the three warehouse kinds
WAREHOUSES = {
    "oracle": ("oracle.jdbc.OracleDriver", "jdbc:oracle:thin:@//{host}:{port}/{database}"),
    "sqlserver": (
        "com.microsoft.sqlserver.jdbc.SQLServerDriver",
        "jdbc:sqlserver://{host}:{port};databaseName={database}",
    ),
    "postgresql": ("org.postgresql.Driver", "jdbc:postgresql://{host}:{port}/{database}"),
}


def jdbc_options(
    kind: str, host: str, port: int, database: str, user: str, password: str, fetch_size: int = 10_000
) -> dict[str, str]:
    """Reader options for a warehouse of the given kind."""
    driver, address = WAREHOUSES[kind]
    return {
        "driver": driver,
        "url": address.format(host=host, port=port, database=database),
        "user": user,
        "password": password,
        "fetchsize": str(fetch_size),
    }


def digit_predicates(key: str, digits: int = 1, width: int = 6, start: int = 3) -> list[str]:
    """One WHERE clause per chunk of the padded key, for a parallel JDBC read."""
    slot = f"substr(lpad({key}, {width}, '0'), {start}, {digits})"
    return [f"{slot} = '{i:0{digits}d}'" for i in range(10**digits)]


def read_table(spark: SparkSession, source: str | dict[str, str], name: str, **split) -> DataFrame:
    """Table ``name`` of a Parquet folder, of the catalog, or of a JDBC warehouse.

    ``source`` is a folder path, ``"catalog"``, or the options from
    :func:`jdbc_options`. For JDBC, either ``predicates=[...]`` or ``column``,
    ``lowerBound``, ``upperBound`` and ``numPartitions`` read it in parallel.
    """
    if isinstance(source, dict):
        predicates = split.pop("predicates", None)
        if predicates:
            options = dict(source)
            return spark.read.jdbc(options.pop("url"), name, predicates=predicates, properties=options)
        return spark.read.format("jdbc").options(**source, dbtable=name, **split).load()
    if source == "catalog":
        return spark.table(name)
    return spark.read.parquet(f"{source.rstrip('/')}/{name}.parquet")


def read_reference_csv(
    spark: SparkSession, path: str, schema: T.StructType, required: str
) -> DataFrame:
    """CSV lookup table without its blank and legend rows, where ``required`` is missing."""
    rows = spark.read.csv(path, header=True, schema=schema, mode="PERMISSIVE")
    return rows.where(F.col(required).isNotNull())


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames, matched by column name, missing columns as NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_parts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """One table out of several snapshots, whose columns may differ."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def save_snapshot(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_table(
    df: DataFrame, name: str, bucket_by: Sequence[str] = (), buckets: int = 0
) -> DataFrame:
    """Replace catalog table ``name``; bucketed by the join key if asked to."""
    writer = df.write.mode("overwrite").format("parquet")
    if bucket_by and buckets:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def append_table(df: DataFrame, name: str) -> DataFrame:
    """Add rows to ``name``, whose columns must have the same names."""
    spark = df.sparkSession
    df.select(*spark.table(name).columns).write.insertInto(name)
    return spark.table(name)


def load_part(df: DataFrame, name: str, key: str, value: str | int) -> DataFrame:
    """Replace the rows of table ``name`` that were loaded under ``value``, and no others.

    The table is laid out in folders by ``key``, a column of its own that says which load a row came
    with. So a load that runs again, after a failure or by mistake, leaves what the first one left.
    A table that is absent is made. ``df`` is computed once; it needs the table's columns, in any order, without ``key``.
    """
    spark = df.sparkSession
    marked = df.withColumn(key, F.lit(value))
    if not spark.catalog.tableExists(name):
        marked.write.format("parquet").partitionBy(key).saveAsTable(name)
        return spark.table(name)
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    columns = [c for c in spark.table(name).columns if c != key]
    written = Observation()
    spark.conf.set(mode, "dynamic")
    try:
        counted = marked.select(*columns, key).observe(written, F.count(F.lit(1)).alias("rows"))
        counted.write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, before)
    if not written.get["rows"]:  # no row has named the folder that has to go
        spark.sql(f"ALTER TABLE IDENTIFIER(:name) DROP IF EXISTS PARTITION (`{key}` = :value)", args={"name": name, "value": value})
    return spark.table(name)


def drop_tables(spark: SparkSession, *names: str) -> None:
    """Drop tables if they exist, without keeping them in a trash folder."""
    for name in names:
        spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name) PURGE", args={"name": name})


def require_tables(spark: SparkSession, *names: str) -> None:
    """Fail early if one of the tables a stage needs is absent."""
    missing = [name for name in names if not spark.catalog.tableExists(name)]
    if missing:
        raise LookupError(f"tables not found: {', '.join(missing)}")


def save_report(df: DataFrame, path: str, most: int = 100_000) -> None:
    """Write a small report as one CSV file with a header.

    One task writes it, so a frame of more than ``most`` rows is refused; counting stops there.
    """
    if df.limit(most + 1).count() > most:
        raise ValueError(f"a report has at most {most} rows; write a table instead")
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def check_required(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the types of ``schema``; a NULL in a required column stops the query."""
    out = []
    for field in schema:
        column = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            failure = F.raise_error(F.lit(f"NULL in required column {field.name}"))
            column = F.coalesce(column, failure.cast(field.dataType))
        out.append(column.alias(field.name))
    return df.select(*out)


STATUS_SCHEMA = T.StructType(
    [
        T.StructField("patient_num", T.StringType()),
        T.StructField("encounter_num", T.StringType()),
        T.StructField("pos_confirmed", T.IntegerType()),
        T.StructField("lab_int", T.IntegerType()),
    ]
)

CODE_MAP_SCHEMA = T.StructType(
    [
        T.StructField("raw_obsclin_name", T.StringType(), False),
        T.StructField("obsclin_code", T.StringType()),
        T.StructField("obsclin_type", T.StringType()),
        T.StructField("i2b2_code", T.StringType(), False),
        T.StructField("i2b2_label", T.StringType(), False),
    ]
)
