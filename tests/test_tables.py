import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortspark.functions.scalars import key_digits
from cohortspark.operators import ranks as rk
from cohortspark.operators import reshape as rs
from cohortspark.sources import batch, refdata, tables


def test_csv_drops_blank_and_legend_rows(spark, tmp_path):
    path = tmp_path / "bands.csv"
    path.write_text("CODE,LB,SCORE\nplts,150,0\nplts,100,1\n,,\n\"btw,c\",[),\n")
    schema = T.StructType([T.StructField("CODE", T.StringType()), T.StructField("LB", T.DoubleType()), T.StructField("SCORE", T.IntegerType())])
    df = tables.read_reference_csv(spark, str(path), schema, "SCORE")
    assert [(r["CODE"], r["LB"], r["SCORE"]) for r in df.collect()] == [("plts", 150.0, 0), ("plts", 100.0, 1)]


def test_snapshots_parts_and_report(spark, tmp_path, rows):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, 5.0)], "id int, b double")
    tables.save_snapshot(a, str(tmp_path / "a"))
    tables.save_snapshot(b, str(tmp_path / "b"))
    assert tables.load_snapshot(spark, str(tmp_path / "a")).count() == 1
    both = tables.read_parts(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert rows(both, "id", "a", "b") == [(1, "x", None), (2, None, 5.0)]
    assert rows(tables.stack([a, b]), "id", "a", "b") == rows(both, "id", "a", "b")
    tables.save_report(a, str(tmp_path / "r"))
    files = list((tmp_path / "r").glob("*.csv"))
    assert len(files) == 1 and files[0].read_text() == "id,a\n1,x\n"


def test_parquet_folder_source(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t.parquet"))
    assert tables.read_table(spark, str(tmp_path), "t").count() == 3


def test_catalog_tables(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    tables.save_table(df, "tab_one", ["id"], 4)
    tables.save_table(df, "tab_one", ["id"], 4)
    tables.require_tables(spark, "tab_one")
    assert tables.read_table(spark, "catalog", "tab_one").count() == 2
    more = spark.createDataFrame([("c", 3)], "v string, id int")
    assert rows(tables.append_table(more, "tab_one"), "id", "v") == [(1, "a"), (2, "b"), (3, "c")]
    tables.drop_tables(spark, "tab_one", "tab_absent")
    with pytest.raises(LookupError, match="tab_one"):
        tables.require_tables(spark, "tab_one")


def test_jdbc_options_and_predicates():
    options = tables.jdbc_options("oracle", "h", 1521, "svc", "u", "p")
    assert options["url"] == "jdbc:oracle:thin:@//h:1521/svc" and options["fetchsize"] == "10000"
    clauses = tables.digit_predicates("patient_num")
    assert len(clauses) == 10 and clauses[4] == "substr(lpad(patient_num, 6, '0'), 3, 1) = '4'"
    assert len(tables.digit_predicates("patient_num", 3)) == 1000


def test_typed_empty_table_and_required_columns(spark):
    empty = tables.empty_table(spark, tables.CODE_MAP_SCHEMA)
    assert empty.count() == 0 and not empty.schema["i2b2_code"].nullable
    bad = spark.createDataFrame([("GCS", None, None, None, "x")], "raw_obsclin_name string, obsclin_code string, obsclin_type string, i2b2_code string, i2b2_label string")
    with pytest.raises(PySparkException, match="i2b2_code"):
        tables.check_required(bad, tables.CODE_MAP_SCHEMA).collect()
    assert tables.check_required(refdata.observation_codes(spark), tables.CODE_MAP_SCHEMA).count() == 21
    assert tables.empty_table(spark, tables.STATUS_SCHEMA).columns[0] == "patient_num"


def test_reference_tables(spark, rows):
    assert refdata.severity_bands(spark).count() == 27
    assert refdata.white_cell_ranges(spark).count() == 6
    assert refdata.respiratory_prefixes(spark).count() == 43
    odd = rows(refdata.misplaced_codes(refdata.observation_codes(spark)), "raw_obsclin_name", "i2b2_code")
    assert odd == [("FiO2", "mmHg"), ("GCS", "@"), ("PaO2", "mmHg")]


def test_calendar(spark):
    got = {(str(r["date"]), r["date_scale"]): r["date_rk"] for r in refdata.calendar(spark, "2020-03-01", "2020-09-20").collect()}
    assert len(got) == 204 * 4
    for day, scale, rank in (
        ("2020-03-01", "date_week", 1), ("2020-03-02", "date_week", 2), ("2020-09-20", "date_week", 30),
        ("2020-03-01", "date_biweek", 1), ("2020-03-02", "date_biweek", 2), ("2020-09-20", "date_biweek", 16),
        ("2020-03-02", "date_daily", 2), ("2020-09-20", "date_daily", 204), ("2020-09-20", "date_month", 9),
    ):
        assert got[(day, scale)] == rank


def test_batch(spark, rows):
    stages = [
        batch.Stage("b_small", "SELECT id FROM range(10) WHERE id >= :least"),
        batch.Stage("b_kept", "SELECT id * 2 AS id FROM b_small", "write"),
        batch.Stage("b_sum", "SELECT sum(id) AS total, :label AS label FROM IDENTIFIER(:source)", "query"),
    ]
    out = batch.run_batch(spark, stages, {"least": 7, "label": "it's", "source": "b_kept"})
    assert rows(out["b_sum"]) == [(48, "it's")]
    tables.drop_tables(spark, "b_kept")
    with pytest.raises(ValueError):
        batch.run_batch(spark, [batch.Stage("x", "SELECT 1", "shout")])


def test_a_load_computes_its_rows_once(spark, rows):
    name, seen = "loads_counted", spark.sparkContext.accumulator(0)

    def through(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    make = lambda n: spark.range(n).mapInArrow(through, "id long").repartition(2)
    try:
        tables.load_part(make(3), name, "load", "mon")
        assert rows(tables.load_part(make(4), name, "load", "mon")) == [(i, "mon") for i in range(4)]
        assert seen.value == 7
    finally:
        tables.drop_tables(spark, name)


def test_a_load_that_runs_again_replaces_its_own_rows(spark, rows):
    name = "loads_of_parts"
    make = lambda *values: spark.createDataFrame([(v, v * 10) for v in values], "a int, b int")
    try:
        tables.load_part(make(1, 2), name, "load", "mon")
        tables.load_part(make(3), name, "load", "tue")
        assert rows(tables.load_part(make(3), name, "load", "tue")) == [(1, 10, "mon"), (2, 20, "mon"), (3, 30, "tue")]
        assert rows(tables.load_part(make(5).select("b", "a"), name, "load", "mon")) == [(3, 30, "tue"), (5, 50, "mon")]
        assert rows(tables.load_part(make(1).where("a > 1"), name, "load", "mon")) == [(3, 30, "tue")]
        stages = [batch.Stage(name, f"SELECT a + 1 AS a, b FROM {name} WHERE load = 'tue'", "load", ("load", "wed"))]
        for _ in range(2):
            out = batch.run_batch(spark, stages)[name]
        assert rows(out) == [(3, 30, "tue"), (4, 30, "wed")]
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    finally:
        tables.drop_tables(spark, name)
    with pytest.raises(ValueError):
        batch.run_batch(spark, [batch.Stage("x", "SELECT 1 AS a", "load")])


def test_a_report_is_small(spark, tmp_path):
    with pytest.raises(ValueError, match="at most 10 rows"):
        tables.save_report(spark.range(11), str(tmp_path / "r"), most=10)
    tables.save_report(spark.range(10), str(tmp_path / "r"), most=10)
    assert spark.read.csv(str(tmp_path / "r"), header=True).count() == 10


def test_calendar_over_years(spark):
    import datetime as dt

    got = {(r.date, r.date_scale): r.date_rk for r in refdata.calendar(spark, "2019-12-28", "2021-01-05").collect()}
    weeks = []
    day = dt.date(2019, 12, 28)
    while day <= dt.date(2021, 1, 5):
        if day.isocalendar()[:2] not in weeks:
            weeks.append(day.isocalendar()[:2])
        assert got[day, "date_week"] == weeks.index(day.isocalendar()[:2]) + 1
        day += dt.timedelta(1)
    assert len(weeks) == 55


def test_grid_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(rs, "_GRID_LEVELS", 4)
    df = spark.range(300).select((F.col("id") % 23).cast("string").alias("a"), F.when(F.col("id") % 7 > 0, F.col("id") % 13).alias("b"))
    got = {(r.row, r.col): r.n for r in rs.crosstab(df, "a", "b").collect()}
    assert len(got) == 23 * 13 and sum(got.values()) == df.where("b IS NOT NULL").count()
    assert all(got[r.a, r.b] == r["count"] for r in df.where("b IS NOT NULL").groupBy("a", "b").count().collect())
    assert "collect_set" not in rs.crosstab(df, "a", "b")._jdf.queryExecution().optimizedPlan().toString()


def test_pages(spark):
    df = spark.range(2005).select((F.col("id") * 7 % 2005).alias("k"))
    paged = rk.row_pages(df, ["k"])
    assert [r["count"] for r in paged.groupBy("page").count().orderBy("page").collect()] == [1000, 1000, 5]
    assert [r["k"] for r in rk.row_page(df, ["k"], 2).orderBy("k").collect()] == list(range(2000, 2005))
    got = [(r["k"], r["row_index"]) for r in paged.collect()]
    assert all(k == i for k, i in got)


def test_digit_chunks_are_whole(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    assert sum(rk.key_digit_chunk(df, "k", i).count() for i in range(10)) == 5000
    assert df.where(key_digits(F.col("k"), 3) == 4).count() == rk.key_digit_chunk(df, "k", 4, 3).count()


@pytest.mark.parametrize("by", [[], ["g"]])
def test_quantiles_equal_the_builtin(spark, by):
    df = spark.range(4000).select(
        F.when(F.col("id") % 10 < 4, F.lit(7.5)).otherwise(F.hash("id") / 1e6 - 3).alias("v"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("g"),
    ).withColumn("v", F.when(F.hash("v") % 11 != 0, F.col("v")))
    probs = {"a": 0.0, "b": 0.05, "c": 1 / 3, "d": 0.5, "e": 0.95, "f": 1.0}
    got = {tuple(r[c] for c in by): [r[p] for p in probs] for r in rk.exact_quantiles(df, "v", probs, by).collect()}
    want = df.groupBy(*by).agg(F.percentile("v", list(probs.values())).alias("q")).collect()
    assert len(got) == len(want) == (5 if by else 1)
    for r in want:
        assert got[tuple(r[c] for c in by)] == pytest.approx(r["q"], abs=1e-9)


def test_quantiles_of_odd_numbers(spark):
    """Both zeros, the smallest and largest numbers, neighbours, infinities, powers of two and what is beside them."""
    import math
    import random

    draw = random.Random(1)
    values = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, -1.7976931348623157e308]
    values += [math.inf, -math.inf, 1.0, math.nextafter(1, 2), math.nextafter(1, 0)]
    for e in range(-1074, 1024, 31):
        x = math.ldexp(1.0, e)
        values += [x, math.nextafter(x, math.inf), math.nextafter(x, 0), -x, x * draw.uniform(1, 2)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    bits = df.select("v", rk.ordered_bits(F.col("v")).alias("b")).collect()
    ordered = sorted(bits, key=lambda r: r.v)
    assert all((a.b < b.b) == (a.v < b.v) and (a.b == b.b) == (a.v == b.v) for a, b in zip(ordered, ordered[1:]))
    n = len(values)
    wanted = {f"q{i}": i / (n - 1) for i in range(0, n, 17)}
    got = rk.exact_quantiles(df, "v", {k: p for k, p in wanted.items()}).first().asDict()
    # a position may lie a rounding error beside a whole one
    for i, name in zip(range(0, n, 17), wanted):
        near = [ordered[j].v for j in (i - 1, i, i + 1) if 0 <= j < n]
        assert any(got[name] == x or math.isclose(got[name], x, rel_tol=1e-9) for x in near)


def test_quantiles_are_three_passes_without_a_write(spark, tmp_path):
    spark.range(5000).select((F.col("id") % 97).cast("double").alias("v"), (F.col("id") % 3).alias("g")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    for by in ([], ["g"]):
        out = rk.exact_quantiles(df, "v", {"a": 0.25, "b": 0.5, "c": 0.9}, by)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 3 and "ExistingRDD" not in plan and "RangePartitioning" not in plan.replace(" ", "")


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert rk.exact_quantiles(df, "v", {"m": 0.5}).collect()[0]["m"] is None


@pytest.mark.parametrize("descending", [True, False])
def test_running_totals(spark, descending):
    df = spark.range(500).select(((F.col("id") * 31 % 500 - 250) / 7).alias("s"), (F.col("id") % 3).alias("n"))
    got = sorted(rk.running_totals(df, "s", ["n"], descending=descending).collect(), key=lambda r: -r["s"] if descending else r["s"])
    total = 0
    for r in got:
        total += r["n"]
        assert r["n_cum"] == total and r["n_total"] == 499
    assert total == 499


def test_first_per_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    first = rk.first_per(df, ["k"], [F.col("id").desc()])
    assert sorted(r["id"] for r in first.collect()) == [97, 98, 99]
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_reshapes(spark, rows):
    df = spark.createDataFrame([(1, 2, None), (2, None, "x")], "id int, a int, b string")
    long = rs.gather(df, ["id"], ["a", "b"], "string")
    assert rows(long) == [(1, "a", "2"), (1, "b", None), (2, "a", None), (2, "b", "x")]
    wide = rs.spread(long, ["id"], "var", "val", ["a", "b"])
    assert rows(wide) == [(1, "2", None), (2, None, "x")]
    text = df.select(rs.unite(["id", "b"], "=").alias("u"))
    assert rows(text) == [("1=NA",), ("2=x",)]
    parts = spark.createDataFrame([("a=b=c",), ("d",)], "t string").select(*rs.separate(F.col("t"), ("k", "v")))
    assert rows(parts) == [("a", "b=c"), ("d", None)]
    times = spark.createDataFrame([(1, 2.9), (2, 0.0), (3, None)], "id int, n double")
    assert rows(rs.repeat_rows(times, "n")) == [(1, 2.9, 1), (1, 2.9, 2), (2, 0.0, 1), (3, None, 1)]


def test_crosstab(spark, rows):
    df = spark.createDataFrame([(0, "a"), (0, "a"), (0, "b"), (1, "b"), (None, "b")], "r int, c string")
    assert rows(rs.crosstab(df, "r", "c", "col")) == [(0, "a", 2, 1.0), (0, "b", 1, 0.5), (1, "a", 0, 0.0), (1, "b", 1, 0.5)]
    assert rows(rs.crosstab(df, "r", "c", "row"))[2] == (1, "a", 0, 0.0)


def test_sparse(spark, rows):
    df = spark.createDataFrame([("b", "y", 2.0), ("a", "y", None), ("a", "x", 3.0), ("a", "x", 4.0)], "id string, v string, x double")
    assert rows(rs.sparse_coo(df, "id", "v", "x")) == [(1, 1, 7.0, "a", "x"), (1, 2, 1.0, "a", "y"), (2, 2, 2.0, "b", "y")]
    assert rows(rs.sparse_coo(df, "id", "v", binary=True), "i", "j", "x") == [(1, 1, 2.0), (1, 2, 1.0), (2, 2, 1.0)]
    flat = rs.sparse_coo(df, "id", "v", binary=True, sum_duplicates=False)
    assert rows(flat, "i", "j", "x") == [(1, 1, 1.0), (1, 2, 1.0), (2, 2, 1.0)]
    assert rows(rs.sparse_rows(flat)) == [(1, [1, 2], [1.0, 1.0]), (2, [2], [1.0])]


def test_null_keys_join_each_other(spark, rows):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, n int")
    right = spark.createDataFrame([(None, 10), ("b", 20)], "k string, m int")
    assert rows(rs.joined_back(left, right, ["k"])) == [("a", 2, None), (None, 1, 10)]
    assert dt is not None


def test_a_task_reads_few_mb_of_a_shuffle(spark):
    """100 MB of a shuffle go to many tasks, however few partitions the session asks for."""
    keys = spark.range(6_000_000).select(F.xxhash64("id").alias("a"), F.xxhash64("id", F.lit(1)).alias("b")).distinct()
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 8
    assert keys.select(F.spark_partition_id().alias("p")).distinct().count() > 10
