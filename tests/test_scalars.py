import datetime as dt

from pyspark.sql import functions as F

from cohortspark.functions import scalars as sc
from cohortspark.functions.tails import beta_fraction, f_tail


def one(spark, expression, **values):
    names = ", ".join(f"{k}" for k in values)
    df = spark.createDataFrame([tuple(values.values())], schema_of(values)) if values else spark.range(1)
    del names
    return df.select(expression.alias("x")).first()[0]


def schema_of(values):
    kinds = {str: "string", int: "long", float: "double", dt.datetime: "timestamp_ntz", type(None): "string"}
    return ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items())


def test_like_takes_backslash_as_text_and_underscore_as_any_character(spark):
    df = spark.createDataFrame(
        [(r"\ACT\UMLS_C1\x",), (r"\ACT\UMLSxC1\x",), (r"\ACT\OTHER\x",), (None,)], "p string"
    )
    hit = df.where(sc.like_any(F.col("p"), [r"%ACT\UMLS_C1%"])).count()
    assert hit == 2
    assert df.where(sc.like_any(F.col("p"), [])).count() == 0
    assert df.where(sc.like_any(F.col("p"), ["%!%", r"%OTHER\x"])).count() == 1


def test_null_is_no_match(spark):
    df = spark.createDataFrame([("Spontaneous",), (None,), ("Assisted",)], "t string")
    assert df.where(~sc.contains_ignoring_case(F.col("t"), "spont")).count() == 2
    assert df.where(~sc.matches(F.col("t"), "^A")).count() == 2


def test_codes(spark):
    assert one(spark, sc.code_system(F.col("c")), c="CH:99:213") == "CPT"
    assert one(spark, sc.after_last_colon(F.col("c")), c="KX|COMPONENT_ID:3009") == "3009"
    assert one(spark, sc.code_system(F.col("c")), c="ICD10:U07.1") == "ICD10"
    assert one(spark, sc.loinc_url(F.col("c")), c="2708-6") == "https://loinc.org/2708-6"
    assert one(spark, sc.search_url(F.col("c")), c="CH:99213").endswith("q=CPT:99213")


def test_key_digits(spark):
    for key, three, single in ((42, 4, 0), (4007, 400, 4), (1234567, 345, 3)):
        assert one(spark, sc.key_digits(F.col("k"), 3), k=key) == three
        assert one(spark, sc.key_digits(F.col("k"), 1), k=key) == single


def test_hours_round_half_to_even(spark):
    a = dt.datetime(2020, 3, 1)
    for minutes, hours in ((30, 0), (90, 2), (150, 2), (-30, 0), (149, 2)):
        b = a + dt.timedelta(minutes=minutes)
        assert one(spark, sc.hours_between(F.col("a"), F.col("b")), a=a, b=b) == hours


def test_clamp(spark):
    df = spark.createDataFrame(
        [(None, 10.0), (12.0, 10.0), (-3.0, 10.0), (4.0, None), (None, None)], "h double, u double"
    )
    out = [r[0] for r in df.select(sc.clamped(F.col("h"), F.col("u"))).collect()]
    assert out == [0.0, 10.0, 0.0, 4.0, 0.0]


def test_recodes(spark):
    from cohortspark.sources.refdata import ADMISSION_GROUPS, ADMISSION_PHRASES, DISCHARGE_RULES

    texts = ["Skilled NURSING home or self", "Home or Self Care", "Expired", "Left", None, "Home Health"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(sc.recode_first(F.col("t"), DISCHARGE_RULES, "OT")).collect()]
    assert got == ["SNF-HOSP-REHAP-LTC-HHA", "HOME", "DEATH", "OT", "OT", "SNF-HOSP-REHAP-LTC-HHA"]
    groups = ["INFLUENZA AND PNEUMONIA", "PERSONS WITH POTENTIAL HEALTH HAZARDS X", None, "BURNS"]
    df = spark.createDataFrame([(t,) for t in groups], "t string")
    kept = sc.keep_listed(F.col("t"), ADMISSION_GROUPS, ADMISSION_PHRASES)
    assert [r[0] for r in df.select(kept).collect()] == [
        "INFLUENZA AND PNEUMONIA", "PERSONS WITH POTENTIAL HEALTH HAZARDS", None, "OT",
    ]


def test_pressure_ratio_share_and_flag(spark):
    df = spark.createDataFrame(
        [(120.0, 80.0, 1.0), (120.0, None, 88.0), (None, None, None)], "s double, d double, m double"
    )
    got = [r[0] for r in df.select(sc.mean_arterial(F.col("s"), F.col("d"), F.col("m"))).collect()]
    assert got == [93.0, 88.0, None]
    df = spark.createDataFrame(
        [(1.0, 4.0), (8.0, 4.0), (1.0, 0.0), (0.0, 0.0), (1.0, None)], "p double, t double"
    )
    got = df.select(sc.share_of_total(F.col("p"), F.col("t")), sc.safe_ratio(F.col("p"), F.col("t"))).collect()
    assert [tuple(r) for r in got] == [(25.0, 0.25), (0.2, 2.0), (None, 0.0), (None, 0.0), (None, 0.0)]
    df = spark.createDataFrame([(1.0,), (2.0,), (0.5,), (3.0,), (None,)], "v double")
    got = [r[0] for r in df.select(sc.range_flag(F.col("v"), F.lit(1.0), F.lit(2.0))).collect()]
    assert got == ["normal", "normal", "low", "high", "normal"]


def test_labels(spark):
    assert one(spark, sc.suppressed(F.col("n")), n=10) == "< 11"
    assert one(spark, sc.suppressed(F.col("n")), n=11) == "11"
    for value, digits, text in ((54.8, 1, "54.8"), (7.0, 1, "7"), (100.0, 0, "100"), (-0.01, 1, "0"), (None, 1, "NA")):
        df = spark.createDataFrame([(value,)], "v double")
        assert df.select(sc.number_text(F.col("v"), digits)).first()[0] == text


def test_first_secure_link(spark):
    pages = [
        '<h3><a href="/url?q=http://a.org&sa=U">a</a></h3><h3 class="r"><a href="/url?q=https://b.org/x&sa=U&v=1">b</a></h3>',
        '<a href="https://outside.org">no heading</a>',
        None,
    ]
    df = spark.createDataFrame([(p,) for p in pages], "html string")
    got = [r[0] for r in df.select(sc.first_secure_link(F.col("html"))).collect()]
    assert got == ["https://b.org/x", None, None]


def test_links_are_read_as_tags_are(spark):
    h3 = lambda tag: f"<H3 class='r'>{tag}hit</a></h3 >"
    cases = [
        (h3("<a href='https://a.org/x'>"), "https://a.org/x"),
        (h3("<A\nHREF = https://a.org/x>"), "https://a.org/x"),
        (h3('<a class="r" href="/url?q=https://a.org/x&amp;sa=U&amp;ved=1">'), "https://a.org/x"),
        (h3('<a href="https://a.org/?a=1&amp;b=2">'), "https://a.org/?a=1&b=2"),
        (h3('<a href="https://a.org/?a=1&#38;amp;b">'), "https://a.org/?a=1&amp;b"),
        (h3('<a href="https:&#x2F;&#47;a.org/&#233;&#x1F600;&quot;&unknown;&amp">'), "https://a.org/\u00e9\U0001f600\"&unknown;&amp"),
        (h3('<a href="https://a.org/&#0;&#xD800;&#99999999999;">'), "https://a.org/\ufffd\ufffd\ufffd"),
        (h3("""<a title="href='https://no.org' >" data-href="https://no.org" href='https://a.org'>"""), "https://a.org"),
        (h3('<a title=">" href="https://a.org">'), "https://a.org"),
        (h3('<abbr href="https://no.org"><a name="x"><a disabled href="https://a.org"/>'), "https://a.org"),
        (h3('<a href="http://a.org">') + h3("<a href='https://b.org'>"), "https://b.org"),
        ("<!-- " + h3('<a href="https://no.org">') + " -->" + h3('<a href="https://a.org">'), "https://a.org"),
        ('<h30><a href="https://no.org"></h30><a href="https://no.org">', None),
        (h3("<a href>") + h3("<a href=''>"), None),
        ("", None),
        (h3("<a " + "x=1 " * 20_000 + "href='https://a.org'>"), "https://a.org"),
        ("<h3>" + "x" * 200_000 + '<a href="https://a.org"></h3>', "https://a.org"),
    ]
    df = spark.createDataFrame([(i, page) for i, (page, _) in enumerate(cases)], "i int, html string")
    got = {r.i: r.link for r in df.select("i", sc.first_secure_link(F.col("html")).alias("link")).collect()}
    assert [got[i] for i in range(len(cases))] == [link for _, link in cases]


def test_prefix_predicate_is_pushed_to_the_scan(spark, tmp_path):
    spark.range(100).select(F.col("id").cast("string").alias("dx")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).where(sc.starts_with_any(F.col("dx"), ["1", "12", "7"]))
    assert df.count() == 22
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(dx,1)" in plan and "StringStartsWith(dx,12)" not in plan


def test_f_tail(spark):
    # closed forms: P(F(2, n) > f) = (1 + 2f/n)^(-n/2)
    for f, n in ((0.5, 10), (3.0, 40), (12.0, 100)):
        want = (1 + 2 * f / n) ** (-n / 2)
        got = beta_fraction(n / 2, 1.0, n / (n + 2 * f))
        assert abs(got - want) < 1e-12
    df = spark.createDataFrame([(3.0, 2, 40), (None, 1, 5)], "f double, a long, b long")
    got = [r[0] for r in df.select(f_tail("f", "a", "b")).collect()]
    assert abs(got[0] - (1 + 6 / 40) ** -20) < 1e-12 and got[1] is None
