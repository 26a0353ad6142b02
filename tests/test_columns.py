import datetime

from pyspark.sql import functions as F

from studylake.functions import columns as fx


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    frame = spark.createDataFrame([tuple(v for _, v in values.values())], schema)
    return frame.select(column.alias("r")).first()["r"]


def test_texts(spark):
    assert one(spark, fx.norm_code(F.col("a")), a=("string", " ab ")) == "AB"
    assert one(spark, fx.norm_text(F.col("a"), "lower"), a=("string", " aB ")) == "ab"
    assert one(spark, fx.clean_text(F.col("a")), a=("string", "\t x y \n")) == "x y"
    assert one(spark, fx.clean_text(F.col("a")), a=("string", " \t\n")) is None


def test_placeholders_and_domains(spark):
    assert one(spark, fx.placeholder_int(F.col("a")), a=("string", "?")) is None
    assert one(spark, fx.placeholder_int(F.col("a")), a=("string", "7")) == 7
    assert one(spark, fx.placeholder_int(F.col("a")), a=("string", "3.7")) is None
    kinds = {"TMA": "TMA", "EXAM": "Exam"}
    assert one(spark, fx.map_domain(F.col("a"), kinds), a=("string", "EXAM")) == "Exam"
    assert one(spark, fx.map_domain(F.col("a"), kinds), a=("string", "QUIZ")) is None
    assert one(spark, fx.flag_to_bool(F.col("a")), a=("string", " y")) is True
    assert one(spark, fx.flag_to_bool(F.col("a")), a=("string", "?")) is None
    assert one(spark, fx.bool_text(F.col("a")), a=("boolean", True)) == "true"


def test_source_text_is_kept(spark):
    frame = spark.createDataFrame([("?",)], "date string")
    assert fx.with_source_text(frame, "date").first().asDict() == {
        "date": "?", "date_source": "?"
    }


def test_keys(spark):
    key = fx.enrollment_key(F.col("s"), F.col("m"), F.col("p"))
    values = {"s": ("bigint", 7), "m": ("string", "AAA"), "p": ("string", "2013J")}
    assert one(spark, key, **values) == "7_AAA_2013J"
    assert one(spark, key, **{**values, "p": ("string", None)}) is None
    # NULL parts are skipped by the hash
    frame = spark.createDataFrame([(None, 5, 3)], "a int, b int, c int")
    left = fx.surrogate_key(F.col("a"), F.col("b"), F.col("c"))
    right = fx.surrogate_key(F.col("b"), F.col("c"))
    assert frame.select((left == right).alias("r")).first()["r"]


def test_fingerprint_tells_null_from_blank(spark):
    assert one(spark, fx.fingerprint([F.col("a"), F.col("b")]),
               a=("string", None), b=("string", "")) == "~|"


def test_weeks_and_phases(spark):
    days = [-8, -7, -1, 0, 1, 7, 8, 70, 71, 140, 141]
    frame = spark.createDataFrame([(d,) for d in days], "d int")
    week = fx.week_of(F.col("d"))
    got = [tuple(r) for r in frame.orderBy("d").select(week, fx.phase_of(week)).collect()]
    assert got == [(-2, 1), (-1, 1), (-1, 1), (0, 1), (1, 1), (1, 1), (2, 1), (10, 1), (11, 2),
                   (20, 2), (21, 3)]
    assert one(spark, fx.week_of(F.col("d")), d=("int", None)) is None


def test_spine(spark):
    weeks = spark.range(1).select(fx.week_spine().alias("w"))
    assert weeks.count() == 101
    assert tuple(weeks.agg(F.min("w"), F.max("w")).first()) == (-25, 75)


def test_bands_and_flags(spark):
    bands = {59: "< 60 Credits", 60: "60-120 Credits", 120: "60-120 Credits",
             121: "> 120 Credits", None: "> 120 Credits"}
    for credits, band in bands.items():
        assert one(spark, fx.credit_band(F.col("c")), c=("int", credits)) == band
    assert one(spark, fx.is_withdrawn(F.col("r")), r=("string", " withdrawn")) == 1
    assert one(spark, fx.is_withdrawn(F.col("r")), r=("string", None)) == 0
    assert one(spark, fx.days_late(F.col("s"), F.col("d")), s=("int", 5), d=("int", 9)) == -4
    assert one(spark, fx.weighted_score(F.col("s"), F.col("w")),
               s=("double", 80.0), w=("double", 25.0)) == 20.0
    assert one(spark, fx.is_non_submission(F.col("s")), s=("double", None)) is True


def test_shares(spark):
    assert one(spark, fx.pct(F.col("a"), F.col("b")), a=("int", 1), b=("int", 3)) == 33.33
    assert one(spark, fx.pct(F.col("a"), F.col("b")), a=("int", 1), b=("int", 0)) is None
    assert one(spark, fx.rate(F.col("a"), F.col("b")), a=("int", 1), b=("int", 3)) == 0.3333


def test_days(spark):
    assert one(spark, fx.offset_date(F.col("d")), d=("int", 1)) == datetime.date(1970, 1, 2)
    today = F.lit("2024-01-10").cast("date")
    assert one(spark, fx.age_days(F.col("d"), today), d=("date", datetime.date(2024, 1, 1))) == 9


def test_reasons(spark):
    rules = {"low": F.col("a") < 0, "odd": F.col("a") % 2 == 1, "none": F.col("a").isNull()}
    assert one(spark, fx.reasons(rules), a=("int", 3)) == ["odd"]
    assert one(spark, fx.reasons(rules), a=("int", None)) == ["none"]
    assert one(spark, fx.first_reason(rules), a=("int", None)) == "none"
    assert one(spark, fx.first_reason(rules), a=("int", 2)) == "other_unspecified"
