import datetime as dt

from pyspark.sql import functions as F

from walkvec.functions import scalar
from walkvec.functions.sql_functions import register_sql_functions


def _one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_uniform(spark):
    assert _one(spark, scalar.uniform(42, 7, 3)) == (0.19650531910339208,)


def test_hashes(spark):
    got = _one(
        spark,
        scalar.md5_hex(F.lit("abc")),
        scalar.md5_hex16(F.lit("abc")),
        scalar.md5_hex(F.lit(None)),
    )
    assert got == ("900150983cd24fb0d6963f7d28e17f72", "3cd24fb0d6963f7d", None)


def test_dates(spark):
    got = _one(
        spark,
        scalar.date_key_diff(F.lit("20200228"), F.lit("20200301")),
        scalar.date_key_add(F.lit("20200228"), 2),
        scalar.date_key_add(F.lit("20200230"), 2),
        scalar.next_sunday(F.lit(dt.date(2026, 12, 6))),
        scalar.today_key(),
    )
    assert got[:4] == (2, "20200301", None, "2026-12-13")
    assert len(got[4]) == 8


def test_minute_of_day(spark):
    ts = F.lit("2020-01-01 13:05:00").cast("timestamp")
    assert _one(spark, scalar.minute_of_day(ts), scalar.minute_of_day(ts, hour12=True)) == (785, 65)


def test_sql_functions_are_inlined(spark):
    register_sql_functions(spark)
    df = spark.sql("SELECT getScore(0.25D) s, md5Handle('a') m, tpId() t, eMode() e")
    assert tuple(df.first()) == (0.75, "0cc175b9c0f1b6a831c399e269772661", "0", "4")
    plan = spark.sql("SELECT getScore(id / 4.0D) s FROM range(3)")._jdf.queryExecution().executedPlan().toString()
    assert "getScore" not in plan.split("AS s")[0].split("Project")[-1]


def test_scores(spark):
    d = F.lit(0.5)
    assert _one(spark, scalar.score_from_distance(d), scalar.cosine_from_distance(d)) == (0.5, 0.875)
