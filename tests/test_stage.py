from pathlib import Path

from pyspark.sql import functions as F

from walkvec.stage import drop, last_staged, stage


def _shuffles(spark):
    """Shuffles whose files are still tracked."""
    return spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses().size()


def test_shuffles_of_a_staged_table_go(spark):
    before = _shuffles(spark)
    grouped = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s"))
    rows = stage(grouped.repartition(3, "s"), "grouped")
    assert _shuffles(spark) <= before
    assert sorted(r.k for r in rows.collect()) == list(range(7))
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_only_the_last_staged_table_stays(spark):
    def make():
        return stage(stage(spark.range(5), "first").where("id > 1"), "second")

    rows = last_staged(spark, make)
    root = Path(rows.inputFiles()[0].removeprefix("file:")).parent.parent
    assert sorted(r.id for r in rows.collect()) == [2, 3, 4]
    second = {p.name for p in root.iterdir() if p.name.startswith("second-")}
    assert second and not [p for p in root.iterdir() if p.name.startswith("first-")]
    drop(rows)
    assert not second & {p.name for p in root.iterdir()}
