"""What is left on disk by writes that shuffle."""

import time

from pyspark.sql import functions as F

from tidemark import workspace
from tidemark.plans.feeds import key_value_feed, survey_findings


def _shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = {blocks.apply(i).getName() for i in range(blocks.size())}
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def _gone(spark, before):
    until = time.time() + 20
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    return not _shuffle_files(spark) - before


def test_a_write_leaves_no_shuffle_files(spark):
    was, before = spark.conf.get(workspace.SHUFFLE_CLEANUP, "false"), _shuffle_files(spark)
    df = spark.range(5000).groupBy((F.col("id") % 700).alias("k")).agg(F.sum("id").alias("s"))
    found = workspace.materialise(df, "shuffled")
    assert _gone(spark, before) and spark.conf.get(workspace.SHUFFLE_CLEANUP) == was
    assert found.count() == 700 and sorted(map(tuple, df.collect())) == sorted(map(tuple, found.collect()))


def test_the_key_value_feed_leaves_only_its_numbered_rows(spark):
    rows = [(i, i % 9, f"E{i % 5}", i % 7, f"C{i % 7}", i, i, f"a{i}", None, "ann") for i in range(400)]
    attributes = spark.createDataFrame(
        rows, "AssetID int, RepairElementID int, RepairElement string, ComponentID int, Component string, AttributeID int, "
              "SurveyAttributeID int, Attribute string, InstallationDate timestamp_ntz, Surveyor string")
    repairs = spark.createDataFrame(
        [(i, f"E{i % 5}", i % 7, f"C{i % 7}", i, i, "patch", 1.0, 2021, 10.0, "zoe") for i in range(0, 400, 2)],
        "AssetID int, RepairElement string, ComponentID int, Component string, RepairID int, SurveyRepairID int, "
        "RepairDescription string, Quantity double, YearDue int, RepairCost double, Surveyor string")
    asset = spark.createDataFrame([(i, f"U{i % 200:03}") for i in range(0, 400, 3)], "AssetID int, UPRN string")
    kept = set(workspace.names_in(spark, workspace.shared_folder(spark)))
    before = _shuffle_files(spark)
    feed = key_value_feed(asset, survey_findings(attributes, repairs), as_of="2019-03-15 14:05:06", creator="tests")
    left = {n.rpartition("-")[0] for n in set(workspace.names_in(spark, workspace.shared_folder(spark))) - kept}
    assert _gone(spark, before) and left == {"row-number"}
    found = sorted((r["PROP_ATTRIBUTE_KEY_VALUE_"], r["F_PROPERTY_ATTRIBUTES"]) for r in feed.collect())
    assert [n for n, _ in found] == list(range(1, len(found) + 1)) and [u for _, u in found] == sorted(u for _, u in found)
