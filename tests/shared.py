"""Constants and helpers of the tests outside ``tests/llm``."""

from pyspark.sql import functions as F

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "line string").withColumn("seq", F.monotonically_increasing_id())
