from pyspark.sql import functions as F

from lakestar.llm import common


def test_rows_of_files_have_a_place_and_others_are_written(spark, tmp_path):
    spark.range(1000).select((F.col("id") % 7).alias("v"), F.lit("x y").alias("a b"), F.lit(3).alias("row")).repartition(5).write.parquet(f"{tmp_path}/a é%20 b")
    read = spark.read.parquet(f"{tmp_path}/a é%20 b")
    docs, row = common.numbered(read, "t")
    assert row == "row_" and docs.columns == [*read.columns, row] and "jaccard" not in row
    places = [r[row] for r in docs.collect()]
    assert len(set(places)) == 1000 and sorted(places) == sorted(r[row] for r in docs.where("v < 100").repartition(3).collect())
    assert f"{tmp_path}" in docs.inputFiles()[0]  # nothing was written
    kept, row = common.numbered(read.where("v = 1").select("v"), "t")
    assert len({r[row] for r in kept.collect()}) == kept.count() == read.where("v = 1").count()
    for made in (spark.createDataFrame([(1,), (1,)], "v int"), read.union(read), read.groupBy("v").count(), read.join(read.select("v").distinct(), "v"), read.limit(0)):
        found, row = common.numbered(made, "t")
        assert len({r[row] for r in found.collect()}) == made.count()


def test_packed_columns_come_back(spark):
    df = spark.createDataFrame([("t", 1, "x")], "text string, score int, `a.b` string")
    inner = common.packed(df, "text")
    assert inner.columns[0] == "text" and len(inner.columns) == 2
    assert common.unpacked(inner.withColumn("score", F.lit(9)).withColumn("text", F.lit("u")), df.columns, "text").collect()[0][:] == ("u", 1, "x")
    assert common.unpacked(common.packed(df.select("text"), "text"), ["text"], "text").collect()[0][:] == ("t",)
