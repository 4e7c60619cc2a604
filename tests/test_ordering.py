from pyspark.sql import Window
from pyspark.sql import functions as F

from clipforge.operators.ordering import positions


def test_positions_match_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") % 7).alias("g"), (F.col("id") * 7919 % 5000).alias("o"))
    for parts in (1, 3, 16):
        got = positions(df, ["o"], ["g"], num_partitions=parts)
        want = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy("o")))
        assert got.exceptAll(want.select(*got.columns)).count() == 0
    glob = positions(df, ["o", "g"], num_partitions=5).agg(F.min("pos"), F.max("pos"), F.countDistinct("pos")).first()
    assert tuple(glob) == (1, 5000, 5000)


def test_null_groups_are_numbered(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), (None, 1), ("a", 2)], "g string, o int")
    got = sorted(map(tuple, positions(df, ["o"], ["g"]).collect()), key=str)
    assert got == sorted([("a", 1, 1), ("a", 2, 2), (None, 1, 1), (None, 2, 2)], key=str)
