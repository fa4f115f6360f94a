from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.operators.numbering import number_once, seq_number


def test_seq_number_equals_row_number(spark):
    rows = [("hot", i) for i in range(0, 3000, 3)] + [(f"k{i % 7}", i) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, x long")
    got = seq_number(df, ["k"], "x", name="n", width=37)
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("x")))
    assert sorted(got.collect()) == sorted(want.collect())


def _both(df):
    got = number_once(df, ["k"], "x", name="n")
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("x")))
    assert got.columns == want.columns
    return sorted(map(repr, got.collect())), sorted(map(repr, want.collect()))


def test_number_once_with_positions_far_apart(spark):
    rows = [("hot", i << 40, "x") for i in range(2000)] + [(f"k{i % 7}", -i, None) for i in range(300)]
    rows += [(None, 5, "a"), (None, None, "b"), ("hot", -1, "c")]
    got, want = _both(spark.createDataFrame(rows, "k string, x long, v string").repartition(5))
    assert got == want


def test_number_once_of_nothing(spark):
    assert number_once(spark.createDataFrame([], "k string, x long"), ["k"], "x").collect() == []


def test_number_once_evaluates_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def watched(x):
        seen.add(1)
        return x

    df = spark.range(500).select(F.lit("a").alias("k"), watched("id").alias("x"))
    assert number_once(df, ["k"], "x", name="n").agg(F.max("n")).collect()[0][0] == 500
    assert seen.value == 500
