"""Server collations by Spark's collated strings."""

from pyspark.sql import functions as F

from ferry.functions.collation import (collated, count_collated, distinct_collated, in_list, join_collated, plain, spark_collation,
                                       with_collation)

NAMES = ["Émile", "émile ", "Emile", "EMILE", "emile  ", "Zoë", "zoe", "ZOË", None, "", "  "]


def frame(spark):
    return spark.createDataFrame([(i, n) for i, n in enumerate(NAMES)], "id int, name string")


def test_names_of_collations():
    assert spark_collation("SQL_Latin1_General_CP1_CI_AS") == "UNICODE_CI_RTRIM"
    assert spark_collation("Latin1_General_CI_AI") == "UNICODE_CI_AI_RTRIM"
    assert spark_collation("Latin1_General_CS_AS") == "UNICODE_RTRIM"
    assert spark_collation("Latin1_General_100_BIN2") == "UTF8_BINARY_RTRIM"


def test_distinct_and_groups(spark):
    df = frame(spark)
    got = sorted((r.name for r in distinct_collated(df, ["name"]).collect()), key=str)
    assert got == sorted(["", "EMILE", None, "ZOË", "zoe", "Émile"], key=str)
    got = {r.name: r.n for r in count_collated(df, "name", "Latin1_General_CI_AI").collect()}
    assert got == {"EMILE": 5, "ZOË": 3, None: 1, "": 2}
    got = {r.name: r.n for r in count_collated(df, "name", "Latin1_General_BIN2").collect()}
    assert got["Emile"] == 1 and got[""] == 2 and len(got) == 10


def test_joins_of_all_kinds(spark):
    df = frame(spark)
    right = spark.createDataFrame([("ÉMILE", 1), ("zoë   ", 2), ("nobody", 3)], "key string, n int")
    got = sorted((r.id, r.n) for r in join_collated(df, right, [("name", "key")]).collect())
    assert got == [(0, 1), (1, 1), (5, 2), (7, 2)]
    got = sorted((r.id, r.n) for r in join_collated(df, right, [("name", "key")], server="X_CI_AI").collect())
    assert got == [(0, 1), (1, 1), (2, 1), (3, 1), (4, 1), (5, 2), (6, 2), (7, 2)]
    assert sorted(r.id for r in join_collated(df, right, [("name", "key")], "left_anti", "X_CI_AI").collect()) == [8, 9, 10]
    plan = join_collated(df, right, [("name", "key")])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_lists_sorting_and_back(spark):
    df = frame(spark)
    assert sorted(r.id for r in df.where(in_list("name", ["ÉMILE", "ZOE "])).collect()) == [0, 1, 6]
    assert [r.id for r in with_collation(df.where("id in (0, 2, 5)"), ["name"], "X_CI_AI").orderBy("name", "id").collect()] == [0, 2, 5]
    back = plain(with_collation(df, ["name"]))
    assert back.schema["name"].dataType.simpleString() == "string" and back.where(F.col("name") == "émile").count() == 0
    assert df.where(collated("name") == F.lit("émile")).count() == 2
