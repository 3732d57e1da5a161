import pytest
from pyspark.sql import functions as F

from heatline.operators import relational, search


def test_salted_join_keeps_every_row_of_a_hot_key(spark):
    rows = spark.range(2000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("key"))
    lookup = rows.groupBy("key").agg(F.count("*").alias("n"))
    got = relational.salted_join(rows, lookup, "key", "id")
    assert got.columns == ["id", "key", "n"] and got.count() == 2000
    assert got.where("key = 'hot'").agg(F.max("n"), F.count("*")).first() == (667, 667)
    assert got.where("key is null").count() == 1
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_earliest_copies(spark):
    df = spark.createDataFrame(
        [(3, "a", "x"), (1, "a", "x"), (2, "a", None), (4, None, "x"), (5, "ax", ""), (6, "a", "x"),
         (7, None, "x")], "id bigint, text string, lang string")
    got = relational.earliest_copies(df, ["text", "lang"], "id")
    assert sorted(r.id for r in got.collect()) == [1, 2, 4, 5]


def test_append_aligns_by_name(spark):
    a = spark.createDataFrame([("t", 1)], "text string, n int")
    b = spark.createDataFrame([(2, "u", "en")], "n int, text string, lang string")
    got = relational.append_by_name(a, b, a)
    assert got.columns == ["text", "n", "lang"]
    assert sorted(tuple(r) for r in got.collect()) == [("t", 1, None), ("t", 1, None), ("u", 2, "en")]


def test_splits(spark):
    df = spark.range(4000).withColumnRenamed("id", "key")
    train, test = relational.hash_split(df, "key")
    assert train.count() + test.count() == 4000 and train.join(test, "key").count() == 0
    assert abs(train.count() / 4000 - 0.75) < 0.03
    again, _ = relational.hash_split(df.repartition(7), "key")
    assert again.exceptAll(train).count() == 0
    a, b = relational.random_split(df)
    assert a.count() + b.count() == 4000


def test_shuffled_is_a_repeatable_permutation(spark):
    df = spark.range(100).withColumnRenamed("id", "key")
    one = [r.key for r in relational.shuffled(df, "key").collect()]
    two = [r.key for r in relational.shuffled(df.repartition(5), "key").collect()]
    assert one == two != list(range(100)) and sorted(one) == list(range(100))


def test_projections(spark):
    df = spark.createDataFrame([(1, 20.0, "a"), (2, 20.1, None), (3, 50.0, "c")],
                               "i int, p double, s string")
    assert relational.drop_position(df, 0).columns == ["p", "s"]
    assert relational.rename(df, {"p": "prediction"}).columns == ["i", "prediction", "s"]
    with pytest.raises(ValueError):
        relational.rename(df, {"nope": "x"})
    assert [r.i for r in relational.known(df, "s").collect()] == [1, 3]
    assert [r.i for r in df.where(relational.between_open(F.col("p"), 20, 50)).collect()] == [2]
    assert relational.surrogate_id(df).select("id").distinct().count() == 3
    assert [r.i for r in relational.first_rows(df, "i", 2).collect()] == [1, 2]


@pytest.fixture(scope="module")
def messages(spark):
    rows = [(i, "en" if i % 2 else "fr", "The Cat sat" if i % 3 else "dog and cat", )
            for i in range(600)]
    return spark.createDataFrame(rows, "id bigint, lang string, text string").withColumn(
        "timestamp", (F.lit("2019-03-01").cast("timestamp")
                      + F.make_interval(hours=F.col("id").cast("int"))).cast("timestamp_ntz"))


def test_topic_search_returns_the_newest(messages):
    got = search.topic_search(messages, "CAT", "id").collect()
    assert [r.id for r in sorted(got, key=lambda r: r["rank"])] == list(range(599, 399, -2))
    assert search.topic_search(messages, "cat", "id", cap=None).count() == 300
    assert search.topic_search(messages, "bird", "id").count() == 0


def test_topic_search_window_is_half_open(messages):
    got = search.topic_search(messages, "cat", "id", since="2019-03-01 01:00:00",
                              until="2019-03-01 05:00:00", cap=None)
    assert sorted(r.id for r in got.collect()) == [1, 3]


def test_topic_sweep_caps_each_topic(messages):
    got = search.topic_sweep(messages, ["cat", "Dog", "bird"], "id", cap=20)
    assert got.groupBy("topic").count().collect() and {
        (r.topic, r["count"]) for r in got.groupBy("topic").count().collect()} == {
        ("cat", 20), ("Dog", 20)}
    everything = search.topic_matches(messages, ["cat", "dog"])
    assert everything.count() == 600 + 200
    with pytest.raises(ValueError):
        search.topic_matches(messages, [str(i) for i in range(10_001)])


def test_many_topics_give_the_rows_of_few(spark, monkeypatch):
    rows = [(1, "The Cat sat, catalogue", {"a": 1}), (2, None, {}), (3, "", {}), (4, "ÉTÉ ΑΣ İ cat\n", {}), (5, "dog", None)]
    df = spark.createDataFrame(rows, "id bigint, text string, extra map<string,int>")
    topics = ["cat", "Cat", "cata", "été", "ας", "i", "", "at, c", "no such topic", "dog", "o"] + [f"zz{k}" for k in range(80)]
    got = sorted((r.id, r.topic, str(r.extra)) for r in search.topic_matches(df, topics).collect())
    monkeypatch.setattr(search, "FEW_TOPICS", 1000)
    assert got == sorted((r.id, r.topic, str(r.extra)) for r in search.topic_matches(df, topics).collect()) and len(got) > 15


def test_the_cap_is_applied_before_the_shuffle(messages):
    plan = search.topic_sweep(messages, ["cat"], "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Partial") > plan.index("Exchange") and "WindowGroupLimit" in plan


def test_label_join(spark):
    m = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, text string")
    labels = spark.createDataFrame([(2, 0.5)], "id bigint, toxicity double")
    assert [r.id for r in relational.label_join(m, labels, "id").collect()] == [2]
    assert relational.label_join(m, labels, "id", "left").count() == 2
    assert [r.id for r in relational.label_join(m, labels, "id", "left_anti").collect()] == [1]
