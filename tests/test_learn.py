import inspect

import numpy as np
import pytest
from pyspark.ml.feature import Tokenizer
from pyspark.sql import functions as F

from heatline.operators import features, learn, metrics, relational
from heatline.functions import text as X
from heatline.plans.catalog import QUERIES


@pytest.fixture(scope="module")
def corpus(spark):
    """Messages whose score depends on one word."""
    rows = [(i, f"word{i % 7} {'nasty' if i % 3 == 0 else 'nice'} thing number{i % 11}",
             0.9 if i % 3 == 0 else 0.1) for i in range(240)]
    df = spark.createDataFrame(rows, "id bigint, text string, toxicity double")
    return learn.training_set(df, df.select("id", "toxicity"), "id", "toxicity").persist()


def test_training_set(spark):
    m = spark.createDataFrame([(1, "A!"), (2, None), (3, "c"), (4, "d")], "id bigint, text string")
    s = spark.createDataFrame([(1, "0.5"), (2, "1"), (3, "junk")], "id bigint, toxicity string")
    got = learn.training_set(m, s, "id", "toxicity").collect()
    assert [tuple(r) for r in got] == [(1, "a", 50.0)]


def test_model_learns_saves_and_scores(spark, corpus, tmp_path):
    train, test = relational.hash_split(corpus, "id")
    model = learn.refit(learn.score_model(features=100, depth=2, rounds=5), train,
                        str(tmp_path / "model"))
    again = learn.load_model(str(tmp_path / "model"))
    result = metrics.evaluate(again.transform(test), []).first()
    assert result.rmse < 15 and result.r > 0.9
    extra = spark.createDataFrame([(1, "NASTY thing!", "en"), (2, None, "fr")],
                                  "id bigint, text string, lang string")
    got = learn.score(extra, again).orderBy("id").collect()
    assert [(r.id, r.text, r.lang) for r in got] == [(1, "NASTY thing!", "en"), (2, None, "fr")]
    assert got[0].prediction > 50 and got[1].prediction is not None
    renamed = learn.score(extra.withColumnRenamed("text", "body"), model, text="body")
    assert renamed.columns == ["id", "body", "lang", "prediction"]


def test_tuning(corpus):
    fitted = learn.tune(corpus, "id", features=(5, 50), depths=(2,), rounds=(2,), folds=2)
    results = learn.grid_results(fitted)
    assert [(f, d, r) for f, d, r, _ in results] == [(5, 2, 2), (50, 2, 2)]
    best = min(results, key=lambda row: row[3])
    assert fitted.bestModel.stages[2].getNumFeatures() == best[0]
    size, error, model = learn.tune_regressor(corpus, "id", features=(50,), depths=(2,),
                                              rounds=(2,), folds=2)
    assert size == 50 and error >= 0 and "prediction" in model.transform(corpus).columns


def test_prefixes_score_the_same_candidates(corpus):
    """One fit per feature size, depth and fold against one per candidate and fold."""
    noisy = corpus.withColumn("label", F.col("label") + F.pmod(F.xxhash64("id"), F.lit(17)))
    grid = {"features": (5, 40), "depths": (1, 3), "rounds": (2, 5), "folds": 2}
    want = {row[:3]: row[3] for row in learn.grid_results(learn.tune(noisy, "id", **grid))}
    got = learn.tune_by_prefix(noisy, "id", **grid)
    assert [row[:3] for row in got] == sorted(want) and len(got) == 8
    assert all(error == pytest.approx(want[row], rel=1e-9) for *row, error in got for row in [tuple(row)])
    model = learn.best_model(noisy, got)
    least = min(got, key=lambda row: row[3])
    assert model.stages[2].getNumFeatures() == least[0] and model.stages[-1].getNumTrees == least[2]


def test_trees_grow_in_few_parts_and_are_the_same(spark, corpus, monkeypatch):
    """The parts that the trees see do not grow with those of the rows; the predictions stay."""
    seen, real = [], learn.GBTRegressor.fit
    monkeypatch.setattr(learn.GBTRegressor, "fit", lambda self, df, *a: seen.append(df.rdd.getNumPartitions()) or real(self, df, *a))
    noisy = corpus.withColumn("label", F.col("label") + F.pmod(F.xxhash64("id"), F.lit(17))).repartition(60, "id")
    model = learn.score_model(features=40, depth=3, rounds=4)
    want = {r.id: r.prediction for r in model.fit(noisy).transform(noisy).collect()}
    got = {r.id: r.prediction for r in learn.fit(model, noisy).transform(noisy).collect()}
    assert got == {k: pytest.approx(v, rel=1e-9) for k, v in want.items()}
    assert seen[-1] == 1
    cores = spark.sparkContext.defaultParallelism
    parts = [learn.gathered(noisy, n).rdd.getNumPartitions() for n in (0, 10_000, 10**6, 10**6 * cores)]
    assert parts == [1, 2, max(cores, 10), min(60, 10 * cores)]


def test_word_vectors(corpus):
    model = learn.score_model(features=20, depth=2, rounds=1, embeddings=4).fit(corpus)
    assert len(model.transform(corpus).first()["features"]) == 24


@pytest.mark.parametrize("kind", ["bayes", "svm"])
def test_classifiers(corpus, kind):
    df = corpus.withColumn("label", (F.col("label") > 50).cast("double"))
    scored = learn.class_model(kind, 100).fit(df).transform(df)
    assert scored.where(F.col("label") == F.col("prediction")).count() > 230


def test_tfidf_equals_the_ml_formula(spark):
    docs = spark.createDataFrame([(1, "a b b"), (2, "a c"), (3, "a")], "id bigint, text string")
    got = {(r.id, r.term): r.tfidf for r in features.tfidf_terms(
        docs, "id", X.tokens(F.col("text"))).collect()}
    import math
    assert got[1, "b"] == pytest.approx(2 * math.log(4 / 2)) and got[2, "a"] == 0
    assert len(got) == 5


def test_tfidf_deals_the_counts_out_once(spark):
    """Keys that repeat or are NULL and NULL terms as in a count by hand; the counts are not sorted for the join."""
    import math
    from collections import Counter
    rows = [(i, f"hot w{i % 5} w{i % 5} once{i}") for i in range(60)]
    rows += [(3, "hot again w1"), (None, "hot lost"), (None, "lost x"), (70, None), (71, "gap hot")]
    docs = spark.createDataFrame(rows, "id bigint, text string")
    words = F.transform(X.tokens(F.col("text")), lambda w: F.when(w != "gap", w))
    tf = Counter((i, None if w == "gap" else w) for i, t in rows if t is not None for w in t.split(" "))
    df = Counter(w for _, w in tf)
    frame = features.tfidf_terms(docs, "id", words, salts=3)
    got = [(r.id, r.term, r.tf, r.df, round(r.tfidf, 9)) for r in frame.collect()]
    want = [(i, w, n, df[w], round(n * math.log((len(rows) + 1) / (df[w] + 1)), 9)) for (i, w), n in tf.items()]
    assert sorted(got, key=str) == sorted(want, key=str)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ReusedExchange" in plan


def test_terms_are_counted_in_parts_of_bounded_size(spark, tmp_path, monkeypatch):
    docs = spark.range(2000).select("id", F.concat_ws(" ", F.sha2(F.col("id").cast("string"), 256), "id").alias("text"))
    docs.write.parquet(path := str(tmp_path / "docs"))
    docs, words = spark.read.parquet(path), X.tokens(F.col("text"))
    monkeypatch.setattr(features, "PART_BYTES", 4096, raising=False)
    size = sum(f.stat().st_size for f in (tmp_path / "docs").glob("*.parquet"))
    parts = features.term_counts(docs, "id", words).rdd.getNumPartitions()
    assert size // 4096 > spark.sparkContext.defaultParallelism and size // 4096 <= parts <= size // 4096 + 2
    assert features.term_counts(docs, "id", words).count() == 4000


def test_stem_tables(spark):
    docs = spark.createDataFrame([(1, "running runs of"), (2, "runs")], "id bigint, text string")
    words = X.tokens(F.col("text"))
    got = {r.token: (r.occurrences, r.stem)
           for r in features.stemmed_vocabulary(docs, words).collect()}
    assert got == {"running": (1, "run"), "runs": (2, "run")}
    assert features.stemmed_tokens(docs, "id", words).orderBy("id").first().stems == ["run", "run"]


def test_only_labelled_texts_are_cleaned(spark):
    messages = spark.createDataFrame([(1, "A, b!"), (2, None), (3, "no label")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, "0.5"), (2, "1"), (4, "1"), (1, "bad")], "doc_id bigint, score string")
    got = learn.training_set(messages, labels, "doc_id", "score")
    assert [tuple(r) for r in got.collect()] == [(1, "a b", 50.0)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1


@pytest.mark.parametrize("name, maker", [(n, "score_model") for n in ("score_messages", "retrained_scores", "holdout_scores",
                                                                      "stream_scores")]
                         + [("classified_messages", "class_model"), ("svm_messages", "class_model")])
def test_registered_queries_learn_at_full_size(spark, tables, monkeypatch, name, maker):
    class Stop(Exception):
        pass

    real, sizes = getattr(learn, maker), {"features", "depth", "depths", "rounds", "folds", "embeddings"}

    def asked(*args, **named):
        bound = inspect.signature(real).bind(*args, **named)
        assert not sizes & set(bound.arguments)
        raise Stop

    monkeypatch.setattr(learn, maker, asked)
    with pytest.raises(Stop):
        QUERIES[name](spark, tables)


def test_word_vectors_are_trained_in_several_parts(spark):
    """Two words that stand in the same company are near each other; rare words have no vector."""
    rng = np.random.default_rng(4)
    lines = []
    for i in range(3000):
        topic, own = [("sun", [f"s{k}" for k in range(6)]), ("rain", [f"r{k}" for k in range(6)])][i % 2]
        word = f"{topic}{'y' if rng.random() < 0.5 else 'ish'}"
        lines.append((i, " ".join([*rng.choice(own, 3), word, *rng.choice(own, 3)])))
    lines.append((9999, "onlyonce s1 s2"))
    df = spark.createDataFrame(lines, "id bigint, text string")
    tokens = Tokenizer(inputCol="text", outputCol="words").transform(df)
    model = learn.vector_model(8, 4, least=5)
    assert (model.getNumPartitions(), model.getMinCount()) == (4, 5)
    vectors = {r.word: np.array(r.vector) for r in model.fit(tokens).getVectors().collect()}
    near = lambda a, b: vectors[a] @ vectors[b] / np.linalg.norm(vectors[a]) / np.linalg.norm(vectors[b])
    assert "onlyonce" not in vectors
    assert near("suny", "sunish") > near("suny", "rainish") and near("rainy", "rainish") > near("rainy", "sunish")
    assert learn.word_vectors(df, 4).select("vectors").first()[0].size == 4


def test_the_grid_is_the_stored_one():
    bound = inspect.signature(learn.tune_by_prefix).parameters
    sizes = [len(bound[name].default) for name in ("features", "depths", "rounds")]
    assert sizes == [3, 4, 4] and bound["folds"].default == 5
