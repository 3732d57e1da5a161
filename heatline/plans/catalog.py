"""The queries, by name. Each takes (spark, folder of Parquet tables) and returns a DataFrame.

Stand-ins: `events` are scored messages (event_type the topic, value the score), `documents` are
messages, `labels` their stored scores, `orders` a daily price-like series per priority.
"""

from functools import wraps

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from heatline.constants import HASH_FEATURES, SCORE_SCALE, SYNTHETIC_AXIS_START, TREE_DEPTH
from heatline.functions import text as X
from heatline.functions import values as V
from heatline.operators import (
    anomaly, autoreg, buckets, features, garch, kalman, learn, metrics, orders, oversample, relational, search)
from heatline.operators.slices import lagged, row_index
from heatline.schemas import table
from heatline.session import folder_names, fresh_folder, settle, ship, spread
from heatline.sources import files, messages, tables
from heatline.streaming import flow, live, stateful

# What the registered searches look for.
TOPICS = (
    "the", "and", "that", "with", "this", "for", "are", "was", "of the", "in the", "to the",
    "worthless", "pathetic", "tion", "ther", "ble", "thon", "thre", "thth", "des", "than", "thes",
    "re of",
)
SEARCHED = "worthless"
SEARCH_SINCE, SEARCH_UNTIL = "2018-04-14 00:00:00", "2018-05-20 00:00:00"
PRICE_KEYS = ("1-URGENT", "5-LOW")
PRICE_SINCE, PRICE_UNTIL = "1996-12-31 00:00:00", "1997-12-31 00:00:00"
BATCH_EDGE = "2024-01-15 00:00:00"
GARCH_ALPHA, GARCH_BETA = 0.1, 0.8
GARCH_POINTS = garch.lattice()
WEEK_LAG = 168
KALMAN_STEPS, VELOCITY_STEPS, GARCH_STEPS, AR_STEPS, MAX_LAG = 50, 500, 25, 100, 24

QUERIES = {}


def query(function):
    @wraps(function)
    def run(spark, folder):
        return function(ship(spark), folder)
    QUERIES[function.__name__] = run
    return run


# -- shared inputs -------------------------------------------------------------------------------

def scored(spark, folder):
    """(event_id, timestamp, series, prediction)."""
    return table(spark, folder, "events").select(
        "event_id", F.col("ts").alias("timestamp"), F.col("event_type").alias("series"),
        F.col("value").alias("prediction"))


def sums(spark, folder, seconds):
    return buckets.bucket_sums(scored(spark, folder), "timestamp", "prediction", seconds)


def hours(spark, folder, fill="forward"):
    """(series, idx, step, y) per hour. The raw table is read once, all else works on its sums."""
    dense = buckets.dense_series(settle(sums(spark, folder, buckets.HOUR)), fill)
    return dense.withColumn("y", F.round("y", 9))


def means(partial, seconds):
    """Means to nine digits: what is left does not depend on the order of addition."""
    return buckets.bucket_means(partial, seconds).withColumn("prediction", F.round("prediction", 9))


def daily(spark, folder):
    """(series, idx, step, y): order value per day with orders, numbered per priority."""
    value = table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("series"), "o_orderdate", "o_totalprice")
    totals = settle(buckets.bucket_sums(value, "o_orderdate", "o_totalprice", buckets.DAY))
    days = totals.select("series", "step", F.round("total", 4).alias("y"))
    return row_index(days, ["series"], "step")


def daily_residuals(spark, folder):
    return garch.residuals(garch.log_returns(daily(spark, folder)))


def documents(spark, folder):
    return spread(table(spark, folder, "documents"), "doc_id")


def words(cleaned=True):
    raw = F.col("text")
    return X.without_stop_words(X.tokens(X.clean_text(raw) if cleaned else raw))


def joined(column):
    return F.array_join(column, "|")


def at(seconds, name):
    return V.step_start(F.col("step"), seconds).alias(name)


# -- means per minute and hour -------------------------------------------------------------------

@query
def minute_mean(spark, folder):
    return means(sums(spark, folder, buckets.MINUTE), buckets.MINUTE).orderBy("timestamp", "series")


@query
def hour_mean(spark, folder):
    return means(sums(spark, folder, buckets.HOUR), buckets.HOUR).orderBy("timestamp", "series")


@query
def hour_from_minute(spark, folder):
    by_hour = buckets.coarser(sums(spark, folder, buckets.MINUTE), 60)
    return means(by_hour, buckets.HOUR)


@query
def null_safe_mean(spark, folder):
    """Times and values arrive as text, some of it unreadable."""
    df = scored(spark, folder).select(
        "series",
        F.when(F.col("prediction") > 200, "no time")
        .otherwise(V.format_timestamp(F.col("timestamp"))).alias("timestamp"),
        F.when(F.col("prediction") < 2, "n/a")
        .otherwise(F.col("prediction").cast("string")).alias("prediction"))
    df = df.select("series", V.parse_timestamp(F.col("timestamp")).alias("timestamp"),
                   V.number(F.col("prediction")).alias("prediction"))
    df = relational.known(df, "timestamp", "prediction")
    return means(
        buckets.bucket_sums(df, "timestamp", "prediction", buckets.HOUR), buckets.HOUR)


@query
def anomalies(spark, folder):
    """Minute means with outlier flags: the time series output."""
    return tagged_minutes(spark, folder, anomaly.RESOLUTION)


@query
def anomalies_every_radius(spark, folder):
    """The same on finer bins."""
    return tagged_minutes(spark, folder, 0.25)


FINEST = 0.01


def tagged_minutes(spark, folder, resolution):
    minutes = settle(means(sums(spark, folder, buckets.MINUTE), buckets.MINUTE))
    return (anomaly.tag_anomalies(minutes, resolution=resolution)
            .select("series", F.col("timestamp").alias("times"), "prediction", "isAnomaly"))


@query
def anomalous_lengths(spark, folder):
    """Documents of unusual length for their language, in steps of 50 characters."""
    docs = documents(spark, folder).select(
        "doc_id", F.col("lang").alias("series"), F.col("n_chars").cast("double").alias("prediction"))
    return (anomaly.tag_anomalies(docs, resolution=50)
            .select("doc_id", "series", "prediction", "isAnomaly"))


@query
def sharp_rises(spark, folder):
    rises = anomaly.sharp_rises(hours(spark, folder))
    return rises.select("series", at(buckets.HOUR, "hour"), "y",
                        F.round("trailing_mean", 12).alias("trailing_mean"),
                        F.round("trailing_std", 6).alias("trailing_std"), "rise")


# -- projections and predicates ------------------------------------------------------------------

@query
def range_filter(spark, folder):
    return (scored(spark, folder).select("event_id", "prediction")
            .where(relational.between_open(F.col("prediction"), 20, 50)))


@query
def scaled_score(spark, folder):
    return table(spark, folder, "labels").select(
        "doc_id", (F.col("toxic") * SCORE_SCALE).alias("toxicity"))


@query
def project_rename(spark, folder):
    df = relational.drop_position(table(spark, folder, "events"), 2).drop("props")
    df = relational.rename(df, {"ts": "times", "value": "prediction", "event_type": "topic"})
    return df.withColumn("collected", V.plain_timestamp(F.lit("2018-04-13 10:31:30").cast("timestamp")))


@query
def strict_parse(spark, folder):
    """Text to timestamp and number, raising on anything unreadable."""
    df = scored(spark, folder)
    return df.select(
        "event_id",
        V.plain_timestamp(V.parse_timestamp_strict(F.col("timestamp").cast("string"))).alias("times"),
        V.number_strict(F.col("prediction").cast("string")).alias("prediction"))


@query
def math_functions(spark, folder):
    p = F.col("prediction")
    return scored(spark, folder).select(
        "event_id", F.round(F.log(p + 1), 6).alias("ln"), F.round(F.sqrt(p), 6).alias("root"),
        F.abs(p - 50).alias("gap"), F.round(F.sin(p), 6).alias("sine"),
        F.round(F.pow(p, 2), 6).alias("square"))


# -- text ----------------------------------------------------------------------------------------

@query
def clean_text(spark, folder):
    return documents(spark, folder).select("doc_id", X.clean_text(F.col("text")).alias("text"))


@query
def normalise_text(spark, folder):
    return documents(spark, folder).select("doc_id", X.normalise_text(F.col("text")).alias("text"))


@query
def tokens(spark, folder):
    listed = X.tokens(F.col("text"))
    return documents(spark, folder).select(
        "doc_id", F.size(listed).cast("bigint").alias("n"), joined(listed).alias("words"))


@query
def tokens_no_stop(spark, folder):
    return documents(spark, folder).select("doc_id", joined(words()).alias("words"))


@query
def tfidf_terms(spark, folder):
    return (features.tfidf_terms(documents(spark, folder), "doc_id", words())
            .withColumn("tfidf", F.round("tfidf", 6)))


@query
def hashed_counts(spark, folder):
    """Tokens per document, as the sum of the hashed term counts."""
    cleaned = documents(spark, folder).select("doc_id", X.clean_text(F.col("text")).alias("text"))
    total = F.aggregate(vector_to_array("tf"), F.lit(0.0), lambda a, b: a + b)
    return learn.hashed_terms(cleaned).select("doc_id", total.alias("total"))


@query
def word_vectors(spark, folder):
    """Averaged word vectors of the labelled messages."""
    return learn.word_vectors(labelled(spark, folder), 8).select(
        "doc_id", vector_to_array("vectors").alias("vector"))


@query
def stem_vocabulary(spark, folder):
    return features.stemmed_vocabulary(documents(spark, folder), words())


@query
def stemmed_documents(spark, folder):
    stems = features.stemmed_tokens(documents(spark, folder), "doc_id", words())
    return stems.select("doc_id", F.size("stems").alias("n"), joined(F.col("stems")).alias("stems"))


# -- search, labels, sets ------------------------------------------------------------------------

def time_axis(spark, folder):
    """(doc_id, idx, timestamp), made from the ids alone so that no text moves."""
    return buckets.synthetic_axis(table(spark, folder, "documents").select("doc_id"), "doc_id")


def timed_documents(spark, folder):
    """Documents with a time: an hour per id, without ranking the ids."""
    begin = F.unix_seconds(F.lit(SYNTHETIC_AXIS_START).cast("timestamp"))
    when = F.timestamp_seconds(begin + (F.col("doc_id") + 1) * buckets.HOUR)
    return documents(spark, folder).withColumn("timestamp", V.plain_timestamp(when))


@query
def synthetic_axis(spark, folder):
    return time_axis(spark, folder)


@query
def topic_search(spark, folder):
    found = search.topic_search(timed_documents(spark, folder), SEARCHED, "doc_id")
    return found.select("topic", "doc_id", "timestamp", "text")


@query
def topic_search_window(spark, folder):
    found = search.topic_search(timed_documents(spark, folder), SEARCHED, "doc_id",
                                since=SEARCH_SINCE, until=SEARCH_UNTIL)
    return found.select("topic", "doc_id", "timestamp", "text")


@query
def topic_sweep(spark, folder):
    found = search.topic_sweep(documents(spark, folder), TOPICS, "doc_id")
    return found.select("topic", F.col("rank").cast("bigint").alias("rank"), "doc_id")


@query
def topic_counts(spark, folder):
    """How many messages mention each topic, and how many of them are labelled toxic."""
    found = search.topic_matches(documents(spark, folder), TOPICS).select("topic", "doc_id")
    labels = table(spark, folder, "labels")
    return (relational.label_join(found, labels, "doc_id", "left").groupBy("topic")
            .agg(F.count("*").alias("n"), F.count("toxic").alias("labelled"),
                 F.coalesce(F.sum("toxic"), F.lit(0)).cast("bigint").alias("toxic")))


@query
def labelled_messages(spark, folder):
    return relational.label_join(documents(spark, folder).select("doc_id", "text"),
                                 table(spark, folder, "labels"), "doc_id")


@query
def unlabelled_messages(spark, folder):
    return relational.label_join(documents(spark, folder).select("doc_id", "text"),
                                 table(spark, folder, "labels"), "doc_id", "left_anti")


@query
def training_rows(spark, folder):
    return learn.training_set(documents(spark, folder), table(spark, folder, "labels"), "doc_id",
                              "toxic")


@query
def union_by_name(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text", "lang")
    turns = table(spark, folder, "conversations").select("text", "role", "conv_id")
    return relational.append_by_name(docs, turns)


@query
def dedup_messages(spark, folder):
    docs = documents(spark, folder)
    return relational.earliest_copies(docs, ["text"], "doc_id").select("doc_id", "text")


@query
def dedup_turns(spark, folder):
    """Turns fetched twice: all of them appended to themselves, then one copy each."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return relational.append_by_name(turns, turns).dropDuplicates(["conv_id", "turn"])


@query
def series_pushdown(spark, folder):
    return tables.read_series(table(spark, folder, "orders"), "o_orderpriority", PRICE_KEYS,
                              "o_orderdate", PRICE_SINCE, PRICE_UNTIL,
                              ["o_orderpriority", "o_orderdate", "o_totalprice"])


@query
def first_rows(spark, folder):
    return relational.first_rows(documents(spark, folder).select("doc_id", "text"), "doc_id", 250)


@query
def shuffled_documents(spark, folder):
    return relational.shuffled(documents(spark, folder).select("doc_id", "text"), "doc_id")


@query
def hash_split(spark, folder):
    train, test = relational.hash_split(documents(spark, folder).select("doc_id"), "doc_id")
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test")))


@query
def random_parts(spark, folder):
    train, test = relational.random_split(documents(spark, folder).select("doc_id"))
    return train.unionAll(test)


@query
def surrogate_ids(spark, folder):
    ids = relational.surrogate_id(scored(spark, folder))
    return ids.agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"))


# -- JSON ----------------------------------------------------------------------------------------

def event_messages(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", F.col("ts").alias("timestamp"), F.col("props").alias("text"))


@query
def json_encode(spark, folder):
    df = timed_documents(spark, folder)
    return df.select("doc_id", V.encode_message(
        V.format_timestamp(F.col("timestamp")), F.col("text")).alias("value"))


@query
def json_decode(spark, folder):
    df = event_messages(spark, folder)
    value = V.encode_message(V.format_timestamp(F.col("timestamp")), F.col("text"))
    parsed = df.select("event_id", V.decode_message(value).alias("m"))
    return parsed.select("event_id", V.plain_timestamp(V.parse_timestamp(F.col("m.timestamp")))
                         .alias("timestamp"), F.col("m.text").alias("text"))


@query
def json_extract(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", V.score_of(F.col("props"), "$.k").alias("k"))


# -- series positions ----------------------------------------------------------------------------

@query
def row_positions(spark, folder):
    """Gapless position of every event, overall and within its topic."""
    df = scored(spark, folder).select("event_id", "series")
    df = row_index(df, ["series"], "event_id", levels=2, name="in_series")
    return row_index(df, [], "event_id", levels=2, name="overall")


@query
def dense_hours(spark, folder):
    return hours(spark, folder).select("series", "idx", at(buckets.HOUR, "hour"), "y")


@query
def holdout_split(spark, folder):
    parts = buckets.holdout(hours(spark, folder, "none"))
    return parts.select("series", "idx", "y", "part", "h")


@query
def forecast_axis(spark, folder):
    ends = buckets.series_ends(hours(spark, folder, "none"))
    return buckets.forecast_axis(ends)


@query
def last_values(spark, folder):
    last = V.step_start(F.col("last_step"), buckets.HOUR).alias("last_hour")
    return (buckets.series_ends(hours(spark, folder, "none"))
            .select("series", "n", "horizon", last, "last_y"))


@query
def log_returns(spark, folder):
    return garch.log_returns(daily(spark, folder)).withColumn("r", F.round("r", 6))


@query
def differences(spark, folder):
    wide = lagged(hours(spark, folder), ["series"], "idx", {"_1": ("y", 1), "_12": ("y", 12)})
    return wide.select("series", "idx", autoreg.differenced("y", "_1").alias("by_1"),
                       autoreg.differenced("y", "_12").alias("by_12"))


@query
def aligned_pairs(spark, folder):
    """Two per-hour tables side by side, by position."""
    rows = hours(spark, folder)
    later = rows.select("series", (F.col("idx") - 24).alias("idx"), F.col("y").alias("next_day"))
    return relational.align(rows.select("series", "idx", "y"), later, ["series", "idx"])


# -- scores --------------------------------------------------------------------------------------

def persistence(spark, folder):
    """(series, idx, label, prediction): each hour predicted by the hour before."""
    rows = hours(spark, folder)
    return (lagged(rows, ["series"], "idx", {"prediction": ("y", 1)})
            .where(F.col("prediction").isNotNull())
            .select("series", "idx", F.col("y").alias("label"), "prediction"))


def rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


@query
def regression_metrics(spark, folder):
    return rounded(metrics.evaluate(persistence(spark, folder), ["series"]).drop("p"),
                   "mean_label", "rmse", "mse", "r", "t")


@query
def significance(spark, folder):
    """Two-sided p of the correlation of each hour with the one before."""
    got = metrics.evaluate(persistence(spark, folder), ["series"])
    return rounded(got, "r", "p").select("series", "n", "r", "p")


@query
def band_fit(spark, folder):
    return rounded(metrics.evaluate_band(persistence(spark, folder), ["series"]),
                   "slope", "intercept", "r")


@query
def percentage_error(spark, folder):
    y, p = F.col("label"), F.col("prediction")
    return persistence(spark, folder).groupBy("series").agg(
        metrics.mape(y, p).alias("mape"), metrics.zero_actuals(y).alias("zero_actuals"),
        F.round(metrics.abs_corr(y, p), 6).alias("corr"))


@query
def overall_mean(spark, folder):
    return table(spark, folder, "labels").agg(
        F.count("*").alias("n"), F.avg(F.col("toxic") * SCORE_SCALE).alias("mean_score"))


@query
def lag_correlation(spark, folder):
    return rounded(metrics.lag_corr(hours(spark, folder)), "r")


@query
def autocorrelation(spark, folder):
    return rounded(metrics.acf(hours(spark, folder), MAX_LAG).withColumn(
        "lag", F.col("lag").cast("bigint")), "r")


@query
def autocorrelation_week(spark, folder):
    """Every lag of a week of hours."""
    return rounded(metrics.acf(hours(spark, folder), WEEK_LAG).withColumn(
        "lag", F.col("lag").cast("bigint")), "r")


@query
def autocorrelation_all(spark, folder):
    """Every lag that a series has."""
    # Adding zero makes one zero of the two that a double has.
    return metrics.acf_all(hours(spark, folder)).withColumn("r", F.round("r", 6) + F.lit(0.0))


# -- autoregressive models -----------------------------------------------------------------------

@query
def seasonal_gram(spark, folder):
    g = autoreg.seasonal_gram(hours(spark, folder))
    return rounded(g, *[c for c in g.columns if c.startswith("g_")])


@query
def sarima_fit(spark, folder):
    fit = autoreg.seasonal_fit(hours(spark, folder)).drop("change")
    return rounded(fit, "phi", "seasonal_phi", "css", "aic")


@query
def sarima_forecast(spark, folder):
    return rounded(autoreg.seasonal_forecast(hours(spark, folder)), "forecast")


@query
def sarima_forecast_sparse(spark, folder):
    """The hours that have data, treated as equally spaced."""
    return rounded(autoreg.seasonal_forecast(hours(spark, folder, "none")), "forecast")


@query
def sarima_holdout(spark, folder):
    scores = autoreg.score_holdout(
        hours(spark, folder), lambda train, share: autoreg.seasonal_forecast(train, share=share))
    return rounded(scores, "corr")


@query
def ar1_fit(spark, folder):
    fit = autoreg.ar_fit(hours(spark, folder), 1, d=0)
    return fit.select("series", "equations", F.round("const", 6).alias("const"),
                      F.round(F.get("phi", F.lit(0)), 6).alias("phi"),
                      F.round("css", 4).alias("css"), F.round("aic", 6).alias("aic"))


@query
def ar10_forecast(spark, folder):
    return rounded(autoreg.ar_forecast(hours(spark, folder), 10, AR_STEPS), "forecast")


@query
def walk_forward_ar1(spark, folder):
    return rounded(autoreg.walk_forward(hours(spark, folder), 1, d=1), "y", "forecast")


@query
def walk_forward_ar5(spark, folder):
    return rounded(autoreg.walk_forward(hours(spark, folder), 5, d=1), "y", "forecast")


@query
def walk_forward_error(spark, folder):
    steps = autoreg.walk_forward(hours(spark, folder), 5, d=1)
    errors = steps.groupBy("series").agg(
        F.count("*").alias("n"), metrics.mse(F.col("y"), F.col("forecast")).alias("mse"))
    return rounded(errors, "mse")


@query
def best_lag(spark, folder):
    fits = autoreg.lag_candidates(hours(spark, folder), MAX_LAG)
    return rounded(metrics.best_positive(fits, ["series"]), "slope", "aic")


@query
def order_search(spark, folder):
    return orders.order_search(hours(spark, folder))


@query
def order_search_ar(spark, folder):
    """The candidates without moving-average terms."""
    found = orders.order_search(hours(spark, folder)).where("q = 0 and sq = 0").drop("q", "sq", "theta", "seasonal_theta", "change")
    return rounded(found, "phi", "seasonal_phi", "aic")


@query
def order_search_ma(spark, folder):
    """The candidates with moving-average terms whose coefficients no longer move."""
    found = orders.order_search(hours(spark, folder)).where("q + sq > 0 and change < 1e-9").drop("status", "change")
    digits = {"phi": 5, "seasonal_phi": 5, "theta": 5, "seasonal_theta": 5, "aic": 4}
    return found.withColumns({c: F.round(c, k) for c, k in digits.items()})


@query
def best_order(spark, folder):
    return orders.best_order(hours(spark, folder))


# -- state space and volatility ------------------------------------------------------------------

@query
def kalman_velocity(spark, folder):
    out = kalman.kalman_filter(hours(spark, folder), kalman.velocity_model())
    return rounded(out.drop("state"), "y", "predicted")


@query
def kalman_velocity_forecast(spark, folder):
    model = kalman.velocity_model()
    states = kalman.final_states(kalman.kalman_filter(hours(spark, folder), model))
    return rounded(kalman.kalman_forecast(states, model, VELOCITY_STEPS), "forecast")


@query
def kalman_acceleration(spark, folder):
    out = kalman.kalman_filter(hours(spark, folder), kalman.acceleration_model())
    return rounded(out.drop("state"), "y", "predicted")


@query
def kalman_acceleration_forecast(spark, folder):
    model = kalman.acceleration_model()
    states = kalman.final_states(kalman.kalman_filter(hours(spark, folder), model))
    return rounded(kalman.kalman_forecast(states, model, KALMAN_STEPS), "forecast")


@query
def garch_path(spark, folder):
    path = garch.garch_path(daily_residuals(spark, folder), GARCH_ALPHA, GARCH_BETA)
    return rounded(path, "e", "variance")


@query
def garch_fit(spark, folder):
    fits = garch.garch_fit(daily_residuals(spark, folder), GARCH_POINTS)
    return rounded(fits, "alpha", "beta", "s2", "next_variance")


@query
def garch_forecast(spark, folder):
    fits = garch.garch_fit(daily_residuals(spark, folder), GARCH_POINTS)
    return rounded(garch.garch_forecast(fits, GARCH_STEPS), "variance")


# -- learning ------------------------------------------------------------------------------------

def labelled(spark, folder):
    return settle(learn.training_set(documents(spark, folder), table(spark, folder, "labels"),
                                     "doc_id", "toxic"))


@query
def score_messages(spark, folder):
    """Train on three quarters of the labelled messages, save, load, score all messages."""
    train, _ = relational.hash_split(labelled(spark, folder), "doc_id")
    path = fresh_folder(spark, "model")
    learn.save_model(learn.fit(learn.score_model(), train), path)
    return learn.score(documents(spark, folder).select("doc_id", "text"),
                       learn.load_model(path)).select("doc_id", "prediction")


@query
def retrained_scores(spark, folder):
    """A stored model replaced by one trained on all labelled messages so far, then scores by it."""
    path = fresh_folder(spark, "retrained")
    first, more = relational.hash_split(labelled(spark, folder), "doc_id")
    model = learn.score_model()
    learn.refit(model, first, path)
    learn.refit(model, relational.append_by_name(first, more), path)
    return learn.score(documents(spark, folder).select("doc_id", "text"),
                       learn.load_model(path)).select("doc_id", "prediction")


@query
def holdout_scores(spark, folder):
    """RMSE, mean label and correlation on the quarter not trained on."""
    train, test = relational.hash_split(labelled(spark, folder), "doc_id")
    model = learn.fit(learn.score_model(), train)
    return metrics.evaluate(model.transform(test), [])


@query
def tuned_rounds(spark, folder):
    """Cross-validated error of each number of rounds of the grid, at the stored feature size and depth."""
    found = learn.tune_by_prefix(labelled(spark, folder), "doc_id", features=(HASH_FEATURES,), depths=(TREE_DEPTH,))
    return spark.createDataFrame(found, "features int, depth int, rounds int, rmse double")


@query
def oversampled_vectors(spark, folder):
    """New vectors for the rarer labels, until all are as many: where each comes from, and its sum."""
    made = oversample.oversample(table(spark, folder, "embeddings"), "vec_id", "embedding", "label")
    return made.select("id", "copy", "label", "neighbour", F.round("weight", 9).alias("weight"),
                       F.round(F.aggregate("vec", F.lit(0.0), lambda total, v: total + v), 6).alias("total"))


@query
def classified_messages(spark, folder):
    """Naive Bayes classes of all messages."""
    model = learn.class_model("bayes").fit(labelled(spark, folder))
    return learn.score(documents(spark, folder).select("doc_id", "text"), model).select(
        "doc_id", "prediction")


@query
def svm_messages(spark, folder):
    """One linear SVM per class."""
    model = learn.class_model("svm").fit(
        labelled(spark, folder).withColumn("label", (F.col("label") > 0).cast("double")))
    return learn.score(documents(spark, folder).select("doc_id", "text"), model).select(
        "doc_id", "prediction")


# -- files, tables, streams ----------------------------------------------------------------------

@query
def csv_round_trip(spark, folder):
    """Messages written as CSV and read back."""
    path = fresh_folder(spark, "csv")
    df = timed_documents(spark, folder).select(
        V.format_timestamp(F.col("timestamp")).alias("timestamp"), "text")
    files.write_csv(df, path)
    return files.read_csv(spark, path, df.schema)


@query
def legacy_csv(spark, folder):
    """Messages written in the legacy encoding and read back: letters that it lacks are question marks."""
    path = fresh_folder(spark, "legacy")
    df = documents(spark, folder).select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    files.write_legacy_csv(df, path)
    return files.read_legacy_csv(spark, path, df.schema)


@query
def series_file(spark, folder):
    """Hourly means of all topics, stored with an order column and read back in that order."""
    path = fresh_folder(spark, "series")
    files.write_series(hours(spark, folder, "none").select("series", F.col("step").alias("position"), F.col("y").alias("prediction")),
                       path, series="series")
    return files.read_series(spark, path, series="series")


@query
def batch_table(spark, folder):
    """Scored messages appended as two batches, the second one written twice, read back."""
    path = fresh_folder(spark, "batches")
    df = scored(spark, folder)
    late = F.col("timestamp") >= F.lit(BATCH_EDGE).cast("timestamp_ntz")
    for batch, part in [(0, df.where(~late)), (1, df.where(late)), (1, df.where(late))]:
        tables.write_batch(part, path, batch)
    return tables.read_table(spark, path).select("event_id", "timestamp", "series", "prediction",
                                                 F.col("batch_id").cast("bigint").alias("batch_id"))


@query
def csv_corpus(spark, folder):
    """Labelled messages collected into one CSV folder per score, read back as one corpus.

    An output of an earlier run lies beside them and is left out.
    """
    path = fresh_folder(spark, "corpus")
    rows = relational.label_join(timed_documents(spark, folder), table(spark, folder, "labels"),
                                 "doc_id").select(
        V.format_timestamp(F.col("timestamp")).alias("timestamp"), "text",
        F.col("toxic").cast("string").alias("toxicity"))
    files.write_csv(rows.where("toxicity = '0'"), f"{path}/tweets_mild.csv")
    files.write_csv(rows.where("toxicity <> '0'"), f"{path}/tweets_harsh.csv")
    files.write_csv(rows, f"{path}/tweets_training.csv")
    return files.read_corpus(spark, path, rows.schema)


def stream_of(spark, folder, name):
    """A stored table as a stream, whether it is one file or a folder of parts.

    A plain path has to be a folder; a pattern, here one that only this name fits, may find either.
    """
    return spark.readStream.schema(table(spark, folder, name).schema).parquet(f"{folder}/{name}.parque[t]")


def event_stream(spark, folder):
    """The events, one file or a folder of them, as a stream of scored messages."""
    return stream_of(spark, folder, "events").select("event_id", F.col("ts").alias("timestamp"),
                         F.col("event_type").alias("series"), F.col("value").alias("prediction"))


@query
def stream_hour_mean(spark, folder):
    """Update mode over a stored table: windows stay open, files may come in any order."""
    path = fresh_folder(spark, "hours")
    stream = event_stream(spark, folder).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    flow.run_available(flow.window_sums(stream, "1 hour"), path, path + "-offsets")
    return current_hours(spark, path)


def current_hours(spark, path):
    return flow.latest_windows(tables.read_table(spark, path)).select(
        "series", "timestamp", F.round("prediction", 9).alias("prediction"), "n")


@query
def stream_dedup_hour_mean(spark, folder):
    """Every message arrives twice; the second copy is dropped before the mean, however late it comes."""
    out = fresh_folder(spark, "dedup")
    twice = event_stream(spark, folder).withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")

    def handle(df, batch_id):
        once = live.first_arrivals(df, batch_id, out, ["event_id"])
        tables.write_batch(buckets.bucket_sums(once, "timestamp", "prediction", buckets.HOUR), f"{out}/hours", batch_id)

    flow.start_batches(twice, handle, out + "-offsets", "append").awaitTermination()
    whole = tables.read_table(spark, f"{out}/hours").groupBy("series", "step").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    return means(whole, buckets.HOUR)


@query
def stream_messages(spark, folder):
    """Messages published as a stream of JSON lines, read back as a stream and parsed."""
    stored, source, path = (fresh_folder(spark, n) for n in ("messages", "lines", "parsed"))
    timed = timed_documents(spark, folder).select("timestamp", "text")
    timed.write.parquet(stored)
    outgoing = spark.readStream.schema(timed.schema).parquet(stored)
    messages.write_value_files(outgoing, source, source + "-offsets").awaitTermination()
    parsed = messages.readable(messages.parse_messages(messages.read_value_files(spark, source)))
    out = parsed.select(V.plain_timestamp(F.col("timestamp")).alias("timestamp"), "text")
    flow.run_available(out, path, path + "-offsets", "append")
    return tables.read_table(spark, path).drop("batch_id")


@query
def stream_kalman(spark, folder):
    """Hourly means filtered with state kept between batches."""
    source, path = fresh_folder(spark, "hourly"), fresh_folder(spark, "filtered")
    rows = hours(spark, folder).select("series", "idx", "y")
    rows.write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    filtered = stateful.stream_kalman(stream, kalman.velocity_model())
    flow.run_available(filtered, path, path + "-offsets", "append")
    return rounded(tables.read_table(spark, path).drop("batch_id"), "y", "predicted")


@query
def stream_scores(spark, folder):
    """The live flow: a stream of messages scored, averaged, flagged and forecast."""
    model = learn.fit(learn.score_model(), labelled(spark, folder))
    stream = stream_of(spark, folder, "documents")
    begin = F.unix_seconds(F.lit("2018-04-13 10:31:30").cast("timestamp"))
    stamped = stream.select(
        F.timestamp_seconds(begin + (F.col("doc_id") + 1) * 3600).alias("timestamp"),
        F.col("lang").alias("series"), "text")
    out = fresh_folder(spark, "live")
    flow.start_batches(flow.score_stream(stamped, model),
                       lambda df, i: live.signal_batch(df, i, out), out + "-offsets",
                       "append").awaitTermination()
    return live.current_minutes(spark, out).select("series", "times", "prediction", "isAnomaly")


LIVE_BATCHES = 4


def live_events(spark, folder):
    """The live tables after the events have come in several batches, one file each, in any order."""
    source, out = fresh_folder(spark, "events"), fresh_folder(spark, "live")
    events = scored(spark, folder).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    events.repartitionByRange(LIVE_BATCHES, "timestamp").write.parquet(source)
    stream = (spark.readStream.schema(events.schema)
              .option("maxFilesPerTrigger", max(1, len(folder_names(spark, source)) // LIVE_BATCHES)).parquet(source))
    flow.start_batches(stream, lambda df, i: live.signal_batch(df, i, out), out + "-offsets", "append").awaitTermination()
    return out


LATE_DAYS, LATE_DELAY_DAYS, LATE_EVERY = 10, 2, 7


@query
def stream_late_rows(spark, folder):
    """Hourly sums of the rows in time, and how many came too late, per series.

    The events come in batches of ten days; every seventh comes with the batch after its own, two days too
    late or more, or just in time.
    """
    source, out = fresh_folder(spark, "events"), fresh_folder(spark, "late")
    events = scored(spark, folder).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    first = events.agg(F.min("timestamp")).first()[0]
    begin = F.floor(F.unix_seconds(F.lit(first)) / buckets.DAY)
    own = F.floor((F.floor(F.unix_seconds("timestamp") / buckets.DAY) - begin) / LATE_DAYS)
    dealt = settle(events.withColumn("part", (own + (F.col("event_id") % LATE_EVERY == 0).cast("int")).cast("int")))

    def handle(df, batch_id):
        kept = live.set_late_aside(df, batch_id, out, LATE_DELAY_DAYS * buckets.DAY)
        tables.write_batch(buckets.bucket_sums(kept, "timestamp", "prediction", buckets.HOUR), f"{out}/hours", batch_id)

    for part in sorted(r.part for r in dealt.select("part").distinct().collect()):
        dealt.where(F.col("part") == part).drop("part").write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        flow.start_batches(stream, handle, out + "-offsets", "append").awaitTermination()
    hourly = buckets.bucket_means(tables.read_table(spark, f"{out}/hours").groupBy("series", "step").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n")), buckets.HOUR)
    late = tables.read_table(spark, f"{out}/late").groupBy("series").agg(F.count("*").alias("n"))
    return (hourly.select("series", F.col("timestamp").alias("times"), F.round("prediction", 9).alias("prediction"), "n")
            .unionByName(late.withColumns({"times": F.lit(None).cast("timestamp_ntz"), "prediction": F.lit(None).cast("double")})))


@query
def stream_minutes(spark, folder):
    """Minute means that several batches have added up, one row per minute."""
    now = live.current_minutes(spark, live_events(spark, folder))
    return now.select("series", "times", F.round("prediction", 9).alias("prediction"))


@query
def stream_forecast(spark, folder):
    """The forecast that several batches have left, each from the sums of the one before."""
    ahead = live.current_forecast(spark, live_events(spark, folder))
    return ahead.select("series", "times", F.round("prediction", 4).alias("prediction"))


@query
def anomalies_finest(spark, folder):
    """The same on bins as fine as the values are written."""
    return tagged_minutes(spark, folder, FINEST)


def flagship(spark, folder):
    """Minute means with outlier flags, in time order. On the smallest tables finer bins change no flag."""
    return anomalies_finest(spark, folder).orderBy("times", "series")
