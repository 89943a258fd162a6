"""The registered queries: every operator applied to the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratewise.functions import bucket_column
from ratewise.operators import alerts as al
from ratewise.operators import factors, popularity, profiling, ranking, recommending, serving
from ratewise.operators import windows as win
from ratewise.operators.titles import numbered_title, with_title
from ratewise.plans import frames
from ratewise.plans.training import train_model
from ratewise.session import pin_utc, scratch_path
from ratewise.settings import DEFAULTS
from ratewise.sinks import alert_lines, write_recommendations
from ratewise.sources import (
    distinct_items,
    newest_batches,
    read_alert_lines,
    read_items,
    read_newest,
    read_rating_lines,
    read_ratings,
    read_records,
    read_recommendations,
    read_served,
)
from ratewise.streaming import (
    Outputs,
    compact,
    dropped_rows,
    encode_events,
    last_batch,
    merge_served,
    parse_events,
    read_current,
    read_latest_served,
    replay_slices,
    run_until_stopped,
    start_queries,
    start_query,
)
from ratewise.streaming.handlers import item_handler

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The events cover a month, so windows of a week and a day hold enough rows.
LENGTH, SLIDE = "7 days", "1 day"
STATE_PARTITIONS = 48
WEEKLY = replace(DEFAULTS, window=LENGTH, slide=SLIDE, state_partitions=STATE_PARTITIONS)
MIN_RATINGS = 80
SLICES = 2


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _ntz(column: str) -> F.Column:
    return F.col(column).cast("timestamp_ntz")


def _flat(windows: DataFrame) -> DataFrame:
    """Window bounds as plain time columns."""
    others = [c for c in windows.columns if c != "window"]
    return windows.select(
        _ntz("window.start").alias("window_start"), _ntz("window.end").alias("window_end"), *others
    )


def _plain_times(df: DataFrame) -> DataFrame:
    times = [f.name for f in df.schema if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: _ntz(c) for c in times})


# ---- cleaning, profile, files -------------------------------------------------


@query
def clean_ratings(spark, sf):
    return _plain_times(frames.clean_event_ratings(spark, sf))


@query
def clean_ratings_orders(spark, sf):
    return _plain_times(frames.clean_order_ratings(spark, sf))


@query
def cleaning_counts(spark, sf):
    return profiling.cleaning_counts(frames.event_ratings(spark, sf))


@query
def profile_stats(spark, sf):
    return profiling.profile(frames.clean_event_ratings(spark, sf))


@query
def profile_stats_orders(spark, sf):
    return profiling.profile(frames.clean_order_ratings(spark, sf))


@query
def profile_by_day(spark, sf):
    """The profile added up from days, and whether its estimates are within their bound."""
    clean = frames.clean_event_ratings(spark, sf)
    exact = profiling.profile(clean).select(F.struct("n_users", "n_items").alias("x")).scalar()
    whole = profiling.profile_of_days(profiling.daily_profiles(clean))
    close = [
        (F.abs(F.col(c) - exact[c]) <= profiling.SKETCH_ERROR * exact[c]).alias(f"{c}_close")
        for c in ("n_users", "n_items")
    ]
    return whole.select("n_ratings", "min_rating", "max_rating", "avg_rating", *close)


@query
def rating_histogram(spark, sf):
    return profiling.rating_histogram(frames.clean_event_ratings(spark, sf))


@query
def rating_histogram_orders(spark, sf):
    return profiling.rating_histogram(frames.clean_order_ratings(spark, sf))


def _ratings_file(spark: SparkSession, sf: str) -> str:
    """The event ratings as a ``::`` file; a missing rating is an empty field."""
    path = scratch_path(spark, "ratings-file")
    fields = ("user_id", "movie_id", "rating", "timestamp")
    line = F.concat_ws("::", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields))
    frames.event_ratings(spark, sf).select(line.alias("value")).write.text(path)
    return path


@query
def ratings_file_scan(spark, sf):
    return read_ratings(spark, _ratings_file(spark, sf))


@query
def rating_lines_scan(spark, sf):
    return read_rating_lines(spark, _ratings_file(spark, sf))


@query
def items_file_scan(spark, sf):
    path = scratch_path(spark, "items-file")
    line = F.concat_ws("::", "movie_id", "title", "genres")
    frames.part_items(spark, sf).select(line.alias("value")).write.text(path)
    return distinct_items(read_items(spark, path))


# ---- events -------------------------------------------------------------------


@query
def encoded_events(spark, sf):
    records = encode_events(frames.event_ratings(spark, sf))
    return records.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "partition",
    )


@query
def parsed_events(spark, sf):
    return _plain_times(parse_events(encode_events(frames.event_ratings(spark, sf))))


# ---- windows and rankings -----------------------------------------------------


def _items(spark, sf):
    return win.item_windows(frames.rated_events(spark, sf), LENGTH, SLIDE)


def _users(spark, sf):
    return win.user_windows(frames.rated_events(spark, sf), LENGTH, SLIDE)


@query
def item_windows(spark, sf):
    return _flat(_items(spark, sf))


@query
def user_windows(spark, sf):
    return _flat(_users(spark, sf))


@query
def item_windows_30s(spark, sf):
    return _flat(win.item_windows(frames.rated_events(spark, sf)))


@query
def user_windows_30s(spark, sf):
    return _flat(win.user_windows(frames.rated_events(spark, sf)))


@query
def item_windows_tumbling(spark, sf):
    return _flat(win.item_windows(frames.rated_events(spark, sf), SLIDE, SLIDE))


@query
def trending_top10(spark, sf):
    top = ranking.top_trending(_items(spark, sf))
    return _flat(with_title(top, frames.part_items(spark, sf), "item_id", max_len=35))


@query
def trending_topk_per_window(spark, sf):
    return _flat(ranking.top_k_per_window(_items(spark, sf), k=5))


@query
def active_users_topk(spark, sf):
    return _flat(ranking.top_k_per_window(_users(spark, sf), ranking.ACTIVITY_ORDER, 5))


@query
def active_users_top5(spark, sf):
    return _flat(ranking.top_users(_users(spark, sf)))


@query
def current_window_trending(spark, sf):
    newest = ranking.newest_events(frames.rated_events(spark, sf), SLIDE)
    current = ranking.current_window(win.item_windows(newest, LENGTH, SLIDE))
    top = ranking.top_k_per_window(current, k=5)
    return _flat(with_title(top, frames.part_items(spark, sf), "item_id", max_len=45))


@query
def current_window_users(spark, sf):
    newest = ranking.newest_events(frames.rated_events(spark, sf), SLIDE)
    current = ranking.current_window(win.user_windows(newest, LENGTH, SLIDE))
    return _flat(ranking.top_k_per_window(current, ranking.ACTIVITY_ORDER, 8))


@query
def numbered_titles(spark, sf):
    rated = frames.rated_events(spark, sf).select("item_id").distinct()
    return with_title(
        rated, frames.moved_part_items(spark, sf), "item_id", numbered_title("item_id")
    )


@query
def unknown_titles(spark, sf):
    rated = frames.rated_events(spark, sf).select("item_id").distinct()
    return with_title(rated, frames.moved_part_items(spark, sf), "item_id")


# ---- alerts -------------------------------------------------------------------


def _item_alerts(spark, sf, **options):
    return al.item_alerts(_items(spark, sf), frames.part_items(spark, sf), **options)


def _all_alerts(spark, sf):
    return _item_alerts(spark, sf).unionByName(al.user_alerts(_users(spark, sf)))


@query
def alerts_rating_spike(spark, sf):
    return _plain_times(_item_alerts(spark, sf).filter(F.col("alert_type") == al.RATING_SPIKE))


@query
def alerts_trending(spark, sf):
    return _plain_times(_item_alerts(spark, sf).filter(F.col("alert_type") == al.TRENDING))


@query
def alerts_user_spike(spark, sf):
    return _plain_times(al.user_alerts(_users(spark, sf)))


@query
def alerts_of_top10(spark, sf):
    """Only the ten highest scores are checked."""
    return _plain_times(_item_alerts(spark, sf, top_n=10))


@query
def alerts_with_support(spark, sf):
    """A rating spike needs three ratings."""
    spikes = _item_alerts(spark, sf, min_count=3).filter(F.col("alert_type") == al.RATING_SPIKE)
    return _plain_times(spikes)


@query
def alert_counts(spark, sf):
    return al.alert_counts(_all_alerts(spark, sf))


@query
def recent_alerts(spark, sf):
    timed = _all_alerts(spark, sf).withColumn("alert_time", F.col("window_end"))
    return _plain_times(al.recent_alerts(timed))


@query
def alert_log_scan(spark, sf):
    """Alerts written as log lines and read back."""
    path = scratch_path(spark, "alert-log")
    alert_lines(_all_alerts(spark, sf).withColumn("alert_time", F.col("window_end"))).write.text(
        path
    )
    return _plain_times(read_alert_lines(spark, path))


# ---- popularity, cold start ---------------------------------------------------


def _popular(spark, sf):
    ratings = frames.rated_events(spark, sf).withColumnRenamed("item_id", "movie_id")
    return popularity.popular_items(
        ratings, frames.part_items(spark, sf), min_ratings=MIN_RATINGS
    )


@query
def popular_items(spark, sf):
    return _popular(spark, sf)


@query
def popular_items_orders(spark, sf):
    return popularity.popular_items(
        frames.clean_order_ratings(spark, sf), frames.part_items(spark, sf), n=10, min_ratings=5
    )


@query
def item_popularity(spark, sf):
    return popularity.item_popularity(frames.clean_event_ratings(spark, sf))


@query
def batch_users(spark, sf):
    return serving.batch_users(frames.event_ratings(spark, sf))


@query
def unseen_candidates(spark, sf):
    """Popular items each event user hasn't rated yet."""
    listed = popularity.popular_list(_popular(spark, sf)).scalar()["listed"]
    ratings = frames.event_ratings(spark, sf)
    candidates = serving.batch_users(ratings).select(
        "user_id", F.explode(listed["movie_id"]).alias("movie_id")
    )
    return recommending.unseen(candidates, ratings)


# ---- splits and models --------------------------------------------------------


def _split(spark, sf):
    return factors.hash_split(frames.clean_event_ratings(spark, sf))


@query
def rating_split(spark, sf):
    tagged = factors.tag_split(frames.clean_event_ratings(spark, sf))
    return tagged.select("user_id", "movie_id", "rating", "part")


@query
def split_counts(spark, sf):
    tagged = factors.tag_split(frames.clean_event_ratings(spark, sf))
    return tagged.groupBy("part").agg(F.count("*").alias("n_rows"))


@query
def random_split_total(spark, sf):
    """Which rows a random split takes depends on the layout; their total doesn't."""
    clean = frames.clean_event_ratings(spark, sf).select("user_id", "movie_id", "rating")
    train, test = factors.random_split(clean)
    return train.unionByName(test)


@query
def rmse_item_mean(spark, sf):
    """Error of predicting each test rating by the item's mean in the training part."""
    train, test = _split(spark, sf)
    means = train.groupBy("movie_id").agg(F.avg("rating").alias("prediction"))
    return factors.rmse(test.join(means, "movie_id")).select(F.round("rmse", 8).alias("rmse"))


_models: dict[tuple[str, str], str] = {}


def _model(spark: SparkSession, sf: str) -> ALSModel:
    """The model of the training part, fitted once per application and saved."""
    pin_utc(spark)
    key = (spark.sparkContext.applicationId, sf)
    if key not in _models:
        path = scratch_path(spark, "model")
        train, _ = _split(spark, sf)
        factors.save_model(factors.fit_als(train), path)
        _models[key] = path
    return factors.load_model(_models[key])


def _products(model: ALSModel, rows: DataFrame) -> DataFrame:
    """Rows (user_id, movie_id) with the product of the saved factors."""
    users = model.userFactors.select(F.col("id").alias("user_id"), F.col("features").alias("u"))
    items = model.itemFactors.select(F.col("id").alias("movie_id"), F.col("features").alias("i"))
    product = F.aggregate(
        F.zip_with("u", "i", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, x: s + x
    )
    found = rows.join(users, "user_id").join(items, "movie_id")
    return found.withColumn("product", product).drop("u", "i")


def _with_products(model: ALSModel, ratings: DataFrame) -> DataFrame:
    """Predictions beside the products of the saved factors, each computed by itself."""
    scored = factors.predict(model, ratings)
    return _products(model, scored).select("user_id", "movie_id", "rating", "prediction", "product")


@query
def als_rmse(spark, sf):
    """Predictions of the test part, and whether their error is that of the factors' products."""
    _, test = _split(spark, sf)
    scored = _with_products(_model(spark, sf), test)
    product_error = F.sqrt(F.avg(F.pow(F.col("rating") - F.col("product"), 2)))
    error = F.sqrt(F.avg(F.pow(F.col("rating") - F.col("prediction"), 2)))
    return scored.agg(
        F.count("*").alias("n_predicted"), (F.abs(error - product_error) < 1e-4).alias("agrees")
    )


@query
def als_rmse_orders(spark, sf):
    """Sizes and error on the wide id space of the orders, from a written split."""
    clean = frames.clean_order_ratings(spark, sf)
    train, test = factors.written_split(clean, scratch_path(spark, "orders-split"))
    trained = factors.train_and_score(train, test)
    return factors.training_summary(trained, train, test).drop("seconds", "rmse")


@query
def als_predictions(spark, sf):
    _, test = _split(spark, sf)
    agrees = F.abs(F.col("prediction") - F.col("product")) < 1e-4
    return _with_products(_model(spark, sf), test).select(
        "user_id", "movie_id", "rating", agrees.alias("agrees")
    )


@query
def als_predicted_pairs(spark, sf):
    """The test pairs that get a prediction: both ids are in the training part."""
    return als_predictions(spark, sf).select("user_id", "movie_id", "rating")


@query
def als_optimality(spark, sf):
    """Whether each user's factors solve their least squares over the training part."""
    train, _ = _split(spark, sf)
    return factors.optimality(_model(spark, sf), train).select("user_id", "n_ratings", "optimal")


@query
def als_tune(spark, sf):
    """All settings tried, with the limit set so low that tuning starts."""
    clean = frames.clean_event_ratings(spark, sf)
    train, test = factors.written_split(clean, scratch_path(spark, "tune-split"))
    first = factors.train_and_score(train, test)
    tried = factors.trial_table(spark, factors.tune(first, train, test, threshold=0.0))
    return tried.select("trial", "rank", "reg", (F.col("rmse") > 0).alias("scored"))


@query
def training_summary(spark, sf):
    trained = train_model(
        frames.clean_event_ratings(spark, sf), scratch_path(spark, "summary-model")
    )
    # Which setting won depends on the errors, which SQL can't give.
    return trained.summary.select("algorithm", "max_iter", "n_train", "n_test")


# ---- recommendations ----------------------------------------------------------


def _sizes(rows: DataFrame, *columns: str) -> DataFrame:
    """Per user: number of items, of distinct items, and highest rank."""
    return rows.groupBy("user_id", *columns).agg(
        F.count("*").alias("n_items"),
        F.count_distinct("movie_id").alias("n_distinct"),
        F.max("rank").alias("max_rank"),
    )


@query
def recommend_all(spark, sf):
    return recommending.recommendation_rows(recommending.recommend_all(_model(spark, sf)))


@query
def recommend_all_sizes(spark, sf):
    return _sizes(recommend_all(spark, sf))


def _agreeing(model: ALSModel, rows: DataFrame) -> DataFrame:
    """Whether the rating of each recommended row is the product of the saved factors."""
    products = _products(model, rows)
    agrees = F.abs(F.col("rating") - F.col("product")) < 1e-4
    return products.select("user_id", "rank", agrees.alias("agrees"))


@query
def recommend_all_products(spark, sf):
    return _agreeing(_model(spark, sf), recommend_all(spark, sf))


@query
def recommend_subset_products(spark, sf):
    return _agreeing(_model(spark, sf), recommend_subset(spark, sf))


@query
def recommend_sources(spark, sf):
    """How many rows each user gets, and from where."""
    rows = recommend_with_fallback(spark, sf)
    return rows.groupBy("user_id", "source").agg(F.count("*").alias("n_rows"))


@query
def known_users(spark, sf):
    return recommending.known_users(frames.customers(spark, sf), _model(spark, sf))


@query
def cold_start_users(spark, sf):
    users = frames.customers(spark, sf)
    return recommending.cold_users(users, recommending.known_users(users, _model(spark, sf)))


@query
def recommend_subset(spark, sf):
    return recommending.recommend_subset(
        _model(spark, sf), frames.customers(spark, sf), frames.event_ratings(spark, sf)
    )


@query
def recommend_subset_sizes(spark, sf):
    return _sizes(recommend_subset(spark, sf))


@query
def recommend_subset_seen(spark, sf):
    """Recommended pairs the user has rated before: none."""
    seen = frames.event_ratings(spark, sf).select("user_id", "movie_id").distinct()
    rows = recommend_subset(spark, sf).join(seen, ["user_id", "movie_id"])
    return rows.agg(F.count("*").alias("n_seen"))


@query
def recommend_with_fallback(spark, sf):
    return recommending.recommend(
        _model(spark, sf),
        frames.customers(spark, sf),
        frames.event_ratings(spark, sf),
        frames.part_items(spark, sf),
        _popular(spark, sf),
    )


@query
def recommend_fallback_rows(spark, sf):
    """The rows of the users the model doesn't know."""
    rows = recommend_with_fallback(spark, sf).filter("note IS NOT NULL")
    return rows.select("user_id", "rank", "movie_id", "title", "avg_rating", "note")


_tables: dict[tuple[str, str], str] = {}


def _table(spark: SparkSession, sf: str) -> DataFrame:
    """The titled recommendation table, written once per application."""
    pin_utc(spark)
    key = (spark.sparkContext.applicationId, sf)
    if key not in _tables:
        path = scratch_path(spark, "recommendations")
        recs = recommending.recommend_all(_model(spark, sf))
        write_recommendations(
            serving.titled_recommendations(recs, frames.part_items(spark, sf)), path
        )
        _tables[key] = path
    return read_recommendations(spark, _tables[key])


@query
def recommendation_table(spark, sf):
    """What the stored table holds per user, and its directories."""
    return _table(spark, sf).select(
        "user_id",
        F.size("recommendations").alias("n_items"),
        F.col(bucket_column(DEFAULTS.user_buckets)).isNotNull().alias("bucketed"),
    )


def _served_now(spark, sf):
    recs = _table(spark, sf)
    users = frames.customers(spark, sf)
    fallback = popularity.popular_list(_popular(spark, sf)).scalar()
    return serving.serve(
        users, recs, frames.part_items(spark, sf), fallback, serving.check_users(users, recs)
    )


@query
def serve_batch(spark, sf):
    return _served_now(spark, sf).select(
        "user_id", F.to_json("recommendations").alias("recommendations"), "source", "display"
    )


@query
def serve_batch_sources(spark, sf):
    return _served_now(spark, sf).select(
        "user_id",
        "source",
        F.size("recommendations").alias("n_items"),
        F.when(F.col("source") == popularity.POPULAR_NOTE, F.col("display")).alias("fallback"),
    )


# ---- served records -----------------------------------------------------------


def _served(spark, sf):
    """Every event stands for one served record."""
    return frames.event_ratings(spark, sf, "value").select(
        "user_id",
        "movie_id",
        F.round("value", 2).alias("latency_ms"),
        F.floor(F.col("event_id") / 100).alias("batch_id"),
        "event_id",
    )


@query
def served_latest(spark, sf):
    return serving.latest_served(_served(spark, sf).withColumn("batch_id", F.col("event_id")))


@query
def served_newest_batches(spark, sf):
    return newest_batches(_served(spark, sf))


@query
def serving_metrics(spark, sf):
    return serving.serving_metrics(_served(spark, sf), _all_alerts(spark, sf), target_ms=50)


# ---- streams ------------------------------------------------------------------

_streams: dict[tuple[str, str], Outputs] = {}
_marks: dict[tuple[str, str], list[dict]] = {}


def _stream(spark: SparkSession, sf: str) -> Outputs:
    """The three queries over all events in two time slices, once per application.

    The queries are started again from their checkpoints for the second slice.
    """
    pin_utc(spark)
    key = (spark.sparkContext.applicationId, sf)
    if key not in _streams:
        records = scratch_path(spark, "records")
        out = Outputs(scratch_path(spark, "stream"))
        checkpoint = scratch_path(spark, "stream-checkpoint")
        recs, popular = _table(spark, sf), _popular(spark, sf)
        ratings = frames.event_ratings(spark, sf).select(
            "user_id", "movie_id", "rating", "timestamp"
        )
        marks = []
        for events in replay_slices(ratings, SLICES):
            events.write.mode("append").parquet(records)
            queries = start_queries(
                parse_events(read_records(spark, records)),
                recs,
                frames.part_items(spark, sf),
                popular,
                out,
                checkpoint,
                {"availableNow": True},
                WEEKLY,
            )
            run_until_stopped(queries)
            marks.append({name: last_batch(q) for name, q in queries.items()})
        _marks[key] = marks
        _streams[key] = out
    return _streams[key]


@query
def stream_item_windows(spark, sf):
    written = spark.read.parquet(_stream(spark, sf).item_windows)
    return _plain_times(
        win.latest_version(written, ["window_start", "window_end", "item_id"])
    )


@query
def stream_user_windows(spark, sf):
    written = spark.read.parquet(_stream(spark, sf).user_windows)
    return _plain_times(
        win.latest_version(written, ["window_start", "window_end", "user_id"])
    )


def _compacted(spark: SparkSession, sf: str, name: str, item: str) -> DataFrame:
    """The windows after a compaction at the end of each time slice."""
    table = getattr(_stream(spark, sf), name)
    for mark in _marks[(spark.sparkContext.applicationId, sf)]:
        batch_id, watermark = mark[name]
        compact(spark, table, [item], watermark, batch_id)
    return _plain_times(read_current(spark, table, [item]))


@query
def stream_item_windows_compacted(spark, sf):
    return _compacted(spark, sf, "item_windows", "item_id")


@query
def stream_user_windows_compacted(spark, sf):
    return _compacted(spark, sf, "user_windows", "user_id")


_late: dict[tuple[str, str], tuple[str, int]] = {}


def _late_stream(spark: SparkSession, sf: str) -> tuple[str, int]:
    """Item windows at the published settings, the users with a 7 at the end of their id
    delivered after all others; and the rows dropped. Once per application."""
    pin_utc(spark)
    key = (spark.sparkContext.applicationId, sf)
    if key not in _late:
        records, out = scratch_path(spark, "late-records"), Outputs(scratch_path(spark, "late"))
        checkpoint = scratch_path(spark, "late-checkpoint")
        ratings = frames.event_ratings(spark, sf).select("user_id", "movie_id", "rating", "timestamp")
        late = F.pmod("user_id", F.lit(10)) == 7
        handler = item_handler(
            out.item_windows, out.item_alerts, out.trending, frames.part_items(spark, sf)
        )
        bounds = (DEFAULTS.window, DEFAULTS.slide, DEFAULTS.watermark)
        dropped = 0
        for part in (ratings.filter(~late), ratings.filter(late)):
            encode_events(part).write.mode("append").parquet(records)
            windows = win.item_windows(parse_events(read_records(spark, records)), *bounds)
            started = start_query(
                windows, "late", "update", handler, checkpoint, {"availableNow": True}, STATE_PARTITIONS
            )
            run_until_stopped({"late": started})
            dropped += dropped_rows(started)
        _late[key] = (out.item_windows, dropped)
    return _late[key]


@query
def stream_late_windows(spark, sf):
    """The windows that remain when some users' rows come late."""
    written = spark.read.parquet(_late_stream(spark, sf)[0])
    return _plain_times(win.latest_version(written, ["window_start", "window_end", "item_id"]))


@query
def stream_late_dropped(spark, sf):
    """Windows that remain, and windows' parts that came too late."""
    path, dropped = _late_stream(spark, sf)
    kept = spark.read.parquet(path).select("window_start", "item_id").distinct()
    return kept.agg(F.count("*").alias("n_windows"), F.lit(dropped).cast("bigint").alias("n_dropped"))


def _numbered_batches(df: DataFrame) -> DataFrame:
    """Batches numbered from 1: empty micro-batches leave gaps between the ids.

    The ranking window has no partition, but sees one row per batch.
    """
    nth = F.row_number().over(Window.orderBy("batch_id"))
    numbers = df.select("batch_id").distinct().withColumn("nth_batch", nth)
    return df.join(numbers, "batch_id").drop("batch_id")


def _stream_alerts(spark, sf):
    out = _stream(spark, sf)
    return spark.read.parquet(out.item_alerts).unionByName(spark.read.parquet(out.user_alerts))


@query
def stream_alerts(spark, sf):
    """Each alert as it was first raised."""
    first = al.first_alerts(_stream_alerts(spark, sf)).drop("batch_id", "alert_time")
    return _plain_times(first)


@query
def stream_alert_log(spark, sf):
    """The log lines that the window queries wrote."""
    out = _stream(spark, sf)
    lines = [read_alert_lines(spark, p) for p in (out.item_alert_log, out.user_alert_log)]
    return _plain_times(lines[0].unionByName(lines[1]))


@query
def stream_alerts_per_batch(spark, sf):
    """Rule hits per micro-batch of the item query; batches numbered from 1 (a row each)."""
    written = spark.read.parquet(_stream(spark, sf).item_alerts)
    return _numbered_batches(al.alerts_per_batch(written))


@query
def stream_trending(spark, sf):
    """The top ten of each micro-batch."""
    return _plain_times(_numbered_batches(spark.read.parquet(_stream(spark, sf).trending)))


@query
def stream_active_users(spark, sf):
    """The five most active users of each micro-batch."""
    return _plain_times(_numbered_batches(spark.read.parquet(_stream(spark, sf).active_users)))


@query
def stream_recommendations(spark, sf):
    """Who was served how often, and from where."""
    served = read_served(spark, _stream(spark, sf).served)
    return served.groupBy("user_id", "source").agg(
        F.count("*").alias("n_served"),
        F.sum(F.size("recommendations")).alias("n_items"),
    )


@query
def stream_served_newest(spark, sf):
    """What the newest micro-batch served, read from its directory alone."""
    served = read_newest(spark, _stream(spark, sf).served, 1)
    return served.select("user_id", "source", F.size("recommendations").alias("n_items"))


@query
def stream_served_latest(spark, sf):
    served = serving.latest_served(read_served(spark, _stream(spark, sf).served))
    return served.select("user_id", F.to_json("recommendations").alias("recommendations"), "source")


@query
def stream_served_snapshot(spark, sf):
    """The newest record of each user, from a snapshot merged after each time slice."""
    served, root = _stream(spark, sf).served, f"{_stream(spark, sf).served}_latest"
    for mark in _marks[(spark.sparkContext.applicationId, sf)]:
        merge_served(spark, served, root, mark["recommendations"][0])
    latest = read_latest_served(spark, served, root)
    return latest.select("user_id", "source", F.size("recommendations").alias("n_items"))
