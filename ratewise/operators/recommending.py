"""Recommendations from a factor model, without seen items, with fallback."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.functions import exact_round
from ratewise.operators.popularity import POPULAR_NOTE, popular_list
from ratewise.operators.titles import with_title
from ratewise.settings import DEFAULTS


#: Where a recommended row comes from.
MODEL_SOURCE, POPULAR_SOURCE = "model", "popular"


def recommend_all(model: ALSModel, n: int = DEFAULTS.top_n) -> DataFrame:
    """Top n for every user of the model, seen items included."""
    return model.recommendForAllUsers(n)


def recommendation_rows(recs: DataFrame) -> DataFrame:
    """One row per recommended item with its rank."""
    return recs.select("user_id", F.posexplode("recommendations").alias("pos", "rec")).select(
        "user_id", (F.col("pos") + 1).alias("rank"), "rec.movie_id", "rec.rating"
    )


def model_users(model: ALSModel) -> DataFrame:
    return model.userFactors.select(F.col("id").alias("user_id"))


def known_users(users: DataFrame, model: ALSModel) -> DataFrame:
    """Requested users the model has factors for."""
    return users.select("user_id").distinct().join(model_users(model), "user_id", "left_semi")


def cold_users(users: DataFrame, known: DataFrame) -> DataFrame:
    """Requested users that aren't among ``known``."""
    return users.select("user_id").distinct().join(
        known.select("user_id"), "user_id", "left_anti"
    )


def unseen(candidates: DataFrame, ratings: DataFrame) -> DataFrame:
    """Candidates the user hasn't rated.

    The key is the (user, item) pair, which hashes evenly however much one
    user or one item holds; repeated ratings of a pair go before the shuffle.
    """
    seen = ratings.select("user_id", "movie_id").distinct()
    return candidates.join(seen, ["user_id", "movie_id"], "left_anti")


def ranked(candidates: DataFrame, n: int) -> DataFrame:
    """The n best candidates per user, ranked from 1."""
    best_first = Window.partitionBy("user_id").orderBy(F.desc("rating"), F.asc("movie_id"))
    return candidates.withColumn("rank", F.row_number().over(best_first)).filter(
        F.col("rank") <= n
    )


def _best(n: int, rank: int):
    """The n best unseen items of each user of a block among the items of a block."""
    rows_at_once = 256

    def matrix(table: pa.Table) -> np.ndarray:
        flat = table.column("features").combine_chunks().flatten()
        return flat.to_numpy(zero_copy_only=False).reshape(-1, rank)

    def best(users: pa.Table, items: pa.Table) -> pa.Table:
        items = items.sort_by("movie_id")  # of equal scores the lower id comes first
        movie = items.column("movie_id").to_numpy()
        user = users.column("user_id").to_numpy()
        found = [np.empty((0, 3))]
        if len(movie) and len(user):
            u, v = matrix(users), matrix(items).T
            seen = users.column("seen").combine_chunks()
            size = seen.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            bounds = np.append(0, np.cumsum(size))
            flat = seen.flatten().to_numpy(zero_copy_only=False)
            place = np.minimum(np.searchsorted(movie, flat), len(movie) - 1)
            real = movie[place] == flat
            owner = np.repeat(np.arange(len(user)), size)
            k = min(n, len(movie))
            for a in range(0, len(user), rows_at_once):
                scores = u[a : a + rows_at_once] @ v
                own = slice(bounds[a], bounds[min(a + rows_at_once, len(user))])
                scores[owner[own][real[own]] - a, place[own][real[own]]] = -np.inf
                least = np.partition(scores, -k, axis=1)[:, -k]
                row, col = np.nonzero((scores >= least[:, None]) & np.isfinite(scores))
                score = scores[row, col]
                order = np.lexsort((col, -score, row))
                row, col, score = row[order], col[order], score[order]
                first = np.searchsorted(row, row)
                kept = np.arange(len(row)) - first < k
                found.append(np.column_stack([user[row + a], movie[col], score])[kept])
        rows = np.concatenate(found)
        return pa.table(
            {
                "user_id": pa.array(rows[:, 0].astype(np.int32)),
                "movie_id": pa.array(rows[:, 1].astype(np.int32)),
                "rating": pa.array(rows[:, 2].astype(np.float32)),
            }
        )

    return best


def recommend_subset(
    model: ALSModel,
    users: DataFrame,
    ratings: DataFrame,
    n: int = DEFAULTS.top_n,
    block_users: int = 2048,
    block_items: int = 4096,
) -> DataFrame:
    """Top n unseen items of the given users that the model knows.

    Users and items lie in blocks by hash; a task multiplies the factors of a block of
    each, leaves out what its users have seen, and gives n items a user, however many
    these have seen. The ratings are read once. A user's seen items travel by item
    block, so no list is longer than such a block, and no task gets more than two blocks.
    """
    known = known_users(users, model)
    wanted = model.userFactors.withColumnRenamed("id", "user_id").join(known, "user_id", "left_semi")
    items = model.itemFactors.withColumnRenamed("id", "movie_id")
    user_blocks = wanted.count() // block_users + 1
    item_blocks = items.count() // block_items + 1

    def block(column: str, blocks: int) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(blocks)).cast("int")

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    seen = (
        ratings.select("user_id", "movie_id")
        .join(known, "user_id", "left_semi")
        .groupBy("user_id", block("movie_id", item_blocks).alias("item_block"))
        .agg(F.collect_set("movie_id").alias("seen"))
    )
    left = wanted.select(
        "user_id", "features", block("user_id", user_blocks).alias("user_block"),
        every(item_blocks).alias("item_block"),
    ).join(seen, ["user_id", "item_block"], "left")
    right = items.select(
        "movie_id", "features", block("movie_id", item_blocks).alias("item_block"),
        every(user_blocks).alias("user_block"),
    )
    pair = ("user_block", "item_block")
    candidates = left.groupBy(*pair).cogroup(right.groupBy(*pair)).applyInArrow(
        _best(n, model.rank), "user_id int, movie_id int, rating float"
    )
    return ranked(candidates, n).select("user_id", "rank", "movie_id", "rating")


def recommend(
    model: ALSModel,
    users: DataFrame,
    ratings: DataFrame,
    items: DataFrame,
    popular: DataFrame,
    n: int = DEFAULTS.top_n,
) -> DataFrame:
    """On-demand recommendations: unseen top n, or the popular list if unknown.

    ``source`` says which of the two a row is from.
    A known user who has rated every item gets no rows. ``ratings`` may be
    uncleaned: every rated item counts as seen.
    """
    personal = with_title(recommend_subset(model, users, ratings, n), items, "movie_id").select(
        "user_id",
        "rank",
        "movie_id",
        "title",
        exact_round(F.col("rating"), 4).alias("predicted_rating"),
        F.lit(None).cast("double").alias("avg_rating"),
        F.lit(None).cast("string").alias("note"),
        F.lit(MODEL_SOURCE).alias("source"),
    )
    # One array for all cold users: a scalar subquery, not a join.
    listed = popular_list(popular.filter(F.col("rank") <= n)).scalar()["listed"]
    fallback = (
        cold_users(users, known_users(users, model))
        .select("user_id", F.explode(listed).alias("rec"))
        .select(
            "user_id",
            "rec.rank",
            "rec.movie_id",
            "rec.title",
            F.lit(None).cast("double").alias("predicted_rating"),
            "rec.avg_rating",
            F.lit(POPULAR_NOTE).alias("note"),
            F.lit(POPULAR_SOURCE).alias("source"),
        )
    )
    return personal.unionByName(fallback)
