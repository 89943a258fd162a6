"""DuckDB SQL for the registered queries."""

from __future__ import annotations

from ratewise.plans.queries import MIN_RATINGS, SLICES
from ratewise.settings import DEFAULTS, TUNING_GRID

ORACLES: dict[str, str] = {}

_POPULAR_NOTE = "cold-start fallback (popular movies)"
_PRECOMPUTED = "precomputed ALS recommendations"

# Common table expressions, each in terms of earlier ones.
_CTES = {
    "r": """
        SELECT event_id, CAST(user_id AS INTEGER) AS user_id,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS movie_id,
               CASE WHEN event_type <> 'error' THEN CAST(floor(value / 25) + 1 AS FLOAT) END AS rating,
               CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp", ts, value
        FROM events""",
    "valid": """
        SELECT * FROM r WHERE rating BETWEEN 1 AND 5 AND user_id > 0 AND movie_id > 0
          AND "timestamp" IS NOT NULL""",
    "rc": """
        SELECT * EXCLUDE (nth) FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id, movie_id
                ORDER BY "timestamp" DESC, event_id DESC) AS nth FROM valid) WHERE nth = 1""",
    "rl": """
        SELECT user_id, movie_id, rating, "timestamp" FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id, movie_id
                ORDER BY "timestamp" DESC, l_orderkey DESC, l_linenumber DESC) AS nth FROM (
                SELECT CAST(o_custkey AS INTEGER) AS user_id, CAST(l_partkey AS INTEGER) AS movie_id,
                       CAST(floor((l_quantity - 1) / 10) + 1 AS FLOAT) AS rating,
                       CAST(floor(epoch(l_shipdate)) AS BIGINT) AS "timestamp",
                       l_orderkey, l_linenumber
                FROM orders JOIN lineitem ON o_orderkey = l_orderkey)
            WHERE rating BETWEEN 1 AND 5 AND user_id > 0 AND movie_id > 0
              AND "timestamp" IS NOT NULL) WHERE nth = 1""",
    "m": "SELECT CAST(p_partkey AS INTEGER) AS movie_id, p_name AS title, p_type AS genres FROM part",
    "e": """
        SELECT user_id, movie_id AS item_id, rating, ts, "timestamp" FROM r
        WHERE rating IS NOT NULL AND user_id IS NOT NULL AND movie_id IS NOT NULL""",
    "ew": """
        SELECT date_trunc('day', ts) - to_days(CAST(k AS INTEGER)) AS window_start, e.*
        FROM e, range(0, 7) AS t(k)""",
    "iw": """
        SELECT window_start, window_start + INTERVAL 7 DAY AS window_end, item_id,
               avg_rating, interaction_count, round(avg_rating * interaction_count, 2) AS trending_score
        FROM (SELECT window_start, item_id, round(avg(rating), 4) AS avg_rating,
                     count(*) AS interaction_count FROM ew GROUP BY ALL)""",
    "uw": """
        SELECT window_start, window_start + INTERVAL 7 DAY AS window_end, user_id,
               count(*) AS user_interaction_count, round(avg(rating), 4) AS user_avg_rating
        FROM ew GROUP BY ALL""",
    "ia": """
        SELECT 'RATING SPIKE' AS alert_type, window_start, window_end, item_id AS entity_id,
               coalesce(title, 'Unknown') AS title, avg_rating AS metric, CAST(4.5 AS DOUBLE) AS threshold,
               printf('🔴 ALERT [RATING SPIKE] Item %d (%s) avg_rating=%.2f > 4.5',
                      item_id, coalesce(title, 'Unknown'), avg_rating) AS message, interaction_count
        FROM iw LEFT JOIN m ON item_id = movie_id WHERE avg_rating >= 4.5
        UNION ALL
        SELECT 'TRENDING', window_start, window_end, item_id, coalesce(title, 'Unknown'),
               trending_score, CAST(30 AS DOUBLE),
               printf('🔥 ALERT [TRENDING] Item %d (%s) trending_score=%.2f > 30',
                      item_id, coalesce(title, 'Unknown'), trending_score), interaction_count
        FROM iw LEFT JOIN m ON item_id = movie_id WHERE trending_score >= 30""",
    "ua": """
        SELECT 'USER SPIKE' AS alert_type, window_start, window_end, user_id AS entity_id,
               CAST(NULL AS VARCHAR) AS title, CAST(user_interaction_count AS DOUBLE) AS metric,
               CAST(10 AS DOUBLE) AS threshold,
               printf('⚡ ALERT [USER SPIKE] User %d has %d interactions in window (threshold=10)',
                      user_id, user_interaction_count) AS message
        FROM uw WHERE user_interaction_count >= 10""",
    "al": """
        SELECT * EXCLUDE (interaction_count) FROM ia UNION ALL SELECT * FROM ua""",
    "pop": f"""
        SELECT row_number() OVER (ORDER BY raw DESC, num_ratings DESC, p.movie_id) AS rank, p.movie_id,
               coalesce(title, 'Unknown') AS title,
               -- printf rounds the exact value, ties to even
               CAST(printf('%.4f', raw) AS DOUBLE) AS avg_rating, num_ratings, '{_POPULAR_NOTE}' AS note
        FROM (SELECT item_id AS movie_id, avg(rating) AS raw, count(*) AS num_ratings FROM e GROUP BY 1
              HAVING count(*) >= {MIN_RATINGS} ORDER BY raw DESC, num_ratings DESC, movie_id LIMIT 5) p
        LEFT JOIN m ON p.movie_id = m.movie_id""",
    "sp": """
        SELECT *, CASE WHEN CAST('0x' || substr(md5(user_id || ':' || movie_id), 1, 8) AS BIGINT) % 100 < 80
                       THEN 'train' ELSE 'test' END AS part FROM rc""",
    "tr": "SELECT * FROM sp WHERE part = 'train'",
    "te": "SELECT * FROM sp WHERE part = 'test'",
    "cu": "SELECT DISTINCT CAST(c_custkey AS INTEGER) AS user_id FROM customer",
    "known": "SELECT user_id FROM cu WHERE user_id IN (SELECT user_id FROM tr)",
    "cold": "SELECT user_id FROM cu WHERE user_id NOT IN (SELECT user_id FROM tr)",
    "poptext": """
        SELECT coalesce(string_agg(printf('%s (%.2f)', title, avg_rating), ' | ' ORDER BY rank), '') AS txt FROM pop""",
    "served": """
        SELECT user_id, movie_id, round(value, 2) AS latency_ms,
               CAST(floor(event_id / 100) AS BIGINT) AS batch_id, event_id FROM r""",
    # Events by time slice, and every version of a window: one per slice that
    # touches it, over all events so far.
    "sl": f"""
        SELECT e.*, CAST(floor((e."timestamp" - lo) / ((hi - lo) // {SLICES} + 1)) AS INTEGER) AS slice
        FROM e, (SELECT min("timestamp") AS lo, max("timestamp") AS hi FROM r)""",
    "slw": """
        SELECT date_trunc('day', ts) - to_days(CAST(k AS INTEGER)) AS window_start, sl.*
        FROM sl, range(0, 7) AS t(k)""",
    "iv": """
        SELECT *, round(avg_rating * interaction_count, 2) AS trending_score FROM (
            SELECT v.slice, v.window_start, v.item_id, round(avg(w.rating), 4) AS avg_rating,
                   count(*) AS interaction_count
            FROM (SELECT DISTINCT slice, window_start, item_id FROM slw) v
            JOIN slw w ON w.window_start = v.window_start AND w.item_id = v.item_id AND w.slice <= v.slice
            GROUP BY ALL)""",
    "uv": """
        SELECT v.slice, v.window_start, v.user_id, count(*) AS n, round(avg(w.rating), 4) AS user_avg_rating
        FROM (SELECT DISTINCT slice, window_start, user_id FROM slw) v
        JOIN slw w ON w.window_start = v.window_start AND w.user_id = v.user_id AND w.slice <= v.slice
        GROUP BY ALL""",
    "sia": """
        SELECT slice, 'RATING SPIKE' AS alert_type, window_start, item_id AS entity_id,
               coalesce(title, 'Unknown') AS title, avg_rating AS metric, CAST(4.5 AS DOUBLE) AS threshold,
               printf('🔴 ALERT [RATING SPIKE] Item %d (%s) avg_rating=%.2f > 4.5',
                      item_id, coalesce(title, 'Unknown'), avg_rating) AS message
        FROM iv LEFT JOIN m ON item_id = movie_id WHERE avg_rating >= 4.5
        UNION ALL
        SELECT slice, 'TRENDING', window_start, item_id, coalesce(title, 'Unknown'),
               trending_score, CAST(30 AS DOUBLE),
               printf('🔥 ALERT [TRENDING] Item %d (%s) trending_score=%.2f > 30',
                      item_id, coalesce(title, 'Unknown'), trending_score)
        FROM iv LEFT JOIN m ON item_id = movie_id WHERE trending_score >= 30""",
    "sua": """
        SELECT slice, 'USER SPIKE' AS alert_type, window_start, user_id AS entity_id,
               CAST(NULL AS VARCHAR) AS title, CAST(n AS DOUBLE) AS metric, CAST(10 AS DOUBLE) AS threshold,
               printf('⚡ ALERT [USER SPIKE] User %d has %d interactions in window (threshold=10)',
                      user_id, n) AS message
        FROM uv WHERE n >= 10""",
}


def _sql(name: str, select: str, *needs: str) -> None:
    ctes = ",\n".join(f"{c} AS ({_CTES[c].strip()})" for c in _CTES if c in needs)
    ORACLES[name] = (f"WITH {ctes}\n" if ctes else "") + select.strip()


_RC = ("r", "valid", "rc")
_IW = ("r", "e", "ew", "iw")
_UW = ("r", "e", "ew", "uw")
_IA = (*_IW, "m", "ia")
_AL = (*_IA, "uw", "ua", "al")
_POP = ("r", "e", "m", "pop")
_TR = (*_RC, "sp", "tr")
_KNOWN = (*_TR, "cu", "known")
_STREAM = ("r", "e", "sl", "slw")

_CLEAN = 'user_id, movie_id, rating, "timestamp", CAST(make_timestamp("timestamp" * 1000000) AS TIMESTAMP) AS event_time'
_PROFILE = """
    SELECT *, 1 - n_ratings / (CAST(n_users AS DOUBLE) * n_items) AS sparsity FROM (
        SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users,
               count(DISTINCT movie_id) AS n_items, min(rating) AS min_rating,
               max(rating) AS max_rating, avg(rating) AS avg_rating FROM {})"""

_sql("clean_ratings", f"SELECT event_id, {_CLEAN} FROM rc", *_RC)
_sql("clean_ratings_orders", f"SELECT {_CLEAN} FROM rl", "rl")
_sql(
    "cleaning_counts",
    """SELECT 'raw' AS frame, count(*) AS n_rows FROM r
       UNION ALL SELECT 'valid', count(*) FROM valid UNION ALL SELECT 'clean', count(*) FROM rc""",
    *_RC,
)
_sql("profile_stats", _PROFILE.format("rc"), *_RC)
_sql("profile_stats_orders", _PROFILE.format("rl"), "rl")
_sql("rating_histogram", "SELECT rating, count(*) AS n_ratings FROM rc GROUP BY 1 ORDER BY 1", *_RC)
_sql(
    "rating_histogram_orders",
    "SELECT rating, count(*) AS n_ratings FROM rl GROUP BY 1 ORDER BY 1",
    "rl",
)
_sql("ratings_file_scan", 'SELECT user_id, movie_id, rating, "timestamp" FROM r', "r")
_sql(
    "rating_lines_scan",
    'SELECT user_id, movie_id, rating, "timestamp" FROM r WHERE rating IS NOT NULL',
    "r",
)
_sql("items_file_scan", "SELECT movie_id, title, genres FROM m", "m")
_sql(
    "encoded_events",
    """SELECT CAST(movie_id % 2 AS VARCHAR) AS key,
              '{"user_id":' || user_id || ',"item_id":' || movie_id
                || CASE WHEN rating IS NULL THEN '' ELSE ',"rating":' || printf('%.1f', rating) END
                || ',"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '"}' AS value,
              CAST(movie_id % 2 AS INTEGER) AS partition FROM r""",
    "r",
)
_sql(
    "parsed_events",
    """SELECT user_id, item_id, rating, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS "timestamp",
              date_trunc('second', ts) AS event_time FROM e""",
    "r",
    "e",
)
_sql("item_windows", "SELECT * FROM iw", *_IW)
_sql("user_windows", "SELECT * FROM uw", *_UW)
_TEN = "time_bucket(INTERVAL 10 SECOND, ts, TIMESTAMP '1970-01-01') - to_seconds(CAST(k * 10 AS INTEGER))"
_sql(
    "item_windows_30s",
    f"""SELECT window_start, window_start + INTERVAL 30 SECOND AS window_end, item_id, avg_rating,
               interaction_count, round(avg_rating * interaction_count, 2) AS trending_score
        FROM (SELECT {_TEN} AS window_start, item_id, round(avg(rating), 4) AS avg_rating,
                     count(*) AS interaction_count FROM e, range(0, 3) AS t(k) GROUP BY ALL)""",
    "r",
    "e",
)
_sql(
    "user_windows_30s",
    f"""SELECT window_start, window_start + INTERVAL 30 SECOND AS window_end, user_id,
               user_interaction_count, user_avg_rating
        FROM (SELECT {_TEN} AS window_start, user_id, round(avg(rating), 4) AS user_avg_rating,
                     count(*) AS user_interaction_count FROM e, range(0, 3) AS t(k) GROUP BY ALL)""",
    "r",
    "e",
)
_sql(
    "item_windows_tumbling",
    """SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, item_id, avg_rating,
              interaction_count, round(avg_rating * interaction_count, 2) AS trending_score
       FROM (SELECT date_trunc('day', ts) AS window_start, item_id, round(avg(rating), 4) AS avg_rating,
                    count(*) AS interaction_count FROM e GROUP BY ALL)""",
    "r",
    "e",
)
_sql(
    "trending_top10",
    """SELECT iw.*, substr(coalesce(title, 'Unknown'), 1, 35) AS title
       FROM iw LEFT JOIN m ON item_id = movie_id
       ORDER BY trending_score DESC, window_start DESC, item_id LIMIT 10""",
    *_IW,
    "m",
)
_RANKED = """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY window_start
        ORDER BY {} DESC, {}) AS rank FROM {}) WHERE rank <= {}"""
_sql("trending_topk_per_window", _RANKED.format("trending_score", "item_id", "iw", 5), *_IW)
_sql("active_users_topk", _RANKED.format("user_interaction_count", "user_id", "uw", 5), *_UW)
_sql(
    "active_users_top5",
    "SELECT * FROM uw ORDER BY user_interaction_count DESC, window_start DESC, user_id LIMIT 5",
    *_UW,
)
_sql(
    "current_window_trending",
    f"""SELECT x.*, substr(coalesce(title, 'Unknown'), 1, 45) AS title
        FROM ({_RANKED.format('trending_score', 'item_id', 'iw', 5)}) x LEFT JOIN m ON item_id = movie_id
        WHERE window_start = (SELECT max(window_start) FROM iw)""",
    *_IW,
    "m",
)
_sql(
    "current_window_users",
    _RANKED.format("user_interaction_count", "user_id", "uw", 8)
    + " AND window_start = (SELECT max(window_start) FROM uw)",
    *_UW,
)
_sql(
    "numbered_titles",
    """SELECT item_id, coalesce(title, 'Movie ' || item_id) AS title
       FROM (SELECT DISTINCT item_id FROM e) LEFT JOIN m ON item_id = movie_id + 50""",
    "r",
    "e",
    "m",
)
_sql(
    "unknown_titles",
    """SELECT item_id, coalesce(title, 'Unknown') AS title
       FROM (SELECT DISTINCT item_id FROM e) LEFT JOIN m ON item_id = movie_id + 50""",
    "r",
    "e",
    "m",
)
_sql(
    "alerts_rating_spike",
    "SELECT * EXCLUDE (interaction_count) FROM ia WHERE alert_type = 'RATING SPIKE'",
    *_IA,
)
_sql(
    "alerts_trending",
    "SELECT * EXCLUDE (interaction_count) FROM ia WHERE alert_type = 'TRENDING'",
    *_IA,
)
_sql("alerts_user_spike", "SELECT * FROM ua", *_UW, "ua")
_sql(
    "alerts_of_top10",
    """SELECT ia.* EXCLUDE (interaction_count) FROM ia JOIN (
           SELECT window_start, item_id FROM iw
           ORDER BY trending_score DESC, window_start DESC, item_id LIMIT 10) t
       ON t.window_start = ia.window_start AND t.item_id = ia.entity_id""",
    *_IA,
)
_sql(
    "alerts_with_support",
    """SELECT * EXCLUDE (interaction_count) FROM ia
       WHERE alert_type = 'RATING SPIKE' AND interaction_count >= 3""",
    *_IA,
)
_sql(
    "alert_counts",
    """SELECT t.alert_type, count(al.alert_type) AS n_alerts
       FROM (VALUES ('TRENDING'), ('RATING SPIKE'), ('USER SPIKE')) t(alert_type)
       LEFT JOIN al ON al.alert_type = t.alert_type GROUP BY 1""",
    *_AL,
)
_sql(
    "recent_alerts",
    """SELECT *, window_end AS alert_time FROM al
       ORDER BY window_end DESC, alert_type, entity_id LIMIT 50""",
    *_AL,
)
_sql("alert_log_scan", "SELECT window_end AS alert_time, alert_type, message FROM al", *_AL)
_sql("popular_items", "SELECT * FROM pop", *_POP)
_sql(
    "popular_items_orders",
    f"""SELECT row_number() OVER (ORDER BY raw DESC, num_ratings DESC, p.movie_id) AS rank, p.movie_id,
               coalesce(title, 'Unknown') AS title, CAST(printf('%.4f', raw) AS DOUBLE) AS avg_rating,
               num_ratings, '{_POPULAR_NOTE}' AS note
        FROM (SELECT movie_id, avg(rating) AS raw, count(*) AS num_ratings FROM rl GROUP BY 1
              HAVING count(*) >= 5 ORDER BY raw DESC, num_ratings DESC, movie_id LIMIT 10) p
        LEFT JOIN m ON p.movie_id = m.movie_id""",
    "rl",
    "m",
)
_sql(
    "item_popularity",
    "SELECT movie_id, count(*) AS num_ratings, avg(rating) AS avg_rating FROM rc GROUP BY 1",
    *_RC,
)
_sql("batch_users", "SELECT DISTINCT user_id FROM r", "r")
_sql(
    "unseen_candidates",
    """SELECT u.user_id, pop.movie_id FROM (SELECT DISTINCT user_id FROM r) u, pop
       WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.user_id = u.user_id AND r.movie_id = pop.movie_id)""",
    *_POP,
)
_sql("rating_split", "SELECT user_id, movie_id, rating, part FROM sp", *_RC, "sp")
_sql("split_counts", "SELECT part, count(*) AS n_rows FROM sp GROUP BY 1", *_RC, "sp")
_sql("random_split_total", "SELECT user_id, movie_id, rating FROM rc", *_RC)
_SIZES = """(SELECT count(*) FROM sp WHERE part = 'train') AS n_train,
       (SELECT count(*) FROM sp WHERE part = 'test') AS n_test"""
_sql(
    "als_predictions",
    """SELECT user_id, movie_id, rating, true AS agrees FROM te
       WHERE user_id IN (SELECT user_id FROM tr) AND movie_id IN (SELECT movie_id FROM tr)""",
    *_TR,
    "te",
)
_sql(
    "als_rmse",
    """SELECT count(*) AS n_predicted, true AS agrees FROM te
       WHERE user_id IN (SELECT user_id FROM tr) AND movie_id IN (SELECT movie_id FROM tr)""",
    *_TR,
    "te",
)
_sql(
    "training_summary",
    f"SELECT 'ALS' AS algorithm, CAST({DEFAULTS.max_iter} AS INTEGER) AS max_iter, {_SIZES}",
    *_RC,
    "sp",
)
_sql(
    "als_tune",
    "SELECT CAST(trial AS INTEGER) AS trial, CAST(rank AS INTEGER) AS rank, "
    "CAST(reg AS DOUBLE) AS reg, true AS scored FROM (VALUES "
    + ", ".join(
        f"({i}, {rank}, {reg})"
        for i, (rank, reg) in enumerate([(DEFAULTS.rank, DEFAULTS.reg), *TUNING_GRID])
    )
    + ") AS t(trial, rank, reg)",
)
_sql(
    "als_rmse_orders",
    f"""SELECT 'ALS' AS algorithm, CAST({DEFAULTS.rank} AS INTEGER) AS rank,
               CAST({DEFAULTS.reg} AS DOUBLE) AS reg, CAST({DEFAULTS.max_iter} AS INTEGER) AS max_iter,
               count(*) FILTER (bucket < 80) AS n_train, count(*) FILTER (bucket >= 80) AS n_test,
               false AS tuned
        FROM (SELECT CAST('0x' || substr(md5(user_id || ':' || movie_id), 1, 8) AS BIGINT) % 100
              AS bucket FROM rl)""",
    "rl",
)
_sql(
    "rmse_item_mean",
    """SELECT round(sqrt(avg((rating - prediction) ** 2)), 8) AS rmse FROM te
       JOIN (SELECT movie_id, avg(rating) AS prediction FROM tr GROUP BY 1) USING (movie_id)""",
    *_TR,
    "te",
)
_sql(
    "als_predicted_pairs",
    """SELECT user_id, movie_id, rating FROM te WHERE user_id IN (SELECT user_id FROM tr)
       AND movie_id IN (SELECT movie_id FROM tr)""",
    *_TR,
    "te",
)
_sql(
    "recommend_all_sizes",
    """SELECT DISTINCT user_id, n AS n_items, n AS n_distinct, CAST(n AS INTEGER) AS max_rank
       FROM tr, (SELECT least(5, count(DISTINCT movie_id)) AS n FROM tr)""",
    *_TR,
)
_sql("known_users", "SELECT user_id FROM known", *_KNOWN)
_sql("cold_start_users", "SELECT user_id FROM cold", *_TR, "cu", "cold")
_sql(
    "recommend_subset_sizes",
    """SELECT user_id, n AS n_items, n AS n_distinct, CAST(n AS INTEGER) AS max_rank FROM (
           SELECT user_id, least(5, (SELECT count(DISTINCT movie_id) FROM tr) - (
               SELECT count(DISTINCT r.movie_id) FROM r WHERE r.user_id = known.user_id
               AND r.movie_id IN (SELECT movie_id FROM tr))) AS n FROM known) WHERE n > 0""",
    *_KNOWN,
)
_sql("recommend_subset_seen", "SELECT CAST(0 AS BIGINT) AS n_seen")
_sql(
    "recommend_fallback_rows",
    "SELECT user_id, rank, movie_id, title, avg_rating, note FROM cold, pop",
    *_TR,
    *_POP,
    "cu",
    "cold",
)
_sql(
    "recommendation_table",
    """SELECT DISTINCT user_id, CAST(n AS INTEGER) AS n_items, true AS bucketed
       FROM tr, (SELECT least(5, count(DISTINCT movie_id)) AS n FROM tr)""",
    *_TR,
)
_sql(
    "serve_batch_sources",
    f"""SELECT user_id, '{_PRECOMPUTED}' AS source,
               CAST((SELECT least(5, count(DISTINCT movie_id)) FROM tr) AS INTEGER) AS n_items,
               CAST(NULL AS VARCHAR) AS fallback FROM known
        UNION ALL SELECT user_id, '{_POPULAR_NOTE}',
               CAST((SELECT count(*) FROM pop) AS INTEGER), txt FROM cold, poptext""",
    *_KNOWN,
    "cold",
    *_POP,
    "poptext",
)
_sql(
    "served_latest",
    """SELECT user_id, movie_id, latency_ms, event_id, event_id AS batch_id FROM (
           SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS nth FROM served)
       WHERE nth = 1""",
    "r",
    "served",
)
_sql(
    "served_newest_batches",
    """SELECT * FROM served WHERE batch_id IN (
           SELECT DISTINCT batch_id FROM served ORDER BY batch_id DESC LIMIT 10)""",
    "r",
    "served",
)
_sql(
    "serving_metrics",
    """SELECT count(*) AS n_served, CAST(printf('%.1f', avg(latency_ms)) AS DOUBLE) AS avg_latency_ms,
              count(*) FILTER (latency_ms >= 50) AS n_over_target,
              (SELECT count(*) FROM al) AS n_alerts FROM served""",
    *_AL,
    "served",
)
_sql("stream_item_windows", "SELECT * FROM iw", *_IW)
_sql("stream_user_windows", "SELECT * FROM uw", *_UW)
_sql(
    "stream_alerts",
    """SELECT alert_type, window_start, window_start + INTERVAL 7 DAY AS window_end, entity_id, title,
              metric, threshold, message FROM (
           SELECT *, row_number() OVER (PARTITION BY alert_type, window_start, entity_id
                                        ORDER BY slice) AS nth
           FROM (SELECT * FROM sia UNION ALL SELECT * FROM sua)) WHERE nth = 1""",
    *_STREAM,
    "iv",
    "uv",
    "m",
    "sia",
    "sua",
)
_sql(
    "stream_alerts_per_batch",
    """SELECT CAST(slice + 1 AS INTEGER) AS nth_batch, count(*) AS n_alerts FROM sia GROUP BY 1""",
    *_STREAM,
    "iv",
    "m",
    "sia",
)
_sql(
    "stream_trending",
    """SELECT nth_batch, window_start, window_end, item_id, avg_rating, interaction_count, trending_score,
              substr(coalesce(title, 'Unknown'), 1, 35) AS title FROM (
           SELECT *, CAST(slice + 1 AS INTEGER) AS nth_batch, window_start + INTERVAL 7 DAY AS window_end,
                  row_number() OVER (PARTITION BY slice
                      ORDER BY trending_score DESC, window_start DESC, item_id) AS nth FROM iv)
       LEFT JOIN m ON item_id = movie_id WHERE nth <= 10""",
    *_STREAM,
    "iv",
    "m",
)
_sql(
    "stream_active_users",
    """SELECT CAST(slice + 1 AS INTEGER) AS nth_batch, window_start,
              window_start + INTERVAL 7 DAY AS window_end, user_id, n AS user_interaction_count,
              user_avg_rating FROM (
           SELECT *, row_number() OVER (PARTITION BY slice
               ORDER BY n DESC, window_start DESC, user_id) AS nth FROM uv) WHERE nth <= 5""",
    *_STREAM,
    "uv",
)
_sql(
    "stream_recommendations",
    f"""SELECT user_id, source, count(*) AS n_served, CAST(sum(n) AS BIGINT) AS n_items FROM (
            SELECT DISTINCT slice, user_id,
                CASE WHEN user_id IN (SELECT user_id FROM tr) THEN '{_PRECOMPUTED}'
                     ELSE '{_POPULAR_NOTE}' END AS source,
                CASE WHEN user_id IN (SELECT user_id FROM tr)
                     THEN (SELECT least(5, count(DISTINCT movie_id)) FROM tr)
                     ELSE (SELECT count(*) FROM pop) END AS n
            FROM sl) GROUP BY 1, 2""",
    *_TR,
    *_POP,
    *_STREAM,
)
_sql(
    "stream_served_newest",
    f"""SELECT DISTINCT user_id,
            CASE WHEN user_id IN (SELECT user_id FROM tr) THEN '{_PRECOMPUTED}'
                 ELSE '{_POPULAR_NOTE}' END AS source,
            CAST(CASE WHEN user_id IN (SELECT user_id FROM tr)
                 THEN (SELECT least(5, count(DISTINCT movie_id)) FROM tr)
                 ELSE (SELECT count(*) FROM pop) END AS INTEGER) AS n_items
        FROM sl WHERE slice = (SELECT max(slice) FROM sl)""",
    *_TR,
    *_POP,
    *_STREAM,
)
_sql(
    "als_optimality",
    "SELECT user_id, count(*) AS n_ratings, true AS optimal FROM tr GROUP BY 1",
    *_TR,
)
_sql(
    "recommend_all_products",
    """SELECT user_id, CAST(k AS INTEGER) AS rank, true AS agrees
       FROM (SELECT DISTINCT user_id FROM tr), (SELECT least(5, count(DISTINCT movie_id)) AS n FROM tr),
            range(1, 6) AS t(k) WHERE k <= n""",
    *_TR,
)
_sql(
    "recommend_subset_products",
    """SELECT user_id, CAST(k AS INTEGER) AS rank, true AS agrees FROM (
           SELECT user_id, least(5, (SELECT count(DISTINCT movie_id) FROM tr) - (
               SELECT count(DISTINCT r.movie_id) FROM r WHERE r.user_id = known.user_id
               AND r.movie_id IN (SELECT movie_id FROM tr))) AS n FROM known), range(1, 6) AS t(k)
       WHERE k <= n""",
    *_KNOWN,
)
_sql(
    "recommend_sources",
    """SELECT user_id, 'model' AS source, n AS n_rows FROM (
           SELECT user_id, least(5, (SELECT count(DISTINCT movie_id) FROM tr) - (
               SELECT count(DISTINCT r.movie_id) FROM r WHERE r.user_id = known.user_id
               AND r.movie_id IN (SELECT movie_id FROM tr))) AS n FROM known) WHERE n > 0
       UNION ALL SELECT user_id, 'popular', count(*) FROM cold, pop GROUP BY 1""",
    *_KNOWN,
    "cold",
    *_POP,
)
_sql("stream_item_windows_compacted", "SELECT * FROM iw", *_IW)
_sql("stream_user_windows_compacted", "SELECT * FROM uw", *_UW)
# A copy of a row in a window is dropped if its user is late and the window had closed by
# the watermark of all others' rows; a batch's rows are added up by window and item first.
_LATE = f"""
    lw AS (SELECT {_TEN} AS window_start, e.*, user_id % 10 = 7 AS late FROM e, range(0, 3) AS t(k)),
    wm AS (SELECT date_trunc('second', max(ts)) - INTERVAL 15 SECOND AS closed FROM e WHERE user_id % 10 <> 7),
    cp AS (SELECT lw.*, late AND window_start + INTERVAL 30 SECOND <= closed AS dropped FROM lw, wm)"""
ORACLES["stream_late_windows"] = f"""WITH r AS ({_CTES['r']}), e AS ({_CTES['e']}), {_LATE}
SELECT window_start, window_start + INTERVAL 30 SECOND AS window_end, item_id, avg_rating,
       interaction_count, round(avg_rating * interaction_count, 2) AS trending_score
FROM (SELECT window_start, item_id, round(avg(rating), 4) AS avg_rating,
             count(*) AS interaction_count FROM cp WHERE NOT dropped GROUP BY ALL)"""
ORACLES["stream_late_dropped"] = f"""WITH r AS ({_CTES['r']}), e AS ({_CTES['e']}), {_LATE}
SELECT count(DISTINCT row(window_start, item_id)) FILTER (NOT dropped) AS n_windows,
       count(DISTINCT row(window_start, item_id)) FILTER (dropped) AS n_dropped FROM cp"""
_sql(
    "stream_served_snapshot",
    f"""SELECT DISTINCT user_id,
            CASE WHEN user_id IN (SELECT user_id FROM tr) THEN '{_PRECOMPUTED}'
                 ELSE '{_POPULAR_NOTE}' END AS source,
            CAST(CASE WHEN user_id IN (SELECT user_id FROM tr)
                 THEN (SELECT least(5, count(DISTINCT movie_id)) FROM tr)
                 ELSE (SELECT count(*) FROM pop) END AS INTEGER) AS n_items FROM sl""",
    *_TR,
    *_POP,
    *_STREAM,
)
_sql(
    "profile_by_day",
    """SELECT count(*) AS n_ratings, min(rating) AS min_rating, max(rating) AS max_rating,
              avg(rating) AS avg_rating, true AS n_users_close, true AS n_items_close FROM rc""",
    *_RC,
)
_sql(
    "stream_alert_log",
    """SELECT window_start + INTERVAL 7 DAY AS alert_time, alert_type, message
       FROM (SELECT * FROM sia UNION ALL SELECT * FROM sua)""",
    *_STREAM,
    "iv",
    "uv",
    "m",
    "sia",
    "sua",
)
