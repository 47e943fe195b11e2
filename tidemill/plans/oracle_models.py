"""Independent SQL for scoring, the auction, the recommender and the sensor stream."""

from tidemill.plans.oracle_pipeline import PRICES


SCORED = """
    SELECT c_custkey, CAST(18 + c_custkey % 47 AS INTEGER) AS age, CAST(20 + c_custkey % 131 AS DOUBLE) AS income_k,
           ROUND(1 / (1 + EXP(-(0.03::DOUBLE * (18 + c_custkey % 47) + 0.04::DOUBLE * (20 + c_custkey % 131) - 4.0::DOUBLE))), 9)
             AS p_buy
    FROM customer
"""

# --- auction -----------------------------------------------------------------

BIDS = """
    SELECT event_id, 'opp-' || event_id AS opportunity_id, ts,
           CASE event_type WHEN 'click' THEN 'sports' WHEN 'view' THEN 'finance' WHEN 'purchase' THEN 'entertainment'
                WHEN 'signup' THEN 'lifestyle' ELSE 'other' END AS content,
           CASE WHEN (event_id // 4) % 2 = 0 THEN 1.1::DOUBLE ELSE 1.0::DOUBLE END AS device_bonus,
           CASE WHEN HOUR(ts) IN (6, 7, 8) THEN 1.2::DOUBLE WHEN HOUR(ts) IN (12, 13) THEN 1.15::DOUBLE
                WHEN HOUR(ts) IN (19, 20, 21, 22) THEN 1.25::DOUBLE ELSE 1.0::DOUBLE END AS time_bonus,
           'adv_' || LPAD(CAST((event_id * 7 + i * 11) % 20 AS VARCHAR), 2, '0') AS advertiser_id,
           (['sportswear', 'energy_drink', 'fintech', 'insurance', 'streaming', 'gaming', 'beauty', 'travel', 'fast_food', 'auto']
             )[1 + (event_id * 7 + i * 3) % 10] AS category,
           (100 + (event_id * 37 + i * 101) % 900) / 100 AS bid_amount
    FROM events, UNNEST([0, 1, 2]) AS u(i)
    WHERE i < event_id % 4 AND (event_id + i) % 19 <> 0 AND event_id % 97 <> 0
"""

SCORES = f"""
    SELECT *, bid_amount * relevance * time_bonus * device_bonus AS score FROM (
        SELECT *, COALESCE(m, 1.0::DOUBLE) AS relevance
        FROM ({BIDS}) LEFT JOIN (VALUES
            ('sports', 'sportswear', 1.4::DOUBLE), ('sports', 'energy_drink', 1.3::DOUBLE), ('finance', 'fintech', 1.5::DOUBLE),
            ('finance', 'insurance', 1.3::DOUBLE), ('entertainment', 'streaming', 1.4::DOUBLE),
            ('entertainment', 'gaming', 1.3::DOUBLE), ('lifestyle', 'beauty', 1.3::DOUBLE),
            ('lifestyle', 'travel', 1.2::DOUBLE)) r(a, b, m) ON a = content AND b = category)
"""

WINNERS = f"""
    SELECT opportunity_id, event_id, ts, content AS content_category, advertiser_id AS winning_advertiser_id,
           bid_amount AS winning_bid_amount, score AS winning_score, score - COALESCE(second, 0.0) AS score_margin
    FROM (SELECT *, ROW_NUMBER() OVER w AS place, LEAD(score) OVER w AS second FROM ({SCORES})
          WINDOW w AS (PARTITION BY event_id ORDER BY score DESC, advertiser_id))
    WHERE place = 1
"""

RUSHED = """
    SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-02 07:00:00' + TO_SECONDS(event_id % 3600) ELSE ts END AS ts) FROM events
"""
WINDOWS = f"""
    SELECT d + TO_HOURS(a) AS first, d + TO_HOURS(b) AS after, bonus
    FROM (SELECT DISTINCT DATE_TRUNC('day', ts)::TIMESTAMP AS d FROM ({RUSHED})),
         (VALUES (6, 9, 1.2::DOUBLE), (12, 14, 1.15::DOUBLE), (19, 23, 1.25::DOUBLE)) h(a, b, bonus)
    UNION ALL VALUES (NULL, TIMESTAMP '2024-01-02', 1.02::DOUBLE), (TIMESTAMP '2024-01-05', NULL, 1.05::DOUBLE)
"""
# the windows that hold a message's second, one by one; the one that begins last counts
BONUS = f"""
    SELECT event_id, bonus FROM (
        SELECT event_id, bonus, ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY first DESC NULLS LAST, after NULLS LAST, bonus) AS place
        FROM ({RUSHED}) JOIN ({WINDOWS}) ON COALESCE(DATE_TRUNC('second', ts) >= first, TRUE) AND COALESCE(DATE_TRUNC('second', ts) < after, TRUE))
    WHERE place = 1
"""

_BID = """'{"advertiser_id":"' || advertiser || '"' ||
    CASE WHEN (event_id + i) % 19 <> 0 THEN ',"bid_amount":' || CAST((100 + (event_id * 37 + i * 101) % 900) / 100 AS VARCHAR) ELSE '' END ||
    ',"category":"' || category || '"}'"""

# the messages that cannot be read, letter for letter
BROKEN_OPPORTUNITIES = f"""
    SELECT 'msg-' || event_id AS message_id, 'not a readable message' AS reason,
           'not json {{"opportunity_id":"opp-' || event_id || '","timestamp":"' || STRFTIME(ts, '%Y-%m-%dT%H:%M:%SZ') ||
           '","user_id":"u_' || user_id || '","content_category":"' ||
           CASE event_type WHEN 'click' THEN 'sports' WHEN 'view' THEN 'finance' WHEN 'purchase' THEN 'entertainment'
                WHEN 'signup' THEN 'lifestyle' ELSE 'other' END ||
           '","device_type":"' || CASE WHEN (event_id // 4) % 2 = 0 THEN 'mobile' ELSE 'desktop' END ||
           '","region":"region-' || (user_id % 4) || '","bids":[' || COALESCE(bids, '') || ']}}' AS body
    FROM events LEFT JOIN (
        SELECT event_id, STRING_AGG({_BID}, ',' ORDER BY i) AS bids FROM (
            SELECT event_id, i, 'adv_' || LPAD(CAST((event_id * 7 + i * 11) % 20 AS VARCHAR), 2, '0') AS advertiser,
                   (['sportswear', 'energy_drink', 'fintech', 'insurance', 'streaming', 'gaming', 'beauty', 'travel', 'fast_food', 'auto']
                     )[1 + (event_id * 7 + i * 3) % 10] AS category
            FROM events, UNNEST([0, 1, 2]) AS u(i) WHERE i < event_id % 4 AND event_id % 97 = 0)
        GROUP BY event_id) USING (event_id)
    WHERE event_id % 97 = 0
"""

# --- recommender -------------------------------------------------------------

FEATURES = """
    SELECT user_id, item_id, CAST(SUM(CASE event_type WHEN 'purchase' THEN 3 WHEN 'click' THEN 2 ELSE 1 END) AS BIGINT) AS interaction_score
    FROM (SELECT user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS item_id, event_type FROM events) GROUP BY 1, 2
"""
PLACED = f"""
    SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY interaction_score DESC, item_id) AS place FROM ({FEATURES})
"""
TRAIN = f"SELECT user_id, item_id, interaction_score FROM ({PLACED}) WHERE place > 1"
HELD = f"SELECT user_id, item_id, interaction_score FROM ({PLACED}) WHERE place = 1"


def _popular(measure: str) -> str:
    return f"""SELECT item_id, CAST({measure} AS BIGINT) AS score FROM ({TRAIN}) GROUP BY 1 ORDER BY score DESC, item_id LIMIT 10"""


def _hits(popular: str) -> str:
    return f"""SELECT COUNT(p.item_id) AS hits, COUNT(*) AS holdout_rows, COUNT(p.item_id) / COUNT(*) AS hit_rate
        FROM ({HELD}) h LEFT JOIN ({popular}) p ON h.item_id = p.item_id"""


# the whole grid, the known cells struck out, and one free cell drawn from each of n strips of them
NEGATIVES = f"""
    SELECT CAST(draw AS BIGINT) AS draw, user_idx, item_idx FROM (
        SELECT j AS draw, lo + (j * 7919) % (hi - lo) AS r FROM (
            SELECT j, CAST(j::HUGEINT * free // n AS BIGINT) AS lo, CAST((j + 1)::HUGEINT * free // n AS BIGINT) AS hi FROM (
                SELECT UNNEST(RANGE(n)) AS j, n, free
                FROM (SELECT COUNT(*) AS n, (SELECT COUNT(*) FROM u) * (SELECT COUNT(*) FROM i) - COUNT(*) AS free FROM train))))
    JOIN (
        SELECT user_idx, item_idx, ROW_NUMBER() OVER (ORDER BY user_idx, item_idx) - 1 AS r
        FROM u CROSS JOIN i LEFT JOIN train USING (user_id, item_id) WHERE interaction_score IS NULL) USING (r)
"""
INDEXED = f"""
    WITH f AS ({FEATURES}), train AS ({TRAIN}),
         u AS (SELECT user_id, ROW_NUMBER() OVER (ORDER BY user_id) - 1 AS user_idx FROM (SELECT DISTINCT user_id FROM f)),
         i AS (SELECT item_id, ROW_NUMBER() OVER (ORDER BY item_id) - 1 AS item_idx FROM (SELECT DISTINCT item_id FROM f)),
         negatives AS ({NEGATIVES})
"""

# --- sensor stream -----------------------------------------------------------

READINGS = """
    SELECT event_id AS reading_id, 's' || (user_id % 3) AS student, 'sensor-0' || (1 + user_id % 6) AS sensor_id,
           (1800 + event_id % 1711) / 100 AS temperature_c, (300 + event_id % 601) / 10 AS humidity_pct, ts AS "at"
    FROM events WHERE event_id % 101 <> 0
"""
MEAN = "CAST(SUM(CAST(temperature_c AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*)"


def _mean_rounded(digits: int) -> str:
    return f"ROUND({MEAN}, {digits})"


SQL = {
    "score_vectorized": SCORED,
    "score_builtin": SCORED,
    "top_scored": f"SELECT * FROM ({SCORED}) ORDER BY p_buy DESC, c_custkey LIMIT 20",
    "score_by_partitions": f"""
        SELECT n AS partitions, (SELECT COUNT(*) FROM customer) AS rows, ROUND((SELECT SUM(p) FROM (
            SELECT 1 / (1 + EXP(-(0.03::DOUBLE * (18 + c_custkey % 47) + 0.04::DOUBLE * (20 + c_custkey % 131) - 4.0::DOUBLE))) AS p
            FROM customer)), 6) AS total_prob, n AS partitions_used
        FROM (VALUES (4::BIGINT), (16), (32)) v(n)""",
    "auction_scores": f"""
        SELECT opportunity_id, advertiser_id, bid_amount, relevance, time_bonus, device_bonus, score FROM ({SCORES})""",
    "auction_windows": f"""
        SELECT opportunity_id, advertiser_id, bid_amount, relevance, time_bonus, device_bonus,
               bid_amount * relevance * time_bonus * device_bonus AS score
        FROM (SELECT * REPLACE (COALESCE(bonus, 1.0::DOUBLE) AS time_bonus) FROM ({SCORES}) LEFT JOIN ({BONUS}) USING (event_id))""",
    "auction_winners": f"SELECT * EXCLUDE (event_id, ts) FROM ({WINNERS})",
    "auction_quarantine": BROKEN_OPPORTUNITIES,
    "auction_wins": f"SELECT winning_advertiser_id, COUNT(*) AS wins FROM ({WINNERS}) GROUP BY 1",
    "auction_wins_by_category": f"""
        SELECT content_category, winning_advertiser_id, COUNT(*) AS wins FROM ({WINNERS}) GROUP BY 1, 2""",
    "auction_latency": f"""
        SELECT content_category, COUNT(*) AS results, ROUND(AVG(event_id % 500) / 1000, 6) AS avg_latency_s,
               ROUND(MAX(event_id % 500) / 1000, 3) AS max_latency_s,
               ROUND(COUNT(*) / ((MAX(began + event_id % 500) - MIN(began)) / 1000), 9) AS results_per_s
        FROM (SELECT *, EPOCH_MS(DATE_TRUNC('second', ts)) AS began FROM ({WINNERS})) GROUP BY 1""",
    "keyed_upsert": f"""
        SELECT opportunity_id, content_category, winning_advertiser_id, winning_bid_amount, winning_score,
               CASE WHEN content_category = 'sports' THEN 0.0 ELSE score_margin END AS score_margin,
               CASE WHEN content_category = 'sports' THEN '2030-01-01T00:00:00.000Z'
                    ELSE STRFTIME(DATE_TRUNC('second', ts) + TO_MILLISECONDS(event_id % 500), '%Y-%m-%dT%H:%M:%S.%gZ') END AS processed_at
        FROM ({WINNERS})""",
    "feature_table": FEATURES,
    "feature_stats": f"""
        SELECT COUNT(*) AS pairs, COUNT(DISTINCT user_id) AS users, COUNT(DISTINCT item_id) AS items,
               MIN(interaction_score) AS min_score, MAX(interaction_score) AS max_score,
               ROUND(SUM(interaction_score) / COUNT(*), 4) AS mean_score,
               ROUND(COUNT(*) / (COUNT(DISTINCT user_id) * COUNT(DISTINCT item_id)), 6) AS density FROM ({FEATURES})""",
    "id_index": """
        SELECT user_id, DENSE_RANK() OVER (ORDER BY user_id) - 1 AS user_idx FROM (SELECT DISTINCT user_id FROM events)""",
    "holdout_split": HELD,
    "train_split": TRAIN,
    "popular_items": _popular("SUM(interaction_score)"),
    "hit_rate": _hits(_popular("SUM(interaction_score)")),
    "negative_samples": f"{INDEXED} SELECT draw, user_idx, item_idx FROM negatives",
    # properties, not the formula: as many new pairs as known ones, and every user with enough free cells gets some
    "negative_checks": f"""
        SELECT COUNT(*) AS draws, COUNT(*) AS pairs, (SELECT COUNT(DISTINCT user_id) FROM ({FEATURES})) AS users, 0::BIGINT AS known FROM ({TRAIN})""",
    "als_checks": f"""
        SELECT COUNT(DISTINCT user_id) AS users, LEAST(10, COUNT(DISTINCT item_id)) AS least, LEAST(10, COUNT(DISTINCT item_id)) AS most,
               0::BIGINT AS repeated, 0::BIGINT AS unscored, 0::BIGINT AS unknown_items, TRUE AS hits_are_joined_pairs FROM ({TRAIN})""",
    "als_factors": f"""
        SELECT 'user' AS side, COUNT(DISTINCT user_id) AS rows, 20::BIGINT AS factors FROM ({TRAIN})
        UNION ALL SELECT 'item', COUNT(DISTINCT item_id), 20 FROM ({TRAIN})""",
    "run_log_checks": """
        SELECT * FROM (VALUES ('run-1', 'popular', 'algorithm=popularity', 'hit_rate', TRUE),
            ('run-2', 'als', 'algorithm=ALS-implicit,maxIter=10,rank=20,regParam=0.1', 'hit_rate', TRUE))
            v(run_id, model, params, metric, is_share)""",
    "training_pairs": f"""{INDEXED}
        SELECT user_idx, item_idx, ROUND(interaction_score / (SELECT MAX(interaction_score) FROM train), 6) AS label
        FROM train JOIN u USING (user_id) JOIN i USING (item_id)
        UNION ALL SELECT user_idx, item_idx, 0.0 FROM negatives""",
    "dot_product_topk": """
        SELECT user_id, item_id, score, place FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS place FROM (
                SELECT u.vec_id AS user_id, i.vec_id AS item_id,
                       ROUND(LIST_DOT_PRODUCT(CAST(u.embedding AS DOUBLE[]), CAST(i.embedding AS DOUBLE[])), 9) AS score
                FROM embeddings u CROSS JOIN embeddings i))
        WHERE place <= 10""",
    "bounded_topk": """
        SELECT user_id, item_id, score, place FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS place FROM (
                SELECT u.vec_id AS user_id, i.vec_id AS item_id,
                       ROUND(LIST_DOT_PRODUCT(CAST(u.embedding AS DOUBLE[]), CAST(i.embedding AS DOUBLE[])) * POW(2.0, i.vec_id % 5 - 1), 9) AS score
                FROM embeddings u CROSS JOIN embeddings i))
        WHERE place <= 10""",
    "bounded_topk_share": "SELECT COUNT(*) * COUNT(*) AS pairs, TRUE AS some_skipped, TRUE AS all_counted FROM embeddings",
    "pair_scores": """
        SELECT u.vec_id AS user_id, i.vec_id AS item_id,
               ROUND(1 / (1 + EXP(-(2.0::DOUBLE * LIST_DOT_PRODUCT(CAST(u.embedding AS DOUBLE[]), CAST(i.embedding AS DOUBLE[]))
                                    - 0.5::DOUBLE))), 9) AS score
        FROM embeddings u JOIN embeddings i ON i.vec_id = u.vec_id + 1""",
    "promotion_decision": f"""
        SELECT 'by_score' AS champion, 'by_users' AS challenger, a.hit_rate AS champion_value, b.hit_rate AS challenger_value,
               b.hit_rate > a.hit_rate AS promoted, CASE WHEN b.hit_rate > a.hit_rate THEN 'by_users' ELSE 'by_score' END AS next_champion,
               ROUND(ABS(b.hit_rate - a.hit_rate), 6) AS margin
        FROM ({_hits(_popular("SUM(interaction_score)"))}) a CROSS JOIN ({_hits(_popular("COUNT(*)"))}) b""",
    "auction_stream": f"SELECT * EXCLUDE (event_id, ts) FROM ({WINNERS})",
    "auction_stream_retries": BROKEN_OPPORTUNITIES,
    "stream_parsed": READINGS,
    "stream_unreadable": """
        SELECT student || '-' || sensor_id AS key,
               'broken {"reading_id":' || reading_id || ',"student":"' || student || '","sensor_id":"' || sensor_id ||
               '","temperature_c":' || CAST(temperature_c AS VARCHAR) || ',"humidity_pct":' || CAST(humidity_pct AS VARCHAR) ||
               ',"timestamp":"' || STRFTIME(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z"}' AS value
        FROM (SELECT event_id AS reading_id, 's' || (user_id % 3) AS student, 'sensor-0' || (1 + user_id % 6) AS sensor_id,
                     (1800 + event_id % 1711) / 100 AS temperature_c, (300 + event_id % 601) / 10 AS humidity_pct, ts
              FROM events WHERE event_id % 101 = 0)""",
    "stream_tag_counts": f"""
        SELECT COUNT(*) FILTER (WHERE student = 's1') AS messages, COUNT(*) FILTER (WHERE student <> 's1') AS skipped
        FROM ({READINGS})""",
    "stream_running_mean": f"""
        SELECT sensor_id, COUNT(*) AS readings, {MEAN} AS avg_temperature FROM ({READINGS}) GROUP BY 1""",
    "stream_restart": f"""
        SELECT sensor_id, COUNT(*) AS readings, {MEAN} AS avg_temperature, 8::BIGINT AS batches, 1::BIGINT AS brought_twice
        FROM ({READINGS}) GROUP BY 1""",
    "stream_batches": """
        SELECT COUNT(*) AS messages, CAST(CEIL(COUNT(*) / 10) AS BIGINT) AS batches, LEAST(COUNT(*), 10) AS largest,
               COUNT(*) // 10 AS full_batches FROM events WHERE event_id % 101 = 0""",
    "stream_gaps": """
        WITH e AS (
            SELECT 'u_' || user_id AS key, event_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id) AS n,
                   event_id % 50 = 7 AS lost, event_id % 10 = 3 AS second FROM events),
        h AS (
            SELECT key, MAX(n) FILTER (NOT lost) AS highest, MAX(n) FILTER (NOT lost AND NOT second) AS at_first,
                   COUNT(*) FILTER (NOT lost AND event_id % 40 = 0) AS copies FROM e GROUP BY 1),
        m AS (SELECT key, n, n - ROW_NUMBER() OVER (PARTITION BY key ORDER BY n) AS island FROM e JOIN h USING (key) WHERE lost AND n < highest),
        g AS (SELECT key, MIN(n) AS a, MAX(n) AS b FROM m GROUP BY key, island)
        SELECT key, highest, COALESCE((SELECT SUM(b - a + 1) FROM g WHERE g.key = h.key), 0)::BIGINT AS missing,
               COALESCE((SELECT STRING_AGG(a || '-' || b, ',' ORDER BY a) FROM g WHERE g.key = h.key), '') AS gaps,
               (SELECT COUNT(*) FROM e WHERE e.key = h.key AND second AND NOT lost AND n < at_first) AS late, copies, FALSE AS closed
        FROM h WHERE highest IS NOT NULL""",
    "stream_session_summary": f"""
        SELECT sensor_id, COUNT(*) AS readings, {_mean_rounded(3)} AS avg_temperature
        FROM ({READINGS}) WHERE student = 's1' GROUP BY 1""",
    "stream_tumbling": f"""
        SELECT DATE_TRUNC('day', "at")::TIMESTAMP AS window_start, sensor_id, COUNT(*) AS readings, {MEAN} AS avg_temperature
        FROM ({READINGS}) GROUP BY 1, 2
        HAVING window_start + INTERVAL 1 DAY <= (SELECT MAX("at") - INTERVAL 1 HOUR FROM ({READINGS}))""",
    "stream_dedup": READINGS,
    "alert_messages": f"""
        SELECT student || '-' || sensor_id AS key,
               '{{"reading_id":' || reading_id || ',"student":"' || student || '","sensor_id":"' || sensor_id ||
               '","temperature_c":' || CAST(temperature_c AS VARCHAR) || '}}' AS value
        FROM ({READINGS}) WHERE temperature_c > 33""",
    "scalar_functions": f"""
        SELECT TRIM("Symbol") AS trimmed, REGEXP_REPLACE("Close", '[\\$,]', '', 'g') AS plain,
               REGEXP_MATCHES("Date", '^\\d{{2}}/\\d{{2}}/\\d{{4}}$') AS is_us_date,
               REGEXP_REPLACE("Date", '(\\d{{2}})/(\\d{{2}})/(\\d{{4}})', '\\3-\\1-\\2') AS iso_date,
               d AS day, YEAR(d) AS year, CAST(d + INTERVAL 30 DAYS AS DATE) AS due, 30::BIGINT AS days,
               NULLIF("Close", 'N/A') AS close_text,
               COALESCE(TRY_CAST(REGEXP_REPLACE(NULLIF("Close", 'N/A'), '[\\$,]', '', 'g') AS DOUBLE), 0.0) AS close,
               ABS(COALESCE(TRY_CAST(NULLIF("Change_Pct", '-') AS DOUBLE), 0.0)) AS move,
               CAST(CAST("Volume" AS BIGINT) % 1000 AS BIGINT) AS odd_lot,
               CASE WHEN "Close" = 'N/A' THEN 'missing' ELSE 'priced' END AS state
        FROM (SELECT *, CAST(CASE WHEN "Date" LIKE '%/%' THEN STRPTIME("Date", '%m/%d/%Y') ELSE STRPTIME("Date", '%Y-%m-%d') END AS DATE) AS d
              FROM ({PRICES}))""",
}

