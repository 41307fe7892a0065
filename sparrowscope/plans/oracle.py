"""The queries as SQL over the test tables."""

from __future__ import annotations

from ..operators.search import MIN_FAVES, MIN_RETWEETS
from ..schemas import ACCOUNT_MEANS, FEATURES, POST_DOCUMENT, POST_TOTALS, USER_DOCUMENT
from .catalog import ACCOUNTS, KEYWORDS, SEGMENTS, TOP_N


def _quoted(values) -> str:
    return ", ".join(f"'{value}'" for value in values)


# -- Views, in order of dependence ---------------------------------------------

VIEWS = {
    "posts": """
        SELECT event_id AS id, CAST(user_id AS VARCHAR) AS screen_name,
               CAST(user_id AS VARCHAR) AS user_id_str,
               CASE WHEN event_type = 'error' THEN ''
                    ELSE event_type || ', k' || CAST(k AS VARCHAR) END AS hashtags,
               CAST(floor(epoch(ts)) AS BIGINT) AS created_at,
               CASE WHEN event_type = 'error' THEN 'Unavailable'
                    ELSE CAST(k * 200 AS VARCHAR) END AS views,
               CAST(floor(value) AS BIGINT) AS favorite_count,
               k AS retweet_count, event_id % 7 AS reply_count,
               event_id % 5 AS quote_count, event_id % 3 AS bookmark_count,
               event_type = 'view' AS is_retweet, event_type = 'click' AS is_reply,
               event_type = 'signup' AS is_quoted, event_type = 'signup' AS is_quote_status,
               'https://example.com/status/' || CAST(event_id AS VARCHAR) AS url,
               CASE event_id % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'fr'
                                 WHEN 2 THEN 'de' ELSE 'es' END AS lang
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
    """,
    "users": """
        SELECT CAST(c_custkey AS VARCHAR) AS screen_name,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Business' END AS verified_type,
               c_acctbal > 0 AS verified, c_custkey % 2 = 0 AS can_dm,
               c_custkey % 3 = 0 AS can_media_tag, c_custkey % 5 = 0 AS default_profile,
               c_custkey % 11 = 0 AS has_custom_timelines,
               1500000000 + c_custkey * 3600 AS created_at,
               c_name AS description, n_name AS location,
               'https://example.com/' || CAST(c_custkey AS VARCHAR) AS profile_url,
               c_custkey % 1000 AS favourites_count, (c_custkey % 7) * 500 AS followers_count,
               CAST(trunc(abs(c_acctbal)) AS BIGINT) AS friends_count,
               CAST(c_nationkey AS BIGINT) AS listed_count, c_custkey % 50 AS media_count,
               c_custkey % 5000 AS statuses_count
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    """,
    "lagged": """
        SELECT *, created_at - lag(created_at) OVER (
                      PARTITION BY screen_name ORDER BY created_at, id) AS time_diff
        FROM posts
    """,
    "gaps": """
        SELECT *, avg(time_diff) OVER (PARTITION BY screen_name) AS average_time_diff
        FROM lagged
    """,
    "flagged": """
        SELECT * REPLACE (n_views AS views),
               CAST(time_diff AS DOUBLE) AS time_diff_seconds,
               average_time_diff AS average_time_diff_seconds,
               CAST(abs(time_diff - average_time_diff) < 300 AS INTEGER) AS time_bot,
               CAST(ratio AS FLOAT) > 50 AND CAST(n_views AS FLOAT) > 7000 AS inflated
        FROM (SELECT *, CASE WHEN favorite_count <> 0
                             THEN CAST(n_views AS DOUBLE) / favorite_count ELSE 0 END AS ratio
              FROM (SELECT *, CASE WHEN views = 'Unavailable' THEN 0
                                   ELSE TRY_CAST(views AS BIGINT) END AS n_views
                    FROM gaps))
    """,
    "scored_posts": """
        SELECT * REPLACE (make_timestamp(created_at * 1000000) AS created_at),
               ratio AS "views/like",
               CASE WHEN inflated THEN 1 ELSE 0 END AS views_score
        FROM flagged
    """,
    "signals": """
        SELECT screen_name, CAST(sum(time_bot) AS BIGINT) AS time_bot_count,
               CAST(sum(views_score) AS BIGINT) AS views_score
        FROM scored_posts GROUP BY screen_name
    """,
    "imbalance": """
        SELECT *, CASE WHEN CAST(ratio AS FLOAT) > 1 AND friends_count > 500
                       THEN 1 ELSE 0 END AS friend_score
        FROM (SELECT *, CASE WHEN followers_count <> 0
                             THEN CAST(friends_count AS DOUBLE) / followers_count
                             ELSE 0 END AS ratio FROM users)
    """,
    "scored": """
        SELECT u.* REPLACE (make_timestamp(u.created_at * 1000000) AS created_at,
                            coalesce(u.verified_type, 'none') AS verified_type),
               coalesce(s.time_bot_count, 0) AS time_bot_count, s.views_score,
               u.ratio AS "following/follower",
               u.friend_score + s.views_score + coalesce(s.time_bot_count, 0) AS bot_score
        FROM imbalance u LEFT JOIN signals s ON u.screen_name = s.screen_name
    """,
    "threshold": """
        SELECT quantile_disc(bot_score, 0.75) AS threshold FROM scored
    """,
    "classified": """
        SELECT * REPLACE (
            CASE WHEN verified_type = 'none' AND bot_score >= threshold AND NOT verified
                 THEN 'bot'
                 WHEN verified_type = 'none' AND bot_score >= threshold AND verified
                 THEN 'project'
                 WHEN verified_type = 'none' AND bot_score < threshold AND NOT verified
                 THEN 'default_user'
                 WHEN verified_type = 'none' AND bot_score < threshold AND verified
                 THEN 'KOL'
                 ELSE verified_type END AS verified_type)
        FROM scored, threshold
    """,
    "segment": f"""
        SELECT {", ".join(f'"{c}" AS user_{c.replace("/", "_")}' for c in USER_DOCUMENT)}
        FROM classified WHERE verified_type IN ({_quoted(SEGMENTS)})
    """,
    "metrics": f"""
        SELECT p.screen_name, count(p.id) AS tweet_count,
               {", ".join(f"CAST(sum(p.{c}) AS BIGINT) AS total_{c}" for c in POST_TOTALS)},
               {", ".join(f"avg({c}) AS {c}" for c in ACCOUNT_MEANS)}
        FROM scored_posts p JOIN segment s ON p.screen_name = s.user_screen_name
        GROUP BY p.screen_name
    """,
    "search": """
        SELECT doc_id AS id, text, lang, n_chars % 500 AS favorite_count,
               doc_id % 40 AS retweet_count
        FROM documents
    """,
    "hits": f"""
        SELECT keyword, s.*
        FROM search s, (SELECT unnest([{_quoted(KEYWORDS)}]) AS keyword)
        WHERE contains(lower(text), lower(keyword))
          AND favorite_count >= {MIN_FAVES} AND retweet_count >= {MIN_RETWEETS}
    """,
    "turns": """
        SELECT *, conv_id || '-' || turn AS id, conv_id || '-0' AS conversation,
               'author' || (conv_id % 20) AS author,
               CASE WHEN conv_id % 5 <> 0 THEN 'en' ELSE 'fr' END AS lang,
               1700000000 + conv_id * 1000 + turn AS posted_at
        FROM conversations
    """,
    "singles": """
        SELECT *, CASE WHEN conv_id % 2 = 1 THEN 1 WHEN conv_id % 8 = 0 THEN 0
                       ELSE 2 END AS phase
        FROM turns WHERE conv_id % 2 = 1 OR conv_id % 4 = 0
    """,
    "kept": """
        SELECT * FROM turns
        WHERE (conv_id % 2 = 1 AND turn = 0) OR (conv_id % 8 = 0 AND turn = 0)
           OR (conv_id % 2 = 0 AND conv_id % 8 <> 0)
    """,
}


def _sql(select: str) -> str:
    views = ",\n".join(f"{name} AS ({body})" for name, body in VIEWS.items())
    return f"WITH {views}\n{select}"


def _columns(names) -> str:
    return ", ".join(f'"{name}"' for name in names)


def _summary_row(label: str, expression: str) -> str:
    names = ["followers_count", "friends_count", "time_bot_count", "views_score", "bot_score"]
    values = ", ".join(
        f"round(CAST({expression.format(name)} AS DOUBLE), 6) AS {name}" for name in names
    )
    return f"SELECT '{label}' AS summary, {values} FROM scored"


_SCANNED = """
    SELECT id, text, conversation, NULL AS thread_ids, NULL AS thread_size FROM singles
    UNION ALL
    SELECT NULL, NULL, NULL, string_agg(id, ',' ORDER BY turn), CAST(count(*) AS INTEGER)
    FROM turns WHERE conv_id % 2 = 0 GROUP BY conv_id
    """

SELECTS = {
    "classify_accounts": f"SELECT {_columns(USER_DOCUMENT)} FROM classified",
    "account_scores": f"SELECT {_columns(USER_DOCUMENT)} FROM scored",
    "account_signals": "SELECT * FROM signals",
    "posting_gaps": """
        SELECT id, screen_name, created_at, time_diff, average_time_diff, time_diff_seconds,
               average_time_diff_seconds, time_bot
        FROM flagged
    """,
    "regularity_count": "SELECT screen_name, time_bot_count FROM signals",
    "view_inflation": """
        SELECT id, screen_name, views, "views/like" AS views_per_like, views_score
        FROM scored_posts
    """,
    "account_view_flags": "SELECT screen_name, views_score FROM signals",
    "follow_imbalance": """
        SELECT screen_name, ratio AS following_follower, friend_score FROM imbalance
    """,
    "score_threshold": "SELECT threshold FROM threshold",
    "sketched_threshold": "SELECT count(bot_score) AS scores, true AS within FROM scored",
    "summary_stats": " UNION ALL ".join(
        [
            _summary_row("count", "count({})"),
            _summary_row("mean", "avg({})"),
            _summary_row("stddev", "stddev_samp({})"),
            _summary_row("min", "min({})"),
            _summary_row("25%", "quantile_disc({}, 0.25)"),
            _summary_row("50%", "quantile_disc({}, 0.5)"),
            _summary_row("75%", "quantile_disc({}, 0.75)"),
            _summary_row("max", "max({})"),
        ]
    ),
    "class_counts": """
        SELECT verified_type, count(*) AS accounts FROM classified GROUP BY verified_type
    """,
    "safe_ratio": "SELECT screen_name, ratio FROM imbalance",
    "sentinel_to_number": "SELECT id, views FROM flagged",
    "parse_epoch": """
        SELECT id, created_at AS raw_seconds, created_at AS iso_seconds FROM posts
    """,
    "epoch_to_timestamp": """
        SELECT event_id AS id, date_trunc('second', ts) AS created_at FROM events
    """,
    "join_array_text": "SELECT id, hashtags FROM posts",
    "scan_parquet": "SELECT * FROM events",
    "scan_json_array": _SCANNED,
    "scan_json_array_ranges": _SCANNED,
    "sink_parquet": f"SELECT {_columns(POST_DOCUMENT)} FROM scored_posts",
    "sink_published": f"SELECT {_columns(POST_DOCUMENT)} FROM scored_posts",
    "sink_json_by_keyword": "SELECT * FROM hits",
    "index_documents_users": f"""
        SELECT screen_name AS key, {_columns(USER_DOCUMENT)} FROM classified
    """,
    "index_documents_posts": f"""
        SELECT CAST(id AS VARCHAR) AS key, {_columns(POST_DOCUMENT)} FROM scored_posts
    """,
    "bulk_request_lines": """
        SELECT 'posts' AS target, CAST(id AS VARCHAR) AS target_id, NULL AS id, NULL AS screen_name,
               NULL AS views FROM scored_posts
        UNION ALL
        SELECT NULL, NULL, id, screen_name, views FROM scored_posts
    """,
    "kafka_messages": """
        SELECT screen_name, CAST(floor(created_at / 86400.0) AS BIGINT) AS part,
               string_agg(CAST(id AS VARCHAR), ',' ORDER BY created_at, id) AS ids
        FROM posts GROUP BY ALL
    """,
    "reject_messages": """
        SELECT id AS message, substr('[{"id":' || id || ',"screen_name":"' || screen_name || '"}]', 1, 12)
               AS rejected
        FROM posts WHERE id % 10 = 0
    """,
    "join_first_versions": """
        SELECT p.id, p.screen_name, s.followers_count AS user_followers_count, 1 AS crawl
        FROM scored_posts p JOIN scored s ON p.screen_name = s.screen_name
    """,
    "metrics_first_versions": """
        SELECT p.screen_name, count(p.id) AS tweet_count,
               CAST(any_value(s.followers_count) AS DOUBLE) AS user_followers_count
        FROM scored_posts p JOIN scored s ON p.screen_name = s.screen_name GROUP BY p.screen_name
    """,
    "json_roundtrip": "SELECT id, screen_name, hashtags, views, is_reply FROM posts",
    "drop_columns": "SELECT * FROM users",
    "prefix_columns": f"""
        SELECT {", ".join(f'"{c}" AS user_{c.replace("/", "_")}' for c in USER_DOCUMENT)}
        FROM scored
    """,
    "fill_null_label": """
        SELECT screen_name, coalesce(verified_type, 'none') AS verified_type, location FROM users
    """,
    "fill_null_strings": """
        SELECT screen_name, coalesce(verified_type, 'none') AS verified_type,
               coalesce(nullif(location, 'NATION_3'), 'none') AS location,
               nullif(media_count, 7) AS media_count
        FROM users
    """,
    "extract_paths": """
        SELECT id, phase, conversation AS conversation_id_str, turn AS reply_count,
               author AS screen_name, CAST(NULL AS VARCHAR) AS nickname
        FROM singles
        UNION ALL
        SELECT NULL, 1, NULL, NULL, NULL, NULL
        FROM (SELECT DISTINCT conv_id FROM turns WHERE conv_id % 2 = 0)
    """,
    "extract_json_paths": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
               json_extract_string(props, '$.a.absent') AS absent
        FROM events
    """,
    "optional_field": """
        SELECT id, phase, CASE WHEN conv_id % 3 = 0 THEN 'Business' END AS verified_type,
               'none' AS verified_type_class
        FROM singles
        UNION ALL
        SELECT NULL, 1, NULL, 'none' FROM (SELECT DISTINCT conv_id FROM turns WHERE conv_id % 2 = 0)
    """,
    "filter_segment": f"""
        SELECT screen_name, verified_type, bot_score FROM classified
        WHERE verified_type IN ({_quoted(SEGMENTS)})
    """,
    "filter_lang": "SELECT * FROM search WHERE lang = 'en'",
    "skip_first_rows": """
        SELECT id, screen_name
        FROM (SELECT *, row_number() OVER (ORDER BY id) AS n FROM posts)
        WHERE n > 1
    """,
    "union_common_columns": """
        SELECT * EXCLUDE (lang) FROM posts WHERE id % 2 = 0
        UNION ALL
        SELECT * EXCLUDE (lang, n)
        FROM (SELECT *, row_number() OVER (ORDER BY id) AS n FROM posts WHERE id % 2 = 1)
        WHERE n > 1
    """,
    "distinct_rows": "SELECT DISTINCT text, lang FROM documents",
    "first_per_key": """
        SELECT screen_name, id, created_at, url
        FROM (SELECT *, row_number() OVER (PARTITION BY screen_name
                                           ORDER BY created_at, id) AS n FROM posts)
        WHERE n = 1
    """,
    "dedup_conversations": "SELECT id, text, conversation FROM kept",
    "crawl_conversations": "SELECT id, text, conversation FROM kept",
    "flatten_threads": "SELECT id, text FROM turns WHERE conv_id % 2 = 0",
    "dedup_audit": """
        SELECT (SELECT count(*) FROM singles)
                 + (SELECT count(DISTINCT conv_id) FROM turns WHERE conv_id % 2 = 0)
                 AS records_in,
               (SELECT count(*) FROM kept) AS posts_out, 0 AS without_key
    """,
    "flat_posts": """
        SELECT id, author AS screen_name, role AS hashtags, lang, posted_at AS created_at,
               turn AS reply_count, NULL AS bookmark_count, NULL AS favorite_count,
               NULL AS is_quote_status, NULL AS quote_count, NULL AS retweet_count,
               NULL AS user_id_str, NULL AS is_retweet, NULL AS is_quoted, NULL AS is_reply,
               NULL AS views, NULL AS url
        FROM kept WHERE lang = 'en'
    """,
    "flat_users": """
        SELECT author AS screen_name,
               CASE WHEN conv_id % 3 = 0 THEN 'Business' ELSE 'none' END AS verified_type,
               'none' AS location, 1500000000 + conv_id AS created_at,
               conv_id * 10 + turn AS statuses_count, NULL AS media_count, NULL AS verified,
               NULL AS can_dm, NULL AS can_media_tag, NULL AS default_profile,
               NULL AS has_custom_timelines, 'none' AS description, 'none' AS profile_url,
               NULL AS favourites_count, NULL AS followers_count, NULL AS friends_count,
               NULL AS listed_count, NULL AS fast_followers_count, NULL AS is_translator,
               'none' AS translator_type, NULL AS want_retweets, NULL AS protected
        FROM (SELECT *, row_number() OVER (PARTITION BY author ORDER BY conv_id, turn) AS n
              FROM kept WHERE lang = 'en')
        WHERE n = 1
    """,
    "engagement_search": "SELECT * FROM hits",
    "indexed_search": "SELECT * FROM hits",
    "top_posts_per_keyword": f"""
        SELECT keyword, CAST(n AS INTEGER) AS rank, id, favorite_count
        FROM (SELECT *, row_number() OVER (PARTITION BY keyword
                                           ORDER BY favorite_count DESC, id) AS n FROM hits)
        WHERE n <= {TOP_N}
    """,
    "account_timeline": f"SELECT * FROM posts WHERE screen_name IN ({_quoted(ACCOUNTS)})",
    "join_posts_accounts": """
        SELECT p.id, p.screen_name, p.favorite_count, p.views, s.user_verified_type,
               s.user_bot_score, s.user_following_follower
        FROM scored_posts p JOIN segment s ON p.screen_name = s.user_screen_name
    """,
    "account_metrics": "SELECT * FROM metrics",
    "colocated_metrics": "SELECT * FROM metrics",
    "maintained_metrics": "SELECT * FROM metrics",
    "feature_vectors": f"""
        SELECT screen_name, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURES)}
        FROM metrics
    """,
    "scaled_features": f"""
        SELECT screen_name, {", ".join(
            f"round(CASE WHEN stddev_samp({c}) OVER () > 0 "
            f"THEN {c} / stddev_samp({c}) OVER () ELSE 0 END, 6) AS {c}" for c in FEATURES)}
        FROM metrics
    """,
    "stream_decode": "SELECT * FROM posts",
    "stream_dedup": "SELECT DISTINCT conversation AS conversation_key FROM turns",
    "stream_rescore": "SELECT * FROM signals",
    "stream_regularity": "SELECT * FROM signals",
}

ORACLE = {name: _sql(select) for name, select in SELECTS.items()}
