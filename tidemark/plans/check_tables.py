"""The domain tables once more, as SQL for the checks, written independently."""

from __future__ import annotations

import re

TABLES: dict[str, str] = {
    "interactions": """
        SELECT event_id, user_id,
          CASE WHEN event_type = 'signup' THEN NULL ELSE (props->>'$.k')::BIGINT END AS movie_id,
          ts AS "timestamp",
          CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'view' WHEN 'purchase' THEN 'rating'
            WHEN 'error' THEN 'skip' ELSE 'search' END AS event_type,
          CASE WHEN event_type IN ('view','click') AND event_id % 41 <> 0 THEN floor(value * 60)::BIGINT END AS watch_time_seconds,
          CASE WHEN event_type = 'purchase' OR (event_type IN ('view','click') AND event_id % 3 = 0)
            THEN (1 + event_id % 5)::INTEGER END AS rating,
          CASE WHEN event_type = 'error' THEN floor(value * 10)::BIGINT END AS watch_duration_seconds
        FROM events""",
    "items": """
        SELECT p_partkey AS movie_id, p_name AS title, [p_type, p_brand] AS genres,
          (DATE '2011-01-01' + (p_partkey * 20 % 5000)::INTEGER)::TIMESTAMP AS release_date,
          3600 + p_size * 60 AS duration_seconds
        FROM part""",
    "users": """
        SELECT c_custkey AS user_id,
          CASE c_custkey % 5 WHEN 0 THEN '18-24' WHEN 1 THEN '25-34' WHEN 2 THEN '35-44'
            WHEN 3 THEN '45-54' ELSE '55+' END AS age_group,
          r_name AS region
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "requests": """
        SELECT event_id, ts,
          CASE WHEN event_type IN ('click','view') THEN '/recommend/user_' || user_id
            WHEN event_type = 'purchase' THEN '/events/ratings/' || event_id
            WHEN event_type = 'error' THEN '/users/' || user_id || '/skips' ELSE '/health' END AS path,
          CASE WHEN event_type IN ('click','view') THEN '/{recommend_id}'
            WHEN event_type = 'purchase' THEN '/events/{rating_id}'
            WHEN event_type = 'error' THEN '/{user_id}/skips' ELSE '/health' END AS endpoint,
          CASE WHEN event_type IN ('click','view','signup') THEN 'GET' ELSE 'POST' END AS method,
          CASE WHEN event_type = 'error' THEN 500 WHEN event_id % 50 = 7 THEN 404 ELSE 200 END AS status,
          value / 1000 AS duration_s,
          CASE event_type WHEN 'click' THEN true WHEN 'view' THEN false END AS cached,
          CASE WHEN event_type IN ('click','view') THEN
            CASE event_id % 3 WHEN 0 THEN 'recommendation' WHEN 1 THEN 'retrieval' ELSE 'ranking' END END AS stage,
          CASE WHEN event_type = 'view' AND (props->>'$.k')::BIGINT < 10 THEN 'trending'
            WHEN event_type = 'view' AND (props->>'$.k')::BIGINT < 20 THEN 'popular' END AS fallback_type,
          CASE WHEN event_type IN ('click','view') THEN (props->>'$.k')::DOUBLE / 100 END AS score
        FROM events""",
    "gauges": """
        SELECT ts,
          CASE event_type WHEN 'view' THEN 'up' WHEN 'click' THEN 'memory_percent'
            WHEN 'purchase' THEN 'cpu_percent' WHEN 'error' THEN 'restarts' ELSE 'other' END AS metric,
          'svc-' || (user_id % 4) AS instance,
          CASE WHEN event_type = 'view' THEN (CASE WHEN (props->>'$.k')::BIGINT < 20 THEN 0 ELSE 1 END)::DOUBLE
            WHEN event_type = 'error' THEN event_id::DOUBLE
            ELSE ((props->>'$.k')::BIGINT + 1)::DOUBLE END AS value
        FROM events""",
    "predictions": """
        SELECT d.source AS user_id, d.doc_id AS item_id, least(d.n_chars / 20000.0::DOUBLE, 1.0::DOUBLE) AS score,
          l.quality AS label
        FROM documents d JOIN labels l USING (doc_id)""",
}

_NAMED = re.compile(r"\b([a-z_0-9]+)\b")


def add_table(name: str, sql: str) -> None:
    """Add a named table other checks may use; it may use tables added before it."""
    TABLES[name] = sql


def with_tables(sql: str) -> str:
    """Prefix ``sql`` with the named tables it uses, in definition order."""
    needed: set[str] = set()
    queue = [sql]
    while queue:
        for word in set(_NAMED.findall(queue.pop())):
            if word in TABLES and word not in needed:
                needed.add(word)
                queue.append(TABLES[word])
    body = sql.strip()
    ctes = [f'{name} AS ({TABLES[name].strip()})' for name in TABLES if name in needed]
    if not ctes:
        return body
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body
