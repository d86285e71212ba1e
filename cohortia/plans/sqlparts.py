"""Reusable oracle SQL fragments (DuckDB dialect), composed by the q_* modules."""

from __future__ import annotations


def user_day_activity_sql(where: str = "TRUE") -> str:
    """Full outer join of per-user-day feed and message aggregates, 0-filled."""
    return f"""
SELECT COALESCE(f.user_id, m.user_id) AS user_id, COALESCE(f.day, m.day) AS day,
       CAST(COALESCE(f.views, 0) AS BIGINT) AS views,
       CAST(COALESCE(f.likes, 0) AS BIGINT) AS likes,
       CAST(COALESCE(m.messages, 0) AS BIGINT) AS messages
FROM (SELECT user_id, CAST(time AS DATE) AS day,
             count(post_id) FILTER (WHERE action = 'view') AS views,
             count(post_id) FILTER (WHERE action = 'like') AS likes
      FROM feed_actions WHERE {where} GROUP BY 1, 2) f
FULL JOIN (SELECT user_id, CAST(time AS DATE) AS day, count(reciever_id) AS messages
           FROM message_actions WHERE {where} GROUP BY 1, 2) m
  ON f.user_id = m.user_id AND f.day = m.day"""


def user_slot_activity_sql(on_day: str) -> str:
    return f"""
SELECT COALESCE(f.user_id, m.user_id) AS user_id, COALESCE(f.mins_15, m.mins_15) AS mins_15,
       CAST(COALESCE(f.views, 0) AS BIGINT) AS views,
       CAST(COALESCE(f.likes, 0) AS BIGINT) AS likes,
       CAST(COALESCE(m.messages, 0) AS BIGINT) AS messages
FROM (SELECT user_id, time_bucket(INTERVAL '15 minutes', time) AS mins_15,
             count(post_id) FILTER (WHERE action = 'view') AS views,
             count(post_id) FILTER (WHERE action = 'like') AS likes
      FROM feed_actions WHERE CAST(time AS DATE) = DATE '{on_day}' GROUP BY 1, 2) f
FULL JOIN (SELECT user_id, time_bucket(INTERVAL '15 minutes', time) AS mins_15,
                  count(reciever_id) AS messages
           FROM message_actions WHERE CAST(time AS DATE) = DATE '{on_day}' GROUP BY 1, 2) m
  ON f.user_id = m.user_id AND f.mins_15 = m.mins_15"""


STATUS_CASE = """CASE WHEN messages = 0 THEN 'feed_only'
     WHEN messages > 0 AND views + likes = 0 THEN 'messenger_only'
     WHEN messages > 0 AND views + likes > 0 THEN 'feed+messenger' ELSE ' ' END"""
