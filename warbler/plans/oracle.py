"""Independent DuckDB SQL for each registered query (the correctness oracle).

Each statement repeats the event → record derivation as CTEs over the ``events`` view, then
parses with DuckDB's own regex engine, so nothing is shared with the Spark code path.
DuckDB lists are 1-based; string literals keep backslashes, so ``\\n``/``\\t`` in patterns reach
the regex engine; plain strings use chr(9)/chr(10).
"""

from __future__ import annotations

_BASE = r"""
WITH RECURSIVE ev AS (
  SELECT event_id, user_id, ts,
         regexp_extract(props, '(\d+)', 1) AS k,
         CASE event_type WHEN 'purchase' THEN 'Youtube' WHEN 'click' THEN 'IranElections'
              WHEN 'view' THEN 'iranians' WHEN 'signup' THEN 'H1N1'
              WHEN 'error' THEN 'Oklahama' END AS tag,
         CASE WHEN event_id % 3 = 0 THEN 'H1N1' ELSE 'iranians' END AS tag2
  FROM events),
records AS (
  SELECT
    CASE WHEN event_id % 103 = 7 THEN chr(10) ELSE '' END
    || CASE WHEN event_id = 0 THEN 'total number:' || (SELECT count(*) FROM events) || chr(10)
         ELSE '' END
    || 'T' || chr(9) || strftime(ts, '%Y-%m-%d %H:%M:%S') || chr(10)
    || 'U' || chr(9) || CASE WHEN event_id % 97 = 0 THEN 'http://example.com/'
                             WHEN event_id % 7 = 0 THEN 'http://www.twitter.com/'
                             ELSE 'http://twitter.com/' END || 'u' || user_id
    || CASE WHEN event_id % 101 = 50 THEN '' ELSE chr(10) || 'W' || chr(9) || CASE event_id % 10
        WHEN 0 THEN 'No Post Title'
        WHEN 1 THEN 'plain words'
        WHEN 2 THEN 'tag only #' || tag
        WHEN 3 THEN 'mention only @u' || k
        WHEN 4 THEN 'hi @u' || k || ' and @u' || (user_id % 13) || ' #' || tag || ' #' || tag2
        WHEN 5 THEN 'mail a@u' || k || '.example #' || tag || ' #' || tag
        WHEN 6 THEN 'bare # and @ signs'
        ELSE 'RT @u' || k || CASE WHEN event_id % 11 = 3 THEN ': #café #' ELSE ': #' END || tag
             || ' end' END END AS value
  FROM ev),
lined AS (
  SELECT value, trim(value, chr(10)) AS body FROM records),
parsed AS (
  SELECT value, body,
    string_split(body, chr(10))[CASE WHEN starts_with(body, 'total') THEN 4 ELSE 3 END] AS msg,
    CASE WHEN regexp_extract(value, '\nU\thttp.*twitter.com/(\w+)\n', 1) = '' THEN '?????'
         ELSE regexp_extract(value, '\nU\thttp.*twitter.com/(\w+)\n', 1) END AS username,
    regexp_extract_all(value, '@(\w+)', 1) AS mentions,
    regexp_extract_all(value, '#(\w+)', 1) AS hashtags
  FROM lined),
marked AS (
  SELECT * FROM parsed WHERE coalesce(contains(msg, '#') AND contains(msg, '@'), false)),
tweets AS (
  SELECT username, h AS hashtag, m AS mention
  FROM marked, unnest(mentions) AS t1(m), unnest(hashtags) AS t2(h)),
typed AS (
  SELECT CASE WHEN contains(value, 'W' || chr(9) || 'No Post Title') THEN 'bad' ELSE 'good' END
         AS record_type
  FROM records),
topic_graph AS (
  SELECT least(username, m) AS src, greatest(username, m) AS dst, count(*) AS weight
  FROM parsed, unnest(mentions) AS t(m)
  WHERE regexp_matches(value, '#H1N1[^\w]') AND username <> m
  GROUP BY 1, 2),
mention_lists AS (
  SELECT mention, string_agg(DISTINCT username, ',' ORDER BY username) AS usernames
  FROM tweets WHERE hashtag = 'H1N1' GROUP BY mention),
ie AS (
  SELECT username, count(mention) AS iranElectionsMentionNumber
  FROM tweets WHERE hashtag = 'IranElections' GROUP BY username),
ir AS (
  SELECT username, count(mention) AS iraniansMentionNumber
  FROM tweets WHERE hashtag = 'iranians' GROUP BY username)
"""

_TAIL = {
    "scan_records": "SELECT value FROM records",
    "scan_header_record": "SELECT value, msg AS message FROM parsed WHERE starts_with(body, 'total')",
    "scan_parquet": "SELECT username, hashtag, mention FROM tweets",
    "scan_edge_list": "SELECT src, dst, CAST(weight AS DOUBLE) AS weight FROM topic_graph",
    "typed_tweet_table": "SELECT username, hashtag, mention FROM tweets",
    "temp_view_sql": "SELECT username, hashtag, mention FROM tweets",
    "sink_parquet": "SELECT mention, usernames FROM mention_lists",
    "sink_csv": "SELECT mention, usernames FROM mention_lists",
    "sink_text_pairs": "SELECT '(' || record_type || ',' || count(*) || ')' AS value "
                       "FROM typed GROUP BY record_type",
    "sink_edge_list": "SELECT src || ',' || dst || ',' || weight AS value FROM topic_graph",
    "row_counts": """
        SELECT count(*) AS records,
               count(*) FILTER (WHERE contains(value, 'W' || chr(9) || 'No Post Title'))
                 AS bad_records,
               count(*) FILTER (WHERE msg IS NULL) AS malformed_records,
               count(*) FILTER (WHERE coalesce(contains(msg, '#') AND contains(msg, '@'), false))
                 AS marked_records,
               coalesce(sum(CASE WHEN coalesce(contains(msg, '#') AND contains(msg, '@'), false)
                            THEN len(mentions) * len(hashtags) ELSE 0 END), 0)::BIGINT
                 AS tweet_rows
        FROM parsed""",
    "prefilter_marked": "SELECT value FROM marked",
    "message_text": "SELECT value, msg AS message FROM parsed",
    "parse_username": "SELECT value, username FROM parsed",
    "parse_mentions": "SELECT value, pos::BIGINT AS pos, mentions[pos + 1] AS mention "
                      "FROM parsed, range(len(mentions)) AS t(pos)",
    "parse_hashtags": "SELECT value, pos::BIGINT AS pos, hashtags[pos + 1] AS hashtag "
                      "FROM parsed, range(len(hashtags)) AS t(pos)",
    "parse_tweets": "SELECT value, username, array_to_string(mentions, ',') AS mentions, "
                    "array_to_string(hashtags, ',') AS hashtags FROM parsed",
    "tweet_table": "SELECT username, hashtag, mention FROM tweets",
    "malformed_records": "SELECT count(*) AS malformed_records FROM parsed WHERE msg IS NULL",
    "topic_users_df": "SELECT DISTINCT username FROM tweets WHERE hashtag = 'Youtube'",
    "topic_users_sql": "SELECT DISTINCT username FROM tweets WHERE hashtag LIKE 'Youtube'",
    "topic_mentions_iranelections": "SELECT username, iranElectionsMentionNumber FROM ie",
    "topic_mentions_iranians": "SELECT username, iraniansMentionNumber FROM ir",
    "topic_join_df": "SELECT ie.iranElectionsMentionNumber, ir.username, ir.iraniansMentionNumber "
                     "FROM ie JOIN ir ON ie.username = ir.username",
    "topic_join_one_scan": "SELECT ie.iranElectionsMentionNumber, ir.username, "
                           "ir.iraniansMentionNumber FROM ie JOIN ir ON ie.username = ir.username",
    "topic_join_sql": "SELECT ir.username, ie.iranElectionsMentionNumber, ir.iraniansMentionNumber "
                      "FROM ie JOIN ir ON ie.username = ir.username",
    "topic_join_top100": "SELECT ir.username, ie.iranElectionsMentionNumber, "
                         "ir.iraniansMentionNumber FROM ie JOIN ir ON ie.username = ir.username "
                         "ORDER BY ir.username LIMIT 100",
    "distinct_then_drop": "SELECT DISTINCT username, mention FROM tweets WHERE hashtag = 'H1N1'",
    "mention_user_count": "SELECT mention, count(username) AS userCount FROM tweets "
                          "WHERE (hashtag = 'H1N1' OR hashtag = 'Oklahama') GROUP BY mention",
    "mention_user_list": "SELECT mention, usernames FROM mention_lists",
    "bad_record_total": "SELECT count(*) FILTER (WHERE record_type = 'bad') AS bad_records "
                        "FROM typed",
    "record_type_counts": "SELECT record_type, count(*) AS count FROM typed GROUP BY record_type",
    "bad_records": "SELECT value FROM records "
                   "WHERE contains(value, 'W' || chr(9) || 'No Post Title')",
    "has_hashtag": r"SELECT value, regexp_matches(value, '#H1N1[^\w]')::BIGINT AS has_hashtag "
                   "FROM records",
    "mention_edges": "SELECT least(username, m) AS src, greatest(username, m) AS dst, "
                     "count(*) AS weight FROM marked, unnest(mentions) AS t(m) "
                     "WHERE username <> m GROUP BY 1, 2",
    "topic_mention_graph": "SELECT src, dst, weight FROM topic_graph",
    "graph_edges": "SELECT src, dst, CAST(weight AS DOUBLE) AS weight FROM topic_graph "
                   "UNION ALL SELECT dst AS src, src AS dst, CAST(weight AS DOUBLE) AS weight "
                   "FROM topic_graph",
    "graph_nodes": "SELECT src AS node FROM topic_graph UNION SELECT dst AS node FROM topic_graph",
}

# The edge lines of the events, and the last line of each pair.
_EVENT_GRAPH = r""",
event_lines AS (
  SELECT event_id, 'u' || user_id AS a, 'u' || regexp_extract(props, '(\d+)', 1) AS b,
         CAST(event_id % 9 + 1 AS DOUBLE) / 10 AS weight
  FROM events),
event_pairs AS (
  SELECT least(a, b) AS src, greatest(a, b) AS dst, arg_max(weight, event_id) AS weight
  FROM event_lines GROUP BY 1, 2)
"""
_BOTH_WAYS = "SELECT src, dst, weight FROM {0} WHERE src <> dst " \
             "UNION ALL SELECT dst AS src, src AS dst, weight FROM {0} WHERE src <> dst"

# Shortest paths by recursion: distances (all of them in every round, until none moves), the arcs of
# shortest paths, walks by number of hops, and dependencies by number of hops.
_CENTRALITY = """,
nodes AS MATERIALIZED (SELECT src AS node FROM {pairs} UNION SELECT dst AS node FROM {pairs}),
arcs AS MATERIALIZED (
  SELECT src, dst, CAST(weight AS DOUBLE) AS weight FROM {pairs} WHERE src <> dst
  UNION ALL SELECT dst, src, CAST(weight AS DOUBLE) FROM {pairs} WHERE src <> dst),
dist AS (
  SELECT 0 AS k, node AS s, node AS v, CAST(0 AS DOUBLE) AS d, true AS moved FROM nodes
  UNION ALL
  SELECT k + 1, s, v, min(d), bool_or(min(d) IS DISTINCT FROM max(old)) OVER ()
  FROM (SELECT k, s, v, d, d AS old FROM dist WHERE moved
        UNION ALL
        SELECT k, s, dst, d + weight, NULL FROM dist JOIN arcs ON src = v WHERE moved) AS told
  GROUP BY k, s, v),
final AS MATERIALIZED (SELECT s, v, d FROM dist WHERE NOT moved),
short AS MATERIALIZED (
  SELECT f.s, a.src AS u, a.dst AS v FROM final f JOIN arcs a ON a.src = f.v
  JOIN final g ON g.s = f.s AND g.v = a.dst WHERE f.d + a.weight = g.d),
walk AS (
  SELECT 0 AS k, node AS s, node AS v, CAST(1 AS DOUBLE) AS n FROM nodes
  UNION ALL
  SELECT k + 1, walk.s, short.v, sum(n) FROM walk JOIN short ON short.s = walk.s AND short.u = walk.v
  GROUP BY k, walk.s, short.v),
sigma AS MATERIALIZED (SELECT s, v, sum(n) AS n FROM walk GROUP BY s, v),
share AS MATERIALIZED (
  SELECT short.s, short.u, short.v, x.n / y.n AS a FROM short
  JOIN sigma x ON x.s = short.s AND x.v = short.u JOIN sigma y ON y.s = short.s AND y.v = short.v),
q AS (
  SELECT 1 AS k, s, u AS v, sum(a) AS x FROM share GROUP BY s, u
  UNION ALL
  SELECT k + 1, share.s, share.u, sum(a * x) FROM q JOIN share ON share.s = q.s AND share.v = q.v
  GROUP BY k, share.s, share.u),
scores AS (
  SELECT node, coalesce(x, 0) * CASE WHEN n > 2 THEN 1.0::DOUBLE / ((n - 1) * (n - 2)) ELSE 1 END AS b
  FROM nodes LEFT JOIN (SELECT v, sum(x) AS x FROM q WHERE s <> v GROUP BY v) AS t ON v = node,
       (SELECT count(*) AS n FROM nodes) AS c)
"""
_SCORE = "SELECT node, round(b, 9) AS betweenness FROM scores"

_TAIL |= {
    "mention_user_list_files": "SELECT mention, CAST(strlen(usernames) AS BIGINT) AS list_bytes FROM mention_lists",
    "mention_user_slices": "SELECT DISTINCT mention, username FROM tweets WHERE hashtag = 'H1N1'",
    "betweenness": _CENTRALITY.format(pairs="topic_graph") + _SCORE,
    "node_sizes": _CENTRALITY.format(pairs="topic_graph")
                  + "SELECT node, round(b, 9) AS betweenness, round(b * 5000, 5) AS node_size FROM scores",
    "event_graph_edges": _EVENT_GRAPH + _BOTH_WAYS.format("event_pairs"),
    "event_graph_nodes": _EVENT_GRAPH + "SELECT src AS node FROM event_pairs "
                         "UNION SELECT dst AS node FROM event_pairs",
    "event_graph_betweenness": _EVENT_GRAPH + _CENTRALITY.format(pairs="event_pairs") + _SCORE,
}

ORACLE_SQL: dict[str, str] = {key: _BASE + tail for key, tail in _TAIL.items()}
