"""Independent SQL for the queries, run by DuckDB over the same tables."""

from __future__ import annotations

from lectern import rules

# White space, terminal escapes and control characters as RE2 writes them.
WS = r"[\s\x0B\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
ANSI = r"[\x{1B}\x{9B}][\[()#;?]*(?:[0-9]{1,4}(?:;[0-9]{0,4})*)?[0-9A-ORZcf-nqry=><]"
CONTROL = r"[\x01-\x08\x0B\x0C\x0E-\x1F\x7F-\x{9F}]"


def q(s: str) -> str:
    """SQL text literal."""
    return "'" + s.replace("'", "''") + "'"


def trim(e: str) -> str:
    return f"regexp_replace({e}, '^{WS}+|{WS}+$', '', 'g')"


def pieces(e: str) -> str:
    """Pieces after splitting at white space; an empty text is one piece."""
    return f"len(string_split_regex({e}, '{WS}+'))"


def template(t: str, **values: str) -> str:
    e = q(t)
    for name, sql in values.items():
        e = f"replace({e}, '{{{name}}}', {sql})"
    return e


def case(n: str, options: list[str]) -> str:
    return f"CASE {n} " + " ".join(f"WHEN {i} THEN {o}" for i, o in enumerate(options)) + " END"


IST = "INTERVAL '5 hours 30 minutes'"

TOPICS = """topics AS (
  SELECT o_orderkey AS topic_id, o_orderpriority AS stream, 'S' || (o_custkey % 7) AS subject,
    'C' || (o_custkey % 29) AS chapter, 'topic ' || o_orderkey AS topic,
    CASE o_orderstatus WHEN 'P' THEN 'Pending' WHEN 'O' THEN 'In Progress' ELSE 'Completed' END AS status,
    o_orderdate AS created_time
  FROM orders)"""

CATALOG = """cat AS (SELECT p_partkey AS topic_id, 'catalog' AS stream, p_brand AS subject, p_type AS chapter, p_name AS topic FROM part)"""

WORDS = f"""docw AS (SELECT doc_id, CASE WHEN {trim('text')} = '' THEN [] ELSE string_split_regex({trim('text')}, '{WS}+') END AS w FROM documents),
words AS (
  SELECT doc_id, i AS word_idx, w[i + 1] AS word, round(i / 2.5, 3) AS start_s, round((i + 1) / 2.5, 3) AS end_s
  FROM (SELECT doc_id, w, unnest(range(len(w)))::INTEGER AS i FROM docw))"""

SEGMENTS = f"""segs AS (
  SELECT doc_id, s AS seg_id, round(s * 10 / 2.5, 3) AS start_s, round(least((s + 1) * 10, len(w)) / 2.5, 3) AS end_s,
    array_to_string(w[s * 10 + 1 : s * 10 + 10], ' ') AS text, len(w[s * 10 + 1 : s * 10 + 10])::INTEGER AS n_words
  FROM (SELECT doc_id, w, unnest(range((len(w) + 9) // 10))::INTEGER AS s FROM docw))"""

SCENES = """sizes AS (SELECT doc_id, len(w) AS n_words, len(w) / 2.5 AS total_s, 7.3::DOUBLE + (doc_id % 5) * 0.37::DOUBLE AS gap FROM docw),
scn0 AS (SELECT *, floor(total_s / gap)::INTEGER AS n FROM sizes),
scenes AS (
  SELECT doc_id, k AS scene_idx, round(k * gap, 3) AS start_s,
    round(CASE WHEN k = n THEN greatest(0.0, total_s - 3.0) ELSE (k + 1) * gap END, 3) AS end_s, k = n AS is_last, n_words
  FROM (SELECT *, unnest(range(n + 1))::INTEGER AS k FROM scn0))"""

RESULTS = f"""results AS (
  SELECT conv_id AS query_id, turn AS rank,
    CASE WHEN conv_id % 5 = 0 AND turn = 0 THEN 'youtube#playlist' ELSE 'youtube#video' END AS kind,
    CASE WHEN conv_id % 5 = 0 AND turn = 0 THEN 'PL' || (conv_id % 20) END AS playlist_id,
    text || CASE conv_id % 4 WHEN 0 THEN '' WHEN 1 THEN ' Part 1' WHEN 2 THEN ' Episode ' || turn ELSE ' complete' END AS title
  FROM conversations),
decided AS (
  SELECT c_custkey AS topic_id, c_name AS topic, c_mktsegment AS chapter, 'K' || (c_nationkey % 5) AS stream, 'N' || c_nationkey AS subject, coalesce(n, 0) AS n_results, coalesce(series, 0) AS series_count,
    CASE WHEN n IS NULL THEN 'No results' WHEN kind = 'youtube#playlist' THEN 'Top result is a playlist'
      WHEN contains(t0, 'part 1') OR contains(t0, 'ep 1') OR contains(t0, 'episode 1') THEN 'Top result is Part 1 of a series'
      WHEN series >= 3 THEN series || '/5 results suggest a multi-part topic' ELSE 'Topic is self-contained' END AS reason,
    CASE WHEN kind = 'youtube#playlist' THEN playlist_id END AS playlist_id
  FROM customer LEFT JOIN (
    SELECT query_id, count(*) AS n, count(*) FILTER (regexp_matches(lower(title), '{rules.SERIES_PATTERN}')) AS series,
      max(kind) FILTER (rank = 0) AS kind, max(playlist_id) FILTER (rank = 0) AS playlist_id, lower(max(title) FILTER (rank = 0)) AS t0
    FROM results WHERE rank < 5 GROUP BY 1) ON query_id = c_custkey),
strategies AS (SELECT *, CASE WHEN reason IN ('No results', 'Topic is self-contained') THEN 'single' ELSE 'branch' END AS strategy FROM decided)"""


def stats(channel: str) -> str:
    return f"""stats AS (SELECT {channel} AS channel, event_id AS video_id, ts AS published_at, CAST(round(value * 100) AS BIGINT) AS views FROM events)"""


def profile(hour: str) -> str:
    return f"""byh AS (SELECT channel, CAST({hour} AS INTEGER) AS hour, sum(views) AS v, count(*) AS n FROM stats GROUP BY 1, 2),
spine AS (SELECT channel, unnest(range(24))::INTEGER AS hour FROM (SELECT DISTINCT channel FROM stats)),
profile AS (
  SELECT s.channel, s.hour, (CASE WHEN s.hour % 12 = 0 THEN 12 ELSE s.hour % 12 END) || CASE WHEN s.hour < 12 THEN ' AM' ELSE ' PM' END AS label,
    CAST(coalesce(v, 0) AS BIGINT) AS views, coalesce(n, 0) AS uploads, CAST(coalesce(floor(v / n + 0.5), 0) AS BIGINT) AS avg_views
  FROM spine s LEFT JOIN byh b ON s.channel = b.channel AND s.hour = b.hour)"""


HOUR_TZ = f"hour(published_at + {IST})"
HOUR_LEGACY = "(hour(published_at) + 5) % 24"

BEST = """ranked AS (
  SELECT channel, hour, row_number() OVER (PARTITION BY channel ORDER BY views / uploads DESC, hour) AS r FROM profile WHERE uploads > 0 AND views > 0),
best AS (
  SELECT p.channel, coalesce(max(r.hour), 18)::INTEGER AS best_hour, CAST(sum(uploads) AS BIGINT) AS videos, sum(uploads) >= 3 AS has_enough
  FROM profile p LEFT JOIN ranked r ON r.channel = p.channel AND r.r = 1 GROUP BY 1)"""

LABEL = "(CASE WHEN best_hour % 12 = 0 THEN 12 ELSE best_hour % 12 END) || CASE WHEN best_hour < 12 THEN ' AM' ELSE ' PM' END"

CANDIDATES = """cand AS (SELECT user_id, round((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 3600000000, 3) AS t FROM events),
totals AS (SELECT user_id, ceil(max(t)) AS total_s FROM cand GROUP BY 1),
ok AS (SELECT DISTINCT c.user_id, t FROM cand c JOIN totals USING (user_id) WHERE t <= total_s - 3.0),
kept(user_id, scene_idx, start_s) AS (
  SELECT user_id, 0, 0.0::DOUBLE FROM totals
  UNION ALL
  SELECT k.user_id, k.scene_idx + 1, (SELECT min(t) FROM ok WHERE ok.user_id = k.user_id AND NOT t - k.start_s < 1.0)
  FROM kept k WHERE EXISTS (SELECT 1 FROM ok WHERE ok.user_id = k.user_id AND NOT t - k.start_s < 1.0))"""

_v = {"channel": "'Daily Lectures'", "topic": "topic", "subject": "subject"}
_secs = {p: f"CAST(ceil({p}_words / 2.5) AS BIGINT)" for p in ("intro", "main", "outro")}


def scripts(choice: str) -> str:
    return f"""dt AS (SELECT doc_id, lang AS stream, source AS subject, 'topic ' || doc_id AS topic, text, {choice} AS v FROM documents),
parts AS (
  SELECT doc_id, stream, subject, {case('v % 5', [template(t, **_v) for t in rules.INTROS])} AS intro, {trim('text')} AS main,
    {case('(v // 5 + v) % 5', [template(t, **_v) for t in rules.OUTROS])} AS outro FROM dt),
scripts AS (
  SELECT doc_id, stream, subject, md5(intro || chr(10) || chr(10) || main || chr(10) || chr(10) || outro) AS script_md5,
    {pieces('intro')} AS intro_words, {pieces('main')} AS main_words, {pieces('outro')} AS outro_words FROM parts)"""


def by_hash(e: str, n: int) -> str:
    return f"CAST(('0x' || substr(sha256(CAST({e} AS VARCHAR)), 1, 8)) AS BIGINT) % {n}"


SPOKEN = """spoken AS (
  SELECT doc_id, source, text || CASE doc_id % 6
    WHEN 0 THEN '. the answer is 4. it works as planned. it runs. . . what is the point of all this.'
    WHEN 1 THEN chr(10) || 'Now We go on, which means more. however it is key and Never is never.'
    WHEN 2 THEN ' and the answer is four. we''re done here...'
    WHEN 3 THEN ', but wait for it. remember this important critical step, actually always.' ELSE '' END AS text
  FROM documents)"""


def _emphasis() -> str:
    """Each rule as one more step; a run of dots hides its first one from rule two."""
    steps: list[tuple[str, str, str]] = []
    for p in rules.SUSPENSE_PHRASES:
        steps.append(("suspense", f"(?i)([,.]) ({'|'.join(p)})", r"\1 ...\2"))
    steps.append(("", rf"\.({WS}*\.(?:{WS}*\.)*)", "\x01" + r"\1"))
    for p in rules.EXCLAIM_PHRASES:
        steps.append(("exclaim", rf"(?i)\b({'|'.join(p)})([^.!?\x01]*)\.", r"\1\2!"))
    steps.append(("", r"\x01", "."))
    steps.append(("question", rf"(?i)\b({'|'.join(rules.QUESTION_PHRASES)})\b([^.!?]{{5,60}})\.", r"\1\2?"))
    steps.append(("comma", rf"(?m)^({'|'.join(rules.LINE_CONNECTORS)}) ([A-Z])", r"\1, \2"))
    steps.append(("comma", rf"(?i)\b({'|'.join(rules.MID_CONNECTORS)}) ([a-z])", r"\1, \2"))
    steps.append(("dash", rf"(?i)\b({'|'.join(rules.REVEAL_PHRASES)}) ", r"\1 — "))
    for w in rules.UPPER_WORDS:
        steps.append(("upper", rf"\b{w}\b", w.upper()))
    ctes, hits = ["e0 AS (SELECT doc_id, source, text, text AS t FROM spoken)"], {}
    hit_cols: list[str] = []
    for i, (kind, pattern, repl) in enumerate(steps):
        cols = "".join(f", {c}" for c in hit_cols)
        new = ""
        if kind:
            name = f"h{i}"
            hits.setdefault(kind, []).append(name)
            new = f", len(regexp_extract_all(t, {q(pattern)})) AS {name}"
        repl_sql = f"chr(1) || {q(repl[1:])}" if repl.startswith("\x01") else q(repl)
        ctes.append(
            f"e{i + 1} AS (SELECT doc_id, source, text{cols}{new}, regexp_replace(t, {q(pattern)}, {repl_sql}, 'g') AS t FROM e{i})"
        )
        if kind:
            hit_cols.append(name)
    sums = ", ".join(f"CAST({' + '.join(v)} AS BIGINT) AS hits_{k}" for k, v in hits.items())
    w0, w1 = pieces(trim("text")), pieces(trim("t"))
    ctes.append(f"em0 AS (SELECT doc_id, source, text, t, abs({w0} - {w1}) / {w0} AS drift, {sums} FROM e{len(steps)})")
    ctes.append("em1 AS (SELECT *, CASE WHEN drift > 0.03 THEN text ELSE t END AS out FROM em0)")
    ctes.append(
        "em AS (SELECT *, CASE WHEN out = text THEN 0 ELSE len(list_filter(list_zip(regexp_extract_all(text, '(?s).')[1:least(length(text), length(out))], "
        "regexp_extract_all(out, '(?s).')[1:least(length(text), length(out))]), lambda p: p[1] <> p[2])) + abs(length(text) - length(out)) END AS n_changes FROM em1)"
    )
    return ", ".join(ctes)


KINDS = ["suspense", "exclaim", "question", "comma", "dash", "upper"]

DIRTY = f"""dirty AS (
  SELECT doc_id, source, CASE WHEN doc_id % 97 = 5 THEN chr(7) || '  ' || chr(7)
    WHEN doc_id % 3 = 0 THEN text || chr(27) || '[31mred' || chr(27) || '[0m end'
    WHEN doc_id % 3 = 1 THEN chr(7) || ' ' || text || chr(9) ELSE text END AS a FROM documents),
cleaned AS (SELECT *, {trim(f"regexp_replace(regexp_replace(a, '{ANSI}', '', 'g'), '{CONTROL}', ' ', 'g')")} AS b FROM dirty)"""

CHUNKS = f"""sent0 AS (SELECT doc_id, text, regexp_extract_all(text, '[^.!?]+[.!?]+{WS}*|[^.!?]+$') AS s FROM documents),
sent1 AS (SELECT doc_id, CASE WHEN len(s) = 0 THEN [text] ELSE s END AS s FROM sent0),
sent AS (SELECT doc_id, unnest(range(1, len(s) + 1)) AS i, unnest(s) AS sentence FROM sent1),
cnt AS (SELECT doc_id, i, sentence, CASE WHEN {trim('sentence')} = '' THEN 0 ELSE {pieces(trim('sentence'))} END AS n FROM sent),
pack(doc_id, i, words, chunk) AS (
  SELECT doc_id, i, n, 0 FROM cnt WHERE i = 1
  UNION ALL
  SELECT c.doc_id, c.i, CASE WHEN p.words + c.n > 100 AND p.words > 0 THEN c.n ELSE p.words + c.n END,
    CASE WHEN p.words + c.n > 100 AND p.words > 0 THEN p.chunk + 1 ELSE p.chunk END
  FROM pack p JOIN cnt c ON c.doc_id = p.doc_id AND c.i = p.i + 1),
chunks0 AS (
  SELECT doc_id, chunk, {trim("string_agg(sentence, '' ORDER BY i)")} AS text, CAST(sum(n) AS INTEGER) AS n_words
  FROM pack JOIN cnt USING (doc_id, i) GROUP BY 1, 2),
chunks AS (SELECT doc_id, chunk AS chunk_idx, count(*) OVER (PARTITION BY doc_id)::INTEGER AS n_chunks, text, n_words FROM chunks0 WHERE text <> '')"""


INSTRUCT = f"""CASE {' '.join(f'WHEN p < {u} THEN {q(t)}' if u else f'ELSE {q(t)}' for u, t, _ in rules.INSTRUCT_BANDS)} END AS instruct,
          CAST(CASE {' '.join(f'WHEN p < {u} THEN {s}' if u else f'ELSE {s}' for u, _, s in rules.INSTRUCT_BANDS)} END AS DOUBLE) AS speed"""


def titles(choice: str) -> str:
    v = {n: n for n in ("topic", "subject", "chapter")}
    return f"""pick AS (SELECT *, {choice} AS formula FROM cat),
titles AS (SELECT topic_id, CAST(formula AS BIGINT) AS formula, substr({case('formula', [template(t, **v) for t in rules.TITLES])}, 1, 100) AS title FROM pick)"""


_low = {n: f"lower({n})" for n in ("topic", "subject", "chapter")}
TAG_LIST = "[" + ", ".join(template(t, **_low) for t in rules.TAGS) + "]"
TIDY = f"substr({trim(f'''regexp_replace(replace(tag, ',', ''), '{WS}{{2,}}', ' ', 'g')''')}, 1, 30)"
NAMES = """names AS (
  SELECT p_partkey, replace(p_name, ' ', CASE p_size % 4 WHEN 0 THEN ' ' WHEN 1 THEN '-' WHEN 2 THEN '/' ELSE '  ' END) || ' ' || upper(p_type) AS name FROM part)"""
SLUG3 = rf"""substr(regexp_replace(regexp_replace(regexp_replace(lower(name), '[^a-z0-9\s\-]', '', 'g'), '[\s\-]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 40)"""

ERR_CASE = (
    "CASE "
    + " ".join(
        "WHEN " + " OR ".join(f"contains(m, {q(x)})" for x in marks) + f" THEN '{name}'" for name, marks in rules.ERROR_RULES
    )
    + " ELSE 'UNKNOWN' END"
)

USER_SCHED = f"""sched AS (
  SELECT user_id AS stream, min(CAST(ts + {IST} AS DATE)) AS first_day, max(CAST(ts + {IST} AS DATE)) AS last_day,
    CAST(user_id % 24 AS INTEGER) AS hour_local, user_id % 10 <> 9 AS enabled FROM events GROUP BY user_id)"""


def slots(extra: int = 0) -> str:
    return f"""days AS (SELECT *, CAST(unnest(generate_series(first_day, last_day + INTERVAL {extra} DAY, INTERVAL 1 DAY)) AS DATE) AS local_day FROM sched),
slots AS (SELECT *, CAST(local_day AS TIMESTAMP) + to_hours(hour_local) - {IST} AS slot_at FROM days)"""


LOG_CAUSE = "CASE event_type WHEN 'error' THEN 'Gradio timed out' WHEN 'purchase' THEN 'upload refused' WHEN 'view' THEN 'ffmpeg exited' ELSE 'all well' END"
HEALTH = """hc AS (SELECT user_id AS service, max(ts) AS checked_at, arg_max(event_type <> 'error', ts) AS ok FROM events GROUP BY 1),
health AS (
  SELECT service, checked_at, (epoch_us(TIMESTAMP '2024-01-30 23:00:00') // 1000 - epoch_us(checked_at) // 1000) / 60000.0 AS age_minutes, ok FROM hc),
states AS (
  SELECT service, checked_at, round(age_minutes, 3) AS age_minutes,
    CASE WHEN age_minutes < 600 AND ok THEN 'live' WHEN age_minutes < 600 THEN 'dead' ELSE 'stale' END AS state FROM health)"""

MACHINE = """ev AS (
  SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n,
    CASE event_type WHEN 'signup' THEN 'claim' WHEN 'purchase' THEN 'complete' WHEN 'error' THEN 'fail' WHEN 'view' THEN 'reset' ELSE 'noop' END AS e FROM events
  WHERE date_trunc('milliseconds', ts) <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR FROM events)),
run(user_id, n, status, verdict) AS (
  SELECT user_id, 0::BIGINT, 'Pending', 'none' FROM (SELECT DISTINCT user_id FROM ev)
  UNION ALL
  SELECT r.user_id, ev.n,
    CASE WHEN e = 'reset' THEN 'Pending' WHEN e = 'claim' AND status = 'Pending' THEN 'In Progress'
      WHEN e = 'complete' AND status = 'In Progress' THEN 'Completed' WHEN e = 'fail' AND status = 'In Progress' THEN 'Failed' ELSE status END,
    CASE WHEN e = 'reset' OR (e = 'claim' AND status = 'Pending') OR (e IN ('complete', 'fail') AND status = 'In Progress') THEN 'applied' ELSE 'illegal' END
  FROM run r JOIN ev ON ev.user_id = r.user_id AND ev.n = r.n + 1)"""

HOST = "regexp_extract(url, '^https?://([^/]+)', 1)"

ORACLES: dict[str, str] = {
    # --- sources ---
    "read_topics": f"""WITH {TOPICS} SELECT CAST(topic_id AS VARCHAR) AS topic_id, stream,
        CASE WHEN topic_id % 11 = 0 THEN 'Unknown' ELSE subject END AS subject, chapter, topic,
        CASE WHEN topic_id % 13 = 0 THEN 'Pending' ELSE status END AS status, created_time FROM topics""",
    "flatten_syllabus": """SELECT r_name AS stream, n_name AS subject, c_mktsegment AS chapter,
        CASE WHEN c_acctbal < 1000 THEN c_mktsegment || ' Overview' ELSE c_name END AS topic, 'Pending' AS status
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "read_search_results": """SELECT conv_id AS query_id, turn AS rank, CASE WHEN role = 'user' THEN 'youtube#video' ELSE 'youtube#playlist' END AS kind,
        CASE WHEN role = 'user' THEN conv_id || '-' || turn END AS video_id, CASE WHEN role <> 'user' THEN conv_id || '-' || turn END AS playlist_id,
        text AS title, role AS description, 'ch' AS channel FROM conversations""",
    "transcript_words": f"WITH {WORDS} SELECT * FROM words",
    "transcript_segments": f"WITH {WORDS}, {SEGMENTS} SELECT * FROM segs",
    "parse_scene_log": "SELECT event_id, round(value, 3) AS ts_s FROM events WHERE event_type <> 'signup'",
    "parse_error_log": """SELECT event_id, CASE WHEN event_type <> 'click' THEN date_trunc('milliseconds', ts) END AS logged_at,
        CASE WHEN event_type <> 'click' THEN upper(event_type) END AS category, CASE WHEN event_type <> 'click' THEN 'user ' || user_id END AS topic,
        CASE WHEN event_type <> 'click' THEN props END AS message FROM events""",
    "retry_summary": """WITH r AS (SELECT user_id, event_id % 3 + 1 AS attempt, date_trunc('milliseconds', ts) AS t, 'event ' || event_id || chr(10) || props AS message
          FROM events WHERE event_type = 'error'),
        f AS (SELECT user_id, count(*) AS failures, CAST(max(attempt) AS INTEGER) AS max_attempt, max(t) AS last_failure, arg_max(message, t) AS last_message FROM r GROUP BY 1),
        s AS (SELECT user_id, max(ts) AS last_success FROM events WHERE event_type = 'purchase' GROUP BY 1)
        SELECT f.user_id AS job, failures, max_attempt, last_failure, last_message, last_success, coalesce(last_success > last_failure, false) AS recovered
        FROM f LEFT JOIN s USING (user_id)""",
    "asset_inventory": f"""WITH f AS (SELECT {HOST} AS topic, page_id, strlen(html) AS length,
          url || CASE page_id % 5 WHEN 0 THEN '.WAV' WHEN 1 THEN '.mp3' WHEN 2 THEN '.txt' WHEN 3 THEN '_timeline.json' ELSE '' END AS name FROM pages),
        c AS (SELECT *, CASE WHEN contains(lower(name), '.wav') OR contains(lower(name), '.mp3') THEN 'audio' WHEN contains(lower(name), '.txt') THEN 'transcript'
          WHEN contains(lower(name), 'timeline') OR contains(lower(name), '.json') THEN 'timeline' ELSE 'other' END AS asset_class FROM f)
        SELECT topic, asset_class, count(*) AS files, CAST(sum(length) AS BIGINT) AS bytes, arg_max(name, page_id) AS newest,
          count(*) FILTER (regexp_matches(name, '\\.(wav|txt|json)$')) AS accepted, count(*) > 1 AND asset_class <> 'other' AS overwritten FROM c GROUP BY 1, 2""",
    "pick_latest_artifact": """WITH f AS (SELECT l_suppkey, l_returnflag AS dir, l_shipdate AS modified_at,
          l_orderkey || '-' || l_partkey || '-' || (CASE l_linenumber WHEN 1 THEN '.mp4' WHEN 2 THEN '.wav' WHEN 3 THEN '.mp3' WHEN 4 THEN '.webm' END) AS name
          FROM lineitem WHERE l_linenumber <= 4 AND l_shipdate > TIMESTAMP '2001-06-01' - INTERVAL 90 DAY),
        r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY CASE dir WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END, modified_at DESC, name) AS n FROM f)
        SELECT l_suppkey, dir, name, modified_at FROM r WHERE n = 1""",
    "write_outputs": f"WITH {TOPICS} SELECT topic_id, topic, status, stream FROM topics",
    # --- catalog ---
    "topic_queue": f"WITH {TOPICS} SELECT stream, topic_id, subject, chapter, topic, status, created_time FROM topics WHERE status IN ('Pending', 'In Progress')",
    "find_topics": f"WITH {CATALOG} SELECT * FROM cat WHERE contains(topic, 'ring') OR contains(topic, 'hot') OR contains(topic, 'blue bo')",
    "reset_topics": f"""WITH {TOPICS}, t AS (SELECT topic_id, stream, CASE WHEN topic_id % 13 <> 0 THEN status END AS old_status FROM topics)
        SELECT topic_id, stream, old_status, 'Pending' AS status FROM t WHERE old_status IS DISTINCT FROM 'Pending'""",
    "archive_videos": f"WITH {TOPICS} SELECT stream, count(*) AS archived, count(*) AS videos FROM topics WHERE status = 'Completed' GROUP BY 1",
    "apply_status": f"""WITH {TOPICS}, e AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS n FROM lineitem)
        SELECT topic_id, stream, CASE l_returnflag WHEN 'A' THEN 'Completed' WHEN 'N' THEN 'In Progress' WHEN 'R' THEN 'Failed' ELSE status END AS status,
          CASE WHEN l_returnflag = 'A' THEN 'https://v.example/' || l_partkey END AS video_url, CASE WHEN l_returnflag = 'A' THEN l_shipdate END AS completed_at
        FROM topics LEFT JOIN e ON l_orderkey = topic_id AND n = 1""",
    "rejected_events": """SELECT l_orderkey AS topic_id, CASE l_returnflag WHEN 'A' THEN 'Completed' WHEN 'N' THEN 'In Progress' ELSE 'Failed' END AS status,
        l_shipdate AS ts, 'https://v.example/' || l_partkey AS video_url, l_linenumber, l_partkey, l_suppkey, l_extendedprice
        FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')""",
    "not_yet_done": "SELECT c_custkey AS topic, c_name AS name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')",
    "collections": f"""WITH {CATALOG}, w AS (SELECT '[' || stream || '] ' || subject || ' Full Course' AS title FROM cat UNION ALL SELECT chapter || ' | ' || subject FROM cat),
        k AS (SELECT lower(p_type || ' | ' || p_brand) AS title_key, min('PL' || p_partkey) AS id FROM part WHERE p_size > 25 GROUP BY 1),
        g AS (SELECT lower(title) AS title_key, min(title) AS title FROM w GROUP BY 1)
        SELECT title_key, title, coalesce(id, sha256(title_key)) AS collection_id, id IS NULL AS created FROM g LEFT JOIN k USING (title_key)""",
    "collection_membership": f"""WITH {CATALOG}, w AS (SELECT topic_id AS video_id, lower('[' || stream || '] ' || subject || ' Full Course') AS title_key FROM cat
          UNION ALL SELECT topic_id, lower(chapter || ' | ' || subject) FROM cat),
        k AS (SELECT lower(p_type || ' | ' || p_brand) AS title_key, min('PL' || p_partkey) AS id FROM part WHERE p_size > 25 GROUP BY 1)
        SELECT video_id, title_key, coalesce(id, sha256(title_key)) AS collection_id FROM w LEFT JOIN k USING (title_key)""",
    "resume_plan": f"""WITH {TOPICS}, steps(no, floor) AS (VALUES (1, 0), (2, 1000), (3, 10239), (4, 1000)),
        need AS (SELECT topic_id, no FROM topics, steps EXCEPT
          SELECT l_orderkey, no FROM lineitem JOIN steps ON l_linenumber = no WHERE floor(l_extendedprice / 10) > steps.floor AND (no > 2 OR l_returnflag <> 'R'))
        SELECT topic_id, min(no)::INTEGER AS resume_step, count(*)::INTEGER AS n_left, string_agg(CAST(no AS VARCHAR), ',' ORDER BY no) AS steps_left FROM need GROUP BY 1""",
    "queue_depth": f"WITH {TOPICS} SELECT stream, count(*) FILTER (status = 'Pending') AS pending FROM topics GROUP BY 1",
    "next_pending": f"""WITH {TOPICS}, r AS (SELECT *, row_number() OVER (PARTITION BY stream ORDER BY created_time, topic_id) AS n FROM topics WHERE status = 'Pending')
        SELECT stream, topic_id, topic, created_time FROM r WHERE n = 1""",
    "claim_topics": f"""WITH {TOPICS}, r AS (SELECT *, row_number() OVER (PARTITION BY stream, status ORDER BY created_time, topic_id) AS n FROM topics),
        c AS (SELECT stream, topic_id, CASE WHEN status = 'Pending' AND n = 1 THEN 'In Progress' ELSE status END AS status FROM r)
        SELECT stream, status, count(*) AS n, CAST(sum(topic_id) AS BIGINT) AS id_sum FROM c GROUP BY 1, 2""",
    "round_robin_plan": f"""WITH {TOPICS}, t AS (SELECT *, row_number() OVER (PARTITION BY stream, subject ORDER BY created_time, topic_id) AS turn FROM topics WHERE status = 'Pending'),
        s AS (SELECT *, row_number() OVER (PARTITION BY stream ORDER BY turn, subject) AS slot FROM t)
        SELECT stream, subject, topic_id, turn, slot, (slot - 1) // 10 AS day FROM s""",
    "union_streams": """SELECT s_suppkey AS topic_id, s_name AS topic, s_acctbal AS balance, 'suppliers' AS stream, NULL::VARCHAR AS segment FROM supplier
        UNION ALL SELECT c_custkey, c_name, NULL, 'customers', c_mktsegment FROM customer""",
    # --- strategy ---
    "decide_strategy": f"WITH {RESULTS} SELECT topic_id, strategy, reason, n_results, series_count, playlist_id FROM strategies",
    "split_topics": f"""WITH {RESULTS}, it AS (SELECT 'PL' || (o_custkey % 20) AS playlist_id,
          CASE WHEN o_orderstatus = 'F' THEN '  ' ELSE 'Video ' || o_orderkey END AS title,
          row_number() OVER (PARTITION BY o_custkey % 20 ORDER BY o_orderkey) - 1 AS pos FROM orders),
        b AS (SELECT * FROM strategies WHERE strategy = 'branch'),
        rows AS (SELECT topic_id, stream, subject, chapter, pos, title FROM b JOIN it USING (playlist_id) WHERE pos < 10
          UNION ALL SELECT topic_id, stream, subject, chapter, i, topic || ' - Part ' || (i + 1) FROM b, range(3) r(i) WHERE playlist_id IS NULL OR playlist_id NOT IN (SELECT playlist_id FROM it))
        SELECT topic_id AS parent_id, stream, subject, chapter, CASE WHEN pos = 0 THEN 'rename' ELSE 'insert' END AS action, CAST(pos AS INTEGER) AS pos,
          CASE WHEN pos = 0 THEN CAST(topic_id AS VARCHAR) ELSE sha256(topic_id || '-' || pos) END AS row_id,
          CASE WHEN pos > 0 AND trim(title) = '' THEN chapter || ' - Lesson ' || (pos + 1) ELSE title END AS title,
          CASE WHEN pos > 0 THEN 'Pending' END AS status FROM rows""",
    "fill_transcripts": """SELECT d.doc_id, lang || ' ' || source AS description,
        CASE WHEN l.doc_id IS NULL OR replace(text, chr(10), ' ') = '' THEN 'Transcript unavailable. Description: ' || lang || ' ' || source ELSE replace(text, chr(10), ' ') END AS transcript
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "harvest_urls": r"""WITH t AS (SELECT page_id, url || ' ' || html || ' ' || replace(url, 'https:', 'http:') AS text FROM pages),
        m AS (SELECT page_id, unnest(regexp_extract_all(text, 'https?://[a-z0-9.\-]+\.example\.(?:com|net|org)')) AS url,
          generate_subscripts(regexp_extract_all(text, 'https?://[a-z0-9.\-]+\.example\.(?:com|net|org)'), 1) AS i FROM t),
        u AS (SELECT page_id, url, min(i) AS i FROM m GROUP BY 1, 2),
        f AS (SELECT page_id, url, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS i FROM u)
        SELECT url, min(page_id) AS first_seen, CAST(arg_min(i, page_id) AS INTEGER) AS first_pos, count(*) AS n_pages FROM f WHERE url NOT IN
          (SELECT regexp_extract(url, 'https?://[a-z0-9.\-]+\.example\.(?:com|net|org)') FROM pages WHERE contains(url, 'utm_source')) GROUP BY 1""",
    # --- alignment ---
    "nearest_word": """WITH e AS (SELECT *, epoch_us(ts) // 3600000000 AS h FROM events),
        p AS (SELECT * FROM e WHERE event_type = 'error'), w AS (SELECT * FROM e WHERE event_type <> 'error'),
        x AS (SELECT p.user_id, p.event_id, w.event_id AS i, row_number() OVER (PARTITION BY p.event_id ORDER BY abs(w.h - p.h), w.event_id) AS n FROM p LEFT JOIN w ON w.user_id = p.user_id)
        SELECT user_id, event_id, coalesce(i, 0) AS nearest_idx FROM x WHERE n = 1""",
    "slide_pace": f"""WITH {WORDS}, s0 AS (SELECT doc_id, len(w) AS n, unnest(range(len(w) // 20 + 1)) AS k FROM docw),
        s AS (SELECT *, 8 + (doc_id % 3) * 0.25::DOUBLE AS video, least(20 * k, n - 1) AS ws, least(20 * k + 19, n - 1) AS we FROM s0),
        d AS (SELECT *, round((we + 1) / 2.5, 3) - round(ws / 2.5, 3) AS raw FROM s),
        v AS (SELECT *, CASE WHEN n = 0 OR raw < 0.1 THEN video ELSE raw END AS tts FROM d),
        f AS (SELECT *, greatest(0.5, least(2.0, video / tts)) AS f FROM v)
        SELECT doc_id, k::INTEGER AS slide_index, round(tts, 4) AS tts_duration, round(f, 4) AS speed_factor, abs(f - 1.0) >= 0.05 AS needs_adjust FROM f""",
    "transcript_rollup": f"""WITH {WORDS}, {SEGMENTS}, a AS (SELECT doc_id, count(*) AS n, array_to_string(list(word ORDER BY word_idx), ' ') AS t FROM words GROUP BY 1),
        b AS (SELECT doc_id, max(end_s) AS duration, count(*) AS k FROM segs GROUP BY 1)
        SELECT doc_id, coalesce(duration, 0.0) AS duration, coalesce(n, 0) AS total_words, coalesce(k, 0) AS total_segments, coalesce(t, '') AS full_text FROM a FULL JOIN b USING (doc_id)""",
    "slide_text": f"""WITH {WORDS}, {SCENES},
        near AS (
          SELECT s.doc_id, s.scene_idx, arg_min(w.word_idx, (abs(w.start_s - s.start_s), w.word_idx)) AS lo, arg_min(w.word_idx, (abs(w.start_s - s.end_s), w.word_idx)) AS hi
          FROM scenes s JOIN words w USING (doc_id) GROUP BY 1, 2),
        r0 AS (SELECT s.*, least(lo, n_words - 1) AS lo, CASE WHEN is_last THEN n_words - 1 ELSE hi - 1 END AS hi FROM scenes s JOIN near USING (doc_id, scene_idx)),
        r AS (SELECT doc_id, scene_idx, start_s, end_s, lo, greatest(lo, least(hi, n_words - 1)) AS hi FROM r0)
        SELECT doc_id, scene_idx AS slide_index, round(start_s, 3) AS video_start, round(end_s, 3) AS video_end, round(end_s - start_s, 3) AS video_duration,
          CAST(lo AS BIGINT) AS word_start_index, CAST(hi AS BIGINT) AS word_end_index, CAST(hi - lo + 1 AS BIGINT) AS word_count,
          round(lo / 2.5, 3) AS original_audio_start, round((hi + 1) / 2.5, 3) AS original_audio_end, array_to_string(w[lo + 1 : hi + 1], ' ') AS text,
          coalesce(lead(lo) OVER (PARTITION BY doc_id ORDER BY scene_idx) <= hi, false) AS overlap
        FROM r JOIN docw USING (doc_id)""",
    "scene_thin": f"WITH RECURSIVE {CANDIDATES} SELECT user_id, scene_idx, start_s FROM kept",
    "scene_intervals": f"""WITH RECURSIVE {CANDIDATES}, n AS (SELECT k.*, total_s, lead(start_s) OVER (PARTITION BY user_id ORDER BY scene_idx) AS nx FROM kept k JOIN totals USING (user_id)),
        e AS (SELECT *, coalesce(nx, greatest(0.0, total_s - 3.0)) AS z FROM n)
        SELECT user_id, scene_idx, start_s, round(z, 3) AS end_s, round(z - start_s, 3) AS duration_s, nx IS NULL AS is_last FROM e""",
    "segment_split": f"""WITH {WORDS}, s AS (SELECT doc_id, len(w) AS n, 10 + doc_id % 7 AS a, len(w) + doc_id % 3 AS b, CASE WHEN doc_id % 2 = 0 THEN 20 ELSE 50 END AS c FROM docw),
        r AS (SELECT *, n::DOUBLE / (a + b + c)::DOUBLE AS r FROM s),
        i AS (SELECT *, least(CAST(floor(a * r + 0.5) AS BIGINT) - 1, n - 2) AS ie FROM r),
        m AS (SELECT *, least(ie + CAST(floor(b * r + 0.5) AS BIGINT), n - 2) AS me FROM i)
        SELECT doc_id, n AS n_words, ie AS intro_end_idx, me AS main_end_idx, CASE WHEN ie < 0 THEN 0.0::DOUBLE ELSE round((ie + 1) / 2.5, 3) END AS intro_end,
          CASE WHEN me < 0 THEN n / 2.5 ELSE round((me + 1) / 2.5, 3) END AS main_end, n / 2.5 AS total_duration FROM m""",
    "track_timeline": """WITH t AS (SELECT l_orderkey AS video_id, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity AS v,
          CASE WHEN l_returnflag <> 'N' THEN l_quantity * (1 - l_discount) END AS a FROM lineitem),
        e AS (SELECT *, CASE WHEN a > 0 THEN a ELSE v END AS d FROM t)
        SELECT video_id, l_linenumber, l_partkey, l_suppkey, l_extendedprice, round(d, 4) AS duration_s,
          round(sum(d) OVER (PARTITION BY video_id ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - d, 4) AS offset_s,
          round(greatest(0.0, d - 1.0), 4) AS fade_out_s, coalesce(a < v - 0.5, false) AS audio_short FROM e""",
    # --- analytics ---
    "enrich_stats": """WITH r AS (SELECT o_orderpriority AS channel, o_orderkey AS video_id, o_orderdate AS published_at,
          row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS recency FROM orders),
        s AS (SELECT l_orderkey, CAST(sum(l_quantity) AS BIGINT) AS views, count(*) AS likes FROM lineitem GROUP BY 1)
        SELECT video_id, channel, published_at, recency, views, likes FROM r JOIN s ON l_orderkey = video_id WHERE recency <= 50""",
    "hourly_profile": f"WITH {stats('event_type')}, {profile(HOUR_TZ)} SELECT * FROM profile",
    "hourly_profile_legacy": f"WITH {stats('user_id')}, {profile(HOUR_LEGACY)} SELECT * FROM profile",
    "best_hour": f"WITH {stats('user_id')}, {profile(HOUR_TZ)}, {BEST} SELECT *, {LABEL} AS label FROM best",
    "hour_chart": f"""WITH {stats('user_id')}, {profile(HOUR_TZ)}, {BEST}
        SELECT p.*, hour = best_hour AS is_best FROM profile p JOIN best USING (channel) WHERE uploads > 0 OR hour = best_hour""",
    "channel_totals": """SELECT l_suppkey AS channel, CAST(sum(CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS total_views,
        0::BIGINT AS total_likes, CAST(sum(l_linenumber) AS BIGINT) AS total_comments, count(*) AS videos FROM lineitem GROUP BY 1""",
    "recent_history": """WITH r AS (SELECT o_custkey AS channel, o_orderkey AS video_id, o_orderdate AS published_at, o_totalprice AS views,
          row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders),
        k AS (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY n DESC) AS seq FROM r WHERE n <= 12)
        SELECT channel, video_id, published_at, views, seq, 'V' || seq AS name FROM k""",
    "top_videos": """WITH v AS (SELECT l_suppkey AS query, l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag <> 'A' THEN CAST(trunc(l_extendedprice) AS BIGINT) ELSE 0 END AS views FROM lineitem),
        r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY views DESC, l_orderkey, l_linenumber, l_partkey) AS rank FROM v WHERE views >= 1000)
        SELECT *, query || '-' || rank || '.jpg' AS file FROM r WHERE rank <= 5""",
    "best_thumbnail": """WITH t AS (SELECT *, CAST(l_quantity AS BIGINT) * CASE WHEN l_returnflag <> 'A' THEN l_linenumber % 3 ELSE 0 END AS area FROM lineitem),
        r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY area DESC, l_linenumber, l_partkey, l_suppkey) AS n FROM t)
        SELECT l_orderkey AS video_id, 'https://t.example/' || l_partkey || '/' || l_suppkey AS url, area FROM r WHERE n = 1""",
    "best_thumbnail_forms": """SELECT p_partkey, 'https://t.example/' || p_partkey || CASE p_partkey % 3 WHEN 0 THEN '' WHEN 2 THEN '/b' ELSE CASE WHEN p_size > 25 THEN '/c' ELSE '/a' END END AS url FROM part""",
    "channel_report": f"""WITH u AS (SELECT user_id, event_id, ts, CAST(round(value * 100) AS BIGINT) AS views, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events),
        stats AS (SELECT user_id AS channel, ts AS published_at, views FROM u WHERE n <= 50), {profile(HOUR_TZ)}, {BEST},
        tot AS (SELECT channel, CAST(sum(views) AS BIGINT) AS total_views, CAST(sum(views % 10) AS BIGINT) AS total_likes, 0::BIGINT AS total_comments FROM stats GROUP BY 1)
        SELECT best.*, {LABEL} AS label, total_views, total_likes, total_comments FROM best JOIN tot USING (channel)""",
    # --- text jobs ---
    "build_scripts": f"""WITH {scripts('(row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) % 25')}
        SELECT doc_id, stream, script_md5, intro_words, main_words, outro_words, intro_words + main_words + outro_words AS total_words,
          {', '.join(f'{e} AS {p}_s' for p, e in _secs.items())} FROM scripts""",
    "script_budget": f"""WITH {scripts(by_hash('doc_id', 25))}
        SELECT stream, subject, count(*) AS scripts, CAST(sum(intro_words + main_words + outro_words) AS BIGINT) AS words,
          round(sum({' + '.join(_secs.values())}) / 60, 2) AS minutes FROM scripts GROUP BY 1, 2""",
    "emphasize": f"""WITH {SPOKEN}, {_emphasis()} SELECT doc_id, md5(out) AS text_md5, round(drift, 6) AS word_drift, drift > 0.03 AS reverted,
        CAST(n_changes AS BIGINT) AS n_changes, {', '.join('hits_' + k for k in KINDS)} FROM em""",
    "emphasis_audit": f"""WITH {SPOKEN}, {_emphasis()} SELECT source, count(*) AS docs, count(*) FILTER (n_changes > 0) AS changed, count(*) FILTER (drift > 0.03) AS reverted,
        round(avg(drift), 6) AS mean_drift, {', '.join(f'CAST(sum(hits_{k}) AS BIGINT) AS hits_{k}' for k in KINDS)} FROM em GROUP BY 1""",
    "clean_text": f"WITH {DIRTY} SELECT doc_id, md5(b) AS text_md5, length(b) AS chars FROM cleaned WHERE b <> ''",
    "cleaning_report": f"""WITH {DIRTY} SELECT source, count(*) AS docs, count(*) FILTER (a <> b) AS changed, CAST(sum(length(a) - length(b)) AS BIGINT) AS chars_removed,
        count(*) FILTER (b = '') AS dropped FROM cleaned GROUP BY 1""",
    "pack_chunks": f"WITH RECURSIVE {CHUNKS} SELECT * FROM chunks",
    "default_instructions": f"""WITH RECURSIVE {CHUNKS}, p AS (SELECT doc_id, chunk_idx, chunk_idx / greatest(n_chunks - 1, 1) AS p FROM chunks)
        SELECT doc_id, chunk_idx, {INSTRUCT} FROM p""",
    "attach_instructions": f"""WITH RECURSIVE {CHUNKS},
        i AS (SELECT doc_id, unnest([0, quality, 1]) AS chunk_idx, unnest([0, 1, 2]) AS pos, quality, toxic FROM labels),
        f AS (SELECT *, row_number() OVER (PARTITION BY doc_id, chunk_idx ORDER BY pos) AS n FROM i),
        g AS (SELECT *, CASE WHEN toxic = 1 OR pos * 0.5 + quality * 0.9 = 0 THEN 1.0 ELSE pos * 0.5 + quality * 0.9 END AS sp FROM f WHERE n = 1)
        SELECT c.doc_id, c.chunk_idx, n_words, CASE WHEN g.doc_id IS NULL THEN {q(rules.INSTRUCT_MISSING)} WHEN pos = 0 AND quality = 0 THEN {q(rules.INSTRUCT_EMPTY)}
          ELSE 'tone ' || pos || '-' || toxic END AS instruct, CAST(CASE WHEN g.doc_id IS NULL THEN 1.0 ELSE greatest(0.85, least(1.1, sp)) END AS DOUBLE) AS speed
        FROM chunks c LEFT JOIN g ON g.doc_id = c.doc_id AND g.chunk_idx = c.chunk_idx""",
    # --- metadata ---
    "plan_titles": f"WITH {CATALOG}, {titles('(row_number() OVER (PARTITION BY stream, subject ORDER BY topic_id) - 1) % 12')} SELECT * FROM titles",
    "duplicate_titles": f"WITH {CATALOG}, {titles(by_hash('topic_id', 12))} SELECT title, count(*) AS n_topics, min(topic_id) AS first_topic_id FROM titles GROUP BY 1 HAVING count(*) > 1",
    "describe_topics": f"""WITH {CATALOG}, d AS (SELECT topic_id, substr({template(rules.DESCRIPTION, topic='topic', subject='subject', chapter='chapter',
        topic_tag="'#' || replace(topic, ' ', '')", subject_tag="'#' || replace(subject, ' ', '')", chapter_tag="'#' || replace(chapter, ' ', '')")}, 1, 4900) AS t FROM cat)
        SELECT topic_id, md5(t) AS description_md5, length(t) AS chars FROM d""",
    "fit_tags": f"""WITH {CATALOG}, l AS (SELECT topic_id, {TAG_LIST} AS l FROM cat), u AS (SELECT topic_id, unnest(range(len(l))) AS pos, unnest(l) AS tag FROM l),
        d AS (SELECT topic_id, tag, min(pos) AS pos FROM u GROUP BY 1, 2), t AS (SELECT topic_id, pos, {TIDY} AS tag FROM d),
        c AS (SELECT *, sum(length(tag) + 3) OVER (PARTITION BY topic_id ORDER BY pos) AS used FROM t)
        SELECT topic_id, string_agg(tag, '|' ORDER BY pos) AS tags, count(*)::INTEGER AS n_tags FROM c WHERE used <= 200 GROUP BY 1""",
    "fit_tags_long": f"""WITH {CATALOG}, l AS (SELECT topic_id, chapter || '/' || subject AS shelf, {TAG_LIST} AS l FROM cat),
        u AS (SELECT shelf, topic_id * 100 + unnest(range(len(l))) AS pos, unnest(l) AS tag FROM l),
        d AS (SELECT shelf, tag, min(pos) AS pos FROM u GROUP BY 1, 2), t AS (SELECT shelf, pos, {TIDY} AS tag FROM d),
        c AS (SELECT *, sum(length(tag) + 3) OVER (PARTITION BY shelf ORDER BY pos) AS used FROM t)
        SELECT shelf, string_agg(tag, '|' ORDER BY pos) AS tags, CAST(max(used) AS BIGINT) AS used FROM c WHERE used <= 495 GROUP BY 1""",
    "slugify_keys": rf"""WITH {NAMES} SELECT p_partkey, name, lower(regexp_replace(name, '[^a-zA-Z0-9]', '_', 'g')) AS slug_chars,
        regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g') AS slug_runs, {SLUG3} AS slug_trimmed FROM names""",
    "slug_collisions": f"""WITH {NAMES}, s AS (SELECT DISTINCT name, {SLUG3} AS slug FROM names)
        SELECT slug, count(*) AS n_names, min(name) AS first_name, max(name) AS last_name FROM s GROUP BY 1 HAVING count(*) > 1""",
    # --- logs, files, health ---
    "classify_errors": f"""WITH x AS (SELECT source, text || CASE doc_id % 9 WHEN 0 THEN ' Gradio' WHEN 1 THEN ' notebooklm' WHEN 2 THEN ' ffmpeg' WHEN 3 THEN ' WAV' WHEN 4 THEN ' Whisper'
          WHEN 5 THEN ' 429' WHEN 6 THEN ' YouTube' WHEN 7 THEN '' ELSE ' Colab 429' END AS m FROM documents)
        SELECT source, {ERR_CASE} AS category, count(*) AS errors FROM x GROUP BY 1, 2""",
    "log_tail": f"""WITH l AS (SELECT doc_id, source, string_split(regexp_replace(text, '{ANSI}', '', 'g'), chr(10)) AS l FROM documents),
        u AS (SELECT doc_id, source, unnest(range(len(l)))::INTEGER AS line_no, unnest(l) AS raw FROM l),
        t AS (SELECT doc_id, source, line_no, {trim('raw')} AS line FROM u),
        r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id DESC, line_no DESC) AS recency FROM t WHERE line <> '')
        SELECT * FROM r WHERE recency <= 50""",
    "last_error": """WITH e AS (SELECT user_id, arg_max(event_id || ' ' || props, ts) FILTER (event_type = 'error') AS l FROM events GROUP BY 1)
        SELECT user_id, coalesce(l, 'none') AS last_error FROM e""",
    "run_sessions": """WITH e AS (SELECT *, count(*) FILTER (event_type = 'signup') OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run_no FROM events),
        g AS (SELECT user_id, run_no, min(ts) AS started_at, min(ts) FILTER (event_type IN ('purchase', 'error')) AS ended_at,
          arg_min(event_type, ts) FILTER (event_type IN ('purchase', 'error')) AS t, count(*) AS n_lines FROM e WHERE run_no > 0 GROUP BY 1, 2)
        SELECT user_id, run_no, started_at, ended_at, CASE t WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failed' ELSE 'running' END AS state,
          (epoch_us(ended_at) // 1000 - epoch_us(started_at) // 1000) / 1000 AS duration_s, n_lines FROM g""",
    "payload_quality": f"""WITH p AS (SELECT {HOST} AS host, CASE page_id % 10 WHEN 0 THEN 'tiny' WHEN 1 THEN repeat('x', 300) || html WHEN 2 THEN html || '{rules.DEAD_PAGE_MARK}' ELSE html END AS c FROM pages),
        f AS (SELECT host, strlen(c) AS b, c, substr(c, 1, 256) AS h FROM p)
        SELECT host, count(*) AS files, CAST(sum(b) AS BIGINT) AS bytes, count(*) FILTER (contains(h, '<!DOCTYPE') OR contains(h, '<html') OR contains(h, '<HTML')) AS is_html,
          count(*) FILTER (b < 100) AS is_junk, count(*) FILTER (b < 10240) AS is_small, count(*) FILTER (contains(c, '{rules.DEAD_PAGE_MARK}')) AS is_dead FROM f GROUP BY 1""",
    "health_checks": f"WITH {HEALTH} SELECT * FROM states",
    "health_rollup": f"""WITH {HEALTH}, s AS (SELECT count(*) AS services, count(*) FILTER (state = 'live') AS live, count(*) FILTER (state <> 'live') AS bad FROM states)
        SELECT CASE WHEN bad > 0 THEN 'degraded' ELSE 'ok' END AS status, services, live, (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS pending,
          (SELECT coalesce(arg_max(event_id || ' ' || props, ts), 'none') FROM events WHERE event_type = 'error') AS last_error FROM s""",
    # --- schedules ---
    "schedule_slots": f"""WITH sched AS (SELECT event_type AS stream, min(CAST(ts + {IST} AS DATE)) AS first_day, max(CAST(ts + {IST} AS DATE)) AS last_day,
          length(event_type)::INTEGER AS hour_local, event_type <> 'click' AS enabled FROM events GROUP BY 1), {slots()}
        SELECT stream, hour_local, enabled, local_day, slot_at FROM slots""",
    "next_run": f"""WITH {USER_SCHED}, a AS (SELECT *, TIMESTAMP '2024-01-15 22:10:30' AS now, CAST(CAST(TIMESTAMP '2024-01-15 22:10:30' + {IST} AS DATE) AS TIMESTAMP) AS today FROM sched),
        s AS (SELECT *, today + to_hours(hour_local) - {IST} AS s0 FROM a),
        n AS (SELECT stream, hour_local, enabled, now, CASE WHEN enabled THEN CASE WHEN s0 > now THEN s0 ELSE s0 + INTERVAL 1 DAY END END AS next_run FROM s)
        SELECT stream, hour_local, enabled, next_run, strftime(next_run + {IST}, '%Y-%m-%d %H:%M') || ' IST' AS next_run_local,
          CASE WHEN next_run IS NULL THEN '—' ELSE ((epoch_ms(next_run) - epoch_ms(now)) // 3600000) || 'h ' || ((epoch_ms(next_run) - epoch_ms(now)) % 3600000 // 60000) || 'm' END AS countdown FROM n""",
    "missed_runs": f"""WITH {USER_SCHED}, {slots()} SELECT stream, local_day, slot_at FROM slots s WHERE enabled AND slot_at < TIMESTAMP '2024-01-25 12:00:00' AND NOT EXISTS (
        SELECT 1 FROM events WHERE event_type = 'purchase' AND user_id = s.stream AND ts <= TIMESTAMP '2024-01-25 12:00:00' AND CAST(ts + {IST} AS DATE) = s.local_day)""",
    "run_status": f"""WITH g AS (SELECT user_id, max(ts) AS last_run, arg_max(event_type, ts) AS t, arg_max(props, ts) AS p, count(*) AS n_events,
          count(*) FILTER (event_type = 'purchase') AS ok, count(*) FILTER (event_type IN ('purchase', 'error')) AS ended FROM events GROUP BY 1)
        SELECT user_id AS stream, CASE t WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failed' ELSE 'running' END AS state, CASE WHEN t = 'error' THEN p END AS message,
          last_run, strftime(last_run + {IST}, '%Y-%m-%d %H:%M') || ' IST' AS last_run_local, n_events, CASE WHEN ended > 0 THEN round(ok / ended, 4) END AS success_rate FROM g""",
    # --- streams ---
    "stream_logs": f"""WITH l AS (SELECT event_id, 0 AS line_no, {LOG_CAUSE} AS line FROM events UNION ALL SELECT event_id, 2, 'user ' || user_id FROM events)
        SELECT event_id, line_no, line, CASE WHEN contains(line, 'Gradio') THEN 'COLAB_DEAD' WHEN contains(line, 'ffmpeg') THEN 'FFMPEG_FAIL' WHEN contains(line, 'upload') THEN 'UPLOAD_FAIL' ELSE 'UNKNOWN' END AS category FROM l""",
    "stream_daily": f"""SELECT CAST(ts + {IST} AS DATE) AS local_day, event_type, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total FROM events
        GROUP BY 1, 2 HAVING CAST(CAST(ts + {IST} AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY - {IST} <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR FROM events)""",
    "stream_run_state": f"""WITH RECURSIVE {MACHINE} SELECT user_id AS topic_id, arg_max(status, n) AS status, count(*) FILTER (verdict = 'applied') AS applied, count(*) FILTER (verdict = 'illegal') AS illegal
        FROM run WHERE n > 0 GROUP BY 1""",
    "stream_missed": f"""WITH {USER_SCHED}, {slots(2)} SELECT stream, local_day, slot_at FROM slots s WHERE enabled
        AND slot_at + INTERVAL 60 SECOND < (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR FROM events WHERE event_type = 'purchase') AND NOT EXISTS (
        SELECT 1 FROM events WHERE event_type = 'purchase' AND user_id = s.stream AND CAST(ts + {IST} AS DATE) = s.local_day AND ts <= s.slot_at + INTERVAL 60 SECOND)""",
    "stream_dedup": f"SELECT DISTINCT user_id AS stream, CAST(ts + {IST} AS DATE) AS local_day FROM events WHERE event_type = 'purchase'",
}

# --- journeys, put together from the queries above ---
ORACLES |= {
    "find_topics_by_terms": ORACLES["find_topics"].split(" WHERE ")[0]
    + " WHERE EXISTS (SELECT 1 FROM part WHERE contains(topic, lower(substr(p_type, 1, 4))))",
    "stream_errors": "SELECT * EXCLUDE (event_id) FROM (" + ORACLES["parse_error_log"] + ")",
    "publish_metadata": f"""SELECT * FROM ({ORACLES["plan_titles"]}) JOIN ({ORACLES["describe_topics"]}) USING (topic_id)
        JOIN ({ORACLES["fit_tags"].replace("used <= 200", "used <= 495")}) USING (topic_id)""",
    # Scenes begin at words here, so places in time are places in the text: 2.5 words a second.
    "align_videos": f"""WITH RECURSIVE {WORDS}, num AS (SELECT doc_id, len(w) AS n, w FROM docw WHERE len(w) > 0),
        cand AS (SELECT doc_id, word_idx AS i FROM words JOIN num USING (doc_id) WHERE length(word) > 6 AND word_idx <= n - 7.5),
        froms AS (SELECT doc_id, 0 AS i FROM num UNION SELECT doc_id, i FROM cand),
        marks AS (SELECT doc_id, i + 3 AS pos, i AS origin FROM froms UNION ALL SELECT doc_id, i, NULL FROM cand),
        following AS (SELECT *, min(CASE WHEN origin IS NULL THEN pos END) OVER (PARTITION BY doc_id ORDER BY pos RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS j FROM marks),
        nxt AS (SELECT doc_id, origin AS i, j FROM following WHERE origin IS NOT NULL AND j IS NOT NULL),
        kept(doc_id, k, i) AS (SELECT doc_id, 0, 0 FROM num UNION ALL SELECT kept.doc_id, k + 1, j FROM kept JOIN nxt ON kept.doc_id = nxt.doc_id AND kept.i = nxt.i),
        ends AS (SELECT kept.doc_id, k, i, n, w, lead(i) OVER (PARTITION BY kept.doc_id ORDER BY k) AS j FROM kept JOIN num ON kept.doc_id = num.doc_id),
        s AS (SELECT *, coalesce(j, n) - 1 AS hi, round(i / 2.5, 3) AS a, round(coalesce(j / 2.5, greatest(0.0, n / 2.5 - 3.0)), 3) AS z FROM ends),
        p AS (SELECT *, z - a AS video, round((hi + 1) / 2.5, 3) - round(i / 2.5, 3) AS tts FROM s),
        f AS (SELECT *, greatest(0.5, least(2.0, video / tts)) AS f FROM p)
        SELECT doc_id, k AS slide_index, a AS video_start, z AS video_end, round(video, 3) AS video_duration, CAST(i AS BIGINT) AS word_start_index,
          CAST(hi AS BIGINT) AS word_end_index, CAST(hi - i + 1 AS BIGINT) AS word_count, md5(array_to_string(w[i + 1 : hi + 1], ' ')) AS text_md5,
          false AS overlap, round(tts, 4) AS tts_duration, round(f, 4) AS speed_factor, abs(f - 1.0) >= 0.05 AS needs_adjust FROM f""",
    "voice_plan": f"""WITH RECURSIVE {scripts('(row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) % 25')},
        spoken AS (SELECT doc_id, subject AS source, intro || chr(10) || chr(10) || main || chr(10) || chr(10) || outro AS text FROM parts), {_emphasis()},
        voiced AS (SELECT doc_id, out AS text FROM em1), {CHUNKS.replace("FROM documents", "FROM voiced")},
        p AS (SELECT *, chunk_idx / greatest(n_chunks - 1, 1) AS p FROM chunks)
        SELECT doc_id, chunk_idx, n_chunks, md5(text) AS text_md5, n_words, {INSTRUCT} FROM p""",
    "next_topics": f"""SELECT * REPLACE ('J' || (parent_id % 50) AS stream) FROM ({ORACLES["split_topics"]})
        WHERE parent_id IN (SELECT min(c_custkey) FROM customer GROUP BY c_custkey % 50)""",
}

# --- tables kept between runs ---
_FOUND = r"https?://[a-z0-9.\-]+\.example\.(?:com|net|org)/[a-z0-9/\-]*"
ORACLES |= {
    "merge_status": f"""WITH {TOPICS}, e AS (SELECT *, l_shipdate < DATE '1996-01-01' AS early, row_number() OVER (PARTITION BY l_orderkey, l_shipdate < DATE '1996-01-01'
          ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS n FROM lineitem),
        a AS (SELECT * FROM e WHERE n = 1 AND early), b AS (SELECT * FROM e WHERE n = 1 AND NOT early)
        SELECT topic_id, stream, CASE coalesce(b.l_returnflag, a.l_returnflag) WHEN 'A' THEN 'Completed' WHEN 'N' THEN 'In Progress' WHEN 'R' THEN 'Failed' ELSE status END AS status,
          CASE WHEN b.l_returnflag = 'A' THEN 'https://v.example/' || b.l_partkey WHEN a.l_returnflag = 'A' THEN 'https://v.example/' || a.l_partkey END AS video_url,
          CASE WHEN b.l_returnflag = 'A' THEN b.l_shipdate WHEN a.l_returnflag = 'A' THEN a.l_shipdate END AS completed_at
        FROM topics LEFT JOIN a ON a.l_orderkey = topic_id LEFT JOIN b ON b.l_orderkey = topic_id""",
    "claim_ledger": f"""WITH {TOPICS}, r AS (SELECT *, row_number() OVER (PARTITION BY stream ORDER BY created_time, topic_id) AS n FROM topics WHERE status = 'Pending')
        SELECT topic_id, stream, 'In Progress' AS status, CASE n WHEN 1 THEN 'one' ELSE 'two' END AS run FROM r WHERE n <= 2""",
    "harvest_twice": f"""WITH t AS (SELECT page_id, url || ' ' || html AS text FROM pages),
        m AS (SELECT page_id, unnest(regexp_extract_all(text, '{_FOUND}')) AS url, generate_subscripts(regexp_extract_all(text, '{_FOUND}'), 1) AS i FROM t),
        u AS (SELECT page_id, url, min(i) AS i FROM m GROUP BY 1, 2),
        f AS (SELECT page_id, url, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS i FROM u),
        one AS (SELECT url, min(page_id) AS first_seen, CAST(arg_min(i, page_id) AS INTEGER) AS first_pos, count(*) AS n_pages FROM f WHERE page_id % 2 = 0 GROUP BY 1)
        SELECT *, 1 AS harvest FROM one UNION ALL
        SELECT url, min(page_id), CAST(arg_min(i, page_id) AS INTEGER), count(*), 2 FROM f WHERE url NOT IN (SELECT url FROM one) GROUP BY 1""",
}
