"""DuckDB SQL for the registered queries, over views of the same tables."""

from __future__ import annotations

import hashlib

_TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
_EVENTS = """events_ AS (SELECT o_orderkey AS event_id, CAST(o_orderdate AS DATE) AS event_date, 'S' || CAST(o_custkey % (SELECT count(*) FROM supplier) AS VARCHAR) AS symbol,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'public_mention' WHEN '2' THEN 'policy_capital' WHEN '3' THEN 'procurement' WHEN '4' THEN 'disclosure_buy' ELSE 'market_reaction' END AS event_type,
  CASE o_orderstatus WHEN 'F' THEN 'high' WHEN 'O' THEN 'medium' ELSE 'low' END AS confidence FROM orders)"""
_RAW = "raw AS (SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS date, l_extendedprice AS close, l_orderkey, l_linenumber FROM lineitem)"
_OWN = "own AS (SELECT symbol, date, close FROM raw QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY l_orderkey DESC, l_linenumber DESC, close DESC) = 1)"


def _prices(sparse: bool) -> str:
    where = "WHERE (date - DATE '1970-01-01') % 7 = 0" if sparse else ""
    return f"{_RAW}, {_OWN}, market AS (SELECT date, max(close) AS close FROM raw {where} GROUP BY date), prices AS (SELECT symbol, date, close FROM own UNION ALL SELECT 'SPY', date, close FROM market)"


def _returns(sparse: bool) -> str:
    """Each distinct event day meets the first priced day on or after it by a running minimum over one ordered list; later days are leads."""
    later = ", ".join(f"lead(date, {k}) OVER w AS d{k}, lead(close, {k}) OVER w AS c{k}" for k in (1, 5, 20))
    spread = " UNION ALL ".join(f"SELECT symbol, event_date, date, close, CAST({k} AS INTEGER) AS window_days, d{k} AS exit_date, c{k} AS exit_close FROM base WHERE d{k} IS NOT NULL" for k in (1, 5, 20))
    change = "(r.exit_close / r.close - 1.0::DOUBLE) * 100.0::DOUBLE"
    market = "(m1.close / m0.close - 1.0::DOUBLE) * 100.0::DOUBLE"
    return f"""{_EVENTS}, {_prices(sparse)},
cal AS MATERIALIZED (SELECT symbol, date, close, {later} FROM prices WINDOW w AS (PARTITION BY symbol ORDER BY date)),
days AS (SELECT DISTINCT symbol, event_date FROM events_),
line AS (SELECT symbol, date, date AS priced, NULL::DATE AS asked FROM cal UNION ALL SELECT symbol, event_date, NULL, event_date FROM days),
found AS (SELECT symbol, asked, min(priced) OVER (PARTITION BY symbol ORDER BY date DESC, asked NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS base_date FROM line),
base AS MATERIALIZED (SELECT f.asked AS event_date, c.* FROM found f JOIN cal c ON c.symbol = f.symbol AND c.date = f.base_date WHERE f.asked IS NOT NULL),
spread AS ({spread}),
ret AS (SELECT e.event_id, e.event_date, e.symbol, e.event_type, r.window_days, r.date AS base_date, r.exit_date, r.close AS base_close, r.exit_close, {change} AS return_pct, 'SPY' AS benchmark_symbol,
  {market} AS benchmark_return_pct, {change} - {market} AS abnormal_return_pct
  FROM events_ e JOIN spread r ON r.symbol = e.symbol AND r.event_date = e.event_date LEFT JOIN market m0 ON m0.date = r.date LEFT JOIN market m1 ON m1.date = r.exit_date)"""


_ITEMS = """items AS (SELECT 'doc-' || CAST(doc_id AS VARCHAR) AS item_id, DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER) AS day,
  CASE doc_id % 6 WHEN 0 THEN 'government_filing' WHEN 1 THEN 'official_remarks' WHEN 2 THEN 'financial_media' WHEN 3 THEN 'issuer_release' WHEN 4 THEN 'government_policy' ELSE 'regulatory_action' END AS source_type,
  CASE WHEN doc_id % 6 = 2 THEN 'https://news.example/' WHEN doc_id % 12 = 3 THEN 'http://issuer.example/' WHEN doc_id % 6 = 3 THEN 'https://issuer.example/' ELSE 'https://agency.gov/' END || CAST(doc_id AS VARCHAR) AS source_url,
  source AS author, coalesce(text, '') || CASE doc_id % 7 WHEN 0 THEN ' Great partner ACM-1 wins.' WHEN 1 THEN ' New funding for $S7 plants.' WHEN 2 THEN ' Contract award to Acme Robotics.' WHEN 3 THEN ' Risk for the partner $F.'
    WHEN 4 THEN ' Policy stake in Beta‑Works.' WHEN 5 THEN '' ELSE ' nothing S77X here' END AS text, doc_id FROM documents)"""
_MENTIONS = _ITEMS + """,
pat(symbol, p) AS (VALUES ('ACM', '(?i)(^|[^A-Za-z0-9$])\\$?ACM([^A-Za-z0-9]|$)'), ('ACM', '(?i)(^|[^A-Za-z0-9$])\\$?ACM-1([^A-Za-z0-9]|$)'), ('ACM', '(?i)Acme Robotics'), ('S7', '(?i)(^|[^A-Za-z0-9$])\\$?S7([^A-Za-z0-9]|$)'),
  ('F', '(?i)(^|[^A-Za-z0-9])\\$F([^A-Za-z0-9]|$)'), ('BETA', '(?i)(^|[^A-Za-z0-9$])\\$?BETA([^A-Za-z0-9]|$)'), ('BETA', '(?i)(^|[^A-Za-z0-9$])\\$?Beta-Works([^A-Za-z0-9]|$)'),
  ('THON', '(?i)(^|[^A-Za-z0-9$])\\$?THON([^A-Za-z0-9]|$)'), ('TION', '(?i)(^|[^A-Za-z0-9$])\\$?TION([^A-Za-z0-9]|$)'), ('TION', '(?i)tion the'), ('TION', '(?i)(^|[^A-Za-z0-9$])\\$?S7([^A-Za-z0-9]|$)')),
found AS (SELECT DISTINCT i.item_id, p.symbol FROM items i JOIN pat p ON regexp_matches(translate(i.text, '‐‑‒–—−', '------'), p.p))"""

_RECORDS = """rec AS (SELECT page_id, ' Page/' || CAST(page_id AS VARCHAR) || ' !' AS record_id, DATE '2024-01-01' + CAST(page_id % 300 AS INTEGER) AS day,
  CASE page_id % 8 WHEN 0 THEN 'government_filing' WHEN 1 THEN 'official_remarks' WHEN 2 THEN 'financial_media' WHEN 3 THEN 'issuer_release' WHEN 4 THEN 'government_policy' WHEN 5 THEN 'regulatory_action' WHEN 6 THEN 'government_procurement' ELSE 'blog' END AS source_type,
  CASE page_id % 7 WHEN 0 THEN 'disclosure_buy' WHEN 1 THEN 'public_mention' WHEN 2 THEN 'policy_capital' WHEN 3 THEN 'procurement' WHEN 4 THEN 'regulatory_action' WHEN 5 THEN 'market_reaction' ELSE 'rumour' END AS event_type,
  CASE WHEN page_id % 3 <> 1 THEN 'https://agency' || CAST(page_id AS VARCHAR) || '.GOV/notice' ELSE url END AS source_url, url FROM pages),
err AS (SELECT *, CASE WHEN page_id % 50 = 49 THEN 'record_date_invalid' WHEN page_id % 41 = 40 THEN 'symbol_blank' WHEN page_id % 37 = 36 THEN 'entity_match_type_invalid' WHEN event_type = 'rumour' THEN 'event_type_invalid'
  WHEN page_id % 8 IN (0, 1, 4, 5, 6) THEN CASE WHEN NOT regexp_matches(lower(regexp_extract(source_url, '(?i)^https://([^/?#]+)', 1)), '\\.gov$') THEN 'government_url_invalid' END
  WHEN page_id % 8 = 3 THEN CASE WHEN NOT regexp_matches(source_url, '(?i)^https://[^/?#]+') THEN 'issuer_url_invalid' END
  WHEN page_id % 8 = 2 THEN CASE WHEN NOT regexp_matches(source_url, '(?i)^https://[^/?#]+') THEN 'media_url_invalid' END
  ELSE 'source_type_unsupported' END AS error_code FROM rec)"""
_CONFIDENCE = "CASE WHEN page_id % 8 IN (0, 1, 4, 5, 6) THEN 'high' WHEN page_id % 8 = 2 THEN 'low' ELSE 'medium' END"

_TRACKER = f"""{_EVENTS}, ev AS (SELECT symbol, sum(CASE event_type WHEN 'public_mention' THEN 4 WHEN 'policy_capital' THEN 4 WHEN 'procurement' THEN 4 WHEN 'disclosure_buy' THEN 3 ELSE 1 END
  + CASE confidence WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END) AS score, count(*) AS n, max(row(event_date, event_type, event_id)) AS latest, bool_or(event_type = 'public_mention') AS m, bool_or(event_type = 'disclosure_buy') AS d,
  bool_or(event_type = 'policy_capital') AS p FROM events_ GROUP BY symbol),
lst AS (SELECT symbol, event_date, event_type FROM events_ QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_date DESC, event_type DESC, event_id DESC) = 1),
tr AS (SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS symbol, s_name AS name, CASE s_nationkey % 5 WHEN 0 THEN 'named_mentioned' WHEN 1 THEN 'policy_capital' WHEN 2 THEN 'disclosed_holding' WHEN 3 THEN 'drone_policy_watchlist' ELSE 'other' END AS bucket,
  CASE WHEN coalesce(m AND d, false) THEN 'disclosure_plus_mention' WHEN coalesce(p, false) THEN 'policy_triggered' WHEN coalesce(m, false) THEN 'mentioned' WHEN coalesce(d, false) THEN 'disclosed' WHEN s_suppkey % 2 = 0 THEN 'watchlist' ELSE 'researching' END AS trigger_status,
  CAST(CASE s_nationkey % 5 WHEN 0 THEN 4 WHEN 1 THEN 4 WHEN 2 THEN 2 WHEN 3 THEN 2 ELSE 0 END + coalesce(score, 0) AS BIGINT) AS priority_score, CAST(coalesce(n, 0) AS BIGINT) AS event_count,
  lst.event_date AS latest_event_date, lst.event_type AS latest_event_type, 'https://issuer.example/' || CAST(s_suppkey AS VARCHAR) AS source_url, '' AS thesis
  FROM supplier LEFT JOIN ev ON ev.symbol = 'S' || CAST(s_suppkey AS VARCHAR) LEFT JOIN lst ON lst.symbol = ev.symbol)"""

_OUTCOMES = _ITEMS + """,
fi AS (SELECT *, doc_id // 10 AS n, CASE WHEN (doc_id // 10) % 9 = 4 THEN 'failed' WHEN (doc_id // 10) % 11 = 6 THEN 'quarantined' ELSE 'accepted' END AS state,
  strftime(day, '%Y-%m-%d') || 'T12:00:00Z' AS published_at, CASE WHEN (doc_id // 10) % 13 = 5 THEN text ELSE regexp_replace(text, '[\\x00-\\x1f]', ' ', 'g') END AS ftext FROM items),
fb AS (SELECT n, state, count(*) AS k, bool_or(regexp_matches(ftext, '[\\x00-\\x1f]')) AS raw FROM fi GROUP BY n, state)"""

_FEED_ITEMS = """d0 AS (SELECT doc_id, 'feed-' || CAST(doc_id // 10 AS VARCHAR) AS feed_id, CASE doc_id % 7 WHEN 3 THEN 'urn:doc:' || CAST(doc_id AS VARCHAR) WHEN 4 THEN '' ELSE 'https://news.example/' || CAST(doc_id AS VARCHAR) END AS link,
  'Document ' || CAST(doc_id AS VARCHAR) || CASE WHEN doc_id % 5 = 2 THEN ' <b>of</b> A &amp; B' ELSE '' END AS title, trim(regexp_replace(regexp_replace(coalesce(text, ''), '<[^>]+>', ' ', 'g'), '[\\s\\x1c-\\x1f\\x{85}\\p{Z}]+', ' ', 'g')) AS body FROM documents),
d AS (SELECT *, bool_or((doc_id // 10) % 17 = 5 AND doc_id % 10 = 0) OVER (PARTITION BY feed_id) AS undated FROM d0)"""

_LINES = _OUTCOMES + """,
ln AS (SELECT row_number() OVER (ORDER BY item_id, published_at, source_type, source_url, author, ftext) - 1 AS i, doc_id, to_json({'author': author, 'item_id': item_id, 'published_at': published_at, 'source_type': source_type, 'source_url': source_url, 'text': ftext})::VARCHAR AS line,
  to_json({'author': CASE WHEN doc_id % 300 = 7 THEN 'x' ELSE author END, 'item_id': item_id, 'published_at': published_at, 'source_type': source_type, 'source_url': source_url, 'text': ftext})::VARCHAR AS changed FROM fi WHERE state = 'accepted')"""
_TREE = _LINES + ", t0 AS (SELECT i // 64 AS node, CAST(min(i) + 1 AS BIGINT) AS first, count(*) AS rows, sha256(string_agg(sha256(line), '' ORDER BY i)) AS digest FROM ln GROUP BY 1)" + "".join(
    f", t{k} AS (SELECT node // 64 AS node, min(first) AS first, CAST(sum(rows) AS BIGINT) AS rows, sha256(string_agg(digest, '' ORDER BY node)) AS digest FROM t{k - 1} WHERE (SELECT count(*) FROM t{k - 1}) > 1 GROUP BY 1)" for k in (1, 2, 3, 4)
)

_DECISION = """count(*) AS feed_count, count(*) FILTER (state = 'accepted') AS successful_feed_count, count(*) FILTER (state = 'failed') AS failed_feed_count, count(*) FILTER (state = 'quarantined') AS quarantined_feed_count,
      CAST(coalesce(sum(k) FILTER (state = 'accepted'), 0) AS BIGINT) AS accepted_row_count, count(*) FILTER (state <> 'accepted') = 0 AS publication_complete, CASE WHEN bool_or(state = 'accepted' AND raw) THEN 'row_invalid' END AS error,
      CASE WHEN bool_or(state = 'accepted' AND raw) THEN 'invalid' WHEN bool_or(state = 'failed') THEN 'hard_fail' WHEN bool_or(state = 'quarantined') THEN 'quarantine' ELSE 'success' END AS decision"""

_WEEKS = f"{_EVENTS}, wk AS (SELECT *, CAST(date_trunc('week', event_date) AS DATE) AS period_start FROM events_)"
_NUMBERED = _WEEKS + ", nums AS (SELECT period_start, (period_start - DATE '1994-12-26') // 7 AS n FROM wk GROUP BY period_start)"

# The texts of contracts, and rules over such texts: what SQL reads there is what the queries wrote and tampered with.
_CONTRACTS = f"""{_NUMBERED}, ac AS (SELECT period_start, confidence, count(*) AS k FROM wk GROUP BY 1, 2),
      w AS (SELECT period_start, n, count(*) AS t, string_agg('{{"path":"events/' || confidence || '.csv","row_count":' || CAST(k AS VARCHAR) || ',"sha256":"' || sha256(CAST(period_start AS VARCHAR) || '|' || confidence) || '"}}', ',' ORDER BY confidence) AS files,
        CASE WHEN n % 6 = 3 THEN 'HEAD' ELSE sha1(CAST(period_start AS VARCHAR)) END AS ref FROM ac JOIN nums USING (period_start) GROUP BY 1, 2),
      c AS (SELECT period_start, n, files, ref, '{{"as_of":"' || CAST(period_start + 6 AS VARCHAR) || '","cadence":"weekly","contract_version":"weekly_source.v1","feed_status":{{"complete":true,"failed_feed_count":0,"feed_count":' || CAST(t AS VARCHAR)
        || ',"missing_feed_count":0,"stale_feed_count":' || CASE WHEN n % 6 = 1 THEN '1' ELSE '0' END || ',"successful_feed_count":' || CAST(t AS VARCHAR) || '}},"generated_at":"' || CAST(CASE WHEN n % 6 = 2 THEN period_start ELSE period_start + 8 END AS VARCHAR)
        || 'T00:00:00.000000Z","period_end_exclusive":"' || CAST(period_start + 7 AS VARCHAR) || '","period_start":"' || CAST(period_start AS VARCHAR) || '","producer_ref":"' || ref
        || '","run_mode":"scheduled","schema_version":"1","source_artifacts":[' || files || '],"source_provenance":"star_schema"}}' AS contract FROM w)"""
_CONTRACT_KEYS = "['as_of', 'cadence', 'contract_version', 'feed_status', 'generated_at', 'period_end_exclusive', 'period_start', 'producer_ref', 'run_mode', 'schema_version', 'source_artifacts', 'source_provenance']"
_LOCK_KEYS = "['as_of', 'calendar', 'lock_version', 'period_end_exclusive', 'period_start', 'producer_ref', 'source_artifacts', 'source_attempt', 'source_provenance', 'source_run_id', 'source_snapshot_digest', 'source_snapshot_id', 'workflow_ref']"
_GATE_KEYS = "['complete', 'failed_feed_count', 'feed_count', 'missing_feed_count', 'stale_feed_count', 'successful_feed_count']"


def _wrapped(contract: str) -> str:
    return f"""'{{"contract":' || {contract} || ',"manifest_type":"weekly_source_manifest"}}'"""


def _text(x: str, path: str) -> str:
    return f"json_extract_string({x}, '$.{path}')"


def _off_canon(x: str, code: str) -> str:
    return f"CASE WHEN CAST(json({x}) AS VARCHAR) <> {x} OR json_keys({x}) <> list_sort(json_keys({x})) THEN '{code}' END"


def _period_off(x: str) -> str:
    day = lambda c: f"CAST({_text(x, c)} AS DATE)"
    return f"(isodow({day('period_start')}) <> 1 OR {day('period_end_exclusive')} - {day('period_start')} <> 7 OR {day('period_end_exclusive')} - {day('as_of')} <> 1)"


def _artifact_fault(x: str) -> str:
    return f"""CASE WHEN coalesce(json_array_length({x}, '$.source_artifacts'), 0) = 0 THEN 'source_artifact_invalid' ELSE list_filter(list_transform(json_extract({x}, '$.source_artifacts[*]'), lambda a: CASE
        WHEN list_sort(list_distinct(json_keys(a))) <> ['path', 'row_count', 'sha256'] THEN 'source_artifact_invalid' WHEN NOT regexp_full_match({_text('a', 'path')}, '[A-Za-z0-9][A-Za-z0-9._/-]*') THEN 'source_artifact_path_invalid'
        WHEN NOT regexp_full_match({_text('a', 'sha256')}, '[0-9a-f]{{64}}') OR CAST({_text('a', 'row_count')} AS BIGINT) < 0 THEN 'source_artifact_invalid' END), lambda e: e IS NOT NULL)[1] END"""


def _contract_fault(x: str) -> str:
    number = lambda c: f"CAST({_text(x, 'feed_status.' + c)} AS BIGINT)"
    return f"""CASE WHEN NOT json_valid({x}) OR list_sort(list_distinct(json_keys({x}))) <> {_CONTRACT_KEYS} THEN 'contract_shape_invalid'
        WHEN {_text(x, 'schema_version')} <> '1' OR {_text(x, 'contract_version')} <> 'weekly_source.v1' OR {_text(x, 'cadence')} <> 'weekly' THEN 'contract_version_invalid' WHEN {_text(x, 'run_mode')} NOT IN ('scheduled', 'manual') THEN 'run_mode_invalid'
        WHEN {_artifact_fault(x)} IS NOT NULL THEN {_artifact_fault(x)} WHEN list_sort(list_distinct(json_keys({x}, '$.feed_status'))) <> {_GATE_KEYS} THEN 'feed_status_invalid'
        WHEN {number('feed_count')} <= 0 OR {number('successful_feed_count')} <> {number('feed_count')} OR {number('failed_feed_count')} + {number('stale_feed_count')} + {number('missing_feed_count')} > 0 OR {_text(x, 'feed_status.complete')} <> 'true' THEN 'feed_status_incomplete'
        WHEN {_period_off(x)} THEN 'period_invalid' WHEN CAST(replace({_text(x, 'generated_at')}, 'Z', '') AS TIMESTAMP) < CAST({_text(x, 'period_end_exclusive')} AS TIMESTAMP) THEN 'generated_at_invalid'
        WHEN NOT regexp_full_match({_text(x, 'producer_ref')}, '[0-9a-f]{{40}}') OR NOT regexp_full_match({_text(x, 'source_provenance')}, '[a-z][a-z0-9]*(_[a-z0-9]+)*') THEN 'provenance_invalid' END"""


def _manifest_fault(x: str) -> str:
    twice = lambda keys: f"len(list_distinct({keys})) < len({keys})"
    inner = f"CAST(json_extract({x}, '$.contract') AS VARCHAR)"
    deep = f"len(list_filter(json_extract({x}, '$.contract.source_artifacts[*]'), lambda a: {twice('json_keys(a)')})) > 0"
    return f"""CASE WHEN NOT json_valid({x}) THEN 'manifest_wire_invalid' WHEN {twice(f'json_keys({x})')} OR {twice(f"json_keys({x}, '$.contract')")} OR {twice(f"json_keys({x}, '$.contract.feed_status')")} OR {deep} THEN 'manifest_duplicate_key'
        WHEN list_sort(json_keys({x})) <> ['contract', 'manifest_type'] OR {_text(x, 'manifest_type')} <> 'weekly_source_manifest' THEN 'manifest_shape_invalid' WHEN json_type({x}, '$.contract') <> 'OBJECT' THEN 'manifest_contract_invalid'
        ELSE coalesce({_contract_fault(inner)}, {_off_canon(x, 'manifest_noncanonical')}) END"""


_EMPTY = "'" + hashlib.sha256(b"[]").hexdigest() + "'"
_STATUS_KEYS = "['accepted_row_count', 'aggregate_row_digest', 'configured_feed_count', 'eligible_for_live_publication', 'failed_feed_count', 'feed_count', 'feeds', 'publication_complete', 'quarantined_feed_count', 'rejected_row_count', 'status_version', 'successful_feed_count']"
_FEED_KEYS = "['accepted_row_count', 'error_code', 'feed_id', 'feed_url', 'kind', 'rejected_row_count', 'row_digest', 'state']"
# Statuses of ten feeds each as text, with the faults that the query's statuses have by number. Digests need not be those of rows but for the empty one.
_STATUS_TEXTS = f"""{_OUTCOMES}, f0 AS (SELECT n, n // 10 AS status_id, 'feed-' || CAST(n AS VARCHAR) AS feed_id, state, CASE WHEN state = 'accepted' THEN k ELSE 0 END AS k, CASE WHEN n % 2 = 0 THEN 'rss2' ELSE 'atom' END AS kind,
        CASE state WHEN 'failed' THEN '"http_error"' WHEN 'quarantined' THEN '"empty_feed"' ELSE 'null' END AS error, CASE WHEN state = 'accepted' THEN repeat('a', 64) ELSE {_EMPTY} END AS digest, (n // 10) % 5 AS way FROM fb),
      f1 AS (SELECT *, '{{"accepted_row_count":' || CASE WHEN way = 4 THEN 0 ELSE k END || ',"error_code":' || error || ',"feed_id":"' || feed_id || '","feed_url":"https://feeds.example/' || n || '","kind":"' || kind || '","rejected_row_count":0,"row_digest":"'
        || CASE WHEN way = 4 AND state <> 'accepted' THEN 'x' ELSE digest END || '","state":"' || state || '"}}' AS feed FROM f0),
      f2 AS (SELECT status_id, way, count(*) AS size, count(*) FILTER (state = 'accepted') AS ok, count(*) FILTER (state = 'failed') AS failed, count(*) FILTER (state = 'quarantined') AS held, CAST(sum(k) AS BIGINT) AS rows, count(*) FILTER (state <> 'accepted') = 0 AS complete,
        CASE WHEN way = 3 THEN string_agg(feed, ',' ORDER BY feed_id DESC) ELSE string_agg(feed, ',' ORDER BY feed_id) END AS feeds FROM f1 GROUP BY 1, 2),
      st AS (SELECT status_id, '{{"accepted_row_count":' || rows || ',"aggregate_row_digest":"' || repeat('b', 64) || '","configured_feed_count":' || size || ',"eligible_for_live_publication":' || complete || ',"failed_feed_count":' || failed || ',"feed_count":' || size || ',"feeds":[' || feeds
        || '],"publication_complete":' || CASE WHEN way = 2 THEN NOT complete ELSE complete END || ',"quarantined_feed_count":' || held || ',"rejected_row_count":0,"status_version":"feed_status.v1","successful_feed_count":' || (ok + CASE WHEN way = 1 THEN 1 ELSE 0 END) || '}}' AS x FROM f2)"""


def _status_fault(x: str) -> str:
    feeds = f"json_extract({x}, '$.feeds[*]')"
    of = lambda test: f"len(list_filter({feeds}, lambda f: {test}))"
    number = lambda c: f"CAST({_text(x, c)} AS BIGINT)"
    state, rows, ids = _text("f", "state"), f"CAST({_text('f', 'accepted_row_count')} AS BIGINT)", f"list_transform({feeds}, lambda f: {_text('f', 'feed_id')})"
    feed = f"""CASE WHEN list_sort(json_keys(f)) <> {_FEED_KEYS} THEN 'feed_invalid' WHEN i > 1 AND {ids}[i - 1] >= {_text('f', 'feed_id')} THEN 'feed_order_invalid' WHEN ({state} = 'accepted') <> ({rows} > 0) THEN 'feed_state_invalid'
        WHEN NOT regexp_full_match({_text('f', 'row_digest')}, '[0-9a-f]{{64}}') THEN 'status_digest_invalid' WHEN ({state} = 'accepted') = ({_text('f', 'row_digest')} = {_EMPTY}) THEN 'empty_digest_invalid' END"""
    first = f"list_filter(list_transform({feeds}, lambda f, i: {feed}), lambda e: e IS NOT NULL)[1]"
    complete = f"({of(f"{state} <> 'accepted'")} = 0)"
    return f"""CASE WHEN NOT json_valid({x}) THEN 'status_invalid' WHEN len(list_distinct(json_keys({x}))) < len(json_keys({x})) OR {of('len(list_distinct(json_keys(f))) < len(json_keys(f))')} > 0 THEN 'status_duplicate_key'
        WHEN list_sort(json_keys({x})) <> {_STATUS_KEYS} THEN 'status_invalid' WHEN {_text(x, 'status_version')} <> 'feed_status.v1' THEN 'status_version_invalid' WHEN {first} IS NOT NULL THEN {first}
        WHEN {number('feed_count')} <> len({feeds}) OR {number('successful_feed_count')} <> {of(f"{state} = 'accepted'")} OR {number('failed_feed_count')} <> {of(f"{state} = 'failed'")} OR {number('quarantined_feed_count')} <> {of(f"{state} = 'quarantined'")}
          OR {number('accepted_row_count')} <> list_sum(list_transform({feeds}, lambda f: {rows})) THEN 'status_counter_invalid'
        WHEN ({number('accepted_row_count')} = 0) <> ({_text(x, 'aggregate_row_digest')} = {_EMPTY}) THEN 'empty_digest_invalid'
        WHEN CAST({_text(x, 'publication_complete')} AS BOOLEAN) <> {complete} OR CAST({_text(x, 'eligible_for_live_publication')} AS BOOLEAN) <> {complete} THEN 'status_flag_invalid' ELSE {_off_canon(x, 'status_noncanonical')} END"""


SQL = {
    "event_study": f"WITH {_returns(False)} SELECT * FROM ret",
    "event_study_sparse_benchmark": f"WITH {_returns(True)} SELECT * FROM ret",
    "return_texts": f"WITH {_returns(True)} SELECT event_id, window_days, printf('%.6f', base_close) AS base_close, printf('%.6f', exit_close) AS exit_close, printf('%.6f', return_pct) AS return_pct, coalesce(printf('%.6f', benchmark_return_pct), '') AS benchmark_return_pct, coalesce(printf('%.6f', abnormal_return_pct), '') AS abnormal_return_pct FROM ret",
    "item_order": f"WITH {_ITEMS} SELECT item_id, row_number() OVER (ORDER BY day, item_id) AS place FROM items",
    "watchlist_statuses": "SELECT 'C' || CAST(c_custkey AS VARCHAR) AS symbol, c_name AS name, '' AS bucket, CASE WHEN c_custkey % 3 = 1 THEN 'active' WHEN c_custkey % 2 = 0 THEN 'older' ELSE '' END AS research_status FROM customer",
    "imported_events": f"""WITH {_RECORDS} SELECT 'official-' || replace(source_type, '_', '-') || '-page-' || CAST(page_id AS VARCHAR) AS event_id, day AS event_date, 'S' || CAST(page_id % 50 AS VARCHAR) AS symbol, event_type,
      CASE WHEN page_id % 2 = 0 THEN 'neutral' ELSE 'bullish' END AS direction, {_CONFIDENCE} AS confidence, source_url, url AS notes FROM err WHERE error_code IS NULL OR error_code = 'entity_match_type_invalid' AND page_id % 50 <> 49 AND page_id % 41 <> 40 AND event_type <> 'rumour'
      AND CASE WHEN page_id % 8 IN (0, 1, 4, 5, 6) THEN regexp_matches(lower(regexp_extract(source_url, '(?i)^https://([^/?#]+)', 1)), '\\.gov$') WHEN page_id % 8 IN (2, 3) THEN regexp_matches(source_url, '(?i)^https://[^/?#]+') ELSE false END""",
    "event_coverage_gaps": f"WITH {_EVENTS}, {_prices(False)} SELECT event_id, event_date, e.symbol FROM events_ e LEFT JOIN (SELECT symbol, max(date) AS last FROM prices WHERE symbol = 'SPY' OR CAST(substr(symbol, 2) AS BIGINT) % 3 <> 0 OR date < DATE '1999-01-01' GROUP BY 1) p ON p.symbol = e.symbol WHERE last IS NULL OR last < event_date",
    "price_last_wins": f"WITH {_RAW}, {_OWN} SELECT symbol, date, close FROM own",
    "return_summary_by_type": f"WITH {_returns(False)} SELECT event_type, window_days, count(*) AS returns, CAST(sum(CAST(return_pct AS DECIMAL(28,6))) AS DECIMAL(38,6)) AS return_sum, CAST(sum(CAST(abnormal_return_pct AS DECIMAL(28,6))) AS DECIMAL(38,6)) AS abnormal_sum FROM ret GROUP BY 1, 2",
    "normalize_records": f"""WITH {_RECORDS} SELECT 'official-' || replace(source_type, '_', '-') || '-page-' || CAST(page_id AS VARCHAR) AS event_id, day AS event_date, 'S' || CAST(page_id % 50 AS VARCHAR) AS symbol, event_type,
      CASE WHEN page_id % 2 = 0 THEN 'neutral' ELSE 'bullish' END AS direction, {_CONFIDENCE} AS confidence, source_url, url AS notes, 'issuer' AS entity_match_type, 'page' AS match_evidence, 'issuer' AS relationship_type FROM err WHERE error_code IS NULL""",
    "rejected_records": f"WITH {_RECORDS} SELECT record_id, error_code FROM err WHERE error_code IS NOT NULL",
    "url_predicates": f"""WITH {_RECORDS} SELECT record_id, regexp_matches(source_url, '(?i)^https://[^/?#]+') AS https, regexp_matches(lower(regexp_extract(source_url, '(?i)^https://([^/?#]+)', 1)), '\\.gov$') AS government,
      'page-' || CAST(page_id AS VARCHAR) AS slug, {_CONFIDENCE} AS confidence FROM rec""",
    "strip_html": """SELECT page_id, replace(replace(replace(replace(trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '[\\s\\x1c-\\x1f\\x{85}\\p{Z}]+', ' ', 'g')), '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&') AS text FROM pages""",
    "stable_item_id": "SELECT page_id, 'pages-' || substr(sha1('pages|' || url || '|' || CAST(page_id AS VARCHAR)), 1, 12) AS item_id FROM pages",
    "published_instant": """SELECT doc_id, strftime(CAST(DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER) AS TIMESTAMP) + to_hours(doc_id % 24) + to_minutes(doc_id % 60) + to_seconds(9)
      - to_minutes(CASE doc_id % 5 WHEN 1 THEN -300 WHEN 2 THEN 330 WHEN 4 THEN -420 ELSE 0 END), '%Y-%m-%dT%H:%M:%SZ') AS published_at FROM documents""",
    "faulty_rows": "SELECT 'clerk ' || CAST(o_custkey % 50 AS VARCHAR) AS clerk, count(*) FILTER (o_orderkey % 7 <> 3 AND o_orderkey % 11 <> 5) AS rows, count(*) FILTER (o_orderkey % 7 = 3 OR o_orderkey % 11 = 5) AS faulty FROM orders GROUP BY 1",
    "published_forms": f"""SELECT doc_id, CASE doc_id % 21 WHEN 18 THEN NULL WHEN 19 THEN '2024-06-01T00:00:00Z' ELSE strftime(CAST(DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER) AS TIMESTAMP)
      + to_hours(CASE WHEN doc_id % 21 = 16 THEN 0 ELSE doc_id % 24 END) + to_minutes(CASE WHEN doc_id % 21 IN (9, 16) THEN 0 ELSE doc_id % 60 END) + to_seconds(CASE WHEN doc_id % 21 IN (9, 12, 16) THEN 0 ELSE 9 END)
      - to_minutes(CASE doc_id % 21 WHEN 13 THEN 120 WHEN 14 THEN -420 WHEN 15 THEN -210 WHEN 17 THEN -330 ELSE 0 END), '%Y-%m-%dT%H:%M:%SZ') END AS published_at FROM documents""",
    "feed_faults": f"""WITH {_FEED_ITEMS}, r AS (SELECT *, row_number() OVER (PARTITION BY feed_id ORDER BY doc_id) AS pos FROM d) SELECT feed_id, 'first' AS payload, CASE WHEN bool_or(undated) THEN 0 ELSE count(*) END AS items,
      CASE WHEN bool_or(undated) THEN 'feed_date_invalid' ELSE '' END AS error FROM r GROUP BY 1 UNION ALL SELECT feed_id, 'second', count(*), '' FROM r WHERE pos > 1 GROUP BY 1""",
    "alias_kinds": """SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS symbol, u.alias, CASE WHEN regexp_matches(u.alias, '^[A-Za-z]$') THEN 'cashtag' WHEN regexp_matches(u.alias, '^[A-Za-z][A-Za-z0-9.\\-]{0,9}$') THEN 'ticker' ELSE 'phrase' END AS kind
      FROM supplier, LATERAL (SELECT unnest([s_name, 'S' || CAST(s_suppkey AS VARCHAR)]) AS alias) u""",
    "mention_join": f"WITH {_MENTIONS} SELECT item_id, symbol FROM found",
    "mention_many": f"""WITH {_ITEMS}, w AS (SELECT item_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS word FROM items), most AS (SELECT word FROM w WHERE regexp_full_match(word, '[a-z]{{4,9}}') GROUP BY 1 ORDER BY count(*) DESC, word LIMIT 1000)
      SELECT DISTINCT item_id, upper(word) AS symbol FROM w JOIN most USING (word)""",
    "mention_index": f"""WITH {_ITEMS}, w AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS word FROM items)
      SELECT item_id, upper(word) AS symbol FROM w WHERE regexp_full_match(word, '[a-z]{{4,9}}')""",
    "stream_mentions": f"WITH {_MENTIONS} SELECT item_id, symbol FROM found",
    "mention_events": f"""WITH {_MENTIONS}, j AS (SELECT i.*, f.symbol FROM items i JOIN found f USING (item_id)) SELECT 'official-' || replace(source_type, '_', '-') || '-' || item_id || '-' || lower(symbol) AS event_id, day AS event_date, symbol,
      CASE WHEN source_type = 'financial_media' THEN 'public_mention' WHEN regexp_matches(lower(text), 'contract|procurement|award') THEN 'procurement' WHEN regexp_matches(lower(text), 'policy|funding|capital|stake') THEN 'policy_capital' ELSE 'public_mention' END AS event_type,
      CASE WHEN regexp_matches(lower(text), 'avoid|ban|sanction|investigation|risk|delay|block|bearish|sell') THEN 'bearish' WHEN regexp_matches(lower(text), 'buy|bullish|great|partner|award|funding|capital|support|contract|upside') THEN 'bullish' ELSE 'neutral' END AS direction,
      CASE WHEN source_type = 'financial_media' THEN 'low' WHEN source_type = 'issuer_release' THEN 'medium' ELSE 'high' END AS confidence, source_url FROM j WHERE source_url NOT LIKE 'http://%'""",
    "tracker": f"WITH {_TRACKER} SELECT * FROM tr",
    "tracker_rank": f"WITH {_TRACKER} SELECT symbol, priority_score, CAST(row_number() OVER (ORDER BY priority_score DESC, symbol, name) AS INTEGER) AS tracker_rank FROM tr",
    "symbol_summary": f"WITH {_EVENTS} SELECT count(DISTINCT symbol) AS symbol_count, string_agg(DISTINCT symbol, ',' ORDER BY symbol) AS symbols FROM events_",
    "confidence_counts": f"WITH {_EVENTS} SELECT confidence AS value, count(*) AS count FROM events_ GROUP BY 1",
    "event_type_counts": f"WITH {_EVENTS} SELECT event_type AS value, count(*) AS count FROM events_ GROUP BY 1",
    "feed_rollup": f"""WITH {_OUTCOMES} SELECT count(*) AS feed_count, count(*) FILTER (state = 'accepted') AS successful_feed_count, count(*) FILTER (state <> 'accepted') AS failed_feed_count,
      CAST(sum(CASE WHEN state = 'accepted' THEN k ELSE 0 END) AS BIGINT) AS item_count, CAST(count(*) FILTER (state = 'accepted') AS DOUBLE) / count(*) AS ratio FROM fb""",
    "feed_top_n": "SELECT source AS feed_id, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 25",
    "feed_parse": f"""WITH {_FEED_ITEMS} SELECT feed_id || '-' || substr(sha1(feed_id || '|' || link || '|' || title), 1, 12) AS item_id, strftime(DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER), '%Y-%m-%d') || 'T13:30:00Z' AS published_at,
      link AS source_url, 'desk' AS author, title || CASE WHEN body = '' THEN '' ELSE ' ' || body END AS text, feed_id, CAST(row_number() OVER (PARTITION BY feed_id ORDER BY doc_id) - 1 AS INTEGER) AS pos FROM d WHERE NOT undated""",
    "feed_statuses": f"""WITH {_FEED_ITEMS} SELECT feed_id, 'https://feeds.example/' || CAST(doc_id // 10 AS VARCHAR) AS feed_url, NOT bool_or(undated) AS ok, CASE WHEN bool_or(undated) THEN 0 ELSE count(*) END AS item_count,
      CASE WHEN bool_or(undated) THEN 'feed_date_invalid' ELSE '' END AS error FROM d GROUP BY feed_id, doc_id // 10""",
    "feed_digest": f"""WITH {_OUTCOMES} SELECT 'feed-' || CAST(n AS VARCHAR) AS feed_id, state, CASE WHEN state = 'accepted' THEN count(*) ELSE 0 END AS accepted_row_count,
      CASE WHEN state = 'accepted' THEN sha256('[' || string_agg(to_json({{'author': author, 'item_id': item_id, 'published_at': published_at, 'source_type': source_type, 'source_url': source_url, 'text': ftext}})::VARCHAR, ',' ORDER BY item_id, published_at, source_type, source_url, author, ftext) || ']')
      ELSE sha256('[]') END AS row_digest FROM fi GROUP BY n, state""",
    "accepted_rows_digest": f"""WITH {_OUTCOMES} SELECT count(*) AS row_count, CAST(coalesce(sum(CAST(('0x' || substr(md5(to_json({{'author': author, 'item_id': item_id, 'published_at': published_at, 'source_type': source_type, 'source_url': source_url, 'text': ftext}})::VARCHAR), 1, 15)) AS BIGINT)), 0) AS VARCHAR) AS hash_sum
      FROM fi WHERE state = 'accepted'""",
    "event_order": f"WITH {_EVENTS} SELECT event_id, row_number() OVER (ORDER BY event_date, symbol, event_id) AS place FROM events_",
    "accepted_rows_tree": f"WITH {_TREE} " + " UNION ALL ".join(f"SELECT {k} AS level, node, first, rows, digest FROM t{k}" for k in range(5)),
    "accepted_rows_changed": f"WITH {_LINES} SELECT min(i) + 1 AS first, count(*) AS a_rows, count(*) AS b_rows FROM ln GROUP BY i // 64 HAVING bool_or(line <> changed)",
    "quality_summary": f"""WITH {_EVENTS}, {_OUTCOMES}, c AS (SELECT string_agg(confidence || '=' || CAST(k AS VARCHAR), ',' ORDER BY confidence) AS x FROM (SELECT confidence, count(*) AS k FROM events_ GROUP BY 1)),
      t AS (SELECT string_agg(event_type || '=' || CAST(k AS VARCHAR), ',' ORDER BY event_type) AS x FROM (SELECT event_type, count(*) AS k FROM events_ GROUP BY 1))
      SELECT (SELECT count(DISTINCT symbol) FROM events_) AS symbol_count, c.x AS confidence_counts, t.x AS event_type_counts, (SELECT count(*) FROM fb) AS feed_count,
      (SELECT CAST(sum(CASE WHEN state = 'accepted' THEN k ELSE 0 END) AS BIGINT) FROM fb) AS item_count FROM c, t""",
    "outcome_faults": f"WITH {_OUTCOMES} SELECT state, CASE WHEN state = 'accepted' AND raw THEN 'row_invalid' END AS fault, count(*) AS feeds FROM fb GROUP BY 1, 2",
    "publication_decision": f"WITH {_OUTCOMES} SELECT {_DECISION} FROM fb",
    "group_decisions": f"WITH {_OUTCOMES} SELECT n // 10 AS group_id, {_DECISION} FROM fb GROUP BY 1",
    "status_audit": f"""WITH {_OUTCOMES}, s AS (SELECT n // 10 AS status_id, count(*) AS k, count(*) FILTER (state = 'accepted') AS acc, min_by(state, 'feed-' || CAST(n AS VARCHAR)) AS first FROM fb GROUP BY 1)
      SELECT status_id, CASE WHEN status_id % 5 = 4 THEN CASE WHEN first = 'accepted' THEN 'feed_state_invalid' ELSE 'status_digest_invalid' END WHEN status_id % 5 = 3 AND k > 1 THEN 'feed_order_invalid'
      WHEN status_id % 5 = 1 THEN 'status_counter_invalid' WHEN acc = 0 THEN 'empty_digest_invalid' WHEN status_id % 5 = 2 THEN 'status_flag_invalid' END AS error_code FROM s""",
    "status_wire_audit": f"""WITH {_STATUS_TEXTS}, t AS (SELECT status_id, CASE CAST(floor(status_id / 5 + status_id) AS BIGINT) % 8 WHEN 1 THEN replace(x, '"status_version"', '"state":1,"status_version"') WHEN 2 THEN ' ' || x WHEN 3 THEN replace(x, 'feed_status.v1', 'feed_status.v0')
        WHEN 4 THEN replace(x, '"failed_feed_count"', '"feed_count":1,"failed_feed_count"') WHEN 5 THEN replace(x, '"kind":"atom"', '"kind":"atom","more":1') WHEN 6 THEN replace(x, '"kind":"atom"', '"kind":"atom","kind":"atom"') ELSE x END AS x FROM st)
      SELECT status_id, {_status_fault('x')} AS error_code FROM t""",
    "weekly_period": f"WITH {_WEEKS} SELECT event_id, period_start, period_start + 7 AS period_end_exclusive, period_start + 6 AS as_of FROM wk",
    "weekly_counts": f"WITH {_WEEKS} SELECT period_start, event_type, count(*) AS events FROM wk GROUP BY 1, 2",
    "weekly_snapshot": f"""WITH {_WEEKS}, a AS (SELECT period_start, confidence, count(*) AS k FROM wk GROUP BY 1, 2) SELECT period_start,
      string_agg('events/' || confidence || '.csv:' || sha256(CAST(period_start AS VARCHAR) || '|' || confidence) || ':' || CAST(k AS VARCHAR), ',' ORDER BY confidence) AS artifacts, false AS duplicate_paths FROM a GROUP BY 1""",
    "weekly_gate": f"""WITH {_WEEKS}, a AS (SELECT period_start, confidence, count(*) AS k FROM wk GROUP BY 1, 2), grid AS (SELECT * FROM (SELECT DISTINCT period_start FROM wk), (SELECT DISTINCT confidence FROM wk))
      SELECT period_start, count(*) AS feed_count, count(*) FILTER (k > 1) AS successful_feed_count, count(*) FILTER (k = 1) AS failed_feed_count, CAST(0 AS BIGINT) AS stale_feed_count, count(*) FILTER (k IS NULL) AS missing_feed_count,
      bool_and(coalesce(k > 1, false)) AS complete FROM grid LEFT JOIN a USING (period_start, confidence) GROUP BY 1""",
    "contract_audit": f"""WITH {_CONTRACTS}, t AS (SELECT period_start, CASE n % 6 WHEN 4 THEN ' ' || contract WHEN 5 THEN replace(contract, '"run_mode":"scheduled"', '"run_mode":"nightly"') ELSE contract END AS x FROM c)
      SELECT period_start, coalesce({_contract_fault('x')}, {_off_canon('x', 'noncanonical')}) AS error_code FROM t""",
    "lock_audit": f"""WITH {_CONTRACTS}, t AS (SELECT period_start, '{{"as_of":"' || CAST(period_start + 6 AS VARCHAR) || '","calendar":"utc_iso_week_monday_sunday","lock_version":"weekly_period_lock.v1","period_end_exclusive":"' || CAST(period_start + 7 AS VARCHAR)
        || '","period_start":"' || CAST(period_start AS VARCHAR) || '","producer_ref":"' || ref || '","source_artifacts":[' || files || '],"source_attempt":1,"source_provenance":"star_schema","source_run_id":"' || CAST(n + 1 AS VARCHAR)
        || '","source_snapshot_digest":"' || sha256('[' || files || ']') || '","source_snapshot_id":"events_weekly","workflow_ref":"jobs/weekly@v1"}}' AS x FROM c)
      SELECT period_start, CASE WHEN NOT json_valid(x) OR list_sort(json_keys(x)) <> {_LOCK_KEYS} THEN 'lock_shape_invalid' WHEN {_text('x', 'lock_version')} <> 'weekly_period_lock.v1' OR {_text('x', 'calendar')} <> 'utc_iso_week_monday_sunday' THEN 'lock_version_invalid'
        WHEN {_period_off('x')} THEN 'period_invalid' WHEN NOT regexp_full_match({_text('x', 'workflow_ref')}, '[A-Za-z0-9][A-Za-z0-9._/@-]*') THEN 'workflow_ref_invalid' WHEN NOT regexp_full_match({_text('x', 'source_run_id')}, '[1-9][0-9]*') THEN 'source_run_id_invalid'
        WHEN {_text('x', 'source_attempt')} <> '1' THEN 'source_attempt_invalid' WHEN NOT regexp_full_match({_text('x', 'producer_ref')}, '[0-9a-f]{{40}}') THEN 'producer_ref_invalid' WHEN NOT regexp_full_match({_text('x', 'source_snapshot_digest')}, '[0-9a-f]{{64}}') THEN 'source_snapshot_digest_invalid'
        WHEN {_artifact_fault('x')} IS NOT NULL THEN {_artifact_fault('x')} ELSE {_off_canon('x', 'noncanonical')} END AS error_code FROM t""",
    "lock_reconcile": f"""WITH {_NUMBERED} SELECT period_start, CASE n % 10 WHEN 7 THEN 'missing' WHEN 8 THEN 'unexpected' WHEN 3 THEN 'mismatch' ELSE 'match' END AS verdict, CASE WHEN n % 10 = 3 THEN 'source_run_id' ELSE '' END AS differing FROM nums""",
    "weekly_manifest": f"WITH {_CONTRACTS} SELECT period_start, {_wrapped('contract')} AS manifest FROM c",
    "manifest_audit": f"""WITH {_CONTRACTS}, m AS (SELECT period_start, n, {_wrapped('contract')} AS x FROM c),
      t AS (SELECT period_start, CASE n % 7 WHEN 1 THEN replace(x, '"manifest_type"', '"kind":1,"manifest_type"') WHEN 2 THEN x || ' ' WHEN 3 THEN replace(x, 'weekly_source_manifest', 'daily') WHEN 4 THEN replace(x, '"manifest_type"', '"contract":{{}},"manifest_type"')
        WHEN 5 THEN replace(x, '"complete":true', '"complete":true,"complete":true') WHEN 6 THEN replace(x, '{{"path"', '{{"more":1,"path"') ELSE x END AS x FROM m)
      SELECT period_start, {_manifest_fault('x')} AS error_code FROM t""",
    "manifest_verify": f"""WITH {_CONTRACTS}, a AS (SELECT period_start, {_wrapped('contract')} AS x FROM c WHERE n % 7 <> 4), e AS (SELECT period_start, CASE n % 7 WHEN 3 THEN replace(contract, '"run_mode":"scheduled"', '"run_mode":"manual"') ELSE contract END AS y FROM c WHERE n % 7 <> 5)
      SELECT period_start, CASE WHEN x IS NULL THEN 'missing' WHEN y IS NULL THEN 'unexpected' ELSE coalesce({_manifest_fault('x')}, CASE WHEN json_extract(x, '$.contract') <> json(y) THEN 'manifest_contract_mismatch' ELSE 'match' END) END AS verdict FROM a FULL JOIN e USING (period_start)""",
    # files are known to SQL by path only: those of the scale at which results are compared
    "live_manifest": f"""WITH {_EVENTS}, {_OUTCOMES}, n AS ({" UNION ALL ".join(f"SELECT '{t}.parquet' AS path, count(*) AS k FROM {t}" for t in _TABLES)}),
      f AS (SELECT regexp_extract(filename, '[^/]+$') AS path, sha256(content) AS digest FROM read_blob('/root/testdata/sf0.01/*.parquet')),
      a AS (SELECT count(*) AS m, string_agg('{{"path":"' || path || '","sha256":"' || digest || '","row_count":' || CAST(k AS VARCHAR) || '}}', ',' ORDER BY path) AS x FROM f JOIN n USING (path)),
      s AS (SELECT count(*) AS m, string_agg('"' || symbol || '"', ',' ORDER BY symbol) AS x FROM (SELECT DISTINCT symbol FROM events_)),
      c AS (SELECT string_agg('"' || confidence || '":' || CAST(k AS VARCHAR), ',' ORDER BY confidence) AS x FROM (SELECT confidence, count(*) AS k FROM events_ GROUP BY 1)),
      t AS (SELECT string_agg('"' || event_type || '":' || CAST(k AS VARCHAR), ',' ORDER BY event_type) AS x FROM (SELECT event_type, count(*) AS k FROM events_ GROUP BY 1)),
      b AS (SELECT count(*) AS m, count(*) FILTER (state = 'accepted') AS ok, CAST(coalesce(sum(k) FILTER (state = 'accepted'), 0) AS BIGINT) AS items FROM fb)
      SELECT '{{"artifact_count":' || a.m || ',"artifacts":[' || a.x || '],"data_quality":{{"symbol_count":' || s.m || ',"symbols":[' || s.x || '],"confidence_counts":{{' || c.x || '}},"event_type_counts":{{' || t.x || '}},"feed_count":' || b.m
        || ',"successful_feed_count":' || b.ok || ',"failed_feed_count":' || (b.m - b.ok) || ',"item_count":' || b.items || ',"feed_success_ratio":' || CAST(round(b.ok / b.m, 4) AS VARCHAR) || '}}}}' AS value FROM a, s, c, t, b""",
    "dataset_inventory": " UNION ALL ".join(f"SELECT '{t}' AS artifact, count(*) AS row_count FROM {t}" for t in _TABLES),
    "stream_weekly_counts": """WITH c AS (SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS period_start, o_orderpriority, count(*) AS events FROM orders GROUP BY 1, 2)
      SELECT * FROM c WHERE period_start + 7 <= (SELECT max(o_orderdate) FROM orders) - INTERVAL 14 DAY""",
    "stream_weekly_gate": """WITH o AS (SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS period_start, substr(o_orderpriority, 1, 1) AS feed_id, bool_or(o_orderkey % 7 > 4) AS ok,
        max(CAST(o_orderdate AS DATE) - CASE WHEN substr(o_orderpriority, 1, 1) = '5' AND o_orderkey % 4 > 0 THEN 365 ELSE 0 END) AS last_item FROM orders GROUP BY 1, 2),
      w AS (SELECT DISTINCT period_start FROM o WHERE period_start + 7 <= (SELECT max(o_orderdate) FROM orders) - INTERVAL 14 DAY), f AS (SELECT unnest(['1', '2', '3', '4', '5', '6']) AS feed_id),
      j AS (SELECT w.period_start, o.ok, o.ok AND last_item < w.period_start AS stale FROM w CROSS JOIN f LEFT JOIN o ON o.period_start = w.period_start AND o.feed_id = f.feed_id)
      SELECT period_start, count(*) AS feed_count, count(*) FILTER (ok AND NOT stale) AS successful_feed_count, count(*) FILTER (NOT ok) AS failed_feed_count, count(*) FILTER (stale) AS stale_feed_count, count(*) FILTER (ok IS NULL) AS missing_feed_count,
      bool_and(coalesce(ok AND NOT stale, false)) AS complete FROM j GROUP BY 1""",
}
SQL |= {"stream_tracker": SQL["tracker"], "stream_feed_parse": SQL["feed_parse"]}
