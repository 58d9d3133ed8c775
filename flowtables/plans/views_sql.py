"""The base views again, in SQL, written from the same definitions but without the operators under test."""

from __future__ import annotations

HEADER = """'{' || array_to_string(list_transform(entries, lambda e: '"' || e.k || '":"' || e.v || '"'), ',') || '}'"""

FLOWS = f"""
flow_entries AS (
  SELECT doc_id AS flow_id, text, strlen(text) AS size, lang, source AS src,
    list_filter([
      {{'k': 'big', 'v': CASE WHEN doc_id % 50 = 7 THEN repeat('x', 600) END}},
      {{'k': 'filename', 'v': 'doc_' || doc_id || '.txt'}},
      {{'k': 'lang', 'v': lang}},
      {{'k': 'mime.type', 'v': 'text/plain'}},
      {{'k': 'note', 'v': CASE WHEN doc_id % 5 = 0 THEN '' END}},
      {{'k': 'path', 'v': './' || source || '/'}},
      {{'k': 'priority', 'v': CASE WHEN doc_id % 3 = 0 THEN '1' END}},
      {{'k': 'source', 'v': source}},
      {{'k': 'uuid', 'v': 'u-' || doc_id}}], lambda e: e.v IS NOT NULL) AS entries
  FROM documents),
flows AS (
  SELECT *, {HEADER} AS header,
    '10.0.' || (flow_id % 4) || '.' || (flow_id % 200 + 1) AS source
  FROM flow_entries)"""

SHORT_FLOWS = FLOWS.replace("doc_id % 50 = 7", "false")

_DATAGRAMS = """,
announced AS (
  SELECT *, 460 - strlen(header) AS fill,
    1 + greatest(CAST(ceil((size - (460 - strlen(header))) / 468.0) AS BIGINT), 0) AS n,
    hex(encode(text)) AS hexed
  FROM flows WHERE strlen(header) <= 460),
datagrams AS (
  SELECT source, flow_id, n, counter, CASE WHEN counter = 0 THEN 0 ELSE 1 END AS header_type,
    size AS payload_length, header,
    CASE WHEN counter = 0 THEN substr(hexed, 1, 2 * fill)
         ELSE substr(hexed, 2 * (fill + (counter - 1) * 468) + 1, 2 * 468) END AS piece
  FROM (SELECT *, unnest(generate_series(0, n - 1)) AS counter FROM announced))"""

_ARRIVALS = """,
arrivals AS (
  SELECT *, arrival_ms * 10 + copy AS arrival_seq, TIMESTAMP '2024-01-01' + to_milliseconds(arrival_ms) AS arrival_ts
  FROM (
    SELECT *, (flow_id % 1000) * 5000 + (counter * 389 + flow_id) % 1013 + copy * 50
      + CASE WHEN flow_id % 20 = 3 AND counter = n - 1 THEN 3000 ELSE 0 END AS arrival_ms
    FROM (
      SELECT *, unnest(CASE WHEN (flow_id * 7 + counter * 13) % 11 = 0 THEN [0, 1] ELSE [0] END) AS copy
      FROM datagrams WHERE (flow_id * 31 + counter * 17) % 97 <> 0)))"""

DATAGRAMS = SHORT_FLOWS + _DATAGRAMS
ARRIVALS = DATAGRAMS + _ARRIVALS
UNLOST_ARRIVALS = DATAGRAMS + _ARRIVALS.replace("WHERE (flow_id * 31 + counter * 17) % 97 <> 0", "")
# With the flows whose headers are too long to be sent.
ALL_DATAGRAMS = FLOWS + _DATAGRAMS
ALL_ARRIVALS = ALL_DATAGRAMS + _ARRIVALS

FRAMES = (
    FLOWS
    + """,
frames AS (
  SELECT *, flow_id % 50 AS conn_id,
    row_number() OVER (PARTITION BY flow_id % 50 ORDER BY flow_id) - 1 AS frame_no,
    lpad(to_hex(strlen(header)), 8, '0') || lpad(to_hex(size), 16, '0') || hex(encode(header)) || hex(encode(text)) AS frame
  FROM flows),
placed AS (
  SELECT *, sum(strlen(frame) // 2) OVER (PARTITION BY conn_id ORDER BY flow_id) AS frame_end,
    sum(strlen(frame) // 2) OVER (PARTITION BY conn_id) AS total
  FROM frames)"""
)

EVENT_IP = "'10.' || (user_id % 4) || '.' || (event_id % 256) || '.' || (user_id % 256)"


def with_views(views: str, select: str) -> str:
    return f"WITH {views.strip()}\n{select.strip()}"
