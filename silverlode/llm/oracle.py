"""Expected results of the text operators that SQL can express."""

OP5 = r"""
WITH urls AS (
  SELECT page_id, coalesce(url, '') AS u, instr(coalesce(url, ''), '://') AS mark FROM pages
), parts AS (
  SELECT page_id,
    CASE WHEN mark > 0 THEN translate(regexp_extract(substr(u, mark + 3), '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN mark > 0 THEN regexp_extract(substr(u, mark + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM urls
), judged AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
  END AS rule FROM parts
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM judged
"""

# A turn is 12 + 10 + 10 characters of marks, its role and its escaped text; an example holds all turns up to its own.
OP12 = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, turn, role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)
), parts AS (
  SELECT *,
    32 + length(regexp_replace(role, CONTROL, chr(8288) || '\1', 'g')) + length(regexp_replace(text, CONTROL, chr(8288) || '\1', 'g')) AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role DESC, text DESC) = 1 AS last
  FROM (SELECT *, '([<\[]\x{2060}*(?:\|[A-Za-z0-9_]+\|>|/?s>|/?INST\]|<SYS>>|</SYS>>))' AS CONTROL FROM said)
), running AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING) AS upto FROM parts
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (role = 'assistant' OR last) AS BIGINT) AS formatted_chars
FROM running GROUP BY conv_id
"""

ORACLE_SQL: dict[str, str] = {"op5_url_filters": OP5, "op12_chat_formatting": OP12}
