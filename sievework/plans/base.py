"""SQL of the relations that the queries share, as common table expressions for DuckDB."""

#: White space of every script, as the Unicode-aware class of the other engine reads it.
WS = r"[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def opens(x: str) -> str:
    return f"len(regexp_extract_all({x}, '(?i)<think>'))"


def closes(x: str) -> str:
    return f"len(regexp_extract_all({x}, '(?i)</think>'))"


def without_blocks(x: str) -> str:
    return f"regexp_replace({x}, '(?is)<think>.*?</think>', '', 'g')"


MSG = f"""raw AS (SELECT ex_id, pos, any_value(run_id) AS run_id, lower({strip("any_value(role)")}) AS r, any_value(content) AS content FROM messages GROUP BY ex_id, pos),
msg AS (SELECT ex_id, pos, run_id, CASE WHEN r IN ('user', 'human') THEN 'user' WHEN r IN ('assistant', 'gpt', 'bot', 'model') THEN 'assistant' WHEN r = 'system' THEN 'system' END AS role, content FROM raw)"""
EX = f"""one AS (SELECT ex_id, any_value(run_id) AS run_id, any_value(target_id) AS target_id, any_value(metadata) AS m, any_value(created_at) AS created_at FROM examples GROUP BY ex_id),
ex AS (SELECT ex_id, run_id, target_id, created_at, lower({strip("m.layer")}) AS layer, lower({strip("m.type")}) AS type, m.ao AS ao, lower({strip("m.text")}) AS text, lower({strip("m.topic")}) AS topic, m.grade_target AS grade_target, m.source AS source, m.turns AS turns FROM one)"""
REJ = "rej AS (SELECT reject_id, any_value(run_id) AS run_id, any_value(target_id) AS target_id, any_value(category) AS category, any_value(type) AS type, lower(any_value(reason)) AS reason, any_value(rejection_history) AS rejection_history, any_value(rejected_at) AS rejected_at FROM rejections GROUP BY reject_id)"
DEFECT = f"""CASE WHEN content IS NULL THEN NULL
 WHEN role = 'assistant' AND {strip(without_blocks("content"))} = '' THEN 'validation_failed: empty_assistant'
 WHEN {strip("content")} = '...' THEN 'validation_failed: degenerate_placeholder (' || role || ')'
 WHEN role = 'assistant' AND {opens("content")} <> {closes("content")} THEN 'validation_failed: unclosed_think_block (opens=' || {opens("content")} || ', closes=' || {closes("content")} || ')' END"""
