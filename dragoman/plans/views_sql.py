"""DuckDB twins of the derived views, as CTE texts with their dependencies."""

from __future__ import annotations

from dragoman import dims
from dragoman.plans import views

# fixed values: Python whitespace in RE2 notation, and as a trim set
RE2_WS = (r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
TRIM_SET = ("(select string_agg(chr(p::int), '') from (select unnest([9,10,11,12,13,28,29,30,31,32,133,160,5760,8192,8193,"
            "8194,8195,8196,8197,8198,8199,8200,8201,8202,8232,8233,8239,8287,12288]) as p))")


def lit(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + str(value).replace("'", "''") + "'"


def rows(table_rows, columns) -> str:
    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in table_rows)
    return f"SELECT * FROM (VALUES {body}) AS v({', '.join(columns)})"


def bucket(expr: str, seed: str = "42") -> str:
    return f"(('0x' || substr(md5('{seed}|' || ({expr})), 1, 8))::BIGINT % 100)"


def strip(expr: str) -> str:
    return f"trim({expr}, (SELECT s FROM ws))"


def _message(template: str) -> str:
    text = lit(template).replace("{e}", "' || event_id || '").replace("{u}", "' || user_id || '")
    return text


def case(expr: str, values: list[str]) -> str:
    return f"CASE {expr} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


def pick_language(cls: str, draw: str, column: int) -> str:
    parts, low = [], 0
    for row in dims.LANGUAGES:
        low += row[2]
        parts.append(f"WHEN {draw} < {low} THEN {lit(row[column])}")
    english = ", ".join(map(str, dims.ENGLISH_ONLY))
    return f"CASE WHEN {cls} IN ({english}) THEN {lit(dims.LANGUAGES[0][column])} {' '.join(parts)} END"


def re2(pattern: str, ignore_case: bool) -> str:
    """A cascade pattern for RE2: unicode whitespace, and ``$`` also before a final line feed."""
    body = pattern.replace(r"[^a-zA-Z0-9\s]", f"[^a-zA-Z0-9{RE2_WS}]").replace("$", r"\n?$")
    return lit(("(?i)" if ignore_case else "") + body)


def first_match(text: str) -> str:
    whens = " ".join(f"WHEN regexp_matches({text}, {re2(p, ic)}) THEN {i}"
                     for i, (p, ic, _, _) in enumerate(dims.PATTERNS))
    return f"CASE {whens} END"


CASCADE_LABEL = case("rule_no", [lit(p[2]) for p in dims.PATTERNS]).replace(" END", " ELSE 'unknown' END")
CASCADE_TIER = case("rule_no", [lit(p[3]) for p in dims.PATTERNS]).replace(" END", " ELSE '?' END")

LATIN = "regexp_replace(lower(s), '[^a-zA-Z]', '', 'g')"
NOISE_RULE = (
    "CASE WHEN s = '' THEN 'empty' WHEN length(s) < 2 THEN 'one_char' "
    r"WHEN NOT regexp_matches(s, '[a-zA-Z0-9\x{600}-\x{6ff}\x{900}-\x{97f}\x{4e00}-\x{9fff}\x{ac00}-\x{d7af}\x{400}-\x{4ff}\x{370}-\x{3ff}]') THEN 'no_alphanumeric' "
    "WHEN length(s) >= 5 AND substr(s, 1, 1) <> chr(10) AND replace(s, substr(s, 1, 1), '') = '' THEN 'repeat' "
    f"WHEN length({LATIN}) > 6 AND length(regexp_replace({LATIN}, '[^aeiou]', '', 'g'))::DOUBLE / length({LATIN}) < 0.05 THEN 'mash' "
    f"WHEN length({LATIN}) >= 6 AND len(list_distinct(string_split({LATIN}, ''))) >= 4 AND ("
    + " OR ".join(f"regexp_full_match({LATIN}, '[{row}]+')" for row in ("qwertyuiop", "asdfghjkl", "zxcvbnm"))
    + ") THEN 'keyboard_row' END"
)

_FILL = "[" + ", ".join(lit(w) for w in views.FILLERS) + "]"

CTES: dict[str, tuple[list[str], str]] = {
    "ws": ([], f"SELECT {TRIM_SET} AS s"),
    "dim_intent": ([], rows([(c - 1, c, l, t, l in dims.SHORT_OK, c in dims.ENGLISH_ONLY) for c, l, t in dims.INTENTS],
                            ["class_idx", "class_id", "label", "tier", "short_ok", "english_only"])),
    "dim_resource": ([], rows(list(enumerate(dims.RESOURCES)), ["resource_idx", "resource_class"])),
    "dim_language": ([], rows(dims.LANGUAGES, ["iso", "resource_class", "weight", "language_name"])),
    "dim_route": ([], rows(dims.ROUTES, ["tier", "label", "action"])),
    "utterances": ([], "SELECT event_id AS msg_id, ts, user_id, (event_id % 36)::INT AS k, value, "
                   + case("event_id % 36", [_message(m) for m in views.MESSAGES]) + " AS text FROM events"),
    "stripped": (["ws", "utterances"], f"SELECT *, {strip('text')} AS s FROM utterances"),
    "gate": (["stripped"], f"SELECT *, {NOISE_RULE} AS gate_rule FROM stripped"),
    "cascade": (["utterances"], f"SELECT *, {CASCADE_LABEL} AS label, {CASCADE_TIER} AS tier, rule_no IS NOT NULL AS matched "
                f"FROM (SELECT *, {first_match('text')} AS rule_no FROM utterances)"),
    "routed": (["cascade"], "SELECT *, CASE WHEN tier = '1' AND label = 'adversarial_probe' THEN 'block' WHEN tier = '1' THEN 'drop' "
               "WHEN tier = '2' THEN 'static_template' WHEN tier = '3' THEN 'device_api' WHEN tier = '4' THEN 'cache_lookup' "
               "ELSE 'route_to_frontier' END AS action FROM cascade"),
    "example_lines": (["dim_intent"],
        "SELECT cls AS file_class_id, e AS line_no, CASE WHEN e % 97 = 0 THEN '' ELSE '{\"text\": ' || CASE WHEN f = 11 THEN 'null' "
        "WHEN f = 6 THEN '\"  \"' ELSE '\"' || words || '\"' END || ', \"intent_class_label\": \"' || "
        "CASE WHEN f = 7 THEN 'mystery_label' ELSE label END || '\"' || CASE WHEN f = 9 THEN '' ELSE ', \"resource_class\": \"' || "
        "CASE WHEN f = 8 THEN 'xx' ELSE rc END || '\"' END || ', \"language_iso\": \"' || iso || '\"' || CASE WHEN f = 10 THEN '' ELSE '}' END END AS line "
        "FROM (SELECT e, cls, f, label, replace(label, '_', ' ') || ' ' || array_to_string(list_slice("
        + _FILL + ", 1, (e % 13)::INT), ' ') || ' ' || (e % 101) AS words, "
        + pick_language("cls", "draw", 0) + " AS iso, " + pick_language("cls", "draw", 1) + " AS rc "
        "FROM (SELECT event_id AS e, (event_id % 22 + 1)::INT AS cls, (event_id // 22) % 12 AS f, " + bucket("event_id")
        + " AS draw FROM events) JOIN dim_intent ON class_id = cls)"),
    "parsed_lines": (["example_lines", "ws"],
        "SELECT file_class_id, line_no, l AS line, CASE WHEN ok THEN json_type(l) END AS jtype, "
        "CASE WHEN ok AND json_type(l) = 'OBJECT' AND json_type(l, '$.text') = 'VARCHAR' THEN trim(json_extract_string(l, '$.text'), (SELECT s FROM ws)) END AS text, "
        "CASE WHEN ok THEN json_extract_string(l, '$.intent_class_label') END AS label, "
        "CASE WHEN ok THEN json_extract_string(l, '$.resource_class') END AS rc, "
        "CASE WHEN ok THEN json_extract_string(l, '$.language_iso') END AS iso "
        "FROM (SELECT *, trim(line, (SELECT s FROM ws)) AS l, json_valid(trim(line, (SELECT s FROM ws))) AS ok FROM example_lines) WHERE l <> ''"),
    "examples": (["parsed_lines", "dim_intent", "dim_resource"],
        "SELECT p.line_no AS example_id, p.file_class_id, p.text, d.class_idx AS intent_label, coalesce(r.resource_idx, 0) AS resource_label, "
        "d.class_id, d.label, d.tier, d.short_ok, p.iso AS language_iso FROM parsed_lines p JOIN dim_intent d ON d.label = p.label "
        "LEFT JOIN dim_resource r ON r.resource_class = p.rc WHERE p.text <> ''"),
    "tokens_counted": (["examples"],
        f"SELECT *, len(regexp_extract_all(text, '[^{RE2_WS}]+')) AS n_tokens FROM examples"),
    "filtered": (["tokens_counted"], "SELECT * FROM tokens_counted WHERE n_tokens >= CASE WHEN short_ok THEN 1 ELSE 8 END"),
    "raw_responses": (["dim_intent"],
        "SELECT r AS response_id, ts, ['groq', 'gemini', 'mistral'][(r % 3 + 1)::INT] AS provider, 'model-' || (r % 5) AS model, "
        "CASE WHEN (r // 8) % 2 <> 0 THEN cls END AS expected_class_id, CASE WHEN r % 8 <= 2 THEN '[' || a || ']' "
        "WHEN r % 8 = 3 THEN '```json' || chr(10) || '[' || a || ']' || chr(10) || '```' WHEN r % 8 = 4 THEN 'Here you go: [' || a || '] hope it helps' "
        "WHEN r % 8 = 5 THEN '{\"items\": [' || a || ']}' WHEN r % 8 = 6 THEN '[' || a || ', {\"text\": \"cut off here' "
        "WHEN (r // 8) % 3 = 0 THEN '{\"error\": \"busy\"}' WHEN (r // 8) % 3 = 1 THEN NULL ELSE 'sorry, no answer' END AS body "
        "FROM (SELECT r, cls, min(ts) AS ts, string_agg(item, ', ' ORDER BY e) AS a FROM (SELECT *, CASE "
        "WHEN f = 11 THEN '\"just a string\"' WHEN f = 12 THEN '{\"text\": \"no label here\", \"intent_class_id\": ' || cls || '}' "
        "ELSE '{\"text\": \"' || CASE WHEN f = 13 THEN ' a ' ELSE replace(label, '_', ' ') || ' sample ' || e END || '\", \"intent_class_id\": ' || "
        "CASE f WHEN 6 THEN '\"' || cls || '\"' WHEN 7 THEN cls || '.7' WHEN 8 THEN 'true' WHEN 9 THEN '\"3.0\"' WHEN 10 THEN 'null' ELSE cls::VARCHAR END || "
        "', \"intent_class_label\": \"' || CASE f WHEN 8 THEN 'noise_gibberish' WHEN 14 THEN 'wrong_label' ELSE label END || '\", \"language_iso\": \"' || "
        "CASE WHEN f = 16 THEN '  EN ' ELSE iso END || '\", \"resource_class\": \"' || CASE WHEN f = 15 THEN 'planet_wide' ELSE rc END || '\"}' END AS item "
        "FROM (SELECT *, " + pick_language("cls", "draw", 0) + " AS iso, " + pick_language("cls", "draw", 1) + " AS rc FROM ("
        "SELECT event_id AS e, ts, event_id // 10 AS r, ((event_id // 30) % 22 + 1)::INT AS cls, (event_id % 17)::INT AS f, "
        + bucket("event_id") + " AS draw FROM events) JOIN dim_intent ON class_id = cls)) GROUP BY r, cls)"),
    "cleaned": (["raw_responses", "ws"],
        "SELECT *, CASE WHEN contains(c1, ']') THEN regexp_replace(c1, '\\][^\\]]*$', ']') ELSE c1 END AS c FROM ("
        "SELECT *, CASE WHEN contains(c0, '[') THEN substr(c0, instr(c0, '[')) ELSE c0 END AS c1 FROM ("
        f"SELECT *, {strip(f'''regexp_replace(regexp_replace({strip('body')}, '^```(?:json)?[{RE2_WS}]*', ''), '[{RE2_WS}]*```$', '')''')} AS c0 FROM raw_responses))"),
    "parsed": (["cleaned"],
        "SELECT *, coalesce(json_valid(c), false) AS ok, CASE WHEN coalesce(json_valid(c), false) THEN json_type(c) END AS jt, "
        "list_filter(regexp_extract_all(c, '\\{[^{}]+\\}'), lambda x: json_valid(x)) AS blocks FROM cleaned"),
    "answers": (["parsed"],
        "SELECT *, NOT ok AND body IS NOT NULL AND len(blocks) > 0 AS salvaged, CASE WHEN body IS NULL THEN 'no_answer' WHEN ok AND jt = 'ARRAY' THEN NULL "
        "WHEN ok THEN 'not_a_list' WHEN len(blocks) > 0 THEN NULL ELSE 'parse_failed' END AS answer_reason, "
        "CASE WHEN ok AND jt = 'ARRAY' THEN json_extract(c, '$[*]')::VARCHAR[] WHEN NOT ok AND len(blocks) > 0 THEN blocks END AS items FROM parsed"),
    "items": (["answers"],
        "SELECT response_id, ts, provider, model, expected_class_id, salvaged, answer_reason, (n - 1)::INT AS item_no, items[n] AS item FROM answers, "
        "unnest(range(1, len(items) + 1)) AS u(n) WHERE items IS NOT NULL UNION ALL "
        "SELECT response_id, ts, provider, model, expected_class_id, salvaged, answer_reason, NULL, NULL FROM answers WHERE items IS NULL"),
    "typed_items": (["items"],
        "SELECT *, CASE WHEN idt IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN trunc(json_extract_string(item, '$.intent_class_id')::DOUBLE)::BIGINT "
        "WHEN idt = 'BOOLEAN' THEN CASE WHEN json_extract_string(item, '$.intent_class_id') = 'true' THEN 1 ELSE 0 END "
        "WHEN idt = 'VARCHAR' AND regexp_full_match(json_extract_string(item, '$.intent_class_id'), '\\s*[+-]?[0-9]+\\s*') "
        "THEN trim(json_extract_string(item, '$.intent_class_id'))::BIGINT END AS class_id FROM ("
        "SELECT *, json_type(item) AS it, json_type(item, '$.text') AS tt, json_type(item, '$.intent_class_id') AS idt, "
        "json_type(item, '$.intent_class_label') AS lt, json_type(item, '$.language_iso') AS ist, json_type(item, '$.resource_class') AS rt FROM items)"),
    "verified": (["typed_items", "dim_intent", "ws"],
        "SELECT *, CASE WHEN reason IS NULL THEN 'valid' ELSE 'discard' END AS status FROM (SELECT t.*, d.label AS class_label, d.tier AS class_tier, CASE "
        "WHEN answer_reason IS NOT NULL THEN answer_reason WHEN it <> 'OBJECT' THEN 'not_an_object' "
        "WHEN tt IS NULL THEN 'missing:text' WHEN idt IS NULL THEN 'missing:intent_class_id' WHEN lt IS NULL THEN 'missing:intent_class_label' "
        "WHEN ist IS NULL THEN 'missing:language_iso' WHEN rt IS NULL THEN 'missing:resource_class' "
        f"WHEN tt <> 'VARCHAR' OR length({strip('''json_extract_string(item, '$.text')''')}) < 3 THEN 'bad_text' "
        "WHEN t.class_id IS NULL THEN 'class_id_not_int' WHEN d.class_id IS NULL THEN 'class_id_unknown' "
        "WHEN expected_class_id IS NOT NULL AND t.class_id <> expected_class_id THEN 'class_id_mismatch' "
        "WHEN lt <> 'VARCHAR' OR json_extract_string(item, '$.intent_class_label') <> d.label THEN 'label_mismatch' "
        f"WHEN ist <> 'VARCHAR' OR {strip('''json_extract_string(item, '$.language_iso')''')} = '' THEN 'bad_language' "
        "WHEN rt <> 'VARCHAR' OR json_extract_string(item, '$.resource_class') NOT IN (" + ", ".join(lit(r) for r in dims.RESOURCES)
        + ") THEN 'bad_resource' END AS reason FROM typed_items t LEFT JOIN dim_intent d ON d.class_id = t.class_id)"),
    "refined": (["verified", "ws"],
        f"SELECT response_id, item_no, provider, model, {strip('''json_extract_string(item, '$.text')''')} AS text, class_id::INT AS intent_class_id, "
        f"class_label AS intent_class_label, class_tier AS tier, lower({strip('''json_extract_string(item, '$.language_iso')''')}) AS language_iso, "
        "json_extract_string(item, '$.resource_class') AS resource_class FROM verified WHERE status = 'valid'"),
    "envelopes": (["raw_responses"],
        "SELECT response_id, provider, CASE WHEN response_id % 11 = 5 THEN '{\"error\": {}}' WHEN response_id % 11 = 6 THEN 'not json at all' WHEN response_id % 11 = 7 THEN to_json({'choices': [{'message': {'content': body}}]})::VARCHAR || ' xx' "
        "WHEN provider = 'gemini' THEN to_json({'candidates': [{'content': {'parts': [{'text': body}]}}]})::VARCHAR "
        "ELSE to_json({'choices': [{'message': {'content': body}}]})::VARCHAR END AS envelope FROM raw_responses"),
    "api_calls": ([], "SELECT event_id AS call_id, ts, " + "CASE event_type " + " ".join(
        f"WHEN {lit(m)} THEN {lit(p)}" for m, p in views.PROVIDER_OF.items()) + " END AS provider, event_type AS model, event_id % 9 <> 0 AS ok FROM events"),
    "call_models": ([], rows([(p, m, None if p == "mistral" else views.MODEL_LIMIT) for m, p in views.PROVIDER_OF.items()],
                             ["provider", "model", "daily_limit"])),
    "logits": ([], "SELECT vec_id AS row_id, embedding[1:22]::DOUBLE[] AS la, embedding[23:27]::DOUBLE[] AS lb, label AS ya, label % 5 AS yb FROM embeddings"),
    "soft": (["logits"],
        "SELECT row_id, ya, yb, list_transform(ea, lambda x: x / list_sum(ea)) AS pa, list_transform(eb, lambda x: x / list_sum(eb)) AS pb FROM ("
        "SELECT *, list_transform(la, lambda x: exp(x - list_max(la))) AS ea, list_transform(lb, lambda x: exp(x - list_max(lb))) AS eb FROM logits)"),
    "decoded": (["soft", "dim_intent", "dim_resource"],
        "SELECT s.*, list_position(pa, list_max(pa)) - 1 AS intent_idx, list_position(pb, list_max(pb)) - 1 AS resource_idx FROM soft s"),
    "history": ([], "SELECT event_type AS run, day(ts)::INT AS epoch, avg(value) / 500 AS val_f1 FROM events GROUP BY ALL"),
    "cases": (["utterances"], "SELECT msg_id AS case_id, text, value, " + case("k", [lit(x) for x in views.EXPECTED]) + " AS expected_label, "
              + case("user_id % 6", [lit(x) for x in views.CATEGORIES]) + " AS category FROM utterances"),
    "predictions": (["cases", "cascade"],
        "SELECT msg_id AS case_id, 'regex' AS classifier, label, matched, NULL::VARCHAR AS error, value / 1000 AS latency_ms FROM cascade UNION ALL "
        "SELECT case_id, 'main', CASE WHEN b >= 95 THEN 'error' WHEN b < 80 THEN expected_label ELSE 'code_task' END, b < 95, CASE WHEN b >= 95 THEN 'timeout' END, "
        "CASE WHEN b >= 95 OR case_id % 50 = 0 THEN 0.0::DOUBLE ELSE value END FROM (SELECT *, " + bucket("case_id") + " AS b FROM cases) UNION ALL "
        "SELECT case_id, 'llm', CASE WHEN b >= 97 THEN 'error' WHEN b < 70 THEN expected_label ELSE 'unknown' END, b < 97, CASE WHEN b >= 97 THEN 'http 500' END, "
        "value * 10 FROM (SELECT *, " + bucket("case_id", "43") + " AS b FROM cases)"),
    "judged": (["cases", "predictions"],
        "SELECT p.*, c.category, c.expected_label, p.label = c.expected_label AS correct FROM predictions p JOIN cases c USING (case_id)"),
    "batch_items": (["utterances"],
        "SELECT msg_id, text, value, (msg_id // 150) * 4 + CASE WHEN msg_id % 150 < 1 THEN 0 WHEN msg_id % 150 < 65 THEN 1 ELSE 2 END AS batch_id, "
        "msg_id % 150 - CASE WHEN msg_id % 150 < 1 THEN 0 WHEN msg_id % 150 < 65 THEN 1 ELSE 65 END AS item_no FROM utterances"),
    "batch_headers": (["batch_items"],
        "SELECT DISTINCT batch_id FROM batch_items UNION ALL SELECT (event_id // 150) * 4 + 3 FROM events WHERE event_id % 150 = 0 AND (event_id // 150) % 7 = 0"),
    "external_questions": ([],
        "SELECT CASE WHEN conv_id % 2 = 1 THEN 2 ELSE 1 END AS source_no, conv_id * 1000 + turn AS row_no, CASE WHEN conv_id % 2 = 0 THEN t END AS question, "
        "CASE WHEN conv_id % 2 = 1 THEN t END AS prompt FROM (SELECT *, CASE WHEN conv_id % 9 = 4 THEN substr(text, 1, 10) "
        "WHEN conv_id % 9 = 5 THEN substr(text, 1, 11) || '  ' ELSE text END AS t FROM conversations WHERE role = 'user')"),
    "external": (["external_questions", "ws"],
        f"SELECT source_no, row_no, {strip('t')} AS text, CASE source_no WHEN 1 THEN 'hf:LibrAI/do-not-answer' ELSE 'hf:walledai/AdvBench' END AS generated_by "
        f"FROM (SELECT *, CASE source_no WHEN 1 THEN question ELSE prompt END AS t FROM external_questions) WHERE length({strip('t')}) > 10"),
    "lang_docs": ([], "SELECT doc_id, text, lang, CASE WHEN " + bucket("doc_id") + " < 80 THEN 'train' ELSE 'eval' END AS side FROM documents"),
    "cache": (["utterances"], "SELECT DISTINCT text, 'cached: ' || text AS answer FROM utterances WHERE msg_id % 3 = 0 AND text <> ''"),
}


def with_views(body: str, *names: str) -> str:
    """``body`` behind a WITH clause that holds the named views and what they need."""
    order: list[str] = []

    def visit(name: str) -> None:
        for needed in CTES[name][0]:
            visit(needed)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    return "WITH " + ", ".join(f"{n} AS ({CTES[n][1]})" for n in order) + " " + body
