"""DuckDB SQL for the registered queries.

RE2 has neither look-around nor Unicode word boundaries; queries that need
them are tested against a plain Python version instead.
"""

from __future__ import annotations

_W = r"[^\p{L}\p{N}_]"
_SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_C = "meta.data_info.content"
_R = f"SELECT rec_no, {_C} AS content, meta.data_info.url AS url FROM example_clean"


def _strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{_SPACE}+', ''), '{_SPACE}+$', '')"


def _fold(x: str, pairs: list[tuple[str, str]]) -> str:
    for a, b in pairs:
        x = f"replace({x}, '{a}', '{b}')"
    return x


_NORMAL = f"regexp_replace(regexp_replace({_strip('url')}, '(?s)#.*$', ''), '/+$', '')"
_HOST = r"nullif(regexp_replace(lower(regexp_extract(coalesce(url, ''), '^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#\s]+)', 1)), '^www\.', ''), '')"
# The signs that the cleaner and the line normaliser rewrite.
_SYMBOLS = [("…", "..."), ("±", "+/-"), ("÷", "/"), ("√", "sqrt"), ("∑", "sum"), ("∏", "prod"), ("≈", "~"), ("≤", "<="), ("≥", ">="), ("∞", "inf"), ("∫", "integral"), ("∂", "d"), ("∆", "delta"), ("∇", "nabla")]
_GUARD = [("±", "plus/minus"), ("×", "x"), ("÷", "divided by"), ("√", "square root"), ("∞", "infinity"), ("≈", "approx"), ("≠", "not equal"), ("≤", "<="), ("≥", ">="), ("°", " degrees ")]
_GATE = r"CASE WHEN content IS NULL THEN 'exception:RuntimeError' WHEN regexp_matches(content, '(?i)^\s*\[Image:\s*https?://[^\]]+\]\s*$') THEN 'image_only' WHEN length(coalesce(text, '')) < 220 THEN 'too_short' END"
_GATED = f"(SELECT rec_no, url, {_GATE} AS reason FROM (SELECT rec_no, text, {_C} AS content, meta.data_info.url AS url FROM example_clean))"
_LINES = r"'\r\n|[\n\x{0b}\x{0c}\r\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]'"
# Full-width punctuation and what it becomes.
_WIDE = "，。！？【】（）％＃＠＆：；“”‘’《》"
_NARROW = ",.!?[]()%#@&:;\"\"''''<>"

# Keywords of the validator, in the order in which they are tried.
_NOISE = ["home >", "site map", "copyright", "all rights reserved", "terms of use", "privacy policy", "contact us", "menu", "footer", "sponsored", "advertisement", "buy now", "add to cart", "shop now", "affiliate", "amazon", "ebay", "photo credit", "image source", "stock image", "watch the video", "play video", "related posts", "related recipes", "leave a reply", "comments", "like & share", "share this", "pin it", "newsletter", "subscribe", "get updates", "popular posts", "latest posts", "seo keywords", "hot posts", "faq"]
_HEADS = ["table of contents", "jump to recipe", "print recipe", "as seen on", "related posts", "related recipes"]


def _first(text: str, words: list[str]) -> str:
    return "CASE " + " ".join(f"WHEN contains(lower({text}), '{w}') THEN '{w}'" for w in words) + " END"


def _word(pattern: str, text: str = "c", flags: str = "") -> str:
    return f"regexp_matches({text}, '{flags}(?:^|{_W})(?:{pattern})(?:$|{_W})')"


_KEYWORD = f"coalesce(CASE WHEN {_word('references', 'c', '(?i)')} THEN 'references' END, CASE WHEN {_word('read' + _SPACE + '+more', 'c', '(?i)')} THEN 'read more' END, {_first('c', _NOISE)})"
_DATE = "(regexp_matches({0}, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}$') AND left({0}, 4) <> '0000' AND try_strptime({0}, '%Y-%m-%d') IS NOT NULL)"
_MINUTE = "(regexp_matches({0}, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}T[0-9]{{1,2}}:[0-9]{{1,2}}$') AND left({0}, 4) <> '0000' AND try_strptime({0}, '%Y-%m-%dT%H:%M') IS NOT NULL)"
_URLS = rf"list_filter(regexp_extract_all(content, 'https?://[^\s\x{{0b}}\x{{1c}}-\x{{1f}}\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+'), lambda u: regexp_matches(u, '(?i)\.(?:png|jpe?g|gif|webp)(?:\?|#|$)'))"
_BARE = _URLS.replace("list_filter(", "list_filter(list_filter(", 1) + rf", lambda u: NOT regexp_matches({_strip('list_filter(string_split(content, chr(10)), lambda x: contains(x, u))[1]')}, '^\[Image:\s*https?://[^\]\s]+?\]$'))"

_SEP = "[-." + _SPACE[1:-1] + "]?"
_TAIL = rf"{_SEP}\p{{Nd}}{{3}}{_SEP}\p{{Nd}}{{4}}(?:$|{_W})"
_COUNTRY = rf"\p{{Nd}}{{1,3}}{_SEP}"
_AREA = r"\(?\p{Nd}{3}\)?"
_PHONE = rf"regexp_matches(c, '(?:^|{_W})(?:{_COUNTRY}{_AREA}|\p{{Nd}}{{3}}\)?){_TAIL}|[\p{{L}}\p{{N}}_](?:\+{_COUNTRY}{_AREA}|\(\p{{Nd}}{{3}}\)?){_TAIL}')"

# Tags and messages.
# (tag, message, condition) of the content and structure rules over typed records, in the order in which they report.
_RULES = [
    ("R1", "'meta.collector 必须为 ''joy'''", "collector IS DISTINCT FROM 'joy'"),
    ("R1", "'meta.collected_time 非 ''YYYY-MM-DDThh:mm'''", f"NOT coalesce({_MINUTE.format('collected_time')}, false)"),
    ("R1", "'meta.data_info.lang 仅允许 ''en'' 或 ''zh'''", "NOT coalesce(lang IN ('en', 'zh'), false)"),
    ("R1", "'meta.data_info.type 不在允许集合 [''HowTo'', ''Recipe/HowTo'', ''百科'', ''问答'']'", "NOT coalesce(type IN ('HowTo', 'Recipe/HowTo', '百科', '问答'), false)"),
    ("R1", "'meta.data_info.processing_date 非 ''YYYY-MM-DD'''", f"NOT coalesce({_DATE.format('processing_date')}, false)"),
    ("R1", "'meta.data_info.delivery_version 必须为 ''V1.0'''", "delivery_version IS DISTINCT FROM 'V1.0'"),
    ("R1", "'meta.content_info.domain 不在允许集合 [''Cooking'', ''Daily Life'']'", "NOT coalesce(domain IN ('Cooking', 'Daily Life'), false)"),
    ("R1", "'meta.content_info.subdomain 不在允许集合 [''Cleaning'', ''Recipes'']'", "NOT coalesce(subdomain IN ('Cleaning', 'Recipes'), false)"),
    ("R1", "'id 需为 32/40/64 位 hex'", "NOT coalesce(regexp_matches(id, '^(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{64})$'), false)"),
    ("R1", "'`text` 必须为字符串'", "text IS NULL"),
    ("R9", "'文本长度 < 200'", "length(text) < 200"),
    ("R1", "'`meta.data_info.content` 必须为字符串'", "c IS NULL"),
    ("R2", "'正文内禁止 Markdown 标题（# 开头的行）'", rf"regexp_matches(c, '(?m)^#+{_SPACE}')"),
    ("R2", f"'疑似模板头/多主题内容触发关键字：' || {_first('c', _HEADS)}", f"{_first('c', _HEADS)} IS NOT NULL"),
    ("R3", "'存在连续 >=2 个换行符'", "contains(c, chr(10) || chr(10))"),
    ("R3", "'含 emoji/艺术字/特殊装饰符'", r"regexp_matches(c, '[\x{1F300}-\x{1FAFF}\x{2700}-\x{27BF}\x{2600}-\x{26FF}•●○■□▢◆◇▪▫]')"),
    ("R3", "'中英文标点混用或与 lang 不匹配'", "lang = 'en' AND regexp_matches(c, '[，。！？【】（）％＃＠：；、“”‘’—…《》·]')"),
    ("R3", "'存在异常缩进行'", rf"regexp_matches(c, '(?m)^(?: {{4,}}|\t+)[^{_SPACE[1:-1]}]')"),
    ("R4", "'存在 HTML 标签或实体残留'", rf"regexp_matches(c, '<{_SPACE}*/?{_SPACE}*[a-zA-Z][^>]*>') OR regexp_matches(c, '&[a-zA-Z0-9#]+;')"),
    ("R4", f"'检出网页噪音（广告/导航/版权/推荐/FAQ/社交/HTML 等）：' || {_KEYWORD}", f"{_KEYWORD} IS NOT NULL"),
    ("R5", "'禁止 Markdown 图片语法 ![alt](...)'", r"regexp_matches(c, '!\[[^\]]*\]\([^)]+\)')"),
    ("R5", "'禁止 Markdown 表格行（|...|）'", rf"regexp_matches(c, '(?m)^{_SPACE}*\|.+\|{_SPACE}*$')"),
    ("R6", "'PII 掩码只能为 ''xxx''，不允许 ''xxxx'' 或 ''xxx@/ @xxx'' 等变体'", rf"{_word('xxxx+')} OR regexp_matches(c, '(?:^|{_W})xxx@|@xxx(?:$|{_W})')"),
    ("R6", "'检测到邮箱明文，应匿名为 ''xxx'''", rf"regexp_matches(c, '(?:^|{_W}|[a-zA-Z0-9._%+-])[a-zA-Z0-9][a-zA-Z0-9._%+-]*@[A-Za-z0-9.-]+\.[A-Za-z]{{2,}}(?:$|{_W})')"),
    ("R6", "'检测到电话号码明文，应匿名为 ''xxx'''", _PHONE),
    ("R6", "'检测到银行卡号/信用卡号明文，应匿名为 ''xxx'''", _word(rf"(?:\p{{Nd}}{{4}}[-{_SPACE[1:-1]}]){{3}}\p{{Nd}}{{4}}")),
    ("R6", "'检测到社会安全号明文，应匿名为 ''xxx'''", _word(r"\p{Nd}{3}-\p{Nd}{2}-\p{Nd}{4}")),
    ("R3", "'仍存在列表前缀（-/*/▢ 等），应在清洗阶段去除'", rf"regexp_matches(c, '(?m)^{_SPACE}*[-*▢]{_SPACE}+[^{_SPACE[1:-1]}]')"),
]
_TYPED = f"SELECT path, line, id, text, meta.collector AS collector, meta.collected_time AS collected_time, meta.data_info.lang AS lang, meta.data_info.type AS type, meta.data_info.processing_date AS processing_date, meta.data_info.delivery_version AS delivery_version, meta.content_info.domain AS domain, meta.content_info.subdomain AS subdomain, {_C} AS c, {_C} AS content FROM example_clean"

ORACLES: dict[str, str] = {
    "record_id": f"SELECT rec_no, sha256(url) AS id FROM ({_R})",
    "url_normalize": f"SELECT rec_no, {_NORMAL} AS url FROM ({_R})",
    "url_normalize_dedup": f"SELECT DISTINCT url FROM (SELECT {_NORMAL} AS url FROM ({_R})) WHERE starts_with(url, 'https://') AND NOT contains(url, '/recipe/') AND NOT contains(url, '?')",
    "url_allow_deny": f"""
WITH s AS (SELECT domain, coalesce(discover.allow, []) AS a, coalesce(discover.deny, []) AS d FROM site_config), r AS (SELECT rec_no, lower(url) AS u, {_HOST} AS domain FROM ({_R}))
SELECT rec_no,
  u IS NOT NULL AND len(list_filter(d, lambda x: CASE WHEN starts_with(x, '/') AND ends_with(x, '/') AND length(x) > 1 THEN regexp_matches(u, '(?i)' || x[2:-2]) ELSE contains(u, lower(x)) END)) = 0
  AND (len(a) = 0 OR len(list_filter(a, lambda x: CASE WHEN starts_with(x, '/') AND ends_with(x, '/') AND length(x) > 1 THEN regexp_matches(u, '(?i)' || x[2:-2]) ELSE contains(u, lower(x)) END)) > 0) AS allowed
FROM (SELECT r.*, coalesce(s.a, []) AS a, coalesce(s.d, []) AS d FROM r LEFT JOIN s ON r.domain = s.domain)""",
    "url_rule_semi_anti": f"SELECT rec_no, url FROM ({_R}) WHERE NOT (contains(lower(url), '?') OR regexp_matches(lower(url), 'tag')) AND (regexp_matches(lower(url), '-(?:bake|soup|pie)-') OR regexp_matches(lower(url), 'recipe'))",
    "frontier_union": "SELECT unnest(discover.index_pages) AS url FROM site_config UNION SELECT coalesce(nullif(discover.sitemap_url, ''), 'https://' || domain || '/sitemap.xml') FROM site_config WHERE discover.sitemap",
    "fetch_left_join": f"WITH w AS (SELECT url FROM rejected WHERE url IS NOT NULL UNION SELECT url FROM ({_R}) WHERE url IS NOT NULL), p AS (SELECT url, max(content) AS content FROM ({_R}) GROUP BY url) SELECT w.url, CASE WHEN p.content IS NULL THEN 'exception:RuntimeError' ELSE 'fetched' END AS status FROM w LEFT JOIN p ON w.url = p.url",
    "links_first_seen": f"SELECT {_NORMAL} AS url, min(rec_no) AS rec_no FROM ({_R}) WHERE url IS NOT NULL GROUP BY 1",
    "links_absolute": rf"SELECT rec_no, regexp_extract(lower(trim(url)), '^([a-z]+://[^/?#]*)', 1) || '/tips/' || rec_no || '/' AS url FROM ({_R}) WHERE url IS NOT NULL",
    "links_discovered": rf"SELECT url, min(rec_no) AS entry, 0 AS pos FROM (SELECT rec_no, regexp_extract(lower(trim(url)), '^([a-z]+://[^/?#]*)', 1) || '/tips/' || rec_no % 50 AS url FROM ({_R}) WHERE url IS NOT NULL) WHERE starts_with(url, 'https://') AND NOT contains(url, '/tips/7') GROUP BY url",
    "seen_urls": f"SELECT DISTINCT url FROM ({_R})",
    "limit_sorted": f"SELECT DISTINCT url FROM ({_R}) WHERE url IS NOT NULL ORDER BY url LIMIT 200",
    "clean_translate": f"SELECT rec_no, translate(content, '　' || chr(160) || '{_WIDE}', '  {_NARROW}') AS clean FROM ({_R})",
    "clean_tags_entities": f"SELECT rec_no, regexp_replace(regexp_replace(content, '<[^>]+>', '', 'g'), '&[a-zA-Z0-9#]+;', ' ', 'g') AS clean FROM ({_R})",
    "clean_symbols": f"SELECT rec_no, {_fold('translate(content, ' + chr(39) + '‐‑‒–—―−×' + chr(39) + ', ' + chr(39) + '-------x' + chr(39) + ')', _SYMBOLS)} AS clean FROM ({_R})",
    "clean_emoji": rf"SELECT rec_no, regexp_replace(content, '[▢☐\x{{1F300}}-\x{{1FAFF}}\x{{2702}}-\x{{27B0}}\x{{24C2}}-\x{{1F251}}\x{{2600}}-\x{{27FF}}]', '', 'g') AS clean FROM ({_R})",
    "build_content": f"SELECT doc_id, {_strip('''concat_ws(chr(10), CASE WHEN coalesce(url, '') <> '' THEN '[Image: ' || url || ']' END, CASE WHEN coalesce(title, '') <> '' THEN 'Ingredients:' || chr(10) || title END, CASE WHEN coalesce(text, '') <> '' THEN 'Instructions:' || chr(10) || text END, CASE WHEN coalesce(subdomain, '') <> '' THEN 'Notes:' || chr(10) || subdomain END)''')} AS content FROM documents",
    "gate_split": f"SELECT rec_no, url, CASE WHEN reason IS NULL THEN 'ok' ELSE 'rejected' END AS status, reason FROM {_GATED}",
    "gate_counts": f"SELECT coalesce(reason, 'ok') AS reason, count(*) AS n FROM {_GATED} GROUP BY 1",
    "math_guard": f"SELECT rec_no, translate({_fold('content', _GUARD)}, '∑∫∏∆∇∂', '') AS clean FROM ({_R})",
    "blank_collapse": f"SELECT rec_no, array_to_string(list_filter(l, lambda x, i: x <> '' OR i = 1 OR l[i - 1] <> ''), chr(10)) AS content FROM (SELECT rec_no, string_split(content, chr(10)) AS l FROM ({_R}))",
    "page_title_h1": f"SELECT rec_no, {_strip('''coalesce(meta.data_info.title, '')''')} AS title FROM example_clean WHERE meta.data_info.url IS NOT NULL",
    "image_urls": f"SELECT rec_no, 'https://img.example/' || rec_no || '.jpg' AS image FROM ({_R}) WHERE url IS NOT NULL",
    "page_links": f"SELECT rec_no, '/next/' || rec_no AS href FROM ({_R}) WHERE url IS NOT NULL",
    "sitemap_walk": f"SELECT DISTINCT trim(url) AS url FROM ({_R}) WHERE url IS NOT NULL AND {_HOST} IS NOT NULL",
    "v_first_noise_keyword": f"SELECT rec_no, {_KEYWORD} AS keyword FROM (SELECT rec_no, content AS c FROM ({_R}))",
    "v_bare_image_url": f"SELECT rec_no, unnest({_BARE}) AS url FROM ({_R})",
    "v_dates": f"SELECT rec_no, coalesce({_DATE.format('meta.data_info.processing_date')}, false) AS date_ok, coalesce({_MINUTE.format('meta.collected_time')}, false) AS time_ok FROM example_clean",
    "v_dup_url": f"WITH r AS (SELECT path, line, {_strip('url')} AS k FROM (SELECT path, line, meta.data_info.url AS url FROM example_clean)), f AS (SELECT *, first_value(line) OVER (PARTITION BY path, k ORDER BY line) AS first FROM r WHERE k <> '') SELECT path, line, 'DUP_URL' AS tag, '同文件重复 URL（首次见于行 ' || first || '）' AS msg FROM f WHERE line <> first",
    "v_dup_id": "WITH r AS (SELECT path, line, lower(coalesce(id, 'none')) AS k FROM example_clean), f AS (SELECT *, row_number() OVER w AS n, first_value(path || ':' || line) OVER w AS first FROM r WHERE k <> '' WINDOW w AS (PARTITION BY k ORDER BY path, line)) SELECT path, line, 'DUP_ID' AS tag, '跨文件重复 id（首次见于 ' || first || '）' AS msg FROM f WHERE n > 1",
    "v_short_files": "WITH n AS (SELECT path, count(*) AS n FROM example_clean GROUP BY path) SELECT f.path, 0 AS line, 'R1' AS tag, 'strict 模式：单文件行数 < 100' AS msg FROM file_summary f LEFT JOIN n ON f.path = n.path WHERE coalesce(n.n, 0) < 100",
    "finding_counts": "SELECT path, upper(tag) AS tag, count(*) AS n FROM finding GROUP BY 1, 2",
    "reject_reasons": "SELECT lower(reason) AS reason, count(*) AS n, count(DISTINCT url) AS urls FROM rejected GROUP BY 1",
    "pass_rates": "SELECT path, CASE WHEN total > 0 THEN passed / total * 100 ELSE 0.0 END AS pass_rate FROM file_summary",
    "merge_volumes": "WITH i AS (SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate, row_number() OVER (ORDER BY l_orderkey NULLS FIRST, l_linenumber NULLS FIRST, l_quantity NULLS FIRST, l_shipdate NULLS FIRST) - 1 AS g, count(*) OVER () AS n FROM lineitem), v AS (SELECT *, g // 10011 + 1 AS own, ceil(n / 10011) AS last FROM i) SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate, g AS idx, CAST(CASE WHEN own = last AND last > 1 AND n - (last - 1) * 10011 < 10000 THEN last - 1 ELSE own END AS BIGINT) AS volume FROM v",
    "rolling_parts": "SELECT CAST(g // 400 + 1 AS BIGINT) AS part, count(*) AS n, max(g) AS last_idx FROM (SELECT row_number() OVER (ORDER BY path, line) - 1 AS g FROM example_clean) GROUP BY 1",
    "preview_blocks": rf"""
SELECT rec_no, CAST(pos AS INTEGER) AS pos, kind, CASE WHEN kind = 'image' THEN a WHEN kind = 'heading' THEN {_strip('b[4:]')} WHEN starts_with(b, '[Image:') OR kind = 'blank' THEN b ELSE x END AS value
FROM (SELECT *, CASE WHEN b = '' THEN 'blank' WHEN starts_with(b, '[Image:') AND regexp_matches(lower(a), '^https?://') THEN 'image' WHEN starts_with(b, '## ') THEN 'heading' ELSE 'text' END AS kind
FROM (SELECT *, trim({_strip('b[8:]')}, ' ]') AS a FROM (SELECT rec_no, i - 1 AS pos, l[i] AS x, {_strip('l[i]')} AS b FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM (SELECT rec_no, CASE WHEN p[-1] = '' THEN p[:-2] ELSE p END AS l FROM (SELECT rec_no, regexp_split_to_array(content, {_LINES}) AS p FROM ({_R})))))))""",
}
# Lines: bullets off, lines of marks alone out, leading marks off.
_MARKS = r",:;.!?)\"''`\-"
_UNBULLETED = f"list_transform(parts, lambda x: regexp_replace(x, '^{_SPACE}*" + r"[\-–—/*•·▪●◦]" + f"{_SPACE}+', ''))"
_KEPT = f"list_filter({_UNBULLETED}, lambda x: NOT regexp_matches({_strip('x')}, '^[{_MARKS}*×]+$'))"
_BARE_LINES = f"array_to_string(list_transform({_KEPT}, lambda x: regexp_replace(x, '^[{_MARKS}]+{_SPACE}*', '')), chr(10))"
_SPLIT = f"SELECT rec_no, regexp_split_to_array(content, {_LINES}) AS l FROM ({_R})"
ORACLES["clean_lines"] = "SELECT rec_no, " + _strip(f"regexp_replace({_BARE_LINES}, '" + r"\n{2,}" + "', chr(10), 'g')") + f" AS clean FROM (SELECT rec_no, CASE WHEN l[-1] = '' THEN l[:-2] ELSE l END AS parts FROM ({_SPLIT}))"
ORACLES["merge_volume_sizes"] = f"SELECT volume, count(*) AS lines FROM ({ORACLES['merge_volumes']}) GROUP BY 1"

_FOUND = "list_concat([" + ", ".join(f"CASE WHEN {when} THEN {{'tag': '{tag}', 'msg': {msg}}} END" for tag, msg, when in _RULES) + "], list_transform(" + _BARE + ", lambda u: {'tag': 'R5', 'msg': '图片需用 ''[Image: URL]'' 行表示：' || u}))"
ORACLES["v_findings_native"] = f"SELECT path, line, f.tag AS tag, f.msg AS msg FROM (SELECT path, line, unnest({_FOUND}) AS f FROM ({_TYPED})) WHERE f IS NOT NULL AND f.tag IS NOT NULL"
_EMOJI = r"[\x{2600}-\x{27FF}\x{1F300}-\x{1FAFF}]"
_PLAIN = f"regexp_replace(line, '{_EMOJI}', '', 'g')"
_ENGLISH = f"CASE WHEN lang = 'en' THEN translate({_PLAIN}, '，。！？【】（）％＃＠＆：；、“”‘’—…《》·', ',.!?[]()%#@&:;,\"\"''''--..<') ELSE {_PLAIN} END"
_NORM = f"regexp_replace(regexp_replace({_ENGLISH}, '^{_SPACE}*(?:[•·*-]|▢){_SPACE}*', ''), '^{_SPACE}*#{_SPACE}*', '')"
_NORM = _strip(f"regexp_replace({_NORM}, '{_SPACE}+', ' ', 'g')")
_NORM_CASE = rf"CASE WHEN regexp_matches(line, '!\[[^\]]*\]\([^)]+\)') OR regexp_matches(line, '^{_SPACE}*\|.+\|{_SPACE}*$') THEN '' ELSE translate({_fold(_NORM, _GUARD)}, '∑∫∏∆∇∂', '') END"
ORACLES["norm_line"] = (
    f"SELECT rec_no, CAST(pos AS INTEGER) AS pos, {_NORM_CASE} AS line "
    f"FROM (SELECT rec_no, coalesce(meta.data_info.lang, 'en') AS lang, i - 1 AS pos, l[i] AS line FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM (SELECT *, string_split({_C}, chr(10)) AS l FROM example_clean)))"
)
_NOISY = _word("share|pinterest|facebook|instagram|advertisement|sponsored|copyright|all rights reserved|privacy policy|terms of use", "x", "(?i)")
_HEADED = _word("table of contents|jump to recipe|nutrition facts|related posts|you may also like|faq|newsletter", "x", "(?i)")
ORACLES["noise_blocks"] = f"SELECT rec_no, array_to_string(list_filter(l, lambda x, i: NOT {_NOISY} AND NOT ((i <= 3 OR i > len(l) - 2) AND {_HEADED})), chr(10)) AS content FROM (SELECT rec_no, list_transform(string_split(content, chr(10)), lambda y: {_strip('y')}) AS l FROM ({_R}))"
ORACLES["strip_ui_headers"] = "SELECT rec_no, " + _strip(rf"regexp_replace(content, '(?im)^{_SPACE}*(?:ingredients & substitutes|ingredients|instructions|notes)(?:[^\p{{L}}\p{{N}}_\n].*?)?$', '', 'g')") + f" AS content FROM ({_R})"
ORACLES["v_json_status"] = f"SELECT path, status, count(*) AS n FROM (SELECT path, CASE WHEN value IS NULL OR {_strip('value')} = '' THEN 'blank' WHEN NOT json_valid(replace(value, ':NaN', ':0')) THEN 'bad' WHEN json_type(replace(value, ':NaN', ':0')) <> 'OBJECT' THEN 'non_object' ELSE 'object' END AS status FROM raw_line) GROUP BY 1, 2"
ORACLES["rejected_json"] = """SELECT '{"url":' || coalesce('"' || url || '"', 'null') || ',"reason":' || coalesce('"' || reason || '"', 'null') || '}' AS value FROM rejected"""
ORACLES["mask_pii"] = r"SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}', 'xxx', 'g'), '\b(?:\d[ -]*?){13,19}\b', 'xxx', 'g'), '\b(?:\+?\d{1,3}[-.\s]?)?(?:\(?\d{2,4}\)?[-.\s]?)?\d{3}[-.\s]?\d{4}\b', 'xxx', 'g') AS clean FROM documents"

# The whole cleaner, step by step. A removed phrase first becomes a mark, so that what stands around it can't join into another.
_PHRASES = (
    "photo~*credit|image~*source|stock~*image|affiliate|sponsored|buy~*now|add~*to~*cart|comments?|newsletter|subscribe|related~+(?:posts|recipes)|read~+more|share|pin~+it|follow~+me|amazon|world~+market|copyright|"
    "all~+rights~+reserved|watch~+the~+video(?:~+(?:above|below))?|video~+tutorial|tiktok|faqs?"
).replace("~", _SPACE)


def _marked(x: str) -> str:
    return rf"regexp_replace({x}, '(?i)(^|{_W})(?:{_PHRASES})($|{_W})', '\1' || chr(1) || '\2', 'g')"


_UNNOISED = f"replace({_marked(_marked('content'))}, chr(1), '')"
ORACLES["clean_noise"] = f"SELECT rec_no, {_UNNOISED} AS clean FROM ({_R})"
_CHAIN = f"SELECT rec_no, coalesce(content, '') AS content FROM ({_R})"
for _step in ("clean_translate", "clean_tags_entities", "clean_symbols", "clean_emoji", "clean_noise", "clean_lines"):
    _CHAIN = "SELECT rec_no, clean AS content FROM (" + ORACLES[_step].replace(f"({_R})", f"({_CHAIN})") + ")"
ORACLES["clean_full"] = f"SELECT rec_no, content AS clean FROM ({_CHAIN})"

# Spans that shield signs don't overlap in these tables, so taking them out equals looking outside them.
_OUTSIDE = r"regexp_matches(regexp_replace(regexp_replace(content, '\$(?:\\\$|[^$])+\$', ' ', 'g'), '\\\[(?:.|\n)+?\\\]', ' ', 'g'), '[±×÷√∑∏≈≠≤≥∞∫∂∆∇]')"
ORACLES["v_unprotected_math"] = f"SELECT rec_no, {_OUTSIDE} AS unprotected FROM ({_R}) WHERE content IS NOT NULL"
_ALL = f"({ORACLES['v_findings_native']} UNION ALL SELECT path, line, 'R5' AS tag, '检出未被 $...$ 或 \\[...\\] 包裹的数学符号（±×÷√∑ 等）' AS msg FROM ({_TYPED}) WHERE {_OUTSIDE})"
ORACLES["v_findings"] = f"SELECT * FROM {_ALL}"
ORACLES["v_findings_by_tag"] = f"SELECT tag, count(*) AS n FROM {_ALL} GROUP BY tag"
ORACLES["v_summary"] = f"WITH b AS (SELECT DISTINCT path, line FROM {_ALL}), r AS (SELECT e.path, CASE WHEN b.path IS NULL THEN 1 ELSE 0 END AS p FROM example_clean e LEFT JOIN b ON e.path = b.path AND e.line = b.line) SELECT path, count(*) AS total, CAST(sum(p) AS BIGINT) AS passed, CAST(sum(p) AS BIGINT) / count(*) * 100 AS pass_rate FROM r GROUP BY ROLLUP (path)"
ORACLES["report_lines"] = (
    f"WITH f AS (SELECT * FROM {_ALL}), s AS ({ORACLES['v_summary']}) SELECT path, unnest(['Validate Report (2025-01-01T00:00:00Z)', 'File: ' || path, repeat('=', 80), repeat('-', 80), printf('Summary: total=%d passed=%d pass_rate=%.2f%%', total, passed, pass_rate)]) AS text FROM s WHERE path IS NOT NULL "
    "UNION ALL SELECT path, path || ':' || line || ': ERROR [' || tag || '] ' || msg FROM f UNION ALL SELECT path, '[PASS] 无错误' FROM s WHERE path IS NOT NULL AND path NOT IN (SELECT path FROM f)"
)
_STEPS = f"array_to_string(list_filter(list_transform(string_split(coalesce({_C}, ''), chr(10)), lambda x: {_strip('x')}), lambda x: x <> ''), chr(10))"
ORACLES["jsonld_recipe"] = f"SELECT rec_no, {_strip('''coalesce(meta.data_info.title, '')''')} AS title, length({_STEPS}) AS instructions_length FROM example_clean WHERE meta.data_info.url IS NOT NULL"
ORACLES["extract_parts"] = f"SELECT url, {_strip('''coalesce(max(title), '')''')} AS title, {_strip("max(CASE WHEN content IS NOT NULL THEN regexp_extract(content, '(?s)Ingredients:\\n(.*?)\\nInstructions:', 1) END)")} AS ingredients, 0 AS step_images FROM (SELECT meta.data_info.url AS url, meta.data_info.title AS title, {_C} AS content FROM example_clean) WHERE url IS NOT NULL GROUP BY url"
_LINED = {c: f"list_filter(list_transform(string_split({c}, chr(10)), lambda line: {_NORM_CASE}), lambda x: x <> '')" for c in "tbn"}
_COLLAPSED = "list_filter(l, lambda x, i: x <> '' OR i = 1 OR l[i - 1] <> '')"
ORACLES["assemble_paragraphs"] = f"""
WITH d AS (SELECT doc_id, coalesce(url, '') AS url, coalesce(title, '') AS t, coalesce(text, '') AS b, coalesce(subdomain, '') AS n, coalesce(lang, 'en') AS lang FROM documents),
k AS (SELECT doc_id, n, url, list_transform(list_concat(CASE WHEN url <> '' THEN ['[Image: ' || url || ']'] ELSE [] END, CASE WHEN t <> '' THEN list_concat(['Ingredients'], {_LINED['t']}) ELSE [] END,
  CASE WHEN b <> '' THEN list_concat(['', 'Instructions'], {_LINED['b']}) ELSE [] END, CASE WHEN n <> '' THEN list_concat(['', 'Notes'], {_LINED['n']}) ELSE [] END, CASE WHEN regexp_matches(url, '^https?://') THEN ['[Image: ' || url || ']'] ELSE [] END), lambda y: {_strip('y')}) AS l FROM d),
c AS (SELECT doc_id, n, url, {_COLLAPSED} AS l FROM k),
f AS (SELECT doc_id, n, url, list_filter(l, lambda x, i: NOT {_NOISY} AND NOT ((i <= 3 OR i > len(l) - 2) AND {_HEADED})) AS l FROM c)
SELECT doc_id, {_strip(f'array_to_string({_COLLAPSED}, chr(10))')} AS content, {_strip('n')} = '' AS missing_notes, CAST(CASE WHEN regexp_matches(url, '^https?://') THEN 1 ELSE 0 END AS BIGINT) AS images_count FROM f"""
ORACLES["report_overall"] = (
    f"WITH f AS (SELECT * FROM {_ALL} UNION ALL SELECT * FROM ({ORACLES['v_dup_url']}) UNION ALL SELECT * FROM ({ORACLES['v_dup_id']})), s AS ({ORACLES['v_summary']}) SELECT unnest(['Validate Report (2025-01-01T00:00:00Z)', 'Files:', repeat('=', 80), repeat('-', 80), printf('Summary: total=%d passed=%d pass_rate=%.2f%%', total, passed, pass_rate)]) AS text FROM s WHERE path IS NULL "
    "UNION ALL SELECT '  - ' || path FROM s WHERE path IS NOT NULL UNION ALL SELECT path || ':' || line || ': ERROR [' || tag || '] ' || msg FROM f"
)

# JSON lines: what is absent, null, a string or of another type is told apart by the type of each member.
_J = "CASE WHEN json_valid(v) THEN v END"
_RAW = f"""
WITH raw AS (SELECT path, line, value, replace(value, ':NaN', ':0') AS v FROM raw_line),
t AS (SELECT path, line, value, coalesce({_strip('value')}, '') = '' AS blank, json_valid(v) AS good, {_J} AS j FROM raw),
o AS (SELECT *, NOT blank AND good AND json_type(j) = 'OBJECT' AS obj, json_type(j, '$.id') AS id_type, json_type(j, '$.text') AS text_type, json_type(j, '$.meta') AS meta_type, json_type(j, '$.meta.data_info') AS info_type,
  json_type(j, '$.meta.content_info') AS kind_type, json_type(j, '$.meta.data_info.content') AS content_type, json_type(j, '$.meta.data_info.lang') AS lang_type FROM t),
s AS (SELECT *, obj AND coalesce(meta_type = 'OBJECT', false) AS m, obj AND coalesce(meta_type = 'OBJECT', false) AND coalesce(info_type = 'OBJECT', false) AS i, obj AND coalesce(meta_type = 'OBJECT' AND info_type = 'OBJECT' AND kind_type = 'OBJECT', false) AS k FROM o),
f AS (SELECT path, line, blank, good, obj, m, i, k, j, id_type, text_type, content_type, lang_type, j ->> '$.id' AS id, {{text}} AS text, {{collector}} AS collector, {{collected_time}} AS collected_time, {{lang}} AS lang, {{type}} AS type, {{processing_date}} AS processing_date,
  {{delivery_version}} AS delivery_version, {{domain}} AS domain, {{subdomain}} AS subdomain, CASE WHEN obj AND coalesce(content_type = 'VARCHAR', true) THEN coalesce(j ->> '$.meta.data_info.content', '') END AS c FROM s)
"""


def _only(at: str) -> str:
    return f"CASE WHEN json_type(j, '{at}') = 'VARCHAR' THEN j ->> '{at}' END"


for _name, _at in [("text", "$.text"), ("collector", "$.meta.collector"), ("collected_time", "$.meta.collected_time"), ("domain", "$.meta.content_info.domain"), ("subdomain", "$.meta.content_info.subdomain"), *[(k, f"$.meta.data_info.{k}") for k in ("lang", "type", "processing_date", "delivery_version")]]:
    _RAW = _RAW.replace("{" + _name + "}", _only(_at))
_KEYS = [("data_info", "i", ["lang", "url", "source", "type", "processing_date", "delivery_version", "title", "content"]), ("content_info", "k", ["domain", "subdomain"])]
_LINE_RULES = [
    ("R1", "'空行/非 JSON 对象'", "blank"), ("R1", "'JSON 解析失败：'", "NOT blank AND NOT good"), ("R1", "'记录必须为 JSON 对象'", "NOT blank AND good AND NOT obj"),
    ("R1", "'缺少字段 `id`'", "obj AND id_type IS NULL"), ("R1", "'缺少字段 `text`'", "obj AND text_type IS NULL"), ("R1", "'缺少或非法字段 `meta`'", "obj AND NOT m"),
    ("R1", "'缺少或非法字段 `meta.data_info`'", "m AND NOT i"), ("R1", "'缺少或非法字段 `meta.content_info`'", "i AND NOT k"),
    *[("R1", f"'缺少字段 `meta.{part}.{key}`'", f"{when} AND json_type(j, '$.meta.{part}.{key}') IS NULL") for part, when, keys in _KEYS for key in keys],
]


def _raw_when(tag: str, msg: str, when: str) -> str:
    """The condition of a rule over typed records, for lines whose members may be absent or of any type."""
    if "domain 不在" in msg:
        return f"k AND {when}"
    if "id 需为" in msg:
        return f"i AND id_type IS NOT NULL AND {when}"
    if "`text` 必须" in msg:
        return "obj AND text_type IS NOT NULL AND text_type <> 'VARCHAR'"
    if "文本长度" in msg:
        return "obj AND (text_type IS NULL OR text_type = 'VARCHAR') AND length(coalesce(text, '')) < 200"
    if "data_info.content`" in msg:
        return "obj AND content_type IS NOT NULL AND content_type <> 'VARCHAR'"
    if msg.startswith("'meta."):
        return f"i AND {when}"
    return when.replace("lang = 'en'", "(lang_type IS NULL OR lang = 'en')")


_LINE_FOUND = ", ".join(f"CASE WHEN {_raw_when(tag, msg, when)} THEN {{'tag': '{tag}', 'msg': {msg}}} END" for tag, msg, when in [*_LINE_RULES, *_RULES])
_LINE_MANY = f"list_transform({_BARE}, lambda u: {{'tag': 'R5', 'msg': '图片需用 ''[Image: URL]'' 行表示：' || u}})".replace("content", "c")
_LINE_MATH = f"CASE WHEN {_OUTSIDE.replace('content', 'c')} THEN {{'tag': 'R5', 'msg': '检出未被 $...$ 或 \\[...\\] 包裹的数学符号（±×÷√∑ 等）'}} END"
ORACLES["v_line_rules"] = _RAW + f"SELECT path, line, f.tag AS tag, f.msg AS msg FROM (SELECT path, line, unnest(list_concat([{_LINE_FOUND}, {_LINE_MATH}], {_LINE_MANY})) AS f FROM f) WHERE f IS NOT NULL AND f.tag IS NOT NULL"


def _cleaned(rows: str) -> str:
    """The whole cleaner over ``rec_no, content``."""
    chain = f"SELECT rec_no, coalesce(content, '') AS content FROM ({rows})"
    for step in ("clean_translate", "clean_tags_entities", "clean_symbols", "clean_emoji", "clean_noise", "clean_lines"):
        chain = "SELECT rec_no, clean AS content FROM (" + ORACLES[step].replace(f"({_R})", f"({chain})") + ")"
    return chain


# Articles of four shapes of pages: fields by selectors, then what a recipe object fills in. Fields are cleaned in one pass, four numbers for each record.
_FIELDS = f"""
SELECT rec_no, rec_no % 4 AS shape, {_strip("coalesce(meta.data_info.title, '')")} AS title, {_C} AS content,
  CASE WHEN rec_no % 4 = 1 THEN '' ELSE {_strip(f"coalesce(regexp_extract({_C}, '(?s)Ingredients:" + chr(92) + "n(.*?)" + chr(92) + "nInstructions:', 1), '')")} END AS ing,
  CASE WHEN rec_no % 4 = 1 THEN '' ELSE {_strip(f"coalesce(regexp_extract({_C}, '(?s)Instructions:" + chr(92) + "n(.*?)(?:" + chr(92) + "nNotes:|$)', 1), '')")} END AS ins,
  CASE rec_no % 4 WHEN 0 THEN 'https://img.example/' WHEN 2 THEN 'https://img.example/og/' WHEN 3 THEN 'https://img.example/set/' END || rec_no || '.jpg' AS own, 'https://img.example/ld/' || rec_no || '.jpg' AS ld_image,
  array_to_string(list_filter(list_transform(CASE WHEN rec_no % 4 = 3 THEN list_concat([coalesce(meta.data_info.title, '')], coalesce(string_split({_C}, chr(10)), [])) ELSE string_split({_C}, chr(10)) END, lambda x: {_strip('x')}), lambda x: x <> ''), chr(10)) AS steps
FROM example_clean"""
_HEADLESS = ORACLES["strip_ui_headers"].replace(f"({_R})", "(SELECT rec_no * 4 + 0 AS rec_no, ing AS content FROM fields UNION ALL SELECT rec_no * 4 + 1, ins FROM fields)")
_PARTS = _cleaned(f"SELECT rec_no, content FROM ({_HEADLESS}) UNION ALL SELECT rec_no * 4 + 2 AS rec_no, steps AS content FROM fields")
_WHOLE = f"""
WITH fields AS MATERIALIZED ({_FIELDS}), parts AS MATERIALIZED ({_PARTS}),
joined AS (SELECT f.*, a.content AS ingredients, b.content AS instructions, coalesce(c.content, '') AS ld_steps FROM fields f JOIN parts a ON a.rec_no = f.rec_no * 4 JOIN parts b ON b.rec_no = f.rec_no * 4 + 1 JOIN parts c ON c.rec_no = f.rec_no * 4 + 2),
used AS (SELECT *, shape <> 2 AND (length(ingredients) < 10 OR length(instructions) < 10 OR title = '' OR own IS NULL) AS use FROM joined),
filled AS (SELECT rec_no, title, CASE WHEN use AND own IS NULL THEN ld_image ELSE own END AS image, CASE WHEN use AND length(ingredients) < 10 THEN '' ELSE ingredients END AS ingredients,
  CASE WHEN use AND length(instructions) < 10 THEN ld_steps ELSE instructions END AS instructions FROM used),
built AS MATERIALIZED ({_cleaned("SELECT rec_no, concat_ws(chr(10), '[Image: ' || image || ']', CASE WHEN ingredients <> '' THEN 'Ingredients:' || chr(10) || ingredients END, CASE WHEN instructions <> '' THEN 'Instructions:' || chr(10) || instructions END) AS content FROM filled")}),
told AS (SELECT f.rec_no, title, content, {_strip("title || chr(10) || content")} AS text FROM filled f JOIN built ON f.rec_no = built.rec_no),
judged AS (SELECT *, CASE WHEN regexp_matches(content, '(?i)^\\s*\\[Image:\\s*https?://[^\\]]+\\]\\s*$') THEN 'image_only' WHEN length(text) < 220 THEN 'too_short' END AS reason FROM told)
"""
ORACLES["article_shapes"] = _WHOLE + "SELECT 'https://p.example/' || rec_no AS url, reason, CASE WHEN reason IS NULL THEN sha256('https://p.example/' || rec_no) END AS id, CASE WHEN reason IS NULL THEN text END AS text, CASE WHEN reason IS NULL THEN title END AS title, CASE WHEN reason IS NULL THEN content END AS content, CASE WHEN reason IS NULL THEN '2025-01-01T00:00' END AS collected_time FROM judged"


def _escaped(x: str) -> str:
    return _fold(x, [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("''", "&#x27;")])


def _details(name: str, value: str) -> str:
    return f"""'<details class="{name}" open><summary>{name}</summary><pre>' || {value} || '</pre></details>'"""


_IMAGE = "'<div class=''img-line''><div class=''img-box''><img src=' || chr(39) || " + _escaped("value") + " || chr(39) || ' alt=''image'' loading=''lazy''></div><div class=''img-url''>' || " + _escaped("value") + " || '</div></div>'"
ORACLES["preview_html"] = f"""
WITH b AS ({ORACLES["preview_blocks"]}), g AS (SELECT *, sum(CASE WHEN kind <> 'text' THEN 1 ELSE 0 END) OVER (PARTITION BY rec_no ORDER BY pos) AS run FROM b),
p AS (SELECT rec_no, min(pos) AS pos, '<p>' || string_agg({_escaped('value')}, '<br>' ORDER BY pos) || '</p>' AS html FROM g WHERE kind = 'text' GROUP BY rec_no, run
  UNION ALL SELECT rec_no, pos, CASE kind WHEN 'image' THEN {_IMAGE} ELSE '<h3>' || {_escaped('value')} || '</h3>' END FROM g WHERE kind IN ('image', 'heading')),
r AS (SELECT rec_no, string_agg(html, chr(10) ORDER BY pos) AS html FROM p GROUP BY rec_no),
e AS (SELECT path, line, coalesce(id, '') AS id, meta.data_info.title AS title, meta.data_info.url AS url, {_C} AS content, r.html FROM example_clean x LEFT JOIN r ON x.rec_no = r.rec_no),
c AS (SELECT path, line, '<section class="card"><p class="index">#' || line || '</p>' || CASE WHEN url IS NULL THEN '<p>解析错误</p>' || {_details('error', "'no &lt;url&gt;'")} || CASE WHEN id <> '' THEN {_details('raw', _escaped('id'))} ELSE '' END
  ELSE '<code>' || {_escaped('id')} || '</code><p class="text">见下方渲染</p>' || CASE WHEN coalesce(title, '') = '' THEN '<h2 class=''title missing''>（无标题）</h2>' ELSE '<h2 class=''title''>' || {_escaped('title')} || '</h2>' END
    || CASE WHEN content IS NULL THEN '<div class=''content-empty''>（无内容）</div>' ELSE coalesce(html, '<div class=''content-empty''>（无渲染内容）</div>') END END || '</section>' AS card FROM e)
SELECT path, CAST((line - 1) // 40 AS INTEGER) AS page, '<!doctype html><html><head><meta charset="utf-8"><title>' || path || '</title></head><body><h1>' || path || ' (' || count(*) || ')</h1>' || string_agg(card, chr(10) ORDER BY line) || '</body></html>' AS html
FROM c GROUP BY path, (line - 1) // 40"""
