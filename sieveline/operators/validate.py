"""Delivery validation: records in a checked form, a registry of rules, findings, duplicates, pass rates.

The checked form keeps apart what a fixed schema would run together: a field
that is absent, null, a string, or of another type. ``from_lines`` makes it from
JSON lines, ``from_table`` from typed records; every rule is a Column on it.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import pstrip, rx
from ..session import checkpoint
from ..sources.arrow import arrow_flat_map

# Required keys, keywords and patterns of the rules.
DATA_INFO_KEYS = ["lang", "url", "source", "type", "processing_date", "delivery_version", "title", "content"]
CONTENT_INFO_KEYS = ["domain", "subdomain"]
TEMPLATE_HEADS = ["table of contents", "jump to recipe", "print recipe", "as seen on", "related posts", "related recipes"]
NOISE_KEYWORDS = [
    "home >", "site map", "copyright", "all rights reserved", "terms of use", "privacy policy", "contact us", "menu", "footer",
    "sponsored", "advertisement", "buy now", "add to cart", "shop now", "affiliate", "amazon", "ebay",
    "photo credit", "image source", "stock image", "watch the video", "play video", "related posts", "related recipes",
    "leave a reply", "comments", "like & share", "share this", "pin it", "newsletter", "subscribe", "get updates",
    "popular posts", "latest posts", "seo keywords", "hot posts", "faq",
]
EMOJI = r"[\x{1F300}-\x{1FAFF}\x{2700}-\x{27BF}\x{2600}-\x{26FF}]"
FANCY_BULLETS = "[•●○■□▢◆◇▪▫]"
CJK_PUNCTUATION = "[，。！？【】（）％＃＠：；、“”‘’—…《》·]"
#: Characters among which all emoji, fancy bullets and Chinese marks lie.
BEYOND = r"[\x{b7}\x{2010}-\x{10ffff}]"
MATH_SYMBOLS = "±×÷√∑∏≈≠≤≥∞∫∂∆∇"
MATH_SPANS = (r"\$(?=[^$])(?:[^$]*\\\$)*[^$]*\$", r"(?s)\\\[.+?\\\]")
MARKDOWN_IMAGE = r"!\[[^\]]*\]\([^)]+\)"
IMAGE_URL_END = r"(?i)\.(?:png|jpe?g|gif|webp)(?:\?|#|$)"
IMAGE_URL_AT = r"https?://\S*\.(?i:png|jpe?g|gif|webp)(?:[?#]|(?!\S))"
IMAGE_LINE = r"\A\[Image:\s*https?://[^\]\s]+?\]\z"
EMAIL = r"\b[a-zA-Z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
PHONE = r"\b(?:\+?\d{1,3}[-.\s]?)?(?:\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4})\b"
CARD = r"\b(?:\d{4}[-\s]){3}\d{4}\b"
SSN = r"\b\d{3}-\d{2}-\d{4}\b"
MIN_TEXT, STRICT_LINES = 200, 10_000


@dataclass(frozen=True)
class Policy:
    """What a delivery may hold; the defaults are one project's and every one can be replaced."""

    collector: str = "joy"
    version: str = "V1.0"
    langs: tuple[str, ...] = ("en", "zh")
    types: tuple[str, ...] = ("HowTo", "Recipe/HowTo", "百科", "问答")
    domains: tuple[str, ...] = ("Cooking", "Daily Life")
    subdomains: tuple[str, ...] = ("Cleaning", "Recipes")
    min_text: int = MIN_TEXT


CHECKED = (
    "path string, line int, status string, error string, id_state string, id string, text_state string, text string, meta_state string, data_info_state string, "
    "missing_data array<string>, content_info_state string, missing_content array<string>, lang_state string, lang string, type string, processing_date string, delivery_version string, "
    "url string, content_state string, content string, domain string, subdomain string, collector string, collected_time string"
)


def _state(holder, key):
    """``absent``, ``null``, ``string``, ``object`` or ``other``, and the value as a string where it has one."""
    if not isinstance(holder, dict) or key not in holder:
        return "absent", None
    v = holder[key]
    if v is None:
        return "null", None
    if isinstance(v, str):
        return "string", v
    if isinstance(v, dict):
        return "object", None
    return "other", json.dumps(v, ensure_ascii=False)


def from_lines(lines: DataFrame, path: str = "path", line: str = "line", value: str = "value") -> DataFrame:
    """Checked form of JSON lines: ``status`` is blank, bad, non_object or object.

    Lines parse as strictly as Python's parser: no trailing text, no raw
    control characters; a repeated key counts last, NaN is a number. A null
    line is blank.
    """

    def make():
        def row(p, n, v):
            empty = [None] * 21
            if v is None or not v.strip():
                yield p, n, "blank", None, *empty
                return
            try:
                obj = json.loads(v)
            except ValueError as e:
                yield p, n, "bad", str(e), *empty
                return
            except RecursionError:
                yield p, n, "bad", "nested too deeply", *empty
                return
            if not isinstance(obj, dict):
                yield p, n, "non_object", None, *empty
                return
            meta = obj.get("meta")
            info = meta.get("data_info") if isinstance(meta, dict) else None
            kind = meta.get("content_info") if isinstance(meta, dict) else None
            say = lambda holder, key: _state(holder, key)[1]
            only = lambda holder, key: _state(holder, key)[1] if _state(holder, key)[0] == "string" else None
            yield (
                p, n, "object", None, *_state(obj, "id"), *_state(obj, "text"), _state(obj, "meta")[0], _state(meta, "data_info")[0],
                [k for k in DATA_INFO_KEYS if isinstance(info, dict) and k not in info], _state(meta, "content_info")[0],
                [k for k in CONTENT_INFO_KEYS if isinstance(kind, dict) and k not in kind],
                *_state(info, "lang"), only(info, "type"), only(info, "processing_date"), only(info, "delivery_version"), say(info, "url"),
                *_state(info, "content"), only(kind, "domain"), only(kind, "subdomain"), only(meta, "collector"), only(meta, "collected_time"),
            )

        return row

    return arrow_flat_map(lines.select(path, line, value), make, CHECKED)


def from_table(df: DataFrame) -> DataFrame:
    """Checked form of typed records ``path, line, id, text, meta``: nothing is absent, a null struct is an absent object."""
    state = lambda c: F.when(c.isNull(), "null").otherwise("string")
    held = lambda c: F.when(c.isNull(), "null").otherwise("object")
    none = F.array().cast("array<string>")
    info = F.col("meta.data_info")
    return df.select(
        "path", "line", F.lit("object").alias("status"), F.lit(None).cast("string").alias("error"), state(F.col("id")).alias("id_state"), "id", state(F.col("text")).alias("text_state"), "text",
        held(F.col("meta")).alias("meta_state"), held(info).alias("data_info_state"), none.alias("missing_data"), held(F.col("meta.content_info")).alias("content_info_state"), none.alias("missing_content"),
        state(info["lang"]).alias("lang_state"), info["lang"].alias("lang"), info["type"].alias("type"), info["processing_date"].alias("processing_date"), info["delivery_version"].alias("delivery_version"),
        info["url"].alias("url"), state(info["content"]).alias("content_state"), info["content"].alias("content"), F.col("meta.content_info.domain").alias("domain"), F.col("meta.content_info.subdomain").alias("subdomain"),
        F.col("meta.collector").alias("collector"), F.col("meta.collected_time").alias("collected_time"),
    )


def is_date(text: Column) -> Column:
    """A real day as year-month-day, months and days padded or not."""
    return F.coalesce(F.try_to_timestamp(text, F.lit("yyyy-M-d")).isNotNull() & ~text.startswith("0000"), F.lit(False))


def is_minute(text: Column) -> Column:
    return F.coalesce(F.try_to_timestamp(text, F.lit("yyyy-M-d'T'H:m")).isNotNull() & ~text.startswith("0000"), F.lit(False))


def is_hex_id(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\A(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{64})\z"), F.lit(False))


def first_word(low: Column, words: list[str]) -> Column:
    """The first of ``words``, in their order, that the text contains; null if none. No higher-order function, so it compiles."""
    return F.coalesce(*[F.when(low.contains(w), F.lit(w)) for w in words])


def noise_keyword(text: Column, low: Column | None = None) -> Column:
    """The first noise word: two whole-word patterns, then substrings in their order. ``low``: the text in lower case, where it is at hand."""
    low = F.lower(text) if low is None else low
    return F.coalesce(
        F.when(low.contains("reference") & text.rlike(rx(r"\breferences\b", ignore_case=True)), F.lit("references")),
        F.when(low.contains("read") & text.rlike(rx(r"\bread\s+more\b", ignore_case=True)), F.lit("read more")),
        first_word(low, NOISE_KEYWORDS),
    )


def bare_image_urls(content: Column) -> Column:
    """Image addresses of which the first line that holds them is not an image line; repeats repeat."""
    urls = F.filter(F.regexp_extract_all(content, F.lit(rx(r"https?://\S+")), F.lit(0)), lambda u: u.rlike(IMAGE_URL_END))
    lines = F.split(content, "\n", -1)
    held = lambda u: F.get(F.filter(lines, lambda x: x.contains(u)), F.lit(0))
    # an address within an image line ends in its bracket, so few texts go past this test
    return F.when(content.rlike(rx(IMAGE_URL_AT)), F.filter(urls, lambda u: ~pstrip(held(u)).rlike(IMAGE_LINE))).when(content.isNotNull(), F.array().cast("array<string>"))


def unprotected_math(content: Column) -> Column:
    """A mathematical sign outside dollar and bracket spans.

    Signs within dollar spans become letters where they stand, so bracket spans
    are found in a text of the same length, whatever they overlap.
    """
    sign = f"[{MATH_SYMBOLS}]"
    dollars, brackets = MATH_SPANS
    between = F.split(content, dollars, -1)
    within = F.transform(F.regexp_extract_all(content, F.lit(dollars), F.lit(0)), lambda x: F.translate(x, MATH_SYMBOLS, "x" * len(MATH_SYMBOLS)))
    shielded = F.concat_ws("", F.flatten(F.zip_with(between, within, lambda x, y: F.array(x, F.coalesce(y, F.lit(""))))))
    outside = F.regexp_replace(shielded, brackets, "").rlike(sign)
    return F.when(~content.rlike(sign), F.lit(False)).when(~(content.contains("$") | content.contains("\\[")), F.lit(True)).otherwise(outside)


@dataclass(frozen=True)
class Rule:
    """A finding: where it fires, its tag and message.

    ``word``: a text, null where the rule doesn't fire, that ends the message.
    ``many``: an array of such texts, one finding for each.
    """

    tag: str
    message: str = ""
    when: Column = field(default=None)
    word: Column = field(default=None)
    many: Column = field(default=None)


def structure_rules(p: Policy) -> list[Rule]:
    obj = F.col("status") == "object"
    meta = obj & (F.col("meta_state") == "object")
    info = meta & (F.col("data_info_state") == "object")
    kind = info & (F.col("content_info_state") == "object")
    is_one = lambda c, allowed: F.coalesce(F.col(c).isin(*allowed), F.lit(False))
    listed = lambda values: "[" + ", ".join(f"'{v}'" for v in values) + "]"
    missing = lambda name, col, where: Rule("R1", f"缺少字段 `{name}.", many=F.when(where & (F.size(col) > 0), F.transform(col, lambda k: F.concat(k, F.lit("`")))))
    return [
        Rule("R1", "缺少字段 `id`", obj & (F.col("id_state") == "absent")),
        Rule("R1", "缺少字段 `text`", obj & (F.col("text_state") == "absent")),
        Rule("R1", "缺少或非法字段 `meta`", obj & ~meta),
        Rule("R1", "缺少或非法字段 `meta.data_info`", meta & ~info),
        missing("meta.data_info", F.col("missing_data"), info),
        Rule("R1", "缺少或非法字段 `meta.content_info`", info & ~kind),
        missing("meta.content_info", F.col("missing_content"), kind),
        Rule("R1", f"meta.collector 必须为 '{p.collector}'", info & ~is_one("collector", [p.collector])),
        Rule("R1", "meta.collected_time 非 'YYYY-MM-DDThh:mm'", info & ~is_minute(F.col("collected_time"))),
        Rule("R1", "meta.data_info.lang 仅允许 " + " 或 ".join(f"'{x}'" for x in p.langs), info & ~is_one("lang", p.langs)),
        Rule("R1", f"meta.data_info.type 不在允许集合 {listed(p.types)}", info & ~is_one("type", p.types)),
        Rule("R1", "meta.data_info.processing_date 非 'YYYY-MM-DD'", info & ~is_date(F.col("processing_date"))),
        Rule("R1", f"meta.data_info.delivery_version 必须为 '{p.version}'", info & ~is_one("delivery_version", [p.version])),
        Rule("R1", f"meta.content_info.domain 不在允许集合 {listed(p.domains)}", kind & ~is_one("domain", p.domains)),
        Rule("R1", f"meta.content_info.subdomain 不在允许集合 {listed(p.subdomains)}", kind & ~is_one("subdomain", p.subdomains)),
        Rule("R1", "id 需为 32/40/64 位 hex", info & (F.col("id_state") != "absent") & ~is_hex_id(F.col("id"))),
    ]


def text_rules(p: Policy) -> list[Rule]:
    obj = F.col("status") == "object"
    said = F.col("text_state").isin("string", "absent")
    return [
        Rule("R1", "`text` 必须为字符串", obj & ~said),
        Rule("R9", f"文本长度 < {p.min_text}", obj & said & (F.length(F.coalesce("text", F.lit(""))) < p.min_text)),
    ]


def content_rules() -> list[Rule]:
    """Rules over ``_c``, the content where it is a text (``_low`` in lower case; ``_beyond``: whether ``BEYOND`` is found in it)."""
    obj = F.col("status") == "object"
    c, low = F.col("_c"), F.col("_low")
    english = F.when(F.col("lang_state") == "absent", F.lit(True)).otherwise(F.coalesce(F.col("lang") == "en", F.lit(False)))
    has = lambda pattern, **kw: c.rlike(rx(pattern, **kw))
    # the same matches, but a look at the first character spares the test for a word's edge nearly everywhere
    numbered = lambda pattern, first: c.rlike("(?dU)" + first + rx(pattern)[len("(?dU)") :])
    beyond = lambda pattern: F.when(F.col("_beyond"), c.rlike(pattern)).otherwise(F.lit(False) & c.isNotNull())
    return [
        Rule("R1", "`meta.data_info.content` 必须为字符串", obj & ~F.col("content_state").isin("string", "absent")),
        Rule("R2", "正文内禁止 Markdown 标题（# 开头的行）", c.contains("#") & has(r"^#+\s", multiline=True)),
        Rule("R2", "疑似模板头/多主题内容触发关键字：", word=first_word(low, TEMPLATE_HEADS)),
        Rule("R3", "存在连续 >=2 个换行符", c.contains("\n\n")),
        Rule("R3", "含 emoji/艺术字/特殊装饰符", beyond(EMOJI) | beyond(FANCY_BULLETS)),
        Rule("R3", "中英文标点混用或与 lang 不匹配", english & beyond(CJK_PUNCTUATION)),
        Rule("R3", "存在异常缩进行", (c.contains("    ") | c.contains("\t")) & has(r"^(?: {4,}|\t+)\S", multiline=True)),
        Rule("R4", "存在 HTML 标签或实体残留", (c.contains("<") & has(r"<\s*/?\s*[a-zA-Z][^>]*>")) | (c.contains("&") & c.rlike(r"&[a-zA-Z0-9#]+;"))),
        Rule("R4", "检出网页噪音（广告/导航/版权/推荐/FAQ/社交/HTML 等）：", word=noise_keyword(c, low)),
        Rule("R5", "禁止 Markdown 图片语法 ![alt](...)", c.contains("![") & c.rlike(MARKDOWN_IMAGE)),
        Rule("R5", "禁止 Markdown 表格行（|...|）", c.contains("|") & has(r"^\s*\|.+\|\s*$", multiline=True)),
        Rule("R5", "检出未被 $...$ 或 \\[...\\] 包裹的数学符号（±×÷√∑ 等）", many=F.when(unprotected_math(c), F.array(F.lit("")))),
        Rule("R5", "图片需用 '[Image: URL]' 行表示：", many=bare_image_urls(c)),
        Rule("R6", "PII 掩码只能为 'xxx'，不允许 'xxxx' 或 'xxx@/ @xxx' 等变体", c.contains("xxx") & (has(r"\bxxxx+\b") | has(r"\bxxx@|@xxx\b"))),
        Rule("R6", "检测到邮箱明文，应匿名为 'xxx'", c.contains("@") & has(EMAIL)),
        Rule("R6", "检测到电话号码明文，应匿名为 'xxx'", numbered(PHONE, r"(?=[+(\p{Nd}])")),
        Rule("R6", "检测到银行卡号/信用卡号明文，应匿名为 'xxx'", numbered(CARD, r"(?=\p{Nd})")),
        Rule("R6", "检测到社会安全号明文，应匿名为 'xxx'", numbered(SSN, r"(?=\p{Nd})")),
        Rule("R3", "仍存在列表前缀（-/*/▢ 等），应在清洗阶段去除", has(r"^\s*[-*▢]\s+\S", multiline=True)),
    ]


def line_rules() -> list[Rule]:
    return [
        Rule("R1", "空行/非 JSON 对象", F.col("status") == "blank"),
        Rule("R1", "JSON 解析失败：", word=F.when(F.col("status") == "bad", F.coalesce("error", F.lit("")))),
        Rule("R1", "记录必须为 JSON 对象", F.col("status") == "non_object"),
    ]


def with_findings(checked: DataFrame, policy: Policy | None = None) -> DataFrame:
    """The checked form with ``findings array<struct<ord, tag, msg>>`` and ``passed``. No shuffle.

    Three projections: the content and its lower case; all plain conditions as
    bits of one number, and the words of messages, which compile; the arrays,
    which don't compile but only look at bits and at what few rows have. Each
    is read more than once by the next, so they aren't run together again.
    """
    policy = policy or Policy()
    rules = line_rules() + structure_rules(policy) + text_rules(policy) + content_rules()
    text = F.when((F.col("status") == "object") & F.col("content_state").isin("string", "absent"), F.coalesce("content", F.lit("")))
    bits, words = F.lit(0).cast("bigint"), {}
    for i, r in enumerate(rules):
        if r.when is not None:
            bits = bits + F.when(r.when, F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
        elif r.word is not None:
            words[i] = f"_word{i}"
    judged = checked.withColumn("_c", text).withColumn("_low", F.lower("_c")).withColumn("_beyond", F.col("_c").rlike(BEYOND)).select("*", bits.alias("_bits"), *[rules[i].word.alias(name) for i, name in words.items()])
    none = F.array().cast("array<struct<ord:int,tag:string,msg:string>>")

    def finding(i: int, msg: Column) -> Column:
        return F.struct(F.lit(i).alias("ord"), F.lit(rules[i].tag).alias("tag"), msg.alias("msg"))

    def each(i: int):
        return lambda end: finding(i, F.concat(F.lit(rules[i].message), end))

    parts, fires = [], [F.col("_bits") != 0]
    for i, r in enumerate(rules):
        if r.many is not None:
            parts.append(F.coalesce(F.transform(r.many, each(i)), none))
            fires.append(F.coalesce(F.size(r.many) > 0, F.lit(False)))
        elif i in words:
            parts.append(F.when(F.col(words[i]).isNotNull(), F.array(each(i)(F.col(words[i])))).otherwise(none))
            fires.append(F.col(words[i]).isNotNull())
        else:
            parts.append(F.when(F.getbit("_bits", F.lit(i)) == 1, F.array(finding(i, F.lit(r.message)))).otherwise(none))
    any_fires = fires[0]
    for x in fires[1:]:
        any_fires = any_fires | x
    return judged.withColumn("findings", F.concat(*parts)).withColumn("passed", (F.col("status") == "object") & ~any_fires).drop("_c", "_low", "_beyond", "_bits", *words.values())


#: What findings, rates and duplicates need of a checked record.
KEPT = ("path", "line", "status", "id_state", "id", "url", "findings", "passed")


def judged_once(checked: DataFrame, policy: Policy | None = None) -> DataFrame:
    """``with_findings`` without the texts, written once, for results that are read several times."""
    return checkpoint(with_findings(checked, policy).select(*KEPT))


def findings(found: DataFrame) -> DataFrame:
    # an inner explode would evaluate the rules a second time, in the filter that it implies
    return found.select("path", "line", F.explode_outer("findings").alias("_f")).where(F.col("_f").isNotNull()).select("path", "line", "_f.ord", "_f.tag", "_f.msg")


def _later(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows that repeat a key, each with the first one as ``first``.

    Keys are aggregated before anything is joined and single ones never go on,
    so a key of any share of the rows is one partial sum a partition.
    """
    firsts = rows.groupBy(*keys).agg(F.min(F.struct(*order)).alias("first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    return rows.join(firsts, keys).where(F.struct(*order) != F.col("first"))


def duplicate_urls(checked: DataFrame) -> DataFrame:
    """Later lines of a file with the url of an earlier one; blank urls count for nothing."""
    rows = checked.where("status = 'object'").select("path", "line", pstrip(F.coalesce("url", F.lit(""))).alias("_key")).where("_key != ''")
    return _later(rows, ["path", "_key"], ["line"]).select("path", "line", F.lit("DUP_URL").alias("tag"), F.concat(F.lit("同文件重复 URL（首次见于行 "), F.col("first.line"), F.lit("）")).alias("msg"))


def duplicate_ids(checked: DataFrame) -> DataFrame:
    """Later records, over all files in order, with an id seen before, case aside; empty ids count for nothing."""
    rows = checked.where("status = 'object'").select("path", "line", F.lower(F.coalesce("id", F.when(F.col("id_state") == "null", F.lit("none")), F.lit(""))).alias("_key")).where("_key != ''")
    first = F.concat(F.col("first.path"), F.lit(":"), F.col("first.line"))
    return _later(rows, ["_key"], ["path", "line"]).select("path", "line", F.lit("DUP_ID").alias("tag"), F.concat(F.lit("跨文件重复 id（首次见于 "), first, F.lit("）")).alias("msg"))


def summary(found: DataFrame) -> DataFrame:
    """``path, total, passed, pass_rate`` of each file and, with a null path, of all. Duplicates don't lower the rate."""
    counted = found.select("path", (F.col("status") != "blank").cast("int").alias("_t"), F.col("passed").cast("int").alias("_p"))
    out = counted.rollup("path").agg(F.coalesce(F.sum("_t"), F.lit(0)).cast("bigint").alias("total"), F.coalesce(F.sum("_p"), F.lit(0)).cast("bigint").alias("passed"))
    return out.select("path", "total", "passed", F.when(F.col("total") > 0, F.col("passed") / F.col("total") * 100).otherwise(F.lit(0.0)).alias("pass_rate"))


def short_files(paths: DataFrame, checked: DataFrame, least: int = STRICT_LINES) -> DataFrame:
    """Strict mode: files of fewer lines than ``least``, files without any line among them."""
    counts = checked.groupBy("path").agg(F.count(F.lit(1)).alias("_n"))
    short = paths.select("path").distinct().join(counts, "path", "left").where(F.coalesce("_n", F.lit(0)) < least)
    return short.select("path", F.lit(0).alias("line"), F.lit("R1").alias("tag"), F.lit(f"strict 模式：单文件行数 < {least}").alias("msg"))


def unreadable_files(paths: DataFrame) -> DataFrame:
    """The finding of each ``path`` that is not UTF-8."""
    return paths.select("path", F.lit(0).alias("line"), F.lit("R1").alias("tag"), F.lit("UTF-8/读文件失败").alias("msg"))


def report_line(path: Column, line: Column, tag: Column, msg: Column) -> Column:
    return F.format_string("%s:%d: ERROR [%s] %s", path, line, tag, msg)
