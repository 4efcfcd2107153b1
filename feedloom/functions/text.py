"""Text functions as Column expressions: matching, URLs, cleaning, tone, length, similarity.

"Keyword match" is case-folded substring containment everywhere.  Vocabularies
are parameters; the defaults are the customary lists.
"""

from __future__ import annotations

import re
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.lambdas import bound

# Lines that match one of these are navigation or legal boilerplate.
BOILERPLATE = [
    r"订阅.*?(?:邮件|newsletter|推送)",
    r"关注我们.*?(?:微信|微博|公众号)",
    r"扫码.*?二维码",
    r"Copyright\s*[©©]?\s*\d{4}.*?(?:All Rights Reserved|版权所有)",
    r"©\s*\d{4}.*?(?:All Rights Reserved|版权所有)",
    r"本站.*?(?:不承担|不承担责任)",
    r"如需.*?(?:转载|授权|联系)",
    r"点击.*?(?:关注|订阅|分享)",
    r"分享到.*?(?:微信|微博|QQ)",
    r"登录.*?(?:注册|账号)",
    r"Cookie\s*(?:政策|使用|提示)",
    r"广告\s*合作.*?联系",
    r"免责声明",
    r"Previous\s*Post|Next\s*Post|相关阅读|猜你喜欢|延伸阅读",
    r"Tags?\s*:.*$",
    r"Posted\s+(?:on|by|in).*?\d{4}.*?$",
    r"作者[:：].*?(?:来源|责编|编辑).*?$",
    r"责编[:：].*?$",
    r"编辑[:：].*?$",
]

# Phrases that mark templated prose, and hedging words.
CLICHES = [
    "本质上", "说白了", "说穿了", "归根结底", "换句话说", "值得注意的是",
    "这意味着", "真正的核心", "才是真正的", "才是核心", "未来已来", "时代变了",
    "我们拭目以待", "未来可期", "不容错过", "值得深思", "值得收藏", "值得关注",
    "重要更新", "最新消息", "一文看懂", "简单说", "快速了解", "赋能", "闭环",
    "打法", "矩阵", "心智", "调性", "底层逻辑", "维度", "拐点",
    "震惊", "绝了", "宝子们", "家人们", "姐妹们", "冲冲冲", "必看", "神器",
    "颠覆", "重磅", "史诗级", "天花板", "yyds", "绝绝子", "太绝了",
]
HEDGES = [
    "可能", "也许", "或许", "一定程度上", "某种程度上", "有望", "预计", "持续",
    "全面", "显著", "大幅", "明显", "进一步", "不断", "逐步",
]

# Dashes that count in tone, and how an item of a list begins.
DASHES = ["——", "—"]
LISTED = r"^\s*(?:[-*•]|\d+[.)、]|[一二三四五六七八九十]+[、.])\s*"

#: The characters of Unicode's class Zs.
SPACES = " \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"

# Least and most characters of a text by platform.
PLATFORM_LIMITS = {"xiaohongshu": (120, 450), "weibo": (50, 140), "twitter": (50, 280), "x": (50, 380)}

#: Cleaned content, snippet and title are cut at these lengths.
CONTENT_MAX, SNIPPET_MAX, TITLE_MAX = 1200, 300, 200


def any_hit(text: Column, words: list[str]) -> Column:
    """Whether any keyword occurs in the text, case aside."""
    low = F.lower(text)
    hit = F.lit(False)
    for w in words:
        hit = hit | F.contains(low, F.lit(w.lower()))
    return F.coalesce(hit, F.lit(False))


def hit_count(text: Column, words: list[str]) -> Column:
    """How many of the keywords occur."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return sum((F.contains(low, F.lit(w.lower())).cast("int") for w in words), F.lit(0))


def matched(text: Column, words: list[str], most: int = 8) -> Column:
    """The first ``most`` keywords that occur, in the order of the list."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.slice(F.array_compact(F.array(*[F.when(F.contains(low, F.lit(w.lower())), F.lit(w)) for w in words])), 1, most)


def occurrences(text: Column, words: list[str]) -> Column:
    """Non-overlapping occurrences of all words, case-sensitive."""
    return sum(((F.length(text) - F.length(F.replace(text, F.lit(w), F.lit("")))) / len(w) for w in words), F.lit(0)).cast("int")


def normalise_url(url: Column, strip_slash: bool = True) -> Column:
    """Drop the fragment and tracking parameters; decode what stays.

    ``utm_*``, ``ref`` and ``ref_source`` go, case aside; parameters without a
    value stay; slashes at the path's end go unless ``strip_slash`` is false.
    """
    plain = F.regexp_extract(url, r"^([^#]*)", 1)
    base = F.regexp_extract(plain, r"^([^?]*)", 1)
    head = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://)", 1)
    rest = F.substring(base, F.length(head) + 1, F.length(base))
    path = F.concat(F.lower(head), F.regexp_replace(rest, r"/+$", "") if strip_slash else rest)
    decoded = lambda c: F.coalesce(F.try_url_decode(c), c)
    key = lambda p: F.regexp_extract(p, r"^([^=]*)", 1)
    parts = F.filter(F.split(F.regexp_extract(plain, r"\?(.*)$", 1), "&"), lambda p: (p != "") & ~F.lower(decoded(key(p))).rlike(r"^(utm_.*|ref|ref_source)$"))
    query = F.array_join(F.transform(parts, lambda p: F.concat(decoded(key(p)), F.lit("="), decoded(F.regexp_extract(p, r"^[^=]*=(.*)$", 1)))), "&")
    return F.when(query == "", path).otherwise(F.concat(path, F.lit("?"), query))


def _code_point(n: Column) -> Column:
    """The character of a code point; the replacement character where there is none."""
    valid = (n > 0) & (n < 0x110000) & ~n.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")).otherwise("\ufffd")


def _decoded(text: Column, pattern: str, value) -> Column:
    """``text`` with each match of ``pattern`` replaced by ``value`` of it, or left where that is null."""

    def once(t: Column) -> Column:
        gaps, found = F.split(t, pattern, -1), F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
        pieces = F.zip_with(gaps, found, lambda g, m: F.concat(g, F.when(m.isNull(), "").otherwise(F.coalesce(value(m), m))))
        return F.when(F.contains(t, F.lit("&")), F.array_join(pieces, "")).otherwise(t)

    return bound(text, once)


def decode_entities(text: Column) -> Column:
    """Named (HTML 4) and numeric character references as characters, numeric ones that this uncovers too; others stay."""
    names = F.create_map(*[F.lit(v) for k, n in sorted(name2codepoint.items()) for v in (k, chr(n))])

    def number(m: Column) -> Column:
        hexadecimal = F.conv(F.regexp_extract(m, "^&#[xX]([0-9a-fA-F]{1,8})", 1), 16, 10)
        decimal = F.regexp_extract(m, "^&#([0-9]{1,10})", 1)
        return F.when(m.startswith("&#"), _code_point(F.when(m.rlike("^&#[xX]"), hexadecimal).otherwise(decimal).try_cast("long")))

    numeric = r"&#(?:[0-9]+|[xX][0-9a-fA-F]+);?"
    named = lambda m: F.coalesce(number(m), F.try_element_at(names, F.regexp_extract(m, "^&([A-Za-z0-9]+);", 1)))
    return _decoded(_decoded(text, rf"{numeric}|&[A-Za-z][A-Za-z0-9]*;", named), numeric, number)


def strip_html(text: Column, gap: str = " ") -> Column:
    """Scripts, styles and page furniture, then tags, give way to ``gap``; entities are decoded."""
    out = F.coalesce(text, F.lit(""))
    for tag in ("script", "style", "nav", "footer", "header"):
        out = F.regexp_replace(out, rf"(?is)<{tag}\b[^>]*>.*?</{tag}>", gap)
    return decode_entities(F.regexp_replace(out, r"<[^>]+>", gap))


def strip_boilerplate(text: Column, patterns: list[str] | None = None, least: int = 5) -> Column:
    """Lines stripped; blank, boilerplate and short ones (under ``least`` non-space characters) go."""
    any_of = "(?im)(?U)" + "|".join(BOILERPLATE if patterns is None else patterns)
    lines = F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))
    return F.array_join(F.filter(lines, lambda x: ~x.rlike(any_of) & (F.length(F.regexp_replace(x, r"(?U)\s", "")) >= least)), "\n")


def squeeze(text: Column) -> Column:
    """Runs of blanks to one, of line feeds to two at most, ends stripped."""
    out = F.regexp_replace(F.regexp_replace(text, r"[ \t]{2,}", " "), r"\n{3,}", "\n\n")
    return F.regexp_replace(out, r"(?U)^\s+|\s+$", "")


def cut(text: Column, most: int = CONTENT_MAX) -> Column:
    """Cut at the last line feed within ``most`` characters where that keeps over 70 %, else hard."""
    head = F.substring(text, 1, most)
    line = F.regexp_extract(head, r"(?s)^(.*)\n", 1)
    return F.when(F.length(text) <= most, text).when(F.length(line) > 0.7 * most, line).otherwise(head)


def clean_text(text: Column, most: int = CONTENT_MAX) -> Column:
    return cut(squeeze(strip_boilerplate(strip_html(text))), most)


def pick_content(content: Column, snippet: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(content), F.lit("")), snippet, F.lit(""))


def cleaned(title: Column, snippet: Column, content: Column) -> Column:
    """Struct ``title, snippet, content, truncated``: the cleaned parts of an item, each within its limit."""
    raw = pick_content(content, snippet)
    body = clean_text(raw)
    short = lambda c, most: F.substring(squeeze(strip_html(c)), 1, most)
    return F.struct(
        short(title, TITLE_MAX).alias("title"),
        short(snippet, SNIPPET_MAX).alias("snippet"),
        body.alias("content"),
        ((F.length(raw) > CONTENT_MAX) & (F.length(body) < F.length(raw))).alias("truncated"),
    )


def title_key(title: Column) -> Column:
    """Lower-case title without punctuation and white space."""
    return F.lower(F.regexp_replace(F.coalesce(title, F.lit("")), r"(?U)[\s，。！？：；、\"“”‘’「」『』()（）\[\]【】<>《》\-—_·.…!?:;,']+", ""))


def bigrams(text: Column) -> Column:
    """Distinct character bigrams; none of a text shorter than two."""
    n = F.length(text)
    return F.when(n < 2, F.array().cast("array<string>")).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.substring(text, i, F.lit(2)))))


def coverage(a: Column, b: Column) -> Column:
    """Shared bigrams over the smaller set; 0 where either is empty."""
    x, y = bigrams(a), bigrams(b)
    small = F.least(F.size(x), F.size(y))
    return F.when(small > 0, F.size(F.array_intersect(x, y)) / small).otherwise(F.lit(0.0))


def stripped(text: Column, blanks: str = " ") -> Column:
    """``text`` without any of ``blanks`` at its ends."""
    return F.trim(text) if blanks == " " else F.trim(text, F.lit(blanks))


def sentences(text: Column, blanks: str = " ") -> Column:
    return F.filter(F.transform(F.split(text, r"[。！？!?；;\n]+"), lambda s: stripped(s, blanks)), lambda s: s != "")


def tone(
    text: Column,
    cliches: list[str] | None = None,
    hedges: list[str] | None = None,
    dashes: list[str] | None = None,
    listed: str = LISTED,
    blanks: str = " ",
) -> Column:
    """Struct of how templated a text sounds: the cliches hit, densities, and a score of 0 to 100.

    Lines that match ``listed`` are items of a list; sentences and lines lose ``blanks`` at their ends.
    Sentences, lines and measures are bound, so each is made once a row. The score is rounded as SQL
    rounds doubles: a hundredfold first, then to the even integer, not by its decimal digits.
    """
    cliches, hedges, dashes = cliches or CLICHES, hedges or HEDGES, DASHES if dashes is None else dashes
    text = F.coalesce(text, F.lit(""))
    hits = F.array_compact(F.array(*[F.when(F.contains(text, F.lit(w)), F.lit(w)) for w in cliches]))
    average = lambda parts: F.when(F.size(parts) > 0, F.aggregate(parts, F.lit(0), lambda a, s: a + F.length(s)) / F.size(parts)).otherwise(F.lit(0.0))
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: stripped(x, blanks)), lambda x: x != "")
    item = lambda x: x.rlike(listed) | (F.length(x) <= 8)
    bullet = lambda of: F.when(F.size(of) > 0, F.size(F.filter(of, item)) / F.size(of)).otherwise(F.lit(0.0))
    measures = F.struct(
        _counted(text, cliches).alias("cliches"),
        _counted(text, dashes).alias("dashes"),
        bound(sentences(text, blanks), average).alias("average"),
        (_counted(text, hedges) / F.greatest(F.length(text) / 100, F.lit(1.0))).alias("hedge"),
        bound(lines, bullet).alias("bullet"),
    )

    def told(m: Column) -> Column:
        score = (
            F.least(m["cliches"] * 16, F.lit(76))
            + F.least(m["dashes"] * 4, F.lit(12))
            + F.least(m["hedge"] * 8, F.lit(16.0))
            + F.least(m["bullet"] * 12, F.lit(12.0))
            + F.when(m["average"] > 42, F.least((m["average"] - 42) * 0.6, F.lit(12.0))).otherwise(F.lit(0.0))
        )
        blank = F.trim(text) == ""
        return F.struct(
            F.when(blank, F.array().cast("array<string>")).otherwise(hits).alias("cliche_hits"),
            F.when(blank, 0).otherwise(m["dashes"]).alias("dash_count"),
            F.when(blank, 0.0).otherwise(F.bround(m["average"], 2)).alias("avg_sentence_len"),
            F.when(blank, 0.0).otherwise(F.bround(m["hedge"], 2)).alias("hedge_density"),
            F.when(blank, 0.0).otherwise(F.bround(m["bullet"], 2)).alias("bullet_density"),
            F.when(blank, 0.0).otherwise(F.rint(F.least(score, F.lit(100.0)) * 100) / 100).alias("ai_score"),
        )

    return bound(measures, told)


def _counted(text: Column, words: list[str]) -> Column:
    """:func:`occurrences`, behind one search for any of the words, which most texts end with."""
    any_of = "|".join(re.escape(w) for w in words)
    return F.when(text.rlike(any_of), occurrences(text, words)).otherwise(0)


def validate_length(text: Column, platform: Column) -> Column:
    """Struct ``ok, reason, length`` against the platform's limits; an unknown platform counts as x."""
    n = F.length(F.coalesce(text, F.lit("")))
    known = F.when(platform.isin(list(PLATFORM_LIMITS)), platform).otherwise("x")
    low = F.element_at(F.create_map(*[F.lit(v) for p, (a, _) in PLATFORM_LIMITS.items() for v in (p, a)]), known)
    high = F.element_at(F.create_map(*[F.lit(v) for p, (_, b) in PLATFORM_LIMITS.items() for v in (p, b)]), known)
    reason = (
        F.when(n == 0, "文本为空")
        .when(n < low, F.concat(platform, F.lit(" 内容过短 ("), n.cast("string"), F.lit(" < "), low.cast("string"), F.lit(" 字)")))
        .when(n > high, F.concat(platform, F.lit(" 内容超长 ("), n.cast("string"), F.lit(" > "), high.cast("string"), F.lit(" 字)")))
        .otherwise("ok")
    )
    return F.struct(((n > 0) & (n >= low) & (n <= high)).alias("ok"), reason.alias("reason"), n.alias("length"))


def truncate(text: Column, most: int) -> Column:
    """Cut at a paragraph, else at a sentence, else hard with an ellipsis.

    Whole parts are kept while they fit in 90 % of ``most`` and used when they
    fill over 70 % of it.
    """

    def fold(parts: Column, extra: int) -> Column:
        start = F.struct(F.array().cast("array<string>").alias("kept"), F.lit(0).alias("n"), F.lit(True).alias("open"))
        step = lambda a, p: F.when(
            a["open"] & (a["n"] + F.length(p) <= most * 0.9),
            F.struct(F.array_append(a["kept"], p).alias("kept"), (a["n"] + F.length(p) + extra).alias("n"), F.lit(True).alias("open")),
        ).otherwise(F.struct(a["kept"].alias("kept"), a["n"].alias("n"), F.lit(False).alias("open")))
        return F.aggregate(parts, start, step)

    paragraphs = fold(F.split(text, "\n\n"), 2)
    pieces = fold(F.filter(F.regexp_extract_all(text, F.lit(r"[^。！？\n]*[。！？\n]|[^。！？\n]+"), F.lit(0)), lambda p: p != ""), 0)
    hard = F.concat(F.rtrim(F.substring(text, 1, most)), F.lit("..."))
    return (
        F.when(F.length(text) <= most, text)
        .when(F.contains(text, F.lit("\n\n")) & (paragraphs["n"] > most * 0.7), F.array_join(paragraphs["kept"], "\n\n"))
        .when(pieces["n"] > most * 0.7, F.array_join(pieces["kept"], ""))
        .otherwise(hard)
    )


def tags(value: Column) -> Column:
    """A comma list, half or full width, as stripped tags without leading ``#``."""
    return F.filter(F.transform(F.split(F.coalesce(value, F.lit("")), "[,，]"), lambda t: F.regexp_replace(F.trim(t), "^#+", "")), lambda t: t != "")


def line_count(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x) != ""))


def first_line(text: Column) -> Column:
    """The first line that is not blank, without spaces around it; the others are not looked at."""
    return F.trim(F.substring_index(F.ltrim(F.coalesce(text, F.lit("")), F.lit(" \n")), "\n", 1))


def epoch_seconds(value: Column) -> Column:
    """Epoch numbers above 1e10 are milliseconds."""
    n = value.try_cast("double")
    return F.when(n > 1e10, F.floor(n / 1000)).otherwise(F.floor(n)).cast("long")


def star_count(text: Column) -> Column:
    """``1,234``, ``12.3k`` and ``2m`` as numbers."""
    low = F.replace(F.lower(F.trim(text)), F.lit(","), F.lit(""))
    n = F.regexp_extract(low, r"([0-9]+(?:\.[0-9]+)?)", 1).try_cast("double")
    unit = F.regexp_extract(low, r"[0-9]\s*([km])", 1)
    return F.floor(F.coalesce(n, F.lit(0.0)) * F.when(unit == "k", 1000).when(unit == "m", 1_000_000).otherwise(1)).cast("long")


def publish_ts(value: Column) -> Column:
    """A timestamp of ISO text, RFC 822 text or epoch text; null where none fits."""
    epoch = F.when(value.rlike(r"^\d{9,13}$"), F.timestamp_seconds(epoch_seconds(value)))
    rfc = F.regexp_extract(value, r"(\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2})", 1)
    return F.coalesce(epoch, F.try_to_timestamp(value), F.try_to_timestamp(F.nullif(rfc, F.lit("")), F.lit("d MMM yyyy HH:mm:ss")))
