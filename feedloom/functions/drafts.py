"""Checks and scores of generated drafts as Column expressions.

A check gives the first failure as its reason, or ``ok``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import any_hit, first_line, hit_count, line_count

# Word lists and patterns of the checks.
WEAK_HOOKS = ["值得关注", "重要更新", "最新消息", "又有新消息", "一文看懂", "简单说", "快速了解"]
HARD_BANNED = [r"#\w+", "重磅|史诗|颠覆|天花板|神器|全民必备|彻底革新|震撼|惊艳", "让我深感|让我震撼"]
SOFT_BANNED = [
    "赋能|闭环|打法|矩阵|心智|调性|底层逻辑|维度|拐点",
    "本质上|说白了|说穿了|归根结底|换句话说|值得注意的是",
    "这意味着|真正的[核心终局护城河关键]|才是真正的|才是核心",
    "不得不|不能不",
    r"对\w+来说[，,]这",
    "我看|我的判断|我认为|个人认为|在我看来|依我看",
    "值得关注|不值得|先记一笔|可以关注|建议关注",
    "未来已来|时代变了|我们拭目以待|未来可期",
    "预示着|揭开了[.的]*序幕|分水岭|转折点",
    "不容错过|值得深思|值得收藏",
]
IMPACT = [
    "影响|风险|机会|适合|利好|门槛|成本|避坑|注意|权限|隐私|安全|涨价|下架|封锁|泄露|翻车|普通人|打工人|创作者|开发者|企业|学生",
    "上线|开放|发布|更新|限制|停止|迁移|退出|转投|支持|不再支持",
    "试试|上手|白嫖|免费|立刻|马上|今天就能|可用|对照|比较|入手|替代|学习|实测|体验|尝鲜|一键|3 步|5 步|三步|五步|配置|部署|设置",
    "小白|新手|家长|学生党|宝妈|刚入门|设计|运营|销售|程序员|产品经理|管理层",
    "涨|降|省|赚|补|扣|减|送|加|加量|升级|解锁|开启|关闭|取消",
]
NETWORK_TERMS = ["xray", "v2ray", "xtls", "vpn", "proxy", "代理", "翻墙", "科学上网", "节点"]
UNSAFE_TERMS = ["节点", "机场", "订阅", "购买", "配置教程", "怎么配置", "绕过", "免翻", "免费节点", "客户端配置"]
TITLE_BAIT = ["震惊", "绝了", "不看后悔", "全网疯传", "宝子", "家人们", "冲啊"]
LONG_FORM_SIGNALS = [
    "适合", "影响", "可以", "建议", "注意", "风险", "用来", "帮助", "避免", "普通人",
    "打工人", "创作者", "创业者", "怎么", "判断", "避坑", "智能眼镜", "耳机", "音箱",
    "家居", "陪伴", "教育", "学习", "翻译", "视频", "图片", "拍照", "健康", "孩子", "家长",
    "出差", "生活", "新手", "场景", "适用", "价格", "权限", "隐私", "上手", "省时",
    "省钱", "效果", "体验", "选择", "不适合",
]
JUDGEMENT = ["我看", "我的判断", "风险", "机会", "别", "但", "真正", "影响"]
# Growth terms.
GROWTH_TERMS = {
    "search": ["AI", "工具", "教程", "技巧", "prompt", "提示词", "避坑", "平替", "测评", "效率", "免费", "新手"],
    "save": ["收藏", "清单", "步骤", "模板", "直接抄", "复制", "对比", "避坑", "流程", "表格", "建议"],
    "beginner": ["普通人", "新手", "小白", "入门", "打工人", "学生", "创作者", "怎么", "如何", "先看", "建议"],
    "series": ["系列", "第", "每天", "每周", "清单", "模板", "工作流", "教程", "测评", "复盘"],
    "jargon": ["benchmark", "endpoint", "CUDA", "kernel", "微调", "蒸馏", "推理框架", "编译器"],
}


def _search(text: Column, patterns: list[str]) -> Column:
    return F.coalesce(text.rlike("(?U)" + "|".join(f"(?:{p})" for p in patterns)), F.lit(False))


def _contains_any(text: Column, words: list[str]) -> Column:
    hit = F.lit(False)
    for w in words:
        hit = hit | F.contains(text, F.lit(w))
    return F.coalesce(hit, F.lit(False))


def unsafe(text: Column) -> Column:
    """Both a network term and an unsafe term occur."""
    return any_hit(text, NETWORK_TERMS) & any_hit(text, UNSAFE_TERMS)


def core_signal(title: Column, source: Column, text: Column) -> Column:
    """A word of the title or the source occurs in the text, or any three characters in a row of a longer title."""
    title, source = F.coalesce(title, F.lit("")), F.coalesce(source, F.lit(""))
    words = F.slice(F.filter(F.split(title, r"(?U)[\s｜|:：,，。/\\\-—_()（）\[\]【】]+"), lambda t: F.length(t) >= 2), 1, 8)
    names = F.slice(F.filter(F.split(source, r"(?U)[\s\-/_.]+"), lambda t: F.length(t) >= 3), 1, 3)
    compact = F.regexp_replace(title, r"(?U)\s+", "")
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length(compact) - 2, F.lit(1))), lambda i: F.substring(compact, i, F.lit(3)))
    return F.exists(F.concat(words, names), lambda t: F.contains(text, t)) | ((F.length(compact) >= 6) & F.exists(grams, lambda g: F.contains(text, g)))


def check_short(text: Column, title: Column, source: Column, material: Column, weak: list[str] | None = None) -> Column:
    """The gate of the short text."""
    t = F.trim(F.coalesce(text, F.lit("")))
    head, lines, n = first_line(t), line_count(t), F.length(t)
    shown = lambda c: c.cast("string")
    return (
        F.when(t == "", "tweet_content 空")
        .when((lines < 2) | (lines > 10), F.concat(F.lit("X 内容行数 "), shown(lines), F.lit(" 不在 2-10")))
        .when(n < 30, F.concat(F.lit("X 内容过短 ("), shown(n), F.lit(" 字)")))
        .when(n > 380, F.concat(F.lit("X 内容过长 ("), shown(n), F.lit(" 字)")))
        .when((F.length(head) < 6) | (F.length(head) > 130), F.concat(F.lit("X 首行长度 "), shown(F.length(head)), F.lit(" 不在 6-130")))
        .when(_contains_any(head, weak or WEAK_HOOKS), F.concat(F.lit("X 首行 hook 过弱: "), F.substring(head, 1, 30)))
        .when(_search(t, HARD_BANNED[:1]), "X 内容命中硬禁用词: " + HARD_BANNED[0])
        .when(_search(t, HARD_BANNED[1:2]), "X 内容命中硬禁用词: " + HARD_BANNED[1])
        .when(_search(t, HARD_BANNED[2:]), "X 内容命中硬禁用词: " + HARD_BANNED[2])
        .when(~core_signal(title, source, t), "X 内容缺少素材核心实体/事件")
        .when(~_search(t, IMPACT), "X 内容缺少影响/风险/机会/适合谁")
        .when(unsafe(F.concat_ws("\n", material, t)), "网络工具内容触及配置/节点/绕过边界")
        .otherwise("ok")
    )


def check_long(title: Column, body: Column, n_tags: Column, image: Column, signals: list[str] | None = None) -> Column:
    """The gate of the long form."""
    t, b, i = (F.trim(F.coalesce(c, F.lit(""))) for c in (title, body, image))
    shown = lambda c: F.length(c).cast("string")
    return (
        F.when((t == "") | (b == ""), "小红书标题/正文空")
        .when(~F.length(t).between(8, 30), F.concat(F.lit("小红书标题 "), shown(t), F.lit(" 字不在 8-30")))
        .when(_contains_any(t, TITLE_BAIT), F.concat(F.lit("小红书标题标题党/硬广: "), F.substring(t, 1, 20)))
        .when(~F.length(b).between(120, 450), F.concat(F.lit("小红书正文 "), shown(b), F.lit(" 字不在 120-450")))
        .when(~n_tags.between(3, 8), F.concat(F.lit("小红书标签数 "), n_tags.cast("string"), F.lit(" 不在 3-8")))
        .when(~F.length(i).between(30, 220), F.concat(F.lit("配图提示词 "), shown(i), F.lit(" 字不在 30-220")))
        .when(hit_count(b, signals or LONG_FORM_SIGNALS) < 2, "小红书正文缺少影响/使用/避坑信息")
        .otherwise("ok")
    )


def short_quality(text: Column, title: Column, source: Column, material: Column, weak: list[str] | None = None) -> Column:
    """Struct ``score, notes``: points for hook, core, impact, size, plain words and judgement; 30 off where unsafe."""
    t = F.trim(F.coalesce(text, F.lit("")))
    head = first_line(t)
    tests = [
        (F.length(head).between(10, 70) & ~_contains_any(head, weak or WEAK_HOOKS), 22, "首行 hook 弱"),
        (core_signal(title, source, t), 20, "核心实体弱"),
        (_search(t, IMPACT), 20, "影响/风险/机会弱"),
        (F.length(t).between(45, 280) & line_count(t).between(2, 8), 12, "长度/行数不佳"),
        (~_search(t, SOFT_BANNED), 16, "命中套话/营销词"),
        (~unsafe(F.concat_ws("\n", material, t)), -30, "网络工具边界风险"),
        (_contains_any(t, JUDGEMENT), 10, "判断感不足"),
    ]
    score = sum((F.when(ok, max(points, 0)).otherwise(min(points, 0)) for ok, points, _ in tests), F.lit(0))
    notes = F.concat_ws("；", *[F.when(~ok, F.lit(note)) for ok, _, note in tests])
    return F.struct(F.least(score, F.lit(100)).cast("double").alias("score"), F.when(notes == "", "ok").otherwise(notes).alias("notes"))


def hook_type(text: Column, angle: Column) -> Column:
    """Kind of the first line, by ordered rules."""
    head = first_line(text)
    shift = F.coalesce(angle == "ecosystem_shift", F.lit(False))
    return (
        F.when(_contains_any(head, ["不是", "不只是", "表面", "真正"]), "反常识")
        .when(_contains_any(head, ["风险", "隐私", "安全", "小心", "避坑", "封锁", "泄露"]), "风险提醒")
        .when(_contains_any(head, ["机会", "利好", "窗口", "省", "成本"]), "机会窗口")
        .when(shift, "生态迁移")
        .when(_contains_any(head, ["圈", "地震", "小", "但"]), "圈层爆点")
        .when(_contains_any(head, ["谁", "开发者", "创作者", "打工人", "普通用户", "企业"]), "谁受影响")
        .when(angle == "cost_change", "成本变化")
        .otherwise("谁受影响")
    )


# Where an item goes to the short platform alone.
COMPANY_ONLY = r"(?i)\b(Snowflake|Databricks|Salesforce|Kubernetes|K8s)\b"
INSIDER_ONLY = "(?i)融资|收购|合并|IPO|人事变动|CEO|CTO|离职|跳槽"
PROXY_BOUNDARY = "(?i)xray|v2ray|xtls|vless|vmess|reality|sing-box|clash|mihomo|hysteria|trojan|shadowsocks|vpn|proxy|翻墙|科学上网|GFW|审查|封锁"
FRIENDLY = [
    "(?i)工具|产品|硬件|眼镜|手机|耳机|视频|图片|图像|音乐|生成|效率|办公|创作者|打工人|隐私|安全|泄露|后门|翻车|涨价|浏览器|搜索|助手|学生|学习|教育|普通人|职场|截图|PDF",
    "(?i)怎么用|如何用|避坑|谁受影响|影响谁|适合谁|价格|权限|风险|教程|案例|工作流|提效",
    r"(?i)\b(ChatGPT|Claude|Gemini|Sora|Suno|Cursor|Notion|LLM|Agent|豆包|元宝|可灵|剪映)\b",
    r"\b(Kimi|DeepSeek|Qwen|文心一言|通义|豆包|GPT|Grok|Llama|Mistral)\b",
]
# Writing persona by part of the source, in order.
PERSONAS = {
    "ai-models": ("技术产品编辑", "普通 AI 用户视角"), "ai-news": ("技术产品编辑", "普通 AI 用户视角"),
    "paper": ("技术解释型编辑", "仅在能转成使用价值时写小红书内容"), "official_ai": ("技术产品编辑", "普通 AI 用户视角"),
    "radar-hot": ("行业观察编辑", "普通 AI 用户视角"), "aihot-hot": ("行业观察编辑", "普通 AI 用户视角"),
    "radar-daily": ("行业观察编辑", "普通 AI 用户视角"), "aihot": ("产品编辑", "工具/效率视角"), "qbitai": ("产品编辑", "工具/效率视角"),
    "sspai": ("产品编辑", "工具/效率视角"), "github-trending": ("开发者工具编辑", "仅在普通人能用时写小红书内容"), "tool": ("开发者工具编辑", "工具/效率视角"),
}
DEFAULT_PERSONA = ("AI 内容编辑", "普通 AI 用户视角")


def one_platform_only(material: Column, source: Column) -> Column:
    """Company-internal, insider or network-tool news without any everyday scene."""
    friendly = F.lit(False)
    for p in FRIENDLY:
        friendly = friendly | material.rlike("(?U)" + p)
    proxy = (F.contains(source, F.lit("github")) | F.contains(source, F.lit("watchlist"))) & material.rlike(PROXY_BOUNDARY)
    return F.coalesce((material.rlike("(?U)" + COMPANY_ONLY) | material.rlike(INSIDER_ONLY) | proxy) & ~friendly, F.lit(False))


def persona(source: Column) -> Column:
    """Struct ``short, long``: the first persona whose key is part of the source."""
    pair = lambda p: F.struct(F.lit(p[0]).alias("short"), F.lit(p[1]).alias("long"))
    out = F.when(F.lit(False), pair(DEFAULT_PERSONA))
    for k, p in PERSONAS.items():
        out = out.when(F.contains(source, F.lit(k)), pair(p))
    return out.otherwise(pair(DEFAULT_PERSONA))


def check_image(prompt: Column, forbidden: list[str], required: list[str], least: int = 60, most: int = 220) -> Column:
    """Struct ``ok, reason``: only unusable prompts fail; missing parts are advice."""
    p = F.trim(F.coalesce(prompt, F.lit("")))
    n = F.length(p)
    reason = F.when(n < 30, F.concat(F.lit("提示词过短 ("), n.cast("string"), F.lit(" 字)"))).when(n > most, F.concat(F.lit("提示词过长 ("), n.cast("string"), F.lit(" 字)")))
    bad = (n < 30) | (n > most)
    for term in forbidden:
        hit = F.contains(F.lower(p), F.lit(term.lower()))
        reason, bad = reason.when(hit, f"命中禁用元素: {term}"), bad | hit
    missing = F.slice(F.array_compact(F.array(*[F.when(~F.contains(p, F.lit(x)), F.lit(x)) for x in required])), 1, 3)
    reason = reason.when(n < least, F.concat(F.lit("提示词偏短，建议补充构图/配色/字体/氛围 ("), n.cast("string"), F.lit(" 字)")))
    reason = reason.when(F.size(missing) > 0, F.concat(F.lit("建议补充: "), F.array_join(missing, ",")))
    return F.struct((~bad).alias("ok"), reason.otherwise("ok").alias("reason"))


def image_quality(prompt: Column, forbidden: list[str], required: list[str], aspects: list[str], styles: list[str], least: int = 60, most: int = 220) -> Column:
    """Points for a usable prompt, 10 at most: size, aspect, three parts of the picture, style."""
    p = F.trim(F.coalesce(prompt, F.lit("")))
    n = F.length(p)
    score = F.when(n.between(30, most), 2).otherwise(0) + F.when(n >= least, 2).otherwise(0) + F.when(_contains_any(p, aspects), 2).otherwise(0)
    score = score + F.least(sum((F.contains(p, F.lit(x)).cast("int") for x in required), F.lit(0)), F.lit(3)) + F.when(_contains_any(p, [*styles, "封面", "信息图", "卡片", "插画", "海报"]), 1).otherwise(0)
    return F.when(check_image(prompt, forbidden, required, least, most)["ok"], F.least(score, F.lit(10)).cast("double")).otherwise(0.0)


def discovery(extra: Column) -> Column:
    """Why an item was found: the parts that its JSON extras hold, joined."""
    get = lambda k: F.nullif(F.get_json_object(extra, f"$.{k}"), F.lit(""))
    listed = lambda k, n: F.array_join(F.slice(F.from_json(get(k), "array<string>"), 1, n), ", ")
    said = lambda text, v: F.when(v.isNotNull() & ~v.isin("", "0", "[]"), F.concat(F.lit(text), v))
    votes = F.when(get("points").isNotNull() | get("comments").isNotNull(), F.concat(F.lit("HN points/comments: "), F.coalesce(get("points"), F.lit("0")), F.lit("/"), F.coalesce(get("comments"), F.lit("0"))))
    sources = F.when(get("source_count") != "0", F.concat(get("source_count"), F.lit(" 个信源")))
    return F.concat_ws(" | ", said("命中词: ", listed("matched_terms", 8)), said("query: ", get("query")), sources, said("来源: ", listed("source_names", 4)), said("GitHub stars: ", get("stars")), said("repo: ", get("repo_path")), votes, said("source_signal: ", get("source_signal_score")))


# Names under which a generated payload holds its parts.
ALIASES = {
    "other_title": ["other_title", "xiaohongshu_title", "xhs_title", "redbook_title", "小红书标题", "通用标题"],
    "other_content": ["other_content", "xiaohongshu_content", "xhs_content", "redbook_content", "小红书内容", "通用内容"],
    "other_tags": ["other_tags", "xiaohongshu_tags", "xhs_tags", "redbook_tags", "小红书标签", "通用标签"],
    "image_prompt": ["image_prompt", "other_image_prompt", "cover_image_prompt", "配图提示词", "通用配图提示词"],
}


def payload(data: Column) -> Column:
    """Struct of a JSON payload's parts, each under the first of its names that is not empty."""
    get = lambda k: F.nullif(F.get_json_object(data, f"$['{k}']"), F.lit(""))
    return F.struct(*[F.coalesce(*[get(a) for a in names]).alias(k) for k, names in ALIASES.items()])


def message_text(content: Column) -> Column:
    """A message's content as text: itself, or the joined texts of a JSON list of strings and parts."""
    parts = F.try_variant_get(F.try_parse_json(content), "$", "array<string>")
    part = lambda x: F.when(F.trim(x).startswith("{"), F.coalesce(F.get_json_object(x, "$.text"), F.lit(""))).otherwise(x)
    return F.when(F.trim(content).startswith("[") & parts.isNotNull(), F.array_join(F.transform(parts, part), "")).otherwise(F.coalesce(content, F.lit("")))


def _objects(text: Column) -> Column:
    """The outermost ``{...}`` stretches, by depth of braces, in order."""
    start = F.struct(F.lit(1).alias("at"), F.lit(0).alias("depth"), F.lit(0).alias("since"), F.array().cast("array<struct<a:int,n:int>>").alias("found"))

    def step(s: Column, ch: Column) -> Column:
        opens, closes = ch == "{", ch == "}"
        depth = s["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        ended = closes & (depth == 0) & (s["since"] > 0)
        since = F.when(opens & (s["depth"] == 0), s["at"]).when(ended, 0).otherwise(s["since"])
        found = F.when(ended, F.array_append(s["found"], F.struct(s["since"].alias("a"), (s["at"] - s["since"] + 1).alias("n")))).otherwise(s["found"])
        return F.struct((s["at"] + 1).alias("at"), depth.alias("depth"), since.alias("since"), found.alias("found"))

    spans = F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), start, step)["found"]
    return F.transform(spans, lambda s: F.substring(text, s["a"], s["n"]))


_WIDE = "\u4e00-\u9fff，。！？、；：（）【】《》“”‘’…—·"


def mend_quotes(text: Column) -> Column:
    """Quotes inside a string value, between wide characters, become corner brackets."""
    return F.regexp_replace(text, rf'([{_WIDE}-][ \t\n]*)"(?=[ \t\n]*[{_WIDE},\}}\]-])', "$1「")


def reply_array(text: Column) -> Column:
    """Objects, as JSON text, of a model's reply.

    A fenced block that parses; else the outermost brackets, as they are, with
    inner quotes mended, or object by object; else the text's objects.  Objects may be nested; what does not parse, mended or not, goes.
    """
    text = F.trim(F.coalesce(text, F.lit("")))
    able = lambda c: F.try_parse_json(c).isNotNull()
    array = lambda c: F.when(able(c), F.when(F.trim(c).startswith("["), F.from_json(c, "array<string>")).otherwise(F.array(F.trim(c))))
    each = lambda c: F.array_compact(F.transform(_objects(c), lambda o: F.when(able(o), o).otherwise(F.when(able(mend_quotes(o)), mend_quotes(o)))))
    fenced = F.nullif(F.regexp_extract(text, r"(?s)```json\s*(.*?)```", 1), F.lit(""))
    outer = F.nullif(F.regexp_extract(text, r"(?s)(\[.*\])", 1), F.lit(""))
    listed = F.when(outer.isNotNull(), F.coalesce(array(outer), array(mend_quotes(outer)), each(outer)))
    # a parser that stops after the first value takes several objects for one, so they are told apart first
    found = each(text)
    return F.coalesce(array(fenced), listed, F.when(F.size(found) > 0, found), F.when(text.startswith("{"), array(text)), found)
