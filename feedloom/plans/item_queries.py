"""Queries of the row-level operators, each with SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.functions import scoring, text
from feedloom.operators import items as ops
from feedloom.operators import relations, sinks
from feedloom.plans import catalog, generation, scoring_stage
from feedloom.plans.catalog import ITEMS, items, query, table
from feedloom.sources import connectors
from feedloom.streaming import state


@query(f"SELECT ordinal, CASE WHEN ordinal % 4 = 0 THEN '' ELSE title END AS title, CASE WHEN ordinal % 10 = 3 THEN NULL ELSE url END AS url FROM ({ITEMS}) WHERE ordinal % 10 <> 3 AND ordinal % 10 <> 5")
def standard_rows(spark, sf_dir):
    n = F.col("ordinal")
    raw = items(spark, sf_dir).select("ordinal", F.when(n % 4 != 0, F.col("title")).alias("title"), F.when(n % 10 == 5, "").when(n % 10 != 3, F.col("url")).alias("url"))
    return ops.standardise(raw)


@query(f"SELECT ordinal FROM ({ITEMS}) WHERE length(trim(content, ' ' || chr(10) || chr(9))) < 200")
def enrichment_candidates(spark, sf_dir):
    return items(spark, sf_dir).filter(ops.needs_enrichment(F.col("content"))).select("ordinal")


@query("SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey % 3 <> 1")
def enabled_sources(spark, sf_dir):
    n = F.col("c_nationkey") % 3
    config = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("type"), F.when(n == 0, True).when(n == 1, False).alias("enabled"))
    return ops.enabled(config, "BUILDING").select("c_custkey")


@query("""WITH a AS (SELECT page_id, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS root, unnest(regexp_extract_all(html, '(?is)<a\\b[^>]*href=["''][^"'']+["''][^>]*>.*?</a>')) AS a FROM pages),
    h AS (SELECT root, regexp_extract(a, '(?i)href=["'']([^"'']+)["'']', 1) AS href, trim(regexp_replace(regexp_replace(a, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS title FROM a)
    SELECT CASE WHEN regexp_matches(href, '^https?://') THEN href WHEN starts_with(href, '//') THEN 'https:' || href WHEN starts_with(href, '/') THEN root || href ELSE root || '/' || href END AS url, title
    FROM h WHERE title <> ''""")
def page_links(spark, sf_dir):
    return ops.page_links(table(spark, sf_dir, "pages"), F.col("url"))


@query(f"SELECT ordinal, 'tweet_' || substr(sha256(url), 1, 12) AS id FROM ({ITEMS})")
def draft_ids(spark, sf_dir):
    return items(spark, sf_dir).select("ordinal", ops.draft_id(F.col("url")).alias("id"))


@query(f"""SELECT profile, count(*) AS n_items FROM (SELECT CASE WHEN lang = 'de' THEN 'editor' WHEN contains(source, 'github') THEN 'developer' WHEN contains(source, 'paper') THEN 'explainer' ELSE 'plain' END AS profile FROM ({ITEMS})) GROUP BY 1""")
def profiles(spark, sf_dir):
    p = ops.profile(F.col("lang"), F.col("source"), {"de": "editor"}, {"github": "developer", "paper": "explainer"}, "plain")
    return items(spark, sf_dir).groupBy(p.alias("profile")).agg(F.count("*").alias("n_items"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'https://s.example/' || event_id WHEN 1 THEN 'name ' || event_id WHEN 2 THEN 'https://l.example/' || event_id ELSE '' END AS cell FROM events""")
def table_cells(spark, sf_dir):
    n = F.col("event_id").cast("string")
    kind = F.col("event_id") % 4
    cell = F.when(kind == 0, F.concat(F.lit('{"link":"https://s.example/'), n, F.lit('","text":"t"}'))).when(kind == 1, F.concat(F.lit("name "), n))
    cell = cell.when(kind == 2, F.concat(F.lit('[{"link":"https://l.example/'), n, F.lit('"},{"link":"x"}]')))
    return table(spark, sf_dir, "events").select("event_id", ops.cell_text(cell).alias("cell"))


@query(f"""SELECT ordinal, reject_kind, reason, preview FROM (SELECT ordinal, 'x_quality_fail' AS reject_kind, 'heat ' || heat_score::BIGINT AS reason, substr(content, 1, 160) AS preview FROM ({ITEMS}) WHERE heat_score < 30)""")
def reject_rows(spark, sf_dir):
    low = items(spark, sf_dir).filter("heat_score < 30")
    return ops.reject_rows(low, F.lit("x_quality_fail"), F.concat(F.lit("heat "), F.col("heat_score").cast("long").cast("string")), F.col("content")).select("ordinal", "reject_kind", "reason", "preview")


@query("""SELECT conv_id, turn, CASE WHEN length(text) > 200 THEN '仅X' ELSE 'X+小红书' END AS platform, CASE WHEN length(text) > 200 THEN '' ELSE role END AS long_title,
    text AS short_text FROM conversations""")
def downgrades(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.lit(scoring.BOTH).alias("platform"), F.col("role").alias("long_title"), F.col("text").alias("short_text"))
    return ops.downgrade(rows, F.length("short_text") > 200)


@query("""SELECT conv_id, turn, CASE WHEN length(t) > 300 THEN 1 WHEN length(t) > 0 AND length(t) < 120 THEN 1 ELSE 0 END AS n_fixes, t = '' AS blank FROM (SELECT conv_id, turn, text AS t FROM conversations)""")
def length_fixes(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    fixed = ops.fit_lengths(rows, {"text": ("xiaohongshu", 300, "long")})
    return fixed.select("conv_id", "turn", F.size("fixes").alias("n_fixes"), (F.col("text") == "").alias("blank"))


@query("""WITH r AS (SELECT doc_id, max(quality) AS q, max(toxic) AS t FROM labels GROUP BY doc_id), b AS (SELECT item_id, text FROM benchmark)
    SELECT d.doc_id, CASE WHEN r.q = 0 AND r.t = 0 AND b.text IS NOT NULL AND b.text <> '' THEN substr(b.text, 1, 40) ELSE d.lang END AS body
    FROM documents d LEFT JOIN r ON d.doc_id = r.doc_id LEFT JOIN b ON d.doc_id % 50 = b.item_id AND r.q = 0 AND r.t = 0""")
def revisions(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("url"), F.col("lang").alias("body"))
    reviews = table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("url")).agg(F.max("quality").alias("q"), F.max("toxic").alias("t"))
    reviews = reviews.select("url", F.when(F.col("q") == 0, "revise").otherwise("publish").alias("action"), (1 - F.col("t")).alias("fixable"))
    given = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("body"))
    given = docs.select("url").join(given, F.col("url") % 50 == F.col("item_id")).select("url", "body")
    return ops.revise(docs, reviews, given, {"body": 40}).select(F.col("url").alias("doc_id"), "body")


@query("SELECT event_type || ':' || (user_id % 3) AS value, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, value LIMIT 7")
def value_histogram(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_type", (F.col("user_id") % 3).cast("string").alias("k"))
    return ops.histogram(rows, "event_type", "k", n=7)


@query("SELECT c_custkey, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 8 AS chunk FROM customer")
def reply_batches(spark, sf_dir):
    return ops.chunked(table(spark, sf_dir, "customer"), 8, "c_nationkey", "c_custkey").select("c_custkey", "chunk")


@query(f"""SELECT ordinal, url, trim(title) AS title, substr(trim(snippet), 1, 150) AS snippet FROM ({ITEMS}) WHERE ordinal % 4 <> 3""")
def feed_items(spark, sf_dir):
    """Objects whose parts go under any of their names; one in four has no url."""
    n, c = F.col("ordinal") % 4, F.col
    one = F.to_json(F.struct(c("url").alias("permalink"), c("title"), c("snippet")))
    two = F.to_json(F.struct(c("url"), c("title").alias("name"), c("snippet").alias("description")))
    three = F.to_json(F.struct(c("url").alias("link"), c("title"), c("snippet").alias("summary")))
    made = items(spark, sf_dir).select("ordinal", F.when(n == 0, one).when(n == 1, two).when(n == 2, three).otherwise('{"title":"no url"}').alias("item"))
    return connectors.feed_items(made, "feed").select("ordinal", "url", "title", F.substring("snippet", 1, 150).alias("snippet"))


@query("""SELECT event_id AS ordinal, 'https://p.example/' || event_id AS url, 'item-' || event_id AS title, lower(event_type) AS platform, value::DOUBLE AS engagement FROM events""")
def social_items(spark, sf_dir):
    n, v = F.col("event_id").cast("string"), F.col("value")
    url = F.concat(F.lit("https://p.example/"), n)
    alias = lambda name, key: F.to_json(F.struct(url.alias("link"), v.alias(name), F.col("event_type").alias(key)))
    k = F.col("event_id") % 3
    item = F.when(k == 0, alias("points", "platform")).when(k == 1, alias("likes", "network")).otherwise(alias("upvotes", "source"))
    return connectors.social_items(table(spark, sf_dir, "events").select(F.col("event_id").alias("ordinal"), item.alias("item"))).select("ordinal", "url", "title", "platform", "engagement")


@query("""WITH n AS (SELECT greatest(1, 20 // count(DISTINCT event_type)) AS most FROM events)
    SELECT event_type AS platform, event_id AS ordinal FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events), n WHERE rn <= most""")
def platform_caps(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("platform"), F.col("event_id").alias("ordinal"))
    return connectors.per_platform(rows, 20)


@query(f"""SELECT 'link ' || ordinal AS title, url FROM ({ITEMS}) WHERE ordinal % 3 < 2""")
def link_lines(spark, sf_dir):
    n = F.col("ordinal")
    line = F.when(n % 3 == 0, F.concat(F.lit("link "), n.cast("string"), F.lit("\t"), "url")).when(n % 3 == 1, F.concat(F.lit("link "), n.cast("string"), F.lit("\t"), "url", F.lit("\n# note"))).otherwise("no address\tftp://x")
    return connectors.link_lines(items(spark, sf_dir).select(line.alias("raw")), "links").select("title", "url")


@query(f"""SELECT url, 'item ' || ordinal AS title, 'body of ' || ordinal AS snippet, CASE WHEN ordinal % 2 = 0 THEN '2026-01-02' END AS publish_time FROM ({ITEMS}) WHERE ordinal % 5 <> 4""")
def front_matter(spark, sf_dir):
    n = F.col("ordinal").cast("string")
    date = F.when(F.col("ordinal") % 2 == 0, "date: 2026-01-02\n").otherwise("")
    url = F.when(F.col("ordinal") % 5 == 4, F.lit("")).otherwise(F.concat(F.lit("url: "), "url", F.lit("\n")))
    raw = F.concat(F.lit("---\ntitle: \"item "), n, F.lit('"\n'), url, date, F.lit("x: y\n---\nbody of "), n)
    return connectors.front_matter(items(spark, sf_dir).select(raw.alias("raw")), "notes").select("url", "title", "snippet", "publish_time")


@query("""SELECT 'own' || (p_partkey % 7) || '/repo-' || p_partkey AS repo, CASE p_partkey % 3 WHEN 0 THEN p_size WHEN 1 THEN p_size * 1000 ELSE p_size * 1000 + 234 END::BIGINT AS stars FROM part""")
def trending_pages(spark, sf_dir):
    n, s = F.col("p_partkey"), F.col("p_size").cast("string")
    stars = F.when(n % 3 == 0, s).when(n % 3 == 1, F.concat(s, F.lit("k"))).otherwise(F.concat(s, F.lit(",234")))
    page = F.concat(F.lit('<article><a href="/own'), (n % 7).cast("string"), F.lit("/repo-"), n.cast("string"), F.lit('">r</a> <span>'), stars, F.lit(" stars</span></article>"))
    return connectors.trending(table(spark, sf_dir, "part").select(page.alias("html")))


@query("""SELECT event_id, least(100.0, value * 0.6::DOUBLE + (event_id % 50) * 1.2::DOUBLE) AS signal FROM events WHERE event_type <> 'view'""")
def community_items(spark, sf_dir):
    rows = table(spark, sf_dir, "events").filter("event_type <> 'view'").select("event_id", F.col("value").alias("points"), (F.col("event_id") % 50).alias("comments"))
    return connectors.community(rows).select("event_id", "signal")


@query("""WITH t AS (SELECT o_orderkey AS n, o_custkey AS c, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders), f AS (SELECT * FROM t WHERE rn <= 60)
    SELECT 'https://h.example/' || (c % 40) AS url, min(n) AS ordinal, '🔥 ' || arg_min(c % 9, n) || ' 个独立信源在报道' || arg_min(CASE WHEN c % 2 = 0 THEN chr(10) || '来源: a, b, c, d, e' ELSE '' END, n) AS snippet FROM f GROUP BY 1""")
def hot_topics(spark, sf_dir):
    c = F.col("o_custkey")
    names = F.when(c % 2 == 0, F.split(F.lit("a,b,c,d,e,f"), ","))
    rows = table(spark, sf_dir, "orders").select(F.concat(F.lit("https://h.example/"), (c % 40).cast("string")).alias("url"), F.lit("t").alias("title"), F.col("o_orderkey").alias("ordinal"), (c % 9).alias("source_count"), names.alias("source_names"))
    return connectors.hot_topics(rows, 30).select("url", "ordinal", "snippet")


@query("""SELECT 'https://r.example/' || lpad(o_orderkey::VARCHAR, 9, '0') AS url, o_totalprice AS stars FROM orders WHERE o_orderdate >= TIMESTAMP '1996-12-02' AND o_orderpriority = '1-URGENT' ORDER BY stars DESC, url LIMIT 15""")
def pushed_repositories(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.concat(F.lit("https://r.example/"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("url"), F.col("o_totalprice").alias("stars"), F.col("o_orderdate").alias("pushed_at"), "o_orderpriority")
    found = connectors.pushed(rows, F.lit("1997-01-01 09:00:00").cast("timestamp_ntz"), subject=F.col("o_orderpriority") == "1-URGENT")
    return found.select("url", "stars")


@query("""WITH l AS (SELECT l_partkey, arg_max(l_orderkey, l_orderkey * 10 + l_linenumber) AS tag FROM lineitem WHERE l_quantity > 45 GROUP BY 1)
    SELECT p_partkey AS repo, tag, least(100.0, 45.0 + least(p_retailprice * 10 / 1000, 25.0) + CASE WHEN tag IS NULL THEN 0 ELSE 15.0 END)::DOUBLE AS signal FROM part LEFT JOIN l ON p_partkey = l_partkey""")
def released_repositories(spark, sf_dir):
    repos = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("repo"), (F.col("p_retailprice") * 10).alias("stars"))
    lines = table(spark, sf_dir, "lineitem").filter("l_quantity > 45").select(F.col("l_partkey").alias("repo"), F.col("l_orderkey").alias("tag"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("published"))
    return connectors.released(repos, lines).select("repo", "tag", "signal")


@query("""WITH a AS (SELECT c_custkey % 97 AS url, 0 AS collector_rank, c_custkey AS ordinal FROM customer UNION ALL SELECT * FROM (SELECT s_suppkey + 50 AS url, 1, s_suppkey FROM supplier ORDER BY s_suppkey LIMIT 12) UNION ALL SELECT n_nationkey + 90, 2, n_nationkey FROM nation)
    SELECT url::VARCHAR AS url, collector_rank, ordinal FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY collector_rank, ordinal) AS rn FROM a) WHERE rn = 1""")
def composed_source(spark, sf_dir):
    part = lambda t, k, url: table(spark, sf_dir, t).select(url.cast("string").alias("url"), F.col(k).cast("long").alias("ordinal"))
    c = part("customer", "c_custkey", F.col("c_custkey") % 97)
    s, n = part("supplier", "s_suppkey", F.col("s_suppkey") + 50), part("nation", "n_nationkey", F.col("n_nationkey") + 90)
    return relations.composed([("stories", c, None), ("radar", s, 12), ("feeds", n, None)]).select("url", "collector_rank", "ordinal")


@query(f"""SELECT ordinal, json_extract_string(payload, '$.url') AS url, length(json_extract_string(payload, '$.snippet')) AS n FROM (SELECT ordinal, to_json({{'url': url, 'snippet': substr(snippet, 1, 50)}}) AS payload FROM ({ITEMS}))""")
def scorer_payloads(spark, sf_dir):
    rows = ops.payload_json(items(spark, sf_dir), ["url", "snippet"], {"snippet": 50})
    return rows.select("ordinal", F.get_json_object("payload", "$.url").alias("url"), F.length(F.get_json_object("payload", "$.snippet")).alias("n"))


@query(f"""WITH c AS ({catalog.SQL['clean_pages']}) SELECT count(*) AS n_items, sum(length(html))::BIGINT AS chars_before, sum(n_chars)::BIGINT AS chars_after,
    count(*) FILTER (WHERE length(html) > 1200 AND n_chars < length(html)) AS n_truncated FROM pages JOIN c USING (page_id)""")
def clean_volume(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("html", text.clean_text(F.col("html")).alias("clean"))
    rows = rows.withColumn("over", (F.length("html") > text.CONTENT_MAX) & (F.length("clean") < F.length("html")))
    return ops.clean_volume(rows, "html", "clean", "over")


@query("""SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN '咒语型' WHEN 1 THEN '平替型' ELSE '结果型' END AS title_pattern,
    CASE p_partkey % 5 WHEN 0 THEN 'hook + prompt_block + tweak_notes' WHEN 1 THEN 'hook + comparison_table + verdict' ELSE 'hook + what_happened + who_cares' END AS note_structure FROM part""")
def note_plans(spark, sf_dir):
    n = F.col("p_partkey") % 5
    p = F.when(n == 0, "spell").when(n == 1, "alternative").when(n == 2, "news_commentary").when(n == 3, "unheard of")
    return table(spark, sf_dir, "part").select("p_partkey", scoring.note_plan(p).alias("x")).select("p_partkey", "x.*")


@query(f"""SELECT angle, count(*) AS n_items FROM (SELECT CASE WHEN contains(lower(content), 'thon') THEN 'cost_change' WHEN regexp_matches(lower(content), 'xray|v2ray|xtls|vpn|proxy') THEN 'ecosystem_shift'
    WHEN contains(source, 'github') THEN 'developer_update' ELSE 'breaking_news' END AS angle FROM ({ITEMS})) GROUP BY 1""")
def angles(spark, sf_dir):
    return items(spark, sf_dir).groupBy(scoring.angle(F.col("content"), [("cost_change", ["thon"])], F.col("source")).alias("angle")).agg(F.count("*").alias("n_items"))


@query("""SELECT page_id, chr((page_id % 500 + 200)::INTEGER) || ' — ' || chr(8217) || ' & <' || chr(233) || chr(160) || '> &unheard; ' || chr(39) AS decoded FROM pages""")
def html_entities(spark, sf_dir):
    raw = F.concat(F.lit("&#"), (F.col("page_id") % 500 + 200).cast("string"), F.lit("; &mdash; &#x2019; &amp; &lt;&eacute;&nbsp;&gt; &unheard; &amp;#39;"))
    return table(spark, sf_dir, "pages").select("page_id", text.decode_entities(raw).alias("decoded"))


@query("""SELECT status, angle, platform, count(*) AS n FROM (SELECT CASE o_orderkey % 3 WHEN 0 THEN '已发布' ELSE '待审核' END AS status, CASE o_orderkey % 3 WHEN 1 THEN 'risk_alert' ELSE 'tool_use_case' END AS angle,
    CASE o_orderkey % 4 WHEN 0 THEN '仅X' WHEN 1 THEN 'X+小红书' WHEN 2 THEN 'X+小红书' ELSE '仅X' END AS platform FROM orders) GROUP BY ALL""")
def normalised_names(spark, sf_dir):
    n = F.col("o_orderkey")
    status = scoring.normalise_status(F.when(n % 3 == 0, "已发布").when(n % 3 == 1, "?"))
    angle = scoring.normalise_angle(F.when(n % 3 == 1, " Risk-Alert ").otherwise("other"))
    platform = scoring.normalise_platform(F.when(n % 4 == 0, "Twitter Only").when(n % 4 == 1, "X + General").otherwise("new"), n % 4 == 2)
    return table(spark, sf_dir, "orders").groupBy(status.alias("status"), angle.alias("angle"), platform.alias("platform")).agg(F.count("*").alias("n"))


@query("""SELECT doc_id, list_filter(list_transform(string_split(replace(text, '，', ','), ','), lambda t: ltrim(trim(t, ' '), '#')), lambda t: t <> '') AS tags FROM documents""")
def tag_lists(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.tags(F.col("text")).alias("tags"))


@query("""SELECT doc_id, len(list_filter(string_split(text, chr(10)), lambda x: trim(x, ' ') <> '')) AS n_lines, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '')[1] AS head FROM documents""")
def text_lines(spark, sf_dir):
    """A null text has a null count, and a text without lines a null head."""
    t = F.col("text")
    n = F.when(t.isNotNull(), text.line_count(t))
    return table(spark, sf_dir, "documents").select("doc_id", n.alias("n_lines"), F.nullif(text.first_line(t), F.lit("")).alias("head"))


@query("""SELECT status, count(*) AS n_rows FROM (SELECT 'done' AS status FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT 'pending' FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0))) GROUP BY 1""")
def queue_upsert(spark, sf_dir):
    queue = table(spark, sf_dir, "customer").filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("id"), F.lit("done").alias("status"))
    new = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("ordinal"))
    return state.enqueue(queue, new, "id").groupBy("status").agg(F.count("*").alias("n_rows"))


@query("SELECT o_orderstatus AS status, count(*) AS n_rows FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1")
def pending_purge(spark, sf_dir):
    left, _ = state.purge(table(spark, sf_dir, "orders").withColumnRenamed("o_orderstatus", "status"), "P", confirm=True)
    return left.groupBy("status").agg(F.count("*").alias("n_rows"))


@query("""SELECT '## 最近已做过的角度（避免重复，2026-07-26 新增）' || chr(10) || chr(10) || string_agg('- ' || substr(p_name, 1, 80), chr(10) ORDER BY p_partkey) || chr(10) || chr(10) || '如果当前素材角度与上面重合度 > 80%，请换一个角度。' AS body
    FROM (SELECT * FROM part ORDER BY p_partkey DESC LIMIT 20)""")
def memory_titles(spark, sf_dir):
    return state.recent_titles(table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("title")), "p_partkey")


@query("""SELECT 'kinds' AS report, CASE event_type WHEN 'error' THEN 'x_quality_fail' ELSE 'unknown' END AS name, count(*) AS n FROM events GROUP BY 2
    UNION ALL SELECT 'sources', (user_id % 5)::VARCHAR, count(*) FROM events GROUP BY 2""")
def reject_reports(spark, sf_dir):
    kind = F.when(F.col("event_type") == "error", "x_quality_fail").otherwise("")
    rows = table(spark, sf_dir, "events").select(kind.alias("reject_kind"), (F.col("user_id") % 5).cast("string").alias("source"), F.lit("r").alias("reason"), F.col("event_id").alias("ordinal"))
    made = sinks.reject_report(rows)
    part = lambda n, c: made[n].select(F.lit(n).alias("report"), F.col(c).alias("name"), F.col("count").alias("n"))
    return part("kinds", "reject_kind").unionByName(part("sources", "source"))


def _plain_items(spark, sf_dir):
    """Items whose words decide nothing, so that SQL can say what the stages below give."""
    said = {"title": "acme 新版本", "snippet": "s", "content": "c", "source": "feed", "category": "综合资讯"}
    return items(spark, sf_dir).select("ordinal", "url", "lang").withColumns({k: F.lit(v) for k, v in said.items()})


@query("""SELECT doc_id AS ordinal, CASE WHEN doc_id % 3 = 0 THEN 'ok' WHEN doc_id % 3 = 1 THEN 'tweet_content 空' ELSE 'xhs_failed: 小红书标题/正文空' END AS verdict,
    CASE WHEN doc_id % 3 = 2 THEN 'X+小红书' ELSE '仅X' END AS platform, CASE WHEN doc_id % 3 = 1 THEN 'breaking_news' ELSE 'risk_alert' END AS angle, 'news_commentary' AS pillar,
    CASE WHEN doc_id % 3 = 1 THEN 16 ELSE 100 END::DOUBLE AS short_score FROM documents""")
def drafts_judged(spark, sf_dir):
    short = "acme 这次更新影响所有开发者\\n风险在于权限变化，适合先看文档\\n但别急着升级，机会仍在后面，先看清楚成本再决定"
    n = F.col("ordinal") % 3
    data = F.when(n == 1, '{"platform":"x only"}').otherwise(F.concat(F.lit('{"content_angle":"risk alert","tweet_content":"' + short + '","platform":"'), F.when(n == 2, "X + other").otherwise("仅X"), F.lit('"}')))
    rows = _plain_items(spark, sf_dir).withColumns({"data": data, "routed": F.lit(None).cast("string"), "routed_reason": F.lit(None).cast("string")})
    made = generation.judged(generation.parsed(rows), generation.DraftRules(angles=[("breaking_news", ["新版本"])]))
    return made.select("ordinal", "verdict", "platform", "angle", "pillar", "short_score")


@query("""SELECT doc_id AS ordinal, CASE WHEN doc_id % 3 = 0 THEN (doc_id * 37 % 101)::DOUBLE ELSE 0 END AS heat_score,
    CASE doc_id % 3 WHEN 0 THEN 'why | relevance=core/other | heat_ai=T' ELSE 'ai_relevance 判定非 AI 主题' END AS score_reason, CASE doc_id % 3 WHEN 0 THEN 'core' ELSE 'none' END AS ai_relevance FROM documents""")
def scoring_stage_replies(spark, sf_dir):
    rows, n = _plain_items(spark, sf_dir), F.col("ordinal")
    score = (n * 37 % 101).cast("string")
    one = F.concat(F.lit('[{"url":"'), "url", F.lit('","heat_score":'), score, F.when(n % 3 == 0, ',"ai_relevance":"core","ai_topic_relevant":true,"score_reason":"why"}]').otherwise("}]"))
    replies = rows.filter(n % 3 < 2).select(n.alias("batch"), one.alias("reply"), F.lit(None).cast("string").alias("error"))
    return scoring_stage.scored(rows, replies).select("ordinal", "heat_score", "score_reason", "ai_relevance")


@query("SELECT lang, floor(rn / 40)::BIGINT AS batch, count(*) AS n_items FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS rn FROM documents) GROUP BY 1, 2")
def scoring_requests(spark, sf_dir):
    sent = scoring_stage.requests(_plain_items(spark, sf_dir), "lang", "ordinal")
    return sent.select("lang", "batch", F.size(F.from_json("request", "array<struct<url:string>>")).cast("long").alias("n_items"))
