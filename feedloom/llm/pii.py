"""Personal data: base patterns, and identifiers found by bootstrapped contexts.

Entities of the base patterns are the seeds, whatever their form.  A possible
identifier is any other token with a digit, or a run of up to ``TOKENS`` such
tokens parted by single spaces.  The one or two words before either are its
cues, without a trailing colon or equals sign, and a word that such a sign
glues to it.  Cues and identifiers form a graph.  A cue's confidence is the
share of all its occurrences in the corpus that are followed by an identifier
believed in; an identifier's is 1 for a seed, else the noisy-or of its trusted
cues.  The two are computed in turns, as joins over the graph, until nothing
changes any more: both only grow.  What follows a cue that ends up trusted is
reported as kind ``context``.

How far it reaches is learnt as well: a run's shape (digits, capitals and small
letters as such) counts if ``SUPPORT`` different identifiers behind trusted
cues have it.  Of the runs that start at one place the longest of such a shape
is reported, else its first token where that may be an identifier alone, else
the whole run; what follows a glued word goes before the token with that word.

The cues' occurrences are counted over all texts, so a word such as "the",
which ordinary words follow, is never trusted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import BROADCAST_ROWS, bound, broadcast_checked, stage
from feedloom.llm.spans import Kind, apart, digest, scan

#: A cue is trusted from this confidence and so many different believed identifiers; a shape counts from as many.
TRUST, SUPPORT = 0.8, 3
#: Tokens of a possible identifier.
TOKENS = 5
#: Confidences that change by less, summed over all cues, have settled.
SETTLED = 1e-6

_GAP = r"\x20\x09-\x0D"
#: An address starts where a run of its characters starts, or at the last match's end; nothing in between can match.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
#: A match that starts inside a run of digits would also start at the run's start.
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: Runs of digits parted by single spaces or hyphens; a single digit fails the count.
CARD = r"[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: A token with a digit.
_WORD = rf"[^{_GAP}0-9]*+[0-9][^{_GAP}]*+"
#: Up to two words without digits, then a run of tokens with one; a token that ends in a sign ends the run.  It starts at a token's start, and what each part takes ends where the next may start, so nothing is tried twice.
TOKEN = rf"(?<![^{_GAP}])(?:[^{_GAP}0-9]++[{_GAP}]++){{0,2}}+{_WORD}(?:(?<=[A-Za-z0-9)/-])\x20{_WORD}){{0,{TOKENS - 1}}}+"

_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_IP_OK = rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(c: Column) -> Column:
    """Whether 13 to 19 digits of ``c`` pass the Luhn check."""
    twice = F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)])

    def passes(d: Column) -> Column:
        values = F.transform(F.filter(F.split(F.reverse(d), ""), lambda x: x != ""), lambda x, i: F.when(i % 2 == 0, x.cast("int")).otherwise(F.get(twice, x.cast("int"))))
        return F.when(F.length(d).between(13, 19), F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0).otherwise(F.lit(False))

    return F.when(F.length(c) >= 13, bound(_digits(c), passes)).otherwise(F.lit(False))


def _kinds() -> list[Kind]:
    return [
        Kind("email", EMAIL, "contains(text, '@')", lead=True),
        Kind("ip", IP, "text rlike '[0-9][.][0-9]'", lambda m: m.rlike(_IP_OK), lead=True),
        Kind("card", CARD, "text rlike '[0-9][ -]?[0-9]'", luhn, lead=True),
        Kind("phone", PHONE, "contains(text, '+')", lambda m: F.length(_digits(m)).between(9, 15), lead=True),
        Kind("context", TOKEN, "text rlike '[0-9]'"),
    ]


NAMES = ["email", "ip", "card", "phone", "context"]
BASE = 4
_TEXTS = "array<string>"


def _cues(two: Column) -> Column:
    """The cues of one or two words joined by a space: both and the last, where they hold no digit."""
    ends = lambda t: F.filter(F.array_distinct(F.array(t, F.regexp_extract(t, r"[^ ]+$", 0))), lambda c: (c != "") & ~c.rlike("[0-9]"))
    return bound(F.trim(F.regexp_replace(two, "[:=]+(?= |$)", "")), ends)


def _seed(s: Column) -> Column:
    """``instance, seed, cues`` of a base span: the words before it, or a word that a colon or equals sign glues to it."""
    last = F.get(s["before"], F.lit(2))
    glued = F.when(last.rlike("^[^0-9:=]+[:=]+$"), F.array(F.regexp_replace(last, "[:=]+$", ""))).otherwise(F.array().cast(_TEXTS))
    words = _cues(F.concat_ws(" ", F.get(s["before"], F.lit(0)), F.get(s["before"], F.lit(1))))
    return F.struct(s["match"].alias("instance"), F.lit(True).alias("seed"), F.when(last.rlike(r"[\p{L}\p{N}]"), glued).otherwise(words).alias("cues"))


def _possible(s: Column) -> Column:
    """What the tokens of a match may hold, each prefix of the run: all of it, and what follows a glued word.

    ``start, end, instance, cues`` with ``site`` (where the run starts),
    ``glued``, ``tokens`` and ``first``, the shortest of its kind at the site,
    which stands for it in the graph.
    """
    whole = lambda t: F.regexp_extract(t, r"(?s)[A-Za-z0-9+](?:.*[A-Za-z0-9])?", 0)

    def part(run: Column, skip: Column, cues: Column, glued: int) -> Column:
        site = s["end"] - F.length(run)

        def prefixes(words: Column) -> Column:
            def prefix(n: Column) -> Column:
                text = F.substring(F.array_join(F.slice(words, 1, n), " "), skip + 1, F.length(run))

                def placed(r: Column) -> Column:
                    at = site + skip + F.instr(r["text"], r["instance"]) - 1
                    return F.struct(
                        at.alias("start"), (at + F.length(r["instance"])).alias("end"), r["instance"].alias("instance"), cues.alias("cues"),
                        site.alias("site"), F.lit(glued).alias("glued"), n.alias("tokens"),
                    )

                return bound(F.struct(text.alias("text"), whole(text).alias("instance")), placed)

            return F.transform(F.sequence(F.lit(1), F.size(words)), prefix)

        usable = F.filter(bound(F.split(run, " "), prefixes), lambda x: (F.length(x["instance"]) >= 4) & x["instance"].rlike("[0-9]"))
        return F.transform(usable, lambda x, i: x.withField("first", i == 0))

    def parts(run: Column) -> Column:
        lead = F.substring(s["match"], F.lit(1), F.length(s["match"]) - F.length(run))
        before = _cues(F.lower(F.trim(F.regexp_replace(lead, rf"[{_GAP}]+", " "))))
        prefix = F.regexp_extract(run, "^([^0-9:=]+)[:=]+", 0)
        own = lambda p: F.when(p != "", part(run, F.length(p), F.array(F.lower(F.regexp_replace(p, "[:=]+$", ""))), 1)).otherwise(F.filter(part(run, F.lit(0), before, 0), lambda x: F.lit(False)))
        return F.concat(part(run, F.lit(0), before, 0), bound(prefix, own))

    return bound(F.regexp_replace(s["match"], rf"^(?:[^{_GAP}0-9]++[{_GAP}]++)*+", ""), parts)


def shape(instance: Column) -> Column:
    """Digits, capitals and small letters as such; other characters stay."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(instance, "[0-9]", "9"), "[A-Z]", "A"), "[a-z]", "a")


def marked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``uid, doc_id, own, seeds, maybe`` of each row: base spans, the same as graph nodes, and the tokens apart from them that may be identifiers."""
    found = scan(docs, _kinds(), BASE, id_col, text_col)
    own = F.transform("own", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    maybe = apart(F.flatten(F.transform("more", _possible)), F.col("own"))
    return found.select(F.monotonically_increasing_id().alias("uid"), "doc_id", own.alias("own"), F.transform("own", _seed).alias("seeds"), maybe.alias("maybe"))


def edges(rows: DataFrame) -> DataFrame:
    """``cue, instance, n, seed``: how often a cue precedes an instance."""
    nodes = F.concat("seeds", F.transform(F.filter("maybe", lambda x: x["first"]), lambda x: F.struct(x["instance"].alias("instance"), F.lit(False).alias("seed"), x["cues"].alias("cues"))))
    flat = rows.select(F.explode(nodes).alias("x")).select("x.instance", "x.seed", F.explode("x.cues").alias("cue"))
    return flat.filter("cue <> ''").groupBy("cue", "instance").agg(F.count("*").alias("n"), F.max("seed").alias("seed"))


def cue_counts(docs: DataFrame, cues: DataFrame, text_col: str = "text", limit: int = BROADCAST_ROWS) -> DataFrame:
    """``cue, total``: how often each cue of one or two words, also one glued by a colon or equals sign, occurs in all texts.

    Up to ``limit`` cues are broadcast, so only their occurrences are counted.
    Beyond it all words are counted first, in the tasks that read them, and
    the counts, not the words, meet the cues.
    """
    text = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    signs = text.contains(":") | text.contains("=")
    words = F.filter(F.split(F.when(signs, F.regexp_replace(text, rf"[:=]++(?![^{_GAP}])", "")).otherwise(text), rf"[{_GAP}]+"), lambda w: w != "")
    glued = F.regexp_extract_all(text, F.lit(rf"(?<![^{_GAP}])([^{_GAP}0-9:=]++)[:=]++[^{_GAP}]"), F.lit(1))
    rows = docs.select(words.alias("w"), F.when(signs, glued).otherwise(F.array().cast(_TEXTS)).alias("g"))
    pairs = F.zip_with(F.col("w"), F.slice("w", 2, F.greatest(F.size("w") - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, F.when(b.isNotNull(), b)))
    seen = rows.select(F.explode(F.concat("w", "g", F.when(F.size("w") > 1, F.slice(pairs, 1, F.greatest(F.size("w") - 1, F.lit(0)))).otherwise(F.array().cast(_TEXTS)))).alias("_cue"))
    if cues.limit(limit + 1).count() <= limit:
        return seen.join(F.broadcast(cues), seen["_cue"] == cues["cue"]).groupBy("cue").agg(F.count("*").alias("total"))
    counted = seen.groupBy("_cue").agg(F.count("*").alias("total"))
    return counted.join(cues, counted["_cue"] == cues["cue"]).select("cue", "total")


def trusted_cues(edges: DataFrame, totals: DataFrame, trust: float = TRUST, support: int = SUPPORT) -> DataFrame:
    """``cue`` of those trusted once the turns have settled.

    ``edges``: ``cue, instance, n, seed`` (staged); ``totals``: ``cue, total``
    (staged) of the cues with enough different instances to be trusted at all.
    Beliefs and confidences only grow from turn to turn and are at most 1, so
    the turns end.
    """
    scored, before = edges.select("cue", "instance", "n", "seed", F.when(F.col("seed"), 1.0).otherwise(0.0).alias("belief")), None
    while True:
        sums = scored.groupBy("cue").agg(F.sum(F.col("n") * F.col("belief")).alias("mass"), F.count_if(F.col("belief") >= 0.5).alias("support"))
        good = sums.join(totals, "cue").withColumn("confidence", F.least(F.lit(0.999), F.col("mass") / F.col("total")))
        good = stage(good.filter((F.col("support") >= support) & (F.col("confidence") >= trust)).select(F.col("cue").alias("_cue"), "confidence"), "trusted")
        now = good.agg(F.count("*"), F.coalesce(F.sum("confidence"), F.lit(0.0))).first()
        if not now[0] or (before is not None and now[0] == before[0] and abs(now[1] - before[1]) < SETTLED):
            return good.select(F.col("_cue").alias("cue"))
        before = now
        doubt = edges.join(good, edges["cue"] == good["_cue"]).groupBy(F.col("instance").alias("_i")).agg(F.exp(F.sum(F.log1p(-F.col("confidence")))).alias("doubt"))
        doubt = stage(doubt, "beliefs")
        belief = F.when(F.col("seed"), 1.0).otherwise(1.0 - F.coalesce("doubt", F.lit(1.0)))
        scored = edges.join(doubt, edges["instance"] == doubt["_i"], "left").select("cue", "instance", "n", "seed", belief.alias("belief"))


def reached(hits: DataFrame, support: int = SUPPORT) -> DataFrame:
    """``uid, start, end``: of the possible identifiers at each site behind a trusted cue the one whose length was learnt.

    ``hits``: ``uid, site, glued, tokens, start, end, instance`` (staged).
    """
    shaped = hits.withColumn("shape", shape(F.col("instance")))
    longer = shaped.filter("tokens > 1").select("shape", "instance").distinct()
    known = longer.groupBy("shape").agg(F.count("*").alias("k")).filter(F.col("k") >= support).select(F.col("shape").alias("_shape"))
    met = shaped.join(known, shaped["shape"] == known["_shape"], "left")
    learnt = (F.col("tokens") == 1) | F.col("_shape").isNotNull()
    best = met.groupBy("uid", "site").agg(F.max_by(F.struct("start", "end"), F.struct("glued", learnt, "tokens")).alias("s"))
    return best.select("uid", "s.start", "s.end")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans``, one row per row of ``docs``.

    Defined cases: a null text is empty; null and repeated ids are told apart
    by row; a document without spans has empty ``spans``; an empty table gives
    no rows; other columns are not read.
    """
    rows = stage(marked(docs, id_col, text_col), "spans")
    graph = stage(edges(rows), "edges")
    enough = stage(graph.groupBy("cue").agg(F.count("*").alias("k")).filter(f"k >= {SUPPORT}").select("cue"), "cues")
    totals = stage(cue_counts(docs, enough, text_col), "totals")
    good = trusted_cues(graph, totals)
    span = F.struct(F.lit(BASE).alias("kind"), "start", "end")
    none = F.array().cast(rows.schema["own"].dataType)
    if good.isEmpty():
        return digest(rows.withColumn("added", none), NAMES, BASE, by_kind=True)
    sites = ["site", "glued", "tokens", "start", "end", "instance"]
    hits = rows.select("uid", F.explode("maybe").alias("x")).select("uid", *[f"x.{c}" for c in sites], F.explode("x.cues").alias("_cue"))
    hits = stage(hits.join(broadcast_checked(good), hits["_cue"] == good["cue"]).select("uid", *sites).distinct(), "hits")
    hits = reached(hits).select(F.col("uid").alias("_uid"), span.alias("s"))
    found = stage(hits.groupBy("_uid").agg(F.collect_set("s").alias("added")), "added")  # one document's spans
    both = rows.select("uid", "doc_id", "own").join(broadcast_checked(found), F.col("uid") == F.col("_uid"), "left")
    return digest(both.withColumn("added", F.coalesce("added", none)), NAMES, BASE, by_kind=True)
