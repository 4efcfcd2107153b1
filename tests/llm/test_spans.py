"""Personal data and secrets against Python's regular expressions."""

import hashlib
import random
import re

from feedloom.llm import pii, secrets


def luhn(m):
    d = [int(c) for c in m if c.isdigit()]
    return 13 <= len(d) <= 19 and sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d[::-1])) % 10 == 0


PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: luhn(m[0])),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= sum(c.isdigit() for c in m[0]) <= 15),
]
SECRETS = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
]


def base_spans(text, kinds, by_kind):
    spans = [(i, m.start(), m.end()) for i, (_, rx, ok) in enumerate(kinds) for m in re.finditer(rx, text or "") if ok(m)]
    if not by_kind:
        spans.sort(key=lambda s: (s[1], s[0]))
    return spans, ",".join(f"{kinds[i][0]}:{a}:{b}" for i, a, b in spans)


def check(got, rows, kinds, by_kind):
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append(base_spans(t, kinds, by_kind))
    assert len(got) == len(rows)
    for r in got:
        spans, line = next(x for x in texts[r["doc_id"]] if hashlib.sha256(x[1].encode()).hexdigest() == r["base_sha256"])
        assert [r[f"n_{k[0]}"] for k in kinds] == [sum(s[0] == i for s in spans) for i in range(len(kinds))]
        listed = [x for x in r["spans"].split(",") if x.split(":")[0] in {k[0] for k in kinds}]
        assert ",".join(listed) == line


def noisy(pieces, n, seed):
    rng = random.Random(seed)
    return [(i, "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 25)))) for i in range(n)]


def test_personal_data(spark):
    pieces = ["a@b.co", "@", "x.y", ".com", "_", "+", "%", " ", "\n", "é", "\U0001f600", "1.2.3.4", ".5", "300.1.1.1", "0001.2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1111", "-", "7", "12", "+1 (743) 555-3824", "(", "+44", "  ", "word"]
    rows = noisy(pieces, 600, 1) + [(1000, None), (1001, ""), (None, "q@r.st and 9.9.9.9"), (1002, "9" * 50_000), (1003, "a" * 50_000 + "@"), (1004, "1." * 30_000), (1004, "u@v.wx"), (1005, "+1 " * 9_000)]
    docs = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, text string, uid int, kind string")
    check(pii.find(docs).collect(), rows, PII, True)
    assert pii.find(docs.limit(0)).count() == 0


def test_contexts_discover_unseen_identifiers(spark):
    rng = random.Random(4)
    rows = []
    for i in range(60):
        mark = f"user{rng.randrange(10**6)}@mail.org" if i % 6 else f"QX-{rng.randrange(10**6)}-Z"
        rows.append((i, f"the meeting was long. Member contact: {mark} and the rest of the text follows"))
    rows += [(100 + i, f"the room {i}99 the year 20{i:02d} was fine and the end") for i in range(30)]
    got = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        found = [tuple(map(int, x.split(":")[1:])) for x in got[i].split(",") if x.startswith("context")]
        if i < 60 and i % 6 == 0:
            assert [text[a:b] for a, b in found] == [re.search(r"QX-\d+-Z", text)[0]]
        else:
            assert not found


def test_base_spans_of_any_form_are_seeds(spark):
    """Phones with spaces and emails without a digit make a cue trusted, also where a colon glues it on."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for i in range(60):
        phone, mail, code = f"+1 ({i + 100}) 555-77{i:02d}", f"jo{letters[i % 26]}{letters[i // 26]}@mail.org", f"QX-{i * 7919}-Z"
        mark = code if i % 6 == 0 else (phone if i % 2 else mail)
        rows.append((i, f"it was long. Reach line: {mark} and on"))
        rows.append((100 + i, f"it was long. dial:{mark if mark != mail else phone} and on"))
    got = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        found = [text[int(a) : int(b)] for _, a, b in (x.split(":") for x in got[i].split(",") if x.startswith("context"))]
        assert found == ([re.search(r"QX-\d+-Z", text)[0]] if i % 100 % 6 == 0 else []), (text, got[i])


def test_secrets(spark):
    pieces = ["password=", "token = ", '"', "'", "API_KEY: ", "apikey:", "secret", "=", ":", " ", "\n", "é", "\U0001f600", "AKIA", "ABCDEFGH1234", "a1b2c3d4e5f60718" * 2, "f", "word", "hunter22", "x.y=z", "Passwd"]
    rows = noisy(pieces, 600, 2) + [(1000, None), (1001, ""), (None, "token=abcdefgh12"), (1002, "f" * 50_000), (1003, "AKIA" * 9_000), (1001, "secret: 12345678")]
    docs = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, text string, uid int, match string")
    check(secrets.find(docs).collect(), rows, SECRETS, False)
    assert secrets.find(docs.limit(0)).count() == 0


def test_random_strings_are_told_from_identifiers(spark, tables):
    rng = random.Random(9)
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text")
    abc = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    keys = ["".join(rng.choice(abc) for _ in range(40)) for _ in range(200)]
    words = [w for r in docs.limit(40).collect() for w in re.findall("[A-Za-z]{4,}", r["text"])]
    names = ["_".join(rng.choice(words).lower() for _ in range(4)) for _ in range(400)]
    ratios, least = secrets.train(docs)
    from pyspark.sql import functions as F

    rate = lambda xs: spark.createDataFrame([(x,) for x in xs], "t string").filter(secrets.ratio(F.col("t"), ratios) >= least).count() / len(xs)
    assert rate(keys) > 0.95 and rate(names) < 0.01
    planted = docs.limit(5).withColumn("text", F.concat("text", F.lit(" key "), F.lit(keys[0])))
    for r in secrets.find(planted, model=(ratios, least)).collect():
        assert "random:" in r["spans"]


def test_contexts_have_no_length_limits(spark):
    """Identifiers of any length and lead, behind any number of blanks, are found whole."""
    rng = random.Random(7)
    rows = [(i, f"it was long. Member contact: user{rng.randrange(10**6)}@mail.org and so on") for i in range(60)]
    long, lead = "7" + "q-" * 60 + "z", "k" * 50 + "31"
    rows += [(100, f"it was long. Member contact: {long} and"), (101, f"it was long. Member contact: {lead} and"), (102, "it was long. Member contact:     AB-12 and")]
    got = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows[60:]:
        found = [text[int(a) : int(b)] for k, a, b in (x.split(":") for x in got[i].split(",")) if k == "context"]
        assert found == [{100: long, 101: lead, 102: "AB-12"}[i]]


def contexts(spark, rows):
    got = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    return {i: [text[int(a) : int(b)] for k, a, b in (x.split(":") for x in got[i].split(",") if x) if k == "context"] for i, text in rows}


def test_identifiers_of_several_tokens(spark):
    """National numbers, grouped account numbers and single codes behind a cue that phones make trusted."""
    rng = random.Random(12)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    marks = [f"+49 ({digits(3)}) {digits(3)}-{digits(4)}" for _ in range(180)] + [f"QX-{digits(4)}" for _ in range(10)] + [f"030 {digits(4)} {digits(4)}" for _ in range(10)]
    marks += [f"DE{digits(2)} K{digits(3)} K{digits(3)} K{digits(3)} {digits(2)}" for _ in range(10)]  # no card by chance
    rows = [(i, f"it was long. call {m} and so on") for i, m in enumerate(marks)]
    rows += [(900, "it was long. call QX-7001 12 apples and so on"), (901, "it was long. call 030 1234 5678, 12 apples"), (902, "call"), (903, "it was long. call +49 (030) 555-7713 7 times")]
    got = contexts(spark, rows)
    for i, m in enumerate(marks):
        assert got[i] == ([] if m.startswith("+") else [m])
    assert got[900] == ["QX-7001"] and got[901] == ["030 1234 5678"] and got[902] == got[903] == []


def test_recall_by_kind_behind_planted_cues(spark, tables):
    """Codes, national numbers, account numbers and user numbers amid the table's own texts, an eighth of the marks being none of the base kinds."""
    rng = random.Random(6)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    kinds = {
        "code": lambda: f"QX-{digits(5)}-Z",
        "phone": lambda: f"0{digits(3)} {digits(4)} {digits(3)}",
        "account": lambda: f"DE{digits(2)} K{digits(3)} K{digits(3)} K{digits(3)} {digits(2)}",
        "user": lambda: f"user_{digits(6)}",
    }
    seeds = [lambda: f"u{digits(6)}@mail.org", lambda: f"+49 ({digits(3)}) {digits(3)}-{digits(4)}"]
    cues = ["reach line", "kontakt unter", "member id:", "appeler"]
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("text").limit(192).collect()
    rows, planted = [], {}
    for i, r in enumerate(docs):
        words = r["text"].split(" ")[:80]
        at = rng.randrange(len(words) + 1)
        kind = None if i % 8 else list(kinds)[i // 8 % 4]
        mark = kinds[kind]() if kind else rng.choice(seeds)()
        rows.append((i, " ".join([*words[:at], cues[i % 7 % 4], mark, "wordy", *words[at:]])))
        if kind:
            planted[i] = (kind, mark)
    got = contexts(spark, rows)
    recall = {k: sum(m in got[i] for i, (kind, m) in planted.items() if kind == k) / sum(kind == k for kind, _ in planted.values()) for k in kinds}
    assert min(recall.values()) >= 0.9, recall


def plain_trusted(edges, totals):
    """The graph's scores by loops, to the fixpoint."""
    seeds = {i for _, i, _, seed in edges if seed}
    belief, trusted = {i: float(i in seeds) for _, i, _, _ in edges}, {}
    while True:
        mass, support = {}, {}
        for cue, i, n, _ in edges:
            mass[cue] = mass.get(cue, 0.0) + n * belief[i]
            support[cue] = support.get(cue, 0) + (belief[i] >= 0.5)
        now = {c: min(0.999, mass[c] / totals[c]) for c in mass if c in totals and support[c] >= pii.SUPPORT and mass[c] / totals[c] >= pii.TRUST}
        if now.keys() == trusted.keys() and sum(abs(now[c] - trusted[c]) for c in now) < 1e-9:
            return set(now)
        trusted = now
        for i in belief:
            doubt = 1.0
            for cue, j, _, _ in edges:
                if i == j and cue in trusted:
                    doubt *= 1 - trusted[cue]
            belief[i] = 1.0 if i in seeds else 1.0 - doubt


def test_scores_are_those_of_plain_loops_at_the_fixpoint(spark):
    """A chain of cues, each trusted only by what the one before made believed, longer than any fixed number of turns."""
    rng = random.Random(3)
    edges = [("c0", f"s{i}", 3, True) for i in range(4)]
    for k in range(7):
        edges += [(f"c{k}", f"i{k}{j}", 1, False) for j in range(2)] + [(f"c{k + 1}", f"i{k}{j}", 6, False) for j in range(2)] + [(f"c{k + 1}", f"x{k}", 1, True)]
    edges += [(f"n{rng.randrange(5)}", f"i{rng.randrange(7)}{rng.randrange(2)}", 1, False) for _ in range(9)]
    edges = list({(c, i): (c, i, n, s) for c, i, n, s in edges}.values())
    totals = {c: sum(n for d, _, n, _ in edges if d == c) + (c.startswith("n")) for c in {e[0] for e in edges}}
    from feedloom.llm.common import stage

    graph = stage(spark.createDataFrame(edges, "cue string, instance string, n long, seed boolean"), "graph")
    sums = stage(spark.createDataFrame(list(totals.items()), "cue string, total long"), "sums")
    want = plain_trusted(edges, totals)
    assert {"c0", "c7"} <= want and {r["cue"] for r in pii.trusted_cues(graph, sums).collect()} == want


def test_cues_are_counted_alike_beyond_a_broadcast(spark):
    docs = spark.createDataFrame([(1, "call me at: 5 call me"), (2, None), (3, "call:7 Me at")], "doc_id long, text string")
    cues = spark.createDataFrame([("call",), ("call me",), ("me at",), ("none",)], "cue string")
    small, large = (sorted(map(tuple, pii.cue_counts(docs, cues, limit=n).collect())) for n in (10, 1))
    assert small == large == [("call", 3), ("call me", 2), ("me at", 2)]


def test_running_and_apart(spark):
    """Against plain Python, over several blocks."""
    from pyspark.sql import functions as F

    from feedloom.llm.common import running
    from feedloom.llm.spans import apart

    rng = random.Random(3)
    rows = []
    for n, m in ((0, 0), (1, 0), (0, 2), (5, 3), (64, 1), (65, 40), (700, 300)):
        span = lambda: (lambda a: (a, a + rng.randrange(1, 9)))(rng.randrange(2000))
        rows.append(([span() for _ in range(n)], [span() for _ in range(m)]))
    df = spark.createDataFrame(rows, "a array<struct<start:bigint,end:bigint>>, b array<struct<start:bigint,end:bigint>>")
    sums = running(F.transform("a", lambda x: x["start"]), F.lit(0).cast("long"), lambda x, y: x + y, 8)
    for r in df.select("a", "b", sums.alias("s"), apart(F.col("a"), F.col("b")).alias("c")).collect():
        starts = [x["start"] for x in r["a"]]
        assert r["s"] == [sum(starts[: i + 1]) for i in range(len(starts))]
        want = sorted(tuple(x) for x in r["a"] if not any(y["start"] < x["end"] and y["end"] > x["start"] for y in r["b"]))
        assert sorted(map(tuple, r["c"])) == want


def test_ratio_is_the_plain_mean_and_parts_are_judged(spark):
    from pyspark.sql import functions as F

    rng = random.Random(5)
    abc = secrets.ALPHABET
    table = [rng.uniform(-3, 3) for _ in range(len(abc) ** 2)]
    tokens = ["".join(rng.choice(abc) for _ in range(n)) for n in (2, 20, 75)]
    for r in spark.createDataFrame([(t,) for t in tokens], "t string").select("t", secrets.ratio(F.col("t"), table).alias("r")).collect():
        pairs = [round(table[abc.index(a) * len(abc) + abc.index(b)], 6) for a, b in zip(r["t"], r["t"][1:])]
        assert abs(r["r"] - sum(pairs) / len(pairs)) < 1e-9
    # a model under which digits are random and letters are not
    plain = [1.0 if a.isdigit() and b.isdigit() else -1.0 for a in abc for b in abc]
    text = "see static/images/backgrounds/ordinary-names/" + "3141592653589793238462" + " and " + "a" * 30
    got = secrets.find(spark.createDataFrame([(1, text)], "doc_id long, text string"), model=(plain, 0.5)).collect()[0]["spans"]
    (span,) = [x.split(":") for x in got.split(",") if x.startswith("random")]
    assert text[int(span[1]) : int(span[2])] == "3141592653589793238462"
