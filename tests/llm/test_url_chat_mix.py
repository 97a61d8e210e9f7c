import hashlib
import random

import pytest
from pyspark.sql import functions as F

from pressroom.llm import chat_format as cf, mixing, url_filter as uf
from pressroom.llm.queries import ORACLES, QUERIES
from tools.check import digest


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLES[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert digest(df.columns, rows)[0] == digest(cols, res.fetchall())[0]


URLS = ["http://A.Example.ORG/es/x", "http://example.org/en/12", "http://example.org/en/2", "http://org", "http://org/",
        "http://notexample.org/es/", "x://fr.com/fr/", "http://fr.com/fr", "http://com/de/1?x#y", None, "", "no scheme/a",
        "http://u@h.com:80/wp-admin/x", "http://a.net/b?c=/login", "http://a.net/login", "http://ads.a.net/x",
        "http://loads.a.net/x", "http://a.net/porn/", "http://a.net?sessionid=1", "http://a.net/q?action=logout",
        "http://a.net/q?xaction=logout", "a://b://example.org/es/", "http://[::1]/(x)*+", "http://example.org/en/1"]


def brute_verdict(url):
    import re

    if url is None or "://" not in url:
        return "", "", None, "allow", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    tail = rest[len(host):]
    host = host.translate(str.maketrans(uf.UPPER, uf.LOWER))
    path = re.match(r"[^?#]*", tail)[0]
    fit = []
    for r in uf.HOST_RULES:
        h, _, p = r.text.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fit.append((len(r.text), r))
    own = max(fit, key=lambda x: x[0])[1] if fit else None
    hits = [r for r in uf.PATTERN_RULES if rest and re.search(uf.regex_of(r.pattern), host + tail)]
    best = own or (min(hits, key=lambda r: (-len(r.text), r.text)) if hits else None)
    return host, path, own and own.text, best.action if best else "allow", best and best.text


def test_url_verdicts(spark):
    rows = [(k, u, "html") for k, u in enumerate(URLS + URLS[:5])]
    df = spark.createDataFrame(rows, "page_id long, url string, token string")
    got = uf.judge_urls(df).collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute_verdict(dict((a, b) for a, b, _ in rows)[r.page_id])
        assert (r.host, r.path, r.rule, r.verdict, r.matched) == want, r.url
    assert uf.judge_urls(df.limit(0)).count() == 0


def test_rule_without_token_is_never_missed(spark):
    df = spark.createDataFrame([(1, "http://a.b/xyzzy"), (2, "http://a.b/c")], "page_id long, url string")
    rules = [uf.Rule("*yzz*", "block", False)]
    assert uf.literal_tokens("*yzz*") == []
    assert {r.page_id: r.verdict for r in uf.judge_urls(df, rules=rules).collect()} == {1: "block", 2: "allow"}


def test_chat_round_trip(spark):
    texts = ["", None, "\\", "\\\\", "<|", "<\\|", "a<|im_end|>\n<|im_start|>assistant\nb", "x\\<|y\n", "🙂\n", "\\n", "|",
             "<", "long " * 20_000]
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", "sy\nst\\em<|", None]), rng.choice(texts), "extra", t)
            for c in range(6) for t in range(rng.randint(1, 40))]
    rows += [rows[0], rows[0], (None, 0, "assistant", "x", "e", 1), (None, None, "user", "y", "e", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, node string, pos int")
    out = cf.format_conversations(df)
    turns, learned = cf.read_back(F.col("formatted"), F.col("loss"))
    got = {r.conv_id: r for r in out.select("conv_id", "formatted", turns.alias("t"), learned.alias("l")).collect()}
    for c in {r[0] for r in rows}:
        null_first = lambda x: (x is not None, x)
        want = sorted((r for r in rows if r[0] == c), key=lambda r: (null_first(r[1]), null_first(r[2]), null_first(r[3])))
        assert [(t.role, t.text) for t in got[c].t] == [(r[2] or "", r[3] or "") for r in want]
        assert got[c].l == "".join(r[3] or "" for r in want if r[2] == "assistant")
        assert got[c].formatted.count(cf.START) == len(want)
    assert cf.format_conversations(df.limit(0)).count() == 0


def test_probe_conversation(spark, sf_dir):
    r = cf.op7_chat_format(spark, sf_dir).where("conv_id = -1").first()
    said = cf.PROBE_TEXT
    assert (r.n_turns, r.loss_chars) == (2, len(said))
    assert r.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert r.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()


def test_reply_tree_branches(spark):
    # 1 - 2 - 4 and 1 - 3 - 5 - 6; 7 alone; 8 <-> 9 a cycle; 10 replies to a message that isn't there
    rows = [(1, None, 1.0), (2, 1, 9.0), (3, 1, 2.0), (4, 2, 2.0), (5, 3, 1.0), (6, 5, 1.0), (7, None, None),
            (8, 9, 1.0), (9, 8, 1.0), (10, 99, 0.0)]
    df = spark.createDataFrame(rows, "m long, p long, s double")
    def paths(k):
        out = {}
        for r in cf.reply_paths(df, "m", "p", "s", k).collect():
            out.setdefault((r.root, r["rank"]), []).append((r.pos, r.node))
        return {key: [n for _, n in sorted(v)] for key, v in out.items()}
    assert paths(1) == {(1, 1): [1, 2, 4], (7, 1): [7], (10, 1): [10]}
    assert paths(2) == {(1, 1): [1, 2, 4], (1, 2): [1, 3, 5, 6], (7, 1): [7], (10, 1): [10]}


def test_long_reply_chain(spark):
    df = spark.range(0, 700).selectExpr("id AS m", "nullif(id - 1, -1) AS p", "1.0 AS s")
    got = sorted((r.pos, r.node) for r in cf.reply_paths(df, "m", "p", "s").collect())
    assert got == [(k, k) for k in range(700)]


def test_mixing_rates_and_repeatability(spark, docs_of, odd_rows):
    docs = spark.range(0, 6000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'a', if(id % 3 = 1, 'b', null)) AS source",
                                           "'t' AS text", "7L AS copy", "id AS u")
    w = {"a": 0.5, "b": 0.1, mixing.REST: 0.4, "absent": 3.0}
    rates = mixing.source_rates(docs, w)
    assert rates == pytest.approx({"a": 1.5, "b": 0.3, "": 1.2, "absent": 0.0})
    out = mixing.mix_sources(docs, w)
    got = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    for s, want in (("a", 3000), ("b", 600), (None, 2400)):
        assert abs(got[s] - want) < 5 * want ** 0.5
    again = mixing.mix_sources(docs.repartition(7), w)
    key = lambda df: sorted((r.doc_id, r.copy) for r in df.select("doc_id", "copy").collect())
    assert key(out) == key(again)
    rows = [r.doc_id for r in out.select("doc_id").collect()]
    assert rows != sorted(rows)
    odd = docs_of(odd_rows)
    kept = mixing.mix_sources(odd, budget=200.0)
    assert set(kept.columns) == set(odd.columns) and kept.count() > 100
    assert mixing.mix_sources(odd.limit(0)).count() == 0


def test_poisson_inversion():
    cdf = mixing.poisson_cdf(2.5)
    assert cdf[0] == pytest.approx(0.0820849986) and cdf[-1] == pytest.approx(1.0, abs=1e-12)
    assert all(a < b for a, b in zip(cdf, cdf[1:]))


def test_mixing_high_rates(spark):
    # one "a" and one "b" among 20,000 rows: rates of 10,000 and 800
    docs = spark.range(0, 20_000).selectExpr("id AS doc_id", "CASE id WHEN 7 THEN 'a' WHEN 8 THEN 'b' END AS source", "'t' AS text")
    w = {"a": 0.5, "b": 0.04, mixing.REST: 0.46}
    assert mixing.source_rates(docs, w)["a"] == pytest.approx(10_000)
    out = mixing.mix_sources(docs, w)
    assert dict(out.dtypes)["copy"] == "int"
    n = {r.source: r for r in out.groupBy("source").agg(F.count("copy").alias("n"), F.count_distinct("copy").alias("kinds"),
                                                       F.min("copy").alias("low"), F.max("copy").alias("high")).collect()}
    for s, want in (("a", 10_000), ("b", 800)):
        assert abs(n[s].n - want) < 5 * want ** 0.5
        assert (n[s].low, n[s].high, n[s].kinds) == (1, n[s].n, n[s].n)
    assert abs(n[None].n - 9_200) < 5 * 9_200 ** 0.5
    key = lambda df: sorted((r.doc_id, r.copy) for r in df.select("doc_id", "copy").collect())
    assert key(out) == key(mixing.mix_sources(docs.repartition(7), w))


def test_mixing_high_rates_spread(spark):
    # 300 documents at a rate of 1,000: two draws each, whose sum has the mean and variance of one Poisson number
    docs = spark.range(0, 300_000).selectExpr("id AS doc_id", "if(id < 300, 'a', null) AS source", "'t' AS text")
    out = mixing.mix_sources(docs, {"a": 1.0, mixing.REST: 0.0})
    n = [r["count"] for r in out.groupBy("doc_id").count().collect()]
    mean = sum(n) / len(n)
    assert len(n) == 300 and abs(mean - 1000) < 10
    assert 700 < sum((x - mean) ** 2 for x in n) / len(n) < 1350


def test_mixing_null_and_repeated_ids(spark):
    # a third of the rows without an id, a third under one id, each of 500 texts twice
    docs = spark.range(0, 3000).selectExpr("CASE WHEN id < 1000 THEN null WHEN id < 2000 THEN 5L ELSE id END AS doc_id",
                                           "string(null) AS source", "concat('t', id % 500) AS text")
    out = mixing.mix_sources(docs, {mixing.REST: 1.0})
    assert out.columns == [*docs.columns, "copy", "shuffle_key"]
    rows = out.collect()
    for has in (lambda r: r.doc_id is None, lambda r: r.doc_id == 5, lambda r: (r.doc_id or 0) >= 2000):
        assert abs(sum(map(has, rows)) - 1000) < 5 * 2000 ** 0.5
    for i in (None, 5):
        n = {}
        for r in rows:
            if r.doc_id == i:
                n[r.text] = n.get(r.text, 0) + 1
        assert 250 < len(n) < 380 and all(k % 2 == 0 for k in n.values()) and len(set(n.values())) > 2
        keys = {(r.text, r.copy): r.shuffle_key for r in rows if r.doc_id == i}
        assert len(set(keys.values())) == len(keys)
    again = mixing.mix_sources(docs.repartition(7), {mixing.REST: 1.0}).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
