import random

from pyspark.sql import functions as F

from basketry.llm import url_rules
from basketry.llm.queries import op9_url_rules

SF = "/root/testdata/sf0.01"


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cuts = [rest.find(c) for c in "/?#" if c in rest]
    host, path = (rest[: min(cuts)], rest[min(cuts) :]) if cuts else (rest, "")
    for c in "?#":
        path = path.split(c, 1)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    best = None
    for verdict, rule_host, rule_path in url_rules.GIVEN:
        fits = (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path)
        if fits and (best is None or len(rule_host + rule_path) > len(best[0])):
            best = (rule_host + rule_path, verdict)
    return best


def test_registered_query_by_plain_rules(spark):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = op9_url_rules(spark, SF).collect()
    assert len(got) == len(urls)
    for r in got:
        assert (r.host, r.path) == plain_parts(urls[r.page_id])
        best = plain_rule(r.host, r.path)
        assert r.rule == (best and best[0]) and r.verdict in ("allow", "block")
        assert best is None or r.verdict == best[1]


def test_odd_urls(make):
    urls = [
        None, "", "example.net/en/", "http://", "HTTP://A.Example.NET/en/x?y#z", "x://net", "x://net/", "x://anet/", "x://a.net?/en/",
        "x://example.net/en/a://b/c", "x://ÄB.example.com/de/#", "x://example.com/de", "a b://org/fr/\n\u2028x?", "x://u.org\n/fr/",
    ]
    rows = make("page_id long, url string, host string, rule string", *[(i, u, "clash", "clash") for i, u in enumerate(urls)])
    empty = make("tokens array<string>, label string, confidence double, support double, token string")
    got = {r.page_id: r for r in url_rules.judge(rows, empty).collect()}
    assert len(got) == len(urls)
    for i, url in enumerate(urls):
        host, path = plain_parts(url)
        assert (got[i].host, got[i].path) == (host, path)
        assert (got[i].rule, got[i].verdict) == (plain_rule(host, path) or (None, "allow"))


def plain_mining(baskets, support, confidence):
    """Support and confidence of a few token sets, by counting."""

    def of(tokens, label):
        with_tokens = [own for own, _ in baskets if set(tokens) <= own]
        both = sum(1 for own, l in baskets if set(tokens) <= own and l == label)
        return both / len(baskets), both / len(with_tokens)

    return of


def test_mined_rules_and_their_use(spark):
    draw = random.Random(1)
    rows = []
    for i in range(600):
        host, word = draw.choice(["shop", "news", "spam"]), draw.choice(["a", "pills", "b"])
        bad = host == "spam" and word == "pills" or draw.random() < 0.05
        rows.append((i, f"http://{host}.example.info/{word}/{i}?ref=x", "block" if bad else "allow"))
    pages = spark.createDataFrame(rows, "page_id long, url string, label string")
    rules = url_rules.mine(pages)
    assert rules.count() > 0
    of = plain_mining([({"host:example", "host:info", f"host:{u.split('//')[1].split('.')[0]}", f"path:{u.split('/')[3]}", "query:ref"}, l) for _, u, l in rows], 0, 0)
    for r in rules.collect():
        support, confidence = of(r["tokens"], r["label"])
        assert abs(confidence - r["confidence"]) < 1e-9 and abs(support - r["support"]) < 1e-9
        assert confidence >= url_rules.CONFIDENCE and r["token"] in r["tokens"]
    blocked = {tuple(r["tokens"]) for r in rules.where("label = 'block'").collect()}
    assert blocked == {("host:spam", "path:pills")}
    judged = url_rules.judge(pages, rules).collect()
    for r in judged:
        assert r["verdict"] == ("block" if "spam." in r["url"] and "/pills/" in r["url"] else "allow")


def test_a_host_is_blocked_however_many_others_there_are(spark):
    bad = [(i, f"http://bad.test/x{i}", "block") for i in range(url_rules.LEAST_ROWS)]
    few = [(90 + i, f"http://few.test/y{i}", "block") for i in range(url_rules.LEAST_ROWS - 1)]
    for others in (50, 20_000):
        good = [(1000 + i, f"http://h{i % 7}.test/z{i}", "allow") for i in range(others)]
        pages = spark.createDataFrame(bad + few + good, "page_id long, url string, label string")
        blocked = {tuple(r["tokens"]) for r in url_rules.mine(pages).where("label = 'block'").collect()}
        assert ("host:bad",) in blocked and ("host:few",) not in blocked


def test_words_of_any_script_are_tokens(spark):
    urls = ["http://x.test/казино/Играть-2", "http://x.test/%D0%BA%D0%B0%D0%B7%D0%B8%D0%BD%D0%BE/", "http://x.test/100%/नमस्ते", None]
    rows = spark.createDataFrame([(u,) for u in urls], "url string").select(url_rules.tokens(F.col("url")).alias("t")).collect()
    paths = [[t.removeprefix("path:") for t in r["t"] if t.startswith("path:")] for r in rows]
    assert paths == [["казино", "играть", "2"], ["казино"], ["100", "नमस्ते"], []]


def test_nothing(make):
    labelled = make("url string, label string")
    rules = url_rules.mine(labelled)
    assert rules.count() == 0
    assert url_rules.mine(make("url string, label string", (None, "block"), ("x://a/b", None))).count() == 0
    assert url_rules.judge(make("page_id long, url string"), rules).count() == 0
