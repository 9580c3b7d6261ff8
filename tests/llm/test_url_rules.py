from __future__ import annotations

import random

from pyspark.sql import functions as F

from panelloom.llm import registry, url_rules

RULES = url_rules.RULES


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    at = min([rest.index(c) for c in "/?#" if c in rest] + [len(rest)])
    host, rest = rest[:at], rest[at:]
    path = rest[: min([rest.index(c) for c in "?#" if c in rest] + [len(rest)])]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule_of(url):
    host, path = split(url)
    fits = [(len(h + p), v, h + p) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


ODD = [
    None, "", "no scheme", "http://", "://net/", "https://net", "https://net/", "HTTP://A.NET/x", "http://xnet/", "http://example.net/en/1",
    "http://example.net/en", "http://a.example.net/EN/", "http://a.example.com/de/x?y#z", "http://example.com?/de/", "http://org/fr/#/",
    "http://ÉCOLE.ORG/fr/", "a://b://net/", "http://example.net#/en/", "http://net:80/",
]


def judged(spark, urls):
    schema = "page_id long, url string, host string, tokens int, rule int, given int, spot int"
    pages = spark.createDataFrame([(i, u, "q", 1, 2, 3, 4) for i, u in enumerate(urls)], schema)
    return sorted(url_rules.judge_urls(pages).collect(), key=lambda r: r.page_id)


def test_given_rules(spark):
    rnd = random.Random(3)
    hosts = ["a.net", "example.net", "example.com", "m.example.com", "x.org", "example.org"]
    urls = ODD + [f"https://{rnd.choice(hosts)}/{rnd.choice(['en', 'de', 'fr'])}/{rnd.randrange(99)}" for _ in range(300)]
    rows = judged(spark, urls)
    assert len(rows) == len(urls)
    for url, r in zip(urls, rows):
        verdict, rule = rule_of(url)
        assert (r.host, r.path) == split(url) and r.rule == rule and r.url == url
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")


def mined_by_hand(baskets, support, confidence, longest):
    """(items, verdict) -> (confidence, support) by counting every combination."""
    from collections import Counter
    from itertools import combinations

    every, with_verdict = Counter(), Counter()
    for tokens, verdict in baskets:
        for n in range(1, longest + 1):
            for items in combinations(sorted(tokens), n):
                every[items] += 1
                with_verdict[items, verdict] += 1
    least = support * len(baskets)
    return {k: (n / every[k[0]], n) for k, n in with_verdict.items() if n >= least and n / every[k[0]] >= confidence}


def test_mined_rules_against_counting(spark):
    rnd = random.Random(5)
    baskets = []
    for _ in range(400):
        tokens = {f"t{rnd.randrange(7)}" for _ in range(4)}
        baskets.append((sorted(tokens), "block" if "t1" in tokens and rnd.random() < 0.95 else "allow"))
    table = spark.createDataFrame([(t, v, k) for k, (t, v) in enumerate(baskets)], "tokens array<string>, verdict string, spot long")
    rules = url_rules.mine(table)
    got = {(tuple(r["items"]), r["verdict"]): (r["confidence"], r["support"]) for r in rules.collect()}
    assert got == mined_by_hand(baskets, url_rules.SUPPORT, url_rules.CONFIDENCE, url_rules.LONGEST)
    index = url_rules.indexed(rules)
    assert index.count() == rules.count() and index.where(F.array_contains("items", F.col("token"))).count() == rules.count()


def test_learned_verdict_is_the_best_rule(spark):
    urls = [f"http://a{i % 5}.net/shop/{i}" for i in range(60)] + [f"http://b{i % 5}.example.net/en/{i}" for i in range(60)]
    urls += ["http://c.com/shop/7", "http://c.com/en/7", "http://c.com/shop/7", "http://nothing.like", None]
    rows = judged(spark, urls)
    by_url = {r.url: r for r in rows}
    assert by_url["http://c.com/shop/7"].verdict == "block" and "p0:shop" in by_url["http://c.com/shop/7"].mined_rule
    assert by_url["http://c.com/en/7"].verdict == "allow" and by_url["http://nothing.like"].verdict == "allow"
    assert by_url[None].mined_rule is None and [r.verdict for r in rows[-5:-2:2]] == ["block", "block"]


def test_empty_table_and_no_labels(spark):
    assert judged(spark, []) == []
    assert [r.verdict for r in judged(spark, ["http://only.com/x"])] == ["allow"]


def test_query_is_native(spark):
    df = registry.QUERIES["op10_association_rule_url_filter"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().toString()
    assert not [n for n in ("Python", "Arrow", "CartesianProduct", "NestedLoop") if n in plan] and df.count() == 50


def test_rules_of_more_than_three_tokens(spark):
    rules = [("block", "bad.org", "/a/b1/"), ("allow", "bad.org", "/x/b1/"), ("allow", "bad.org", "/a/y/"), ("allow", "good.org", "/a/b1/"), ("allow", "bad.net", "/a/b1/")]
    urls = [f"http://{host}{path}" for verdict, host, path in rules for _ in range(100 if verdict == "block" else 40)]
    pages = spark.createDataFrame(list(enumerate([*urls, "http://bad.org/a/b2/", "http://bad.org/a/c/"])), "page_id long, url string")
    rows = {r.url: r for r in url_rules.judge_urls(pages, rules).collect()}
    found = rows["http://bad.org/a/b2/"]  # only the four tokens together are confident
    assert (found.rule, found.verdict, found.mined_rule) == (None, "block", "h0:org h1:bad p0:a p1:b#")
    assert rows["http://bad.org/a/c/"].verdict == "allow"


def test_a_long_url_that_is_repeated(spark):
    """Sixty steps in half of the rows: one item beside the few that others share, and rules equal to counting."""
    long = "http://far.net/" + "/".join(f"step{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60))
    urls = [long] * 300 + [f"http://a{i % 3}.net/shop/x{i % 2}y/" for i in range(200)] + [f"http://b.example.net/en/{i}" for i in range(100)]
    open_ = ["http://new.com/stepaa/other", "http://new.com/z/stepba", "http://far.com/q", "http://far.com/stepaa/stepba", "http://x.com/shop/xzy"]
    rows = {r.url: r for r in judged(spark, urls + open_)}
    assert rows[long].verdict == "block" and rows["http://x.com/shop/xzy"].verdict == "block"
    # any of the item's tokens leads to its rule, and the rule is named after those that the URL has
    assert [rows[u].mined_rule for u in open_[:4]] == ["p0:stepaa", "p1:stepba", "h1:far", "h1:far p0:stepaa p1:stepba"]
    assert {rows[u].verdict for u in open_[:4]} == {"block"}


def best_by_counting(baskets, tokens, support, confidence):
    """The rule that judges a URL where every combination of its tokens is counted one by one."""
    from itertools import combinations

    best = None
    for n in range(1, len(tokens) + 1):
        for items in combinations(sorted(tokens), n):
            verdicts = [v for t, v in baskets if set(items) <= set(t)]
            for verdict in ("allow", "block"):
                count = verdicts.count(verdict)
                if count and count >= support * len(baskets) and count / len(verdicts) >= confidence:
                    best = max(best or (0,), (count / len(verdicts), count, n, " ".join(items), verdict))
    return best


def test_folded_rules_judge_like_counting(spark):
    rnd = random.Random(11)
    shapes = [("a", "b", "c"), ("a", "b", "c", "d"), ("e", "f"), ("e", "f", "g"), ("h",), ("a", "e"), ("i", "j", "k", "l")]
    baskets = [(rnd.choice(shapes), rnd.choice(["block"] * 9 + ["allow"])) for _ in range(300)]
    baskets += [(("h", "i", "j", "k", "l"), "allow")] * 60
    labelled = spark.createDataFrame([(list(t), v, k) for k, (t, v) in enumerate(baskets)], "tokens array<string>, verdict string, spot long")
    rules = url_rules.mine(labelled, longest=None).collect()
    assert {tuple(m) for r in rules for m in r.members} >= {("b", "c"), ("i", "j", "k", "l")}
    for tokens in [("b",), ("c", "x"), ("b", "c"), ("a", "c", "d"), ("j",), ("h", "l"), ("h", "i", "k"), ("e", "f", "g"), ("f", "a"), ("x",)]:
        fits = [r for r in rules if all(set(m) & set(tokens) for m in r.members)]
        named = [(r.confidence, r.support, sorted(t for m in r.members for t in m if t in tokens), r.verdict) for r in fits]
        found = max(((c, s, len(by), " ".join(by), v) for c, s, by, v in named), default=None)
        assert found == best_by_counting(baskets, tokens, url_rules.SUPPORT, url_rules.CONFIDENCE), tokens
