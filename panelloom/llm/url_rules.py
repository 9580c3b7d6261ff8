"""URL filters: given host and path rules, and rules mined from the URLs that they label.

The given rules decide what they fit. URLs so labelled are baskets of tokens
with a verdict; FP-growth mines frequent token combinations, and those whose
verdict is confident enough become association rules. Tokens that occur in
the same URLs only are one item: the combinations of a long URL that is
repeated are then few, and every combination that counting would find has the
support and confidence of the one mined. A URL that no given rule fits is
judged by the best mined rule of which it has some token of every item: an
inverted index names each rule under its rarest item, so a URL meets only
rules that one of its tokens leads to, and the other items are then checked.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.llm.registry import query, table
from panelloom.llm.shared import written

# Verdict, host and path of the rules of the query.
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
LEARN_FROM = 200_000  # labelled URLs in the fit, at most in expectation; the bound of the fit
SUPPORT, CONFIDENCE = 0.01, 0.8
LONGEST = 3  # items of a mined rule, where `mine` is given no other bound
DEFAULT = "allow"  # where no rule, given or mined, fits
_BLOCK, _ALLOW = "=block", "=allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host, A-Z lowered, and path of a URL; both empty where there is no "://"."""
    url = F.coalesce(F.col(url), F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    beyond = F.substr(rest, F.length(host) + 1)
    return F.translate(host, _UPPER, _LOWER), F.regexp_extract(beyond, r"^[^?#]*", 0)


def tokens_of(host: Column, path: Column) -> Column:
    """What may stand in a mined rule: host labels by place from the right, path steps by place, the last step's ending."""
    labels = F.reverse(F.filter(F.split(host, r"\."), lambda x: x != ""))
    steps = F.filter(F.split(path, "/"), lambda x: x != "")
    named = F.concat(
        F.transform(labels, lambda x, i: F.concat(F.lit("h"), i.cast("string"), F.lit(":"), x)),
        F.transform(steps, lambda x, i: F.concat(F.lit("p"), i.cast("string"), F.lit(":"), F.regexp_replace(x, r"\d+", "#"))),
        F.transform(
            F.filter(F.array(F.regexp_extract(path, r"\.(\w+)$", 1)), lambda x: x != ""), lambda x: F.concat(F.lit("e:"), x)
        ),
    )
    return F.array_distinct(named)


def given_verdict(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest given rule that fits; its host covers all subdomains."""
    rule = verdict = F.lit(None).cast("string")
    for what, name, start in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r)):
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(start))
        rule, verdict = F.when(fits, name + start).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def folded(baskets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tokens, items) for each distinct ``tokens`` of ``baskets``, and (item, members) of the items.

    Tokens are one item where the sets that hold them are the same; that is
    told from the number of those sets and two 64-bit checksums of them. An
    item bears the name of its first member. Its members stand in one URL, so
    they are no more than a URL has tokens.
    """
    sets = baskets.select("tokens").distinct().withColumns({"a": F.xxhash64("tokens"), "b": F.xxhash64(F.lit(10), "tokens")})
    held = sets.select("a", "tokens", F.explode("tokens").alias("token"), "b")
    marks = held.groupBy("token").agg(F.count("*").alias("n"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    members = F.array_sort(F.collect_list("token"))
    items = written(marks.groupBy("n", "a", "b").agg(members.alias("members")).select(F.col("members")[0].alias("item"), "members"), "items")
    named = held.select("tokens", F.col("token").alias("item")).join(items.select("item"), "item", "left_semi")
    return named.groupBy("tokens").agg(F.collect_list("item").alias("items")), items


def mine(labelled: DataFrame, learn_from: int = LEARN_FROM, longest: int | None = LONGEST) -> DataFrame:
    """(rule_id, items, members, verdict, confidence, support) from ``labelled`` (tokens, verdict, spot).

    ``spot`` is a hash of the row by which about ``learn_from`` rows are taken.
    ``members`` has the tokens of each of ``items``; any of them will do. Rules
    have at most ``longest`` items; None leaves them to support and confidence
    alone.
    """
    share = learn_from / max(labelled.count(), 1)
    taken = labelled.where(F.pmod("spot", F.lit(1_000_000)) / 1_000_000 < share).select("tokens", "verdict")
    sets, items = folded(taken)
    label = F.when(F.col("verdict") == "block", _BLOCK).otherwise(_ALLOW)
    none = F.array().cast("array<string>")
    baskets = taken.join(sets, "tokens", "left").select(F.array_append(F.coalesce("items", none), label).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=SUPPORT, minConfidence=CONFIDENCE).fit(baskets)
    labels = F.array(F.lit(_BLOCK), F.lit(_ALLOW))
    found = model.freqItemsets if longest is None else model.freqItemsets.where(F.size("items") <= longest + 1)
    found = written(found, "itemsets")
    bare = found.where(~F.arrays_overlap("items", labels)).select(F.array_sort("items").alias("items"), F.col("freq").alias("all"))
    with_label = found.where(F.arrays_overlap("items", labels)).select(
        F.array_sort(F.array_except("items", labels)).alias("items"),
        F.when(F.array_contains("items", _BLOCK), "block").otherwise("allow").alias("verdict"),
        "freq",
    )
    rules = with_label.where(F.size("items") > 0).join(bare, "items")
    rules = rules.select("items", "verdict", (F.col("freq") / F.col("all")).alias("confidence"), F.col("freq").alias("support"))
    rules = rules.where(F.col("confidence") >= CONFIDENCE).withColumn("rule_id", F.concat_ws(" ", "items"))
    each = rules.select("rule_id", "verdict", F.explode("items").alias("item")).join(items, "item")
    each = each.groupBy("rule_id", "verdict").agg(F.collect_list("members").alias("members"))
    return rules.join(each, ["rule_id", "verdict"])


def indexed(rules: DataFrame) -> DataFrame:
    """``rules`` with ``token``: a row for each token of the item that is the rarest of a rule's among all rules."""
    uses = rules.select("rule_id", F.explode("items").alias("item"))
    often = uses.groupBy("item").agg(F.count("*").alias("n"))
    rarest = uses.join(often, "item").groupBy("rule_id").agg(F.min(F.struct("n", "item"))["item"].alias("item"))
    led = F.filter("members", lambda m: F.array_contains(m, F.col("item")))[0]
    return rules.join(rarest, "rule_id").withColumn("token", F.explode(led)).drop("item")


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """(page_id, url, host, path, rule, verdict, mined_rule) for every row of ``pages`` (page_id, url).

    ``rule`` is the longest given rule that fits, else null; ``verdict`` is
    that rule's, else that of the mined rule of highest confidence, then
    support, then most tokens, else ``allow``; ``mined_rule`` names the tokens
    by which it fits. A null URL or one without
    "://" has empty host and path and no tokens. Rows are judged by their URL
    alone, so repeated rows and rows without page_id are judged like others.
    Further columns are ignored. ``rules`` is a parameter, some hundred at most.
    """
    host, path = host_and_path("url")
    parts = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = given_verdict(F.col("host"), F.col("path"), rules)
    tokens = F.array_sort(tokens_of(F.col("host"), F.col("path")))
    parts = written(parts.withColumns({"rule": rule, "given": verdict, "tokens": tokens}), "urls")
    fitted, open_ = parts.where("given is not null"), parts.where("given is null")
    spot = F.xxhash64("page_id", "url").alias("spot")
    mined = written(mine(fitted.select("tokens", F.col("given").alias("verdict"), spot), longest=None), "rules")
    index = written(indexed(mined), "index")  # with its size known, the engine sends a small one to every task
    # learned once for each distinct set of tokens, however many URLs have it
    met = open_.select("tokens").distinct().select("tokens", F.explode("tokens").alias("token")).join(index, "token")
    met = met.where(F.forall("members", lambda m: F.arrays_overlap(m, F.col("tokens"))))
    by = F.array_sort(F.flatten(F.transform("members", lambda m: F.array_intersect(m, F.col("tokens")))))
    order = F.struct("confidence", "support", F.size(by), F.concat_ws(" ", by).alias("by"), "verdict")
    best = met.groupBy("tokens").agg(F.max(order).alias("best"))
    best = best.select("tokens", F.col("best.verdict").alias("learned"), F.col("best.by").alias("mined_rule"))
    best = written(best, "best")
    same = ["page_id", "url", "host", "path", "rule"]
    learned = open_.join(best, "tokens", "left").select(
        *same, F.coalesce("learned", F.lit(DEFAULT)).alias("verdict"), "mined_rule"
    )
    given = fitted.select(*same, F.col("given").alias("verdict"), F.lit(None).cast("string").alias("mined_rule"))
    return given.unionByName(learned)


@query("op10_association_rule_url_filter")
def op10_association_rule_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages")).select(
        "page_id", "host", "path", "rule", "verdict", "mined_rule"
    )
