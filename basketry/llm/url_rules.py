"""URL filtering: given host and path rules, and association rules mined from labelled URLs.

FP-growth finds the token combinations of labelled URLs that go with a label; those with enough support
and confidence become rules. A URL's verdict is that of the longest given rule that fits it, else that of
the surest mined rule whose tokens it has, else ``allow``. Mined rules are found through an inverted index:
each stands under its rarest token, and only URLs with that token are tested for the others.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.tables import columns, cut

#: (verdict, host, path)
GIVEN = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: A rule needs so many labelled URLs, however many there are, and this share of them with its label.
LEAST_ROWS, CONFIDENCE = 20, 0.8
LABEL = "label="


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-case host and path; both empty where the URL is NULL or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), upper, lower)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def given_rule(host: Column, path: Column, rules=GIVEN) -> tuple[Column, Column]:
    """The longest rule that fits (as ``host/path``) and its verdict; NULL where none does."""
    rule = verdict = F.lit(None).cast("string")
    for decision, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        at_host = (host == rule_host) | F.endswith(host, F.lit(f".{rule_host}"))
        fits = at_host & F.startswith(path, F.lit(rule_path))
        rule = F.when(fits, rule_host + rule_path).otherwise(rule)
        verdict = F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def tokens(url: Column) -> Column:
    """The distinct tokens of a URL: labels of the host, words of the path in any script, and query keys.

    A path is decoded first where its percent signs allow that.
    """
    host, path = host_and_path(url)
    path = F.coalesce(F.try_url_decode(path), path)
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    words = F.filter(F.split(F.lower(path), r"[^\p{L}\p{M}\p{N}]+"), lambda x: x != "")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    keys = F.filter(F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1)), lambda x: x != "")
    made = F.concat(
        F.transform(labels, lambda x: F.concat(F.lit("host:"), x)),
        F.transform(words, lambda x: F.concat(F.lit("path:"), x)),
        F.transform(keys, lambda x: F.concat(F.lit("query:"), x)),
    )
    return F.array_distinct(F.coalesce(made, F.array().cast("array<string>")))


def mine(labelled: DataFrame, url: str = "url", label: str = "label", least: int = LEAST_ROWS, confidence: float = CONFIDENCE) -> DataFrame:
    """Rules (tokens, label, confidence, support, token): ``token`` is the rarest of ``tokens``.

    A rule counts from ``least`` URLs with its tokens and its label on, at any size of the table. Rows with a NULL url or label are left out; no rows give no rules. A rule that holds all tokens of
    a surer or equally sure rule for the label is pruned.
    """
    rows = columns(labelled, url=url, label=label).where("url is not null and label is not null")
    label_item = F.concat(F.lit(LABEL), F.col("label").cast("string"))
    baskets = cut(rows.select(F.array_append(tokens(F.col("url")), label_item).alias("items")), "baskets")
    # A little less, so that rounding loses no rule with just as many rows.
    support = min(1.0, (least - 0.5) / max(1, baskets.count()))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    found = cut(
        model.associationRules.where(F.startswith(F.col("consequent")[0], F.lit(LABEL)))
        .where(~F.exists("antecedent", lambda x: F.startswith(x, F.lit(LABEL))))
        .select(
            F.array_sort("antecedent").alias("tokens"),
            F.substring(F.col("consequent")[0], len(LABEL) + 1, 1 << 20).alias("label"),
            "confidence",
            "support",
        ),
        "rules",
    )
    # A rule is tested only against the rules that its own subsets can be: those under its tokens.
    shorter = found.select(
        F.explode("tokens").alias("token"), F.col("tokens").alias("part"),
        F.col("label").alias("part_label"), F.col("confidence").alias("part_confidence"),
    ).where(F.col("token") == F.col("part")[0])
    longer = found.withColumn("token", F.explode("tokens"))
    idle = longer.join(shorter, "token").where(
        (F.col("label") == F.col("part_label"))
        & (F.col("part_confidence") >= F.col("confidence"))
        & (F.size("part") < F.size("tokens"))
        & (F.size(F.array_except("part", "tokens")) == 0)
    )
    kept = found.join(idle.select("tokens", "label").distinct(), ["tokens", "label"], "left_anti")
    counts = baskets.select(F.explode("items").alias("token")).groupBy("token").count()
    rare = kept.withColumn("token", F.explode("tokens")).join(counts, "token")
    return rare.groupBy("tokens", "label", "confidence", "support").agg(
        F.min(F.struct("count", "token")).getField("token").alias("token")
    )


def judge(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", given=GIVEN) -> DataFrame:
    """One row per row of ``pages``: page_id, url, host, path, rule, verdict, mined_tokens, confidence.

    ``mined_tokens`` are those of the mined rule that decided; ties in confidence go to the greater support,
    then to the smallest tokens. A URL that no rule fits is allowed.
    """
    rows = columns(pages, page_id=page_id, url=url)
    rules = cut(rules, "mined")
    host, path = host_and_path(F.col("url"))
    placed = rows.withColumn("host", host).withColumn("path", path)
    rule, verdict = given_rule(F.col("host"), F.col("path"), given)
    placed = placed.withColumn("rule", rule).withColumn("given", verdict)
    # The method decides by the text of a URL alone, so each different open URL is looked up once.
    open_urls = placed.where("rule is null and url is not null").select("url").distinct()
    tokens_of = open_urls.withColumn("own", tokens(F.col("url")))
    hits = tokens_of.withColumn("token", F.explode("own")).join(rules, "token")
    fitting = hits.where(F.size(F.array_except("tokens", "own")) == 0)
    best = fitting.groupBy("url").agg(
        F.min(F.struct((-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"), "tokens", "label")).alias("best")
    )
    return placed.join(cut(best, "best"), "url", "left").select(
        "page_id", "url", "host", "path", "rule",
        F.coalesce("given", "best.label", F.lit("allow")).alias("verdict"),
        F.when(F.col("rule").isNull(), F.col("best.tokens")).alias("mined_tokens"),
        F.when(F.col("rule").isNull(), -F.col("best.c")).alias("confidence"),
    )
