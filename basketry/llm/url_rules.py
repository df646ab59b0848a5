"""URL filtering by association rules (operator 3), with DataFrame and SQL functions only.

Given rules judge what they fit. With their verdicts as labels, Spark's FP-growth mines combinations of
URL tokens (host labels, path segments, query keys). A mined rule says that URLs with
all its tokens are allowed, or blocked. Rules are pruned by support and confidence, and where a
part of their tokens says as much with no less confidence. An inverted index of the rules, by their
rarest token, finds those that fit the other URLs; the most confident one decides, or ``default``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.shared import staged

#: Share of the labelled URLs that hold a rule's tokens and its verdict, at least.
SUPPORT = 0.005
CONFIDENCE = 0.9
DEFAULT = "allow"


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("org", "/", "allow"), Rule("example.org", "/es/", "block"), Rule("example.org", "/en/1", "block"),
         Rule("com", "/fr/", "allow"), Rule("com", "/de/", "block"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL; both empty where it is NULL or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), upper, upper.lower())
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """The tokens of a URL, each once, named by where they stand."""
    named = lambda kind, parts: F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.concat(F.lit(kind), p))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^#]*?\?([^#]*)", 1)
    return F.array_distinct(F.concat(
        named("host:", F.split(host, r"\.")), named("path:", F.split(path, "/")),
        named("query:", F.transform(F.split(query, "&"), lambda p: F.regexp_extract(p, "^[^=]*", 0)))))


def _best_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest given rule that fits, as a struct, or NULL; rules are a short list of the caller."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def _kinds(urls: DataFrame, need: float) -> DataFrame:
    """(name, members, n, blocks) of the tokens with support, those held by the same URLs as one kind.

    Sets of URLs are told apart by their sizes and 128 bits of hashes of their members.
    """
    return (
        urls.select("url", "verdict", F.explode("tokens").alias("token"))
        .groupBy("token").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("verdict") == "block").alias("blocks"),
            F.bit_xor(F.xxhash64("url")).alias("one"), F.bit_xor(F.xxhash64("url", F.lit("other"))).alias("other"))
        .filter(F.greatest("blocks", F.col("n") - F.col("blocks")) >= need)
        .groupBy("n", "blocks", "one", "other")
        .agg(F.min("token").alias("name"), F.collect_list("token").alias("members"))
        .select("name", "members", "n", "blocks")
    )


def _frequent_sets(urls: DataFrame, names: DataFrame, support: float) -> DataFrame:
    """(held, verdict, said, n): FP-growth's sets of two names and more, with the verdict they share.

    A transaction is the names of a URL and its verdict, so both counts are of whole URLs.
    """
    tokens = urls.select("url", "verdict", F.explode_outer("tokens").alias("name"))
    transactions = (
        tokens.join(names.withColumn("item", F.concat(F.lit("t"), "name")), "name", "left")
        .groupBy("url", "verdict").agg(F.collect_list("item").alias("items"))
        .select(F.array_append("items", F.concat(F.lit("v"), "verdict")).alias("items"))
    )
    model = FPGrowth(itemsCol="items", minSupport=support).fit(transactions)
    of = lambda mark: F.transform(
        F.filter("items", lambda i: i.startswith(mark)), lambda i: F.substr(i, F.lit(2)))
    found = staged(
        model.freqItemsets.select(F.array_sort(of("t")).alias("held"), F.get(of("v"), 0).alias("verdict"), "freq")
        .filter(F.size("held") > 1), "frequent-sets")
    said = found.filter("verdict is not null").withColumnRenamed("freq", "said")
    return said.join(found.filter("verdict is null").select("held", F.col("freq").alias("n")), "held")


def _every_choice(members: Column) -> Column:
    """All arrays that take one token of each of ``members``."""
    return F.aggregate(
        members, F.array(F.array().cast("array<string>")),
        lambda begun, kind: F.flatten(F.transform(begun, lambda b: F.transform(kind, lambda t: F.array_append(b, t)))))


def mined_rules(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """(antecedent, verdict, confidence, support) from a table (tokens, verdict) of labelled URLs.

    Support, above 0, is the share of the labelled URLs that hold the antecedent and the verdict. All
    counts are of whole URLs. A rule is idle if a part of its tokens has the same verdict with no less
    confidence; idle rules are left out, and no others.

    Three kinds of sets can hold idle rules only and are kept from FP-growth, whose work doubles with each
    token of a URL: those with two tokens that the same URLs hold (one stands for both, and the
    rules are written out for each), with a token that all URLs hold, and with a token of one verdict only.
    """
    total = labelled.count()
    if not total:
        return labelled.select(F.col("tokens").alias("antecedent"), "verdict", F.lit(0.0).alias("confidence"),
                               F.lit(0.0).alias("support")).filter(F.lit(False))
    urls = staged(labelled.select(F.monotonically_increasing_id().alias("url"), "verdict",
                                  F.array_distinct("tokens").alias("tokens")), "labelled")
    kinds = staged(_kinds(urls, support * total), "token-kinds")
    telling = F.col("said") / F.col("n")
    single = (
        kinds.select(F.array("name").alias("held"), "n", F.explode(F.create_map(
            F.lit("allow"), F.col("n") - F.col("blocks"), F.lit("block"), F.col("blocks"))).alias("verdict", "said"))
        .filter(F.col("said") >= support * total)
        .select("held", "verdict", "said", "n", F.lit(0.0).alias("before"), telling.alias("best"))
    )
    mixed = kinds.filter((F.col("blocks") > 0) & (F.col("blocks") < F.col("n")) & (F.col("n") < total)).select("name")
    sets = staged(_frequent_sets(urls, mixed, support), "rule-sets")
    longest = sets.agg(F.max(F.size("held"))).first()[0] or 1
    # The best confidence among the parts of a set is handed on from size to size.
    levels = [single]
    for size in range(2, longest + 1):
        parts = levels[-1].select(F.col("held").alias("part"), "verdict", F.col("best").alias("before"))
        levels.append(staged(
            sets.filter(F.size("held") == size)
            .withColumn("part", F.explode(F.transform("held", lambda t: F.array_remove("held", t))))
            .join(parts, ["part", "verdict"])
            .groupBy("held", "verdict", "said", "n").agg(F.max("before").alias("before"))
            .withColumn("best", F.greatest("before", telling)), f"rules-{size}"))
    rules = staged(
        reduce(DataFrame.unionByName, levels).filter((telling >= confidence) & (telling > F.col("before")))
        .withColumn("id", F.monotonically_increasing_id()), "kept-rules")
    members = (
        rules.select("id", F.explode("held").alias("name")).join(kinds.select("name", "members"), "name")
        .groupBy("id").agg(F.collect_list("members").alias("members"))
    )
    return rules.join(members, "id").select(
        F.explode(_every_choice(F.col("members"))).alias("antecedent"), "verdict", telling.alias("confidence"),
        (F.col("said") / total).alias("support")
    ).withColumn("antecedent", F.array_sort("antecedent"))


def judged(pages: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "page_id", url_col: str = "url",
           default: str = DEFAULT, **mining: float) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, mined (the deciding antecedent, or NULL).

    The longest given rule that fits decides. Otherwise it is the mined rule of the greatest confidence,
    then support, then number of tokens, then ``allow`` before ``block``, then the first tokens by
    name; without any, ``default``. A NULL URL, or one without ``://``, has an empty host and path and
    no tokens. Rows that repeat are judged alike. An empty table gives an empty result.
    """
    host, path = host_and_path(F.col(url_col))
    rows = staged(
        pages.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("page_id"),
                     F.col(url_col).alias("url"), host.alias("host"), path.alias("path"))
        .select("row", "page_id", "host", "path", _best_rule(F.col("host"), F.col("path"), rules).alias("given"),
                url_tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens")), "urls")
    learned = staged(
        mined_rules(rows.filter("given is not null").select("tokens", F.col("given.verdict").alias("verdict")), **mining),
        "rules")
    # The index: a rule stands under the token that fewest of the URLs to judge have.
    open_rows = rows.filter("given is null")
    terms = learned.select(F.explode("antecedent").alias("token")).distinct()
    common = (
        open_rows.select(F.explode("tokens").alias("token")).join(terms, "token").groupBy("token").count()
    )
    listed = learned.withColumn("id", F.monotonically_increasing_id())
    index = staged(
        listed.select("id", F.explode("antecedent").alias("token")).join(common, "token", "left")
        .groupBy("id").agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "token")).alias("least"))
        .join(listed, "id").select(F.col("least.token").alias("token"), "antecedent",
                                   F.struct("confidence", "support", F.size("antecedent").alias("size"),
                                            (F.col("verdict") == "allow").alias("allows")).alias("weight"), "verdict"),
        "rule-index")
    rank = F.struct((-F.col("weight.confidence")).alias("c"), (-F.col("weight.support")).alias("s"),
                    (-F.col("weight.size")).alias("n"), (~F.col("weight.allows")).alias("a"),
                    F.col("antecedent"), F.col("verdict"))
    matched = (
        open_rows.select("row", "tokens", F.explode("tokens").alias("token")).join(index, "token")
        .filter(F.size(F.array_except("antecedent", "tokens")) == 0)
        .groupBy("row").agg(F.min(rank).alias("best"))
    )
    return rows.join(matched, "row", "left").select(
        "page_id", "host", "path", F.col("given.rule").alias("rule"),
        F.coalesce(F.col("given.verdict"), F.col("best.verdict"), F.lit(default)).alias("verdict"),
        F.col("best.antecedent").alias("mined"))
