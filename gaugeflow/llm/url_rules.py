"""URL filters by association rules, in DataFrame and Spark ML operations only.

Spark's FP-growth mines combinations of URL tokens together with the label
token of labelled pages. Rules "token combination -> bad" above a confidence
bound and a number of bad pages are kept unless a sub-combination is at least as confident.
They are matched by an inverted index: a rule is listed under its rarest token
only, joined with the tokens of each URL, and then compared as a whole.
A fixed list of host and path rules goes before the mined ones.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import stage

# Fixed by the task: verdict and host/path rule.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
BAD = "label=bad"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end,
    A-Z in lower case; empty for null or without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, _SPLIT, 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _SPLIT, 2), F.lit(""))


def listed_rule(host_col: Column, path_col: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest listed rule that fits, or null."""
    out = F.lit(None)
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host_col == name) | host_col.endswith("." + name)) & path_col.startswith("/" + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def url_tokens(url: Column, host_col: Column, path_col: Column) -> Column:
    """Distinct tokens of a URL, in lower case: scheme, host, every parent
    domain, path words (numbers as one token), query keys, and query keys with
    their value unless it is empty or a number."""
    def tagged(parts, tag):
        return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(tag), x))

    labels = F.split(host_col, r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(
        F.lit("domain="), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    words = F.transform(F.split(F.lower(path_col), r"[^\p{L}\p{N}]+"),
                        lambda x: F.when(x.rlike(r"^[0-9]+$"), F.lit("#")).otherwise(x))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    pairs = F.split(F.lower(query), "&")
    keys = F.transform(pairs, lambda x: F.split_part(x, F.lit("="), F.lit(1)))
    values = F.filter(pairs, lambda x: x.rlike("^[^=]*=.") & ~x.rlike("^[^=]*=[0-9]+$"))
    scheme = F.split_part(F.coalesce(url, F.lit("")), F.lit("://"), F.lit(1))
    return F.array_distinct(F.concat(
        F.when(host_col != "", F.array(F.concat(F.lit("scheme="), F.lower(scheme)))).otherwise(F.array().cast("array<string>")),
        F.when(host_col != "", parents).otherwise(F.array().cast("array<string>")),
        tagged(words, "path="), tagged(keys, "key="), tagged(values, "value=")))


def mine_rules(tokens: DataFrame, labels: DataFrame, min_support: float = 0.0,
               min_confidence: float = 0.5, min_pages: int = 10) -> DataFrame:
    """(rule_id, items, confidence, support) of token combinations that go with
    bad pages: ``tokens`` (page_id, items) labelled by ``labels`` (doc_id,
    quality, toxic) of the same id; bad means toxic or not of good quality.
    Rows with a null id, or with both labels null, teach nothing. Rules with a
    combination of one token less and at least their confidence are dropped. Without labelled
    pages there are no rules. A rule needs ``min_pages`` bad pages, at any size of
    the table (and a share ``min_support`` of the labelled pages, if given).

    Combinations that cannot be in the result are not mined: those with a token
    of too few bad pages, with one of bad pages only or of all pages (such a
    token is a rule alone or adds nothing), and with two tokens that always
    occur together (one of them is mined, the rules of the others follow).
    """
    bad = (F.coalesce("toxic", F.lit(0)) == 1) | (F.coalesce("quality", F.lit(1)) == 0)
    marks = (labels.filter("doc_id is not null and (toxic is not null or quality is not null)")
             .groupBy(F.col("doc_id").alias("page_id")).agg(F.max(bad.cast("int")).alias("bad")))
    baskets = stage(tokens.filter(F.size("items") > 0).join(marks, "page_id")
                    .select(F.monotonically_increasing_id().alias("basket"), "bad", "items"), "url-baskets")
    n = baskets.count()
    if n < min_pages:
        return tokens.sparkSession.createDataFrame([], "rule_id long, items array<string>, confidence double, support double")
    least = max(min_pages, math.ceil(min_support * n))
    listed = baskets.select("basket", "bad", F.explode("items").alias("token"))
    known = stage(listed.groupBy("token").agg(
        F.count("*").alias("pages"), F.sum("bad").alias("bad_pages"),
        F.bit_xor(F.xxhash64("basket")).alias("mark"), F.bit_xor(F.xxhash64("basket", F.lit(1))).alias("mark2"))
        .filter(F.col("bad_pages") >= least)
        .withColumn("alone", (F.col("bad_pages") == F.col("pages")) | (F.col("pages") == n)), "url-tokens")
    # tokens of the same pages: the first one stands for all
    classes = stage(known.filter("not alone").groupBy("pages", "mark", "mark2")
                    .agg(F.min("token").alias("token"), F.collect_list("token").alias("members"))
                    .select("token", "members"), "url-classes")
    mined = stage(listed.join(classes, "token").groupBy("basket", "bad").agg(F.collect_list("token").alias("items"))
                  .select(F.when(F.col("bad") == 1, F.concat("items", F.array(F.lit(BAD)))).otherwise(F.col("items"))
                          .alias("items")), "url-mined-baskets")
    m = mined.count()
    measured = known.filter("alone").select(F.array("token").alias("items"), "pages", "bad_pages")
    if m >= least:
        model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / m, minConfidence=min_confidence).fit(mined)
        sets = stage(model.freqItemsets.select(F.array_sort("items").alias("items"), "freq"), "url-itemsets")
        with_bad = (sets.filter(F.array_contains("items", BAD) & (F.size("items") > 1))
                    .select(F.array_remove("items", BAD).alias("items"), F.col("freq").alias("bad_pages")))
        measured = measured.unionByName(with_bad.join(sets.withColumnRenamed("freq", "pages"), "items"))
    found = stage(measured.withColumn("confidence", F.col("bad_pages") / F.col("pages"))
                  .filter(F.col("confidence") >= min_confidence)
                  .select("items", "confidence", (F.col("bad_pages") / F.lit(n)).alias("support")), "url-rules")
    # the combination without one of its tokens, looked up among the rules by equality
    drop_one = (found.filter(F.size("items") > 1)
                .select("items", "confidence", F.explode("items").alias("__out"))
                .select("items", "confidence", F.filter("items", lambda x: x != F.col("__out")).alias("__sub")))
    weaker = (drop_one.join(found.select(F.col("items").alias("__sub"), F.col("confidence").alias("__c")), "__sub")
              .filter("__c >= confidence").select("items").distinct())
    kept = found.join(weaker, "items", "left_anti")
    members = (kept.select("items", "confidence", "support", F.explode("items").alias("token")).join(classes, "token", "left")
               .groupBy("items", "confidence", "support")
               .agg(F.collect_list(F.coalesce("members", F.array("token"))).alias("members")))
    every = F.aggregate("members", F.array(F.array().cast("array<string>")), lambda done, more: F.flatten(
        F.transform(done, lambda x: F.transform(more, lambda y: F.concat(x, F.array(y))))))
    return (members.select(F.explode(every).alias("items"), "confidence", "support")
            .withColumn("items", F.array_sort("items"))
            .select(F.xxhash64("items").alias("rule_id"), "items", "confidence", "support"))


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, min_support: float = 0.0,
          min_confidence: float = 0.5) -> DataFrame:
    """(page_id, host, path, rule, verdict, mined_rules) for each row of
    ``pages`` (page_id, url): the longest fitting listed rule decides; else a
    URL that matches a mined rule is blocked and any other allowed.

    A null url has an empty host and path and no tokens: allowed. Repeated
    rows and ids give a row each; other columns are ignored.
    """
    url = F.col("url")
    base = (pages.select("page_id", "url").withColumn("host", host(url)).withColumn("path", path(url))
            .withColumn("items", url_tokens(url, F.col("host"), F.col("path"))))
    mined = stage(mine_rules(base.select("page_id", "items"), labels, min_support, min_confidence), "url-mined")
    # URLs are judged once per distinct token set, which folds hot hosts
    sets = stage(base.select("items").distinct().withColumn("set_id", F.xxhash64("items")), "url-sets")
    listed = sets.select("set_id", "items", F.explode("items").alias("token"))
    spread = listed.groupBy("token").agg(F.count("*").alias("__df"))
    terms = mined.select("rule_id", F.col("items").alias("rule_items"), F.explode("items").alias("token"))
    index = (terms.join(spread, "token")
             .groupBy("rule_id", "rule_items").agg(F.min_by("token", F.struct("__df", "token")).alias("token")))
    hits = (listed.join(stage(index, "url-index"), "token")
            .filter(F.size(F.array_except("rule_items", "items")) == 0)
            .groupBy("items").agg(F.count("*").alias("mined_rules")))
    judged = base.join(stage(hits, "url-hits"), "items", "left")
    rule = listed_rule(F.col("host"), F.col("path"), rules)
    return (judged.withColumn("__rule", rule)
            .select("page_id", "host", "path", F.col("__rule.rule").alias("rule"),
                    F.coalesce(F.col("__rule.verdict"), F.when(F.col("mined_rules") > 0, F.lit("block"))
                               .otherwise(F.lit("allow"))).alias("verdict"),
                    F.coalesce("mined_rules", F.lit(0)).alias("mined_rules")))
