"""URL filter: token combinations mined by FP-growth from labels, matched by an inverted index, under a list of given rules."""

import math
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tripmill.llm._common import key_bitmaps, materialised, tasks_for, with_bit

#: The item that stands for a bad label.
BAD = "label=bad"

#: A combination must be in this share of the labelled pages, as a bad one, and in so many bad pages at least: a handful proves nothing.
MIN_SUPPORT = 0.002
MIN_PAGES = 10

#: Of the labelled pages that a combination is in, this share must be bad.
MIN_CONFIDENCE = 0.6

#: Rows of one key are spread over so many tasks where they meet what was found for it.
SALTS = 8

#: The file type at the end of a path.
_TYPE = r"\.(\w+)$"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/ ? #`` or the end, A-Z in lower case; empty without ``://`` or for null."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``? #`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def tokens_of(url: Column) -> Column:
    """The different tokens of a URL, one for each fact: scheme, host labels by their place from the right, path segments, file type, names of parameters, fragment.

    ``host1=com`` and ``host2=b`` together stand for the domain ``b.com``. No token follows from another, so combinations that are mined do not
    say the same thing twice. Segments that are numbers are one token, and the file type is not part of its segment. A null or empty URL has none.
    """
    text = F.coalesce(url, F.lit(""))
    host, path = host_of(url), path_of(url)
    labels = F.transform(
        F.reverse(F.filter(F.split(host, r"\."), lambda x: x != "")),
        lambda x, i: F.concat(F.lit("host"), (i + 1).cast("string"), F.lit("="), x),
    )
    segments = F.filter(F.split(F.regexp_replace(path, _TYPE, ""), "/"), lambda x: x != "")
    named = F.transform(segments, lambda s: F.when(s.rlike(r"^[0-9]+$"), F.lit("#")).otherwise(F.lower(s)))
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    names = F.filter(F.transform(F.split(query, "&"), lambda p: F.regexp_extract(p, r"^[^=]*", 0)), lambda x: x != "")
    kinds = [
        ("scheme", F.filter(F.array(F.lower(F.regexp_extract(text, r"^(\w+)://", 1))), lambda x: x != "")),
        ("path", named),
        ("type", F.filter(F.array(F.lower(F.regexp_extract(path, _TYPE, 1))), lambda x: x != "")),
        ("parameter", names),
        ("fragment", F.filter(F.array(F.regexp_extract(text, r"#(.*)$", 1)), lambda x: x != "")),
    ]
    return F.array_distinct(F.concat(labels, *[_prefixed(kind, values) for kind, values in kinds]))


def _prefixed(kind: str, values: Column) -> Column:
    return F.transform(values, lambda x: F.concat(F.lit(f"{kind}="), x))


def mine_rules(
    pages: DataFrame,
    labels: DataFrame,
    *,
    min_support: float = MIN_SUPPORT,
    min_pages: int = MIN_PAGES,
    min_confidence: float = MIN_CONFIDENCE,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """Rules ``tokens, confidence, support``: combinations of URL tokens whose pages are mostly labelled bad.

    ``labels`` has ``id_col`` and ``bad`` (boolean); a page labelled twice is bad if any label says so. All labelled pages are transactions, their tokens and the label the items.
    A combination of any length is a rule if at least ``min_pages`` bad pages, and a share of ``min_support`` of all labelled ones, have it and are bad, if ``min_confidence``
    of its pages are bad, and no part of it is a rule at least as confident. Of tokens that occur in just the same
    labelled pages only the first in the alphabet is mined: the others would double the combinations and add no rule that stays.
    Without labelled pages, or enough bad ones among them, there are no rules. Pages without id or URL teach nothing.
    """
    spark = pages.sparkSession
    known = labels.where(F.col(id_col).isNotNull() & F.col("bad").isNotNull()).groupBy(id_col).agg(F.max("bad").alias("bad"))
    known = known.withColumnRenamed(id_col, "_id")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url")).where("url is not null")
    taught = materialised(
        rows.join(known, F.col("id") == F.col("_id"))
        .select(F.monotonically_increasing_id().alias("page"), "bad", tokens_of(F.col("url")).alias("tokens"))
        .where(F.size("tokens") > 0),
        "labelled",
    )
    n_pages = taught.count()
    least = max(min_pages, math.ceil(min_support * n_pages), 1)
    each = taught.select("page", "bad", F.explode("tokens").alias("token"))
    # Sums of hashes tell sets of pages apart. A token of a rule is in `least` pages, so there are at most as many of
    # them as tokens in 1 / min_support pages: few enough to broadcast, at any size of the tables.
    same_pages = F.sum(F.xxhash64("page").cast("decimal(20,0)")).alias("pages")
    tokens = (
        each.groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("n_bad"), same_pages)
        .where(F.col("n_bad") >= least)
        .groupBy("n", "pages")
        .agg(F.min("token").alias("token"))
        .select("token")
    )
    items = F.collect_list("token")
    transactions = materialised(
        each.join(F.broadcast(tokens), "token")
        .groupBy("page", "bad")
        .agg(items.alias("items"))
        .select(F.when(F.col("bad"), F.array_append("items", F.lit(BAD))).otherwise(F.col("items")).alias("items")),
        "transactions",
    )
    n_mined = transactions.count()
    if not n_mined:
        return spark.createDataFrame([], "tokens array<string>, confidence double, support double")
    # Half a page less, so that rounding cannot ask for one page more.
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n_mined, numPartitions=tasks_for(spark)).fit(transactions)
    sets = materialised(model.freqItemsets, "itemsets")
    bad = sets.where(F.array_contains("items", BAD)).select(F.array_sort(F.array_remove("items", BAD)).alias("tokens"), F.col("freq").alias("n_bad"))
    alone = sets.where(~F.array_contains("items", BAD)).select(F.array_sort("items").alias("tokens"), "freq")
    found = materialised(
        alone.join(bad, "tokens")
        .select("tokens", (F.col("n_bad") / F.col("freq")).alias("confidence"), (F.col("n_bad") / n_pages).alias("support"))
        .where(F.col("confidence") >= min_confidence),
        "rules",
    )
    # A part of a combination has its first token in common with the combination's tokens: they meet by token, not all with all.
    short = found.select(
        F.col("tokens").alias("part"), F.col("confidence").alias("part_confidence"), F.col("tokens")[0].alias("token")
    )
    contained = (F.size(F.array_except("part", "tokens")) == 0) & (F.size("part") < F.size("tokens"))
    redundant = (
        found.select("tokens", "confidence", F.explode("tokens").alias("token"))
        .join(short, "token")
        .where(contained & (F.col("part_confidence") >= F.col("confidence")))
        .select("tokens")
        .distinct()
    )
    return found.join(redundant, "tokens", "left_anti")


def _with_salt(found: DataFrame) -> DataFrame:
    return found.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _salt_of(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(SALTS)).cast("int")


def matching_urls(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The different URLs that have all tokens of a rule: ``url``, once.

    Of a URL's tokens only those that rules have are kept, by a bitmap of fixed size, and URLs that are left with the same tokens are judged once. The index
    leads from a token to the rules of which it is the rarest, so a token that nearly all URLs have leads to few; only the
    rules found there are compared whole. A rule without tokens fits nothing.
    """
    bits = key_bitmaps(rules.select(F.explode("tokens").alias("token")), ["token"])
    each = urls.select("url").where("url is not null").distinct().select("url", F.explode(tokens_of(F.col("url"))).alias("token"))
    each = with_bit(each, bits, ["token"], "_of_rule").where("_of_rule")
    has = materialised(each.groupBy("url").agg(F.array_sort(F.collect_list("token")).alias("has")), "url-tokens")
    kinds = materialised(has.groupBy("has").agg(F.count(F.lit(1)).alias("n")), "token-sets")
    frequent = kinds.select("n", F.explode("has").alias("token")).groupBy("token").agg(F.sum("n").alias("n"))
    rarest = W.partitionBy("tokens").orderBy("n", "token")
    index = (
        rules.select("tokens", F.explode("tokens").alias("token"))
        .join(frequent, "token")
        .withColumn("_rank", F.row_number().over(rarest))
        .where("_rank = 1")
        .select("token", "tokens")
    )
    fits = (
        kinds.select("has", F.explode("has").alias("token"))
        .join(index, "token")
        .where(F.size(F.array_except("tokens", "has")) == 0)
        .select("has")
        .distinct()
    )
    return has.withColumn("_salt", _salt_of("url")).join(_with_salt(fits), ["has", "_salt"]).select("url")


def listed(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits, as a struct (rule, verdict), or null. A rule is a host and the beginning of a path, in one text.

    It fits its host and all subdomains. Of rules of one length the one that comes first in the alphabet wins.
    """
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1]))[::-1]:
        name, slash, rest = rule.partition("/")
        here = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(slash + rest))
        best = F.when(here, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(best)
    return best


def judge_urls(
    pages: DataFrame,
    mined: DataFrame,
    rules: Sequence[tuple[str, str]] = (),
    *,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """One row per page: ``id_col, host, path, rule, verdict``.

    A given rule decides where one fits, the longest first; otherwise a URL that matches a mined rule is blocked, and any other allowed. Equal URLs are
    looked up once. A null URL, or one without ``://``, has an empty host and path, and no given rule fits it. Null and repeated ids are rows like any other. Other columns
    are not looked at.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    hit = matching_urls(rows, mined).withColumnRenamed("url", "_url")
    # Rows of a URL that a third of all pages have are spread by their ids. Null URLs get keys of their own.
    own = F.coalesce("url", F.concat(F.lit("\0"), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    joined = rows.withColumn("_own", _salt_of("id")).join(_with_salt(hit), (own == F.col("_url")) & (F.col("_own") == F.col("_salt")), "left")
    named = joined.select(
        "id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.col("_url").isNotNull().alias("hit")
    ).withColumn("given", listed(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce(F.col("given.verdict"), F.when(F.col("hit"), F.lit("block")).otherwise(F.lit("allow")))
    return named.select(
        F.col("id").alias(id_col), "host", "path", F.col("given.rule").alias("rule"), verdict.alias("verdict")
    )
