"""URL filter lists by hash prefixes.

Every URL becomes the expressions of its host suffixes of a number of labels that some rule has with
its path prefixes of a length that some rule has. Expressions meet the rules in an equi-join on the first bytes of their SHA-256,
the full digest confirms the match, and among a URL's matches the longest rule wins.

The host lies between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, with A-Z in lower
case; the path goes on to ``?``, ``#`` or the end. A rule fits its host and all its subdomains if
the URL's path starts with the rule's. Without a match the verdict is ``default``.

Defined cases: a null URL or one without ``://`` has an empty host and path and matches no rule, as
has an empty host; two rules of one host and path: block wins; repeated rows give one result each;
an empty table gives an empty result, no rules give only defaults. Other columns are carried along.

Distinct URLs are matched, so a URL that a third of all rows hold is expanded once. Expansions are as
many as distinct label counts times distinct path lengths of the rules, however long a URL is; only
their digests meet the rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX_BYTES = 4

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.unhex(F.sha2(F.concat(host, F.lit("\x00"), path), 256))


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url",
               default: str = "allow", prefix_bytes: int = PREFIX_BYTES) -> DataFrame:
    """All columns of ``pages`` with host, path, rule and verdict (replaced where they exist).

    ``rules`` has (host, path, action); an action is ``block`` or ``allow``. A rule without a host
    is ignored, a null path is empty.
    """
    listed = rules.select(
        F.translate(F.col("host"), _UPPER, _UPPER.lower()).alias("rule_host"),
        F.coalesce(F.col("path"), F.lit("")).alias("rule_path"), F.col("action"),
    ).filter("rule_host <> ''")
    listed = listed.groupBy("rule_host", "rule_path").agg(F.max("action").alias("action"))
    digest = _digest(F.col("rule_host"), F.col("rule_path"))
    listed = listed.select("*", digest.alias("digest"))
    # two small lists: no more numbers than a rule path has characters and a rule host labels
    lengths, depths = listed.agg(F.collect_set(F.char_length("rule_path")),
                                 F.collect_set(F.size(F.split("rule_host", r"\.")))).first()

    url = F.col("url")
    urls = pages.select(F.col(url_col).alias("url")).filter("url IS NOT NULL").distinct()
    labels = F.split("host", r"\.")
    held = F.filter(F.array(*map(F.lit, sorted(depths))).cast("array<int>"), lambda k: k <= F.size(labels))
    suffixes = F.transform(
        held, lambda k: F.concat_ws(".", F.slice(labels, F.size(labels) - k + 1, k)))
    parts = urls.select("url", host_of(url).alias("host"), path_of(url).alias("path")).filter(
        "host <> ''")
    known = F.array(*map(F.lit, sorted(lengths))).cast("array<int>")
    fitting = F.filter(known, lambda n: n <= F.char_length("path"))
    expressions = (
        parts.select("url", "path", fitting.alias("fits"), F.explode(suffixes).alias("suffix"))
        .select("url", "suffix", F.explode("fits").alias("n"), "path")
        .select("url", _digest(F.col("suffix"), F.substring("path", F.lit(1), F.col("n")))
                .alias("its_digest"))
    )

    def short(d: str) -> Column:
        return F.substring(d, 1, prefix_bytes)

    matched = expressions.select("*", short("its_digest").alias("prefix")).join(
        listed.select("*", short("digest").alias("prefix")), "prefix"
    ).filter(F.col("digest") == F.col("its_digest"))
    rule = F.concat("rule_host", "rule_path")
    best = matched.groupBy("url").agg(
        F.max(F.struct(F.char_length(rule).alias("n"), F.char_length("rule_host").alias("h"),
                       rule.alias("rule"), F.col("action"))).alias("best"))
    verdicts = best.select(F.col("url").alias("judged_url"), F.col("best.rule").alias("judged_rule"),
                           F.col("best.action").alias("judged_action"))
    own = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    joined = pages.join(verdicts, pages[url_col] == F.col("judged_url"), "left")
    return joined.select(
        *(pages[c] for c in own), host_of(pages[url_col]).alias("host"),
        path_of(pages[url_col]).alias("path"), F.col("judged_rule").alias("rule"),
        F.coalesce("judged_action", F.lit(default)).alias("verdict"))
