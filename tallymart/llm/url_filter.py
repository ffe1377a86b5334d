"""URL filters: host-suffix and path-prefix expressions looked up by short hash prefixes."""

from pyspark.sql import Column, DataFrame, functions as F

from .common import ascii_lower

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
PREFIX_HEX = 8  # hex digits of the joined hash prefix: 32 bits


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, _PARTS, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict``. A rule fits its host and all
    its subdomains when the page's path starts with its own. The longest fitting
    rule text (host and path) wins, then the longer host, then ``block``; a page
    that no rule fits gets a NULL rule and the ``default`` verdict.

    Only different (host, path) pairs are looked up, so a hot page or host is
    folded first. Each pair is expanded to those host-suffix and path-prefix
    expressions whose numbers of labels and characters occur in the rules, joined
    on 32 bits of the expression's SHA-256, then compared on all of it. No
    broadcast is asked for: Spark broadcasts rules that its size check allows and
    otherwise merges, splitting hot prefixes.

    NULL or odd urls have an empty host and path and get the default verdict,
    unless a rule is empty too. Rules without host or verdict are ignored, a NULL
    path means an empty one. Empty tables give no rows or default verdicts. Page
    columns named like a result are replaced; all others, and repeated rows, stay.
    """
    rule_text = F.concat("rule_host", "rule_path")
    known = rules.filter("host IS NOT NULL AND verdict IS NOT NULL").select(
        ascii_lower(F.col("host")).alias("rule_host"),
        F.coalesce(F.col("path"), F.lit("")).alias("rule_path"), F.col("verdict").alias("rule_verdict"))
    listed = known.select(
        F.sha2(rule_text, 256).alias("rule_digest"), rule_text.alias("rule"), F.length("rule_host").alias("host_chars"),
        "rule_verdict").withColumn("prefix", F.substring("rule_digest", 1, PREFIX_HEX))
    shapes = known.agg(F.collect_set(F.struct(
        F.size(F.split("rule_host", r"\.")).alias("labels"), F.length("rule_path").alias("chars")))).scalar()

    read = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))}).drop("rule", "verdict")
    labels = F.split("host", r"\.")
    fitting = F.filter("shapes", lambda s: (s["labels"] <= F.size(labels)) & (s["chars"] <= F.length("path")))
    expressions = F.transform(fitting, lambda s: F.concat(
        F.array_join(F.slice(labels, F.size(labels) - s["labels"] + 1, s["labels"]), "."),
        F.substring(F.col("path"), F.lit(1), s["chars"])))
    asked = (
        read.select("host", "path").distinct().withColumn("shapes", shapes)
        .select("host", "path", F.explode(expressions).alias("expression"))
        .select("host", "path", F.sha2("expression", 256).alias("digest"))
        .withColumn("prefix", F.substring("digest", 1, PREFIX_HEX))
    )
    best = (
        asked.join(listed, "prefix").filter("digest = rule_digest").groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule").alias("chars"), "host_chars", "rule", "rule_verdict")).alias("best"))
        .select("host", "path", F.col("best.rule").alias("rule"), F.col("best.rule_verdict").alias("verdict"))
    )
    return read.join(best, ["host", "path"], "left").withColumn("verdict", F.coalesce("verdict", F.lit(default)))
