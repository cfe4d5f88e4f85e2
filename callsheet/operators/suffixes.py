"""Public suffixes by a table of rules: plain (``co.uk``), wildcard (``*.ck``) and exception
(``!www.ck``).

A host meets the rules by equality on its last labels, one look-up for each number of labels
that rules have, so the work follows the hosts and the rules' depth, never hosts times rules.
An exception wins over all others and leaves out its first label, then the longest match
wins; a host that no rule matches ends in a suffix of one label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from callsheet import dims
from callsheet.functions import urls


def default_rules(spark) -> DataFrame:
    """The small set of suffixes that is used without a table of rules."""
    return spark.createDataFrame([(r,) for r in dims.TWO_LABEL_SUFFIXES], "rule string")


def _tail(labels: Column, n: Column) -> Column:
    return F.array_join(F.slice(labels, F.size(labels) - n + 1, n), ".")


def public_suffixes(hosts: DataFrame, rules: DataFrame, host: str = "host") -> DataFrame:
    """One row per distinct host: ``host, suffix, label`` (the label before the suffix; null
    when the host is a suffix itself). Case does not matter, a final dot is left out; null
    and empty hosts are left out; repeated and blank rules count once or not at all."""
    known = rules.select(F.lower(F.trim("rule")).alias("rule")).filter("rule <> ''").distinct()
    bare = F.when(F.col("rule").startswith("!"), F.substring("rule", 2, 1 << 20)).when(
        F.col("rule").startswith("*."), F.substring("rule", 3, 1 << 20)).otherwise(F.col("rule"))
    tails = known.select(bare.alias("tail"), F.col("rule").startswith("!").alias("exception"), F.col("rule").startswith("*.").alias("wildcard"))
    per_tail = tails.withColumn("n", F.size(F.split("tail", "[.]"))).groupBy("tail", "n").agg(
        F.bool_or("exception").alias("exception"), F.bool_or("wildcard").alias("wildcard"),
        F.bool_or(~F.col("exception") & ~F.col("wildcard")).alias("plain"))
    depth = per_tail.agg(F.max("n")).first()[0] or 0  # labels of the longest rule
    asked = hosts.select(F.col(host).alias("host")).filter(F.col("host") != "").distinct()
    split = asked.withColumn("labels", F.split(F.regexp_replace(F.lower("host"), r"[.]$", ""), "[.]"))
    tried = split.select("host", F.size("labels").alias("size"), F.posexplode(F.transform(
        F.sequence(F.lit(1), F.greatest(F.least(F.size("labels"), F.lit(depth)), F.lit(1))), lambda n: _tail(F.col("labels"), n))).alias("at", "tail"))
    met = tried.withColumn("k", F.col("at") + 1).join(per_tail, "tail").groupBy("host").agg(
        F.max(F.when(F.col("exception"), F.col("k") - 1)).alias("less"),
        F.max(F.greatest(F.when(F.col("plain"), F.col("k")), F.when(F.col("wildcard") & (F.col("k") < F.col("size")), F.col("k") + 1))).alias("most"))
    n = F.coalesce("less", "most", F.lit(1))
    return split.join(met, "host", "left").select(
        "host", _tail(F.col("labels"), n).alias("suffix"), F.when(F.size("labels") > n, F.try_element_at("labels", -1 - n)).alias("label"))


def entry_variants(rows: DataFrame, rules: DataFrame, url: str = "url", key: str = "input_row_id") -> DataFrame:
    """``key, pos, try_url``: the URLs to try for an entry, the domain told from its suffix by
    ``rules``. A host that is a suffix, a null URL or one without host has only itself."""
    named = rows.select(key, F.col(url).alias("url"), F.regexp_replace(urls.url_host(F.col(url)), r":[0-9]+$", "").alias("host"))
    known = public_suffixes(named, rules)
    met = named.join(known, "host", "left")
    tries = urls.variants_of(F.col("url"), F.col("label"), F.col("suffix"))
    return met.select(key, F.posexplode(F.when(F.col("label").isNull(), F.array("url")).otherwise(tries)).alias("pos", "try_url"))
