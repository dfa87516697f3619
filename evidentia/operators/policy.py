"""Joins with policy tables: outlets by domain (longest suffix), label lookups, domain lists.

Policy is data: tables the caller supplies (domain, tier, bloc, name, bias; alias to domain; affiliate groups),
small and joined by key, so the optimizer broadcasts them while they are small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.sources.tables import norm_domain

# Weight of a tier; what an outlet missing from the table gets.
TIER_WEIGHT = {"T1": 1.0, "TA": 0.90, "T2": 0.85, "T3": 0.60, "T4": 0.45, "T5": 0.30}
DEFAULT_TIER, DEFAULT_BLOC = "T5", "unknown"


def tier_weight(tier: Column, default: float = 0.3) -> Column:
    out = F.lit(default)
    for name, w in TIER_WEIGHT.items():
        out = F.when(tier == name, w).otherwise(out)
    return out


def suffixes(host: Column) -> Column:
    """(step, suffix) of a host: itself, then one label less at a time, never the last label alone."""
    labels = F.split(F.regexp_replace(norm_domain(host), "^\\.+", ""), "\\.")
    steps = F.sequence(F.lit(0), F.greatest(F.size(labels) - 2, F.lit(0)))
    return F.transform(steps, lambda k: F.struct(k.alias("step"), F.array_join(F.slice(labels, k + 1, F.size(labels) - k), ".").alias("suffix")))


def classify(df: DataFrame, outlets: DataFrame, host: str = "source_domain", aliases: DataFrame | None = None) -> DataFrame:
    """df with domain, tier, bloc, name, bias of its host: the longest known suffix, an alias before an outlet at each step, else the default."""
    hosts = df.select(F.col(host).alias("_host")).distinct()
    each = hosts.select("_host", F.explode(suffixes(F.col("_host"))).alias("s")).select("_host", "s.step", F.col("s.suffix").alias("_suffix"))
    known = outlets.select(F.col("domain").alias("_suffix"), F.col("domain").alias("_to"), F.lit(1).alias("_rank"))
    if aliases is not None:
        known = known.unionByName(aliases.select(F.col("alias").alias("_suffix"), F.col("domain").alias("_to"), F.lit(0).alias("_rank")))
    best = each.join(known, "_suffix").groupBy("_host").agg(F.min_by("_to", F.struct("step", "_rank")).alias("domain"))
    facts = outlets.select("domain", "tier", "bloc", "name", "bias")
    looked = best.join(facts, "domain", "left")
    clean = F.coalesce(F.regexp_replace(norm_domain("_host"), "^\\.+", ""), F.lit(""))
    full = hosts.join(looked, "_host", "left").select("_host", F.coalesce("domain", clean).alias("domain"), F.coalesce("tier", F.lit(DEFAULT_TIER)).alias("tier"), F.coalesce("bloc", F.lit(DEFAULT_BLOC)).alias("bloc"), F.coalesce("name", "domain", clean).alias("name"), "bias")
    own = [c for c in df.columns if c not in ("domain", "tier", "bloc", "name", "bias")]
    return df.select(*own).join(full, df[host].eqNullSafe(full["_host"]), "left").drop("_host")


def listed_domain(df: DataFrame, domains: DataFrame, host: str) -> DataFrame:
    """Rows whose host is, or ends with a dot and, a listed domain."""
    each = df.select(F.col(host).alias("_host")).distinct().select("_host", F.explode(F.transform(suffixes(F.col("_host")), lambda s: s["suffix"])).alias("domain"))
    hit = each.join(domains.select("domain"), "domain", "left_semi").select("_host").distinct()
    return df.join(hit, df[host] == hit["_host"], "left_semi")


def label(df: DataFrame, labels: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """df with the label of its key from a table (key, value), the key itself where none is known."""
    small = labels.select(F.col(key).alias("_k"), F.col(value).alias("_v"))
    return df.join(small, df[key] == small["_k"], "left").withColumn(out, F.coalesce("_v", df[key].cast("string"))).drop("_k", "_v")


def independence_key(domain: Column, bloc: Column, affiliate: Column | None = None) -> Column:
    """What counts as one independent voice: an outlet (or its group), or a whole bloc."""
    return F.when(bloc == "independent", domain if affiliate is None else F.coalesce(affiliate, domain)).otherwise(bloc)
