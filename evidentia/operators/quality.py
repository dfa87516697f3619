"""Quality of clusterings against labels, by contingency counts instead of pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evidentia.functions.text import strip_furniture, title_numbers

MOST_LABELS = 10_000
# What a clustering must reach.
LEAST_F1, MOST_CONTAMINATED, MOST_FRAGMENTS = 0.80, 2, 6


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(1.0)


def _contingency(rows: DataFrame, cluster: str, label: str) -> DataFrame:
    return rows.groupBy(F.col(cluster).alias("c"), F.col(label).alias("l")).agg(F.count(F.lit(1)).alias("n"))


def prefix_labels(titles: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, label): by the longest prefix that a title starts with or holds; titles without one get a label of their own. labels (prefix, label) is a small table, and checked to be one."""
    if labels.limit(MOST_LABELS + 1).count() > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} label prefixes: too many to hold against every title")
    hit = titles.join(F.broadcast(labels), F.col("title").contains(F.col("prefix")), "left")
    return hit.groupBy("id").agg(F.max_by("label", F.struct(F.length("prefix"), "prefix")).alias("label")).select("id", F.coalesce("label", F.concat(F.lit("solo:"), F.col("id").cast("string"))).alias("label"))


def pairwise(rows: DataFrame, cluster: str = "cluster", label: str = "label", gray: DataFrame | None = None) -> DataFrame:
    """Pairwise precision, recall, F1. gray (a, b): unordered label pairs left out of the count."""
    t = _contingency(rows, cluster, label)
    two = lambda n: n * (n - 1) / 2
    both = t.agg(F.coalesce(F.sum(two(F.col("n"))), F.lit(0.0)).alias("tp"))
    pc = t.groupBy("c").agg(F.sum("n").alias("n")).agg(F.coalesce(F.sum(two(F.col("n"))), F.lit(0.0)).alias("pc"))
    pl = t.groupBy("l").agg(F.sum("n").alias("n")).agg(F.coalesce(F.sum(two(F.col("n"))), F.lit(0.0)).alias("pl"))
    out = both.crossJoin(pc).crossJoin(pl)  # three single rows
    if gray is not None:
        a, b = t.select("c", F.col("l").alias("a"), F.col("n").alias("na")), t.select("c", F.col("l").alias("b"), F.col("n").alias("nb"))
        pairs = gray.select("a", "b").unionByName(gray.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().where("a < b")
        g = pairs.join(a, "a").join(b, ["c", "b"]).agg(F.coalesce(F.sum(F.col("na") * F.col("nb")), F.lit(0)).alias("g"))
        out = out.crossJoin(g).withColumn("pc", F.col("pc") - F.col("g"))
    out = out.select(_ratio(F.col("tp"), F.col("pc")).alias("precision"), _ratio(F.col("tp"), F.col("pl")).alias("recall"))
    return out.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0, 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0))


def bcubed(rows: DataFrame, cluster: str = "cluster", label: str = "label") -> DataFrame:
    t = _contingency(rows, cluster, label)
    t = t.withColumn("nc", F.sum("n").over(Window.partitionBy("c"))).withColumn("nl", F.sum("n").over(Window.partitionBy("l")))
    out = t.agg((F.sum(F.col("n") * F.col("n") / F.col("nc")) / F.sum("n")).alias("precision"), (F.sum(F.col("n") * F.col("n") / F.col("nl")) / F.sum("n")).alias("recall"))
    return out.withColumn("f1", 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))


def contamination(rows: DataFrame, cluster: str = "cluster", label: str = "label", gray: DataFrame | None = None) -> DataFrame:
    """(cluster, majority, n_other): members outside their cluster's majority label (ties: the larger label), single ones and gray pairs excused."""
    t = _contingency(rows, cluster, label)
    top = t.groupBy("c").agg(F.max_by("l", F.struct("n", "l")).alias("majority"), F.sum("n").alias("size")).where("size > 1")
    other = t.join(top, "c").where("l <> majority")
    if gray is not None:
        g = gray.select("a", "b").unionByName(gray.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
        other = other.join(g, (F.col("l") == g["a"]) & (F.col("majority") == g["b"]), "left_anti")
    return other.groupBy(F.col("c").alias("cluster"), "majority").agg(F.sum("n").alias("n_other"))


def fragmentation(rows: DataFrame, cluster: str = "cluster", label: str = "label") -> DataFrame:
    return rows.groupBy(F.col(label).alias("label")).agg(F.count_distinct(cluster).alias("n_clusters"))


def load_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """A stored set of articles (JSON); what a row lacks gets its default."""
    df = spark.read.schema("id string, title string, summary string, url string, published timestamp, lang string, source_domain string, source_name string, tier string, bloc string, bias string, hedged boolean, primary_cited boolean").json(path)
    return df.fillna({"summary": "", "hedged": False, "primary_cited": False})


def probe(cases: DataFrame, got: Column, want: str = "want") -> DataFrame:
    """The cases (input columns and `want`) that come out otherwise, with what they gave."""
    return cases.withColumn("got", got).where(~F.col("got").eqNullSafe(F.col(want)))


# Inputs whose outcome is known: figures of a title, and titles that keep their whole text.
FIGURE_PROBES = [("Tension rises over a drone", []), ("Two days of drills near the strait", [2]), ("Navy tracks 11 ships, 4 aircraft", [4, 11]), ("In 2026, ninety of 15 planes", [15])]
WHOLE_PROBES = ["Activity near the strait hits three-year low", "Talks between A-B resume", "Tactics near the gray-zone - 17 sorties"]


def failed_probes(spark: SparkSession, figures: list = FIGURE_PROBES, whole: list = WHOLE_PROBES) -> list[str]:
    """What the scalar functions give for the probes, where it is not what it must be."""
    a = probe(spark.createDataFrame(figures, "title string, want array<int>"), title_numbers("title"))
    b = probe(spark.createDataFrame([(t, t) for t in whole], "title string, want string"), strip_furniture("title"))
    return [f"{r['title']}: {r['got']} instead of {r['want']}" for df in (a, b) for r in df.collect()]


def quality_row(rows: DataFrame, cluster: str = "cluster", label: str = "label", gray: DataFrame | None = None) -> DataFrame:
    """One row: BCubed F1, members out of place, clusters beyond the first of a label, and whether they pass the gate's defaults."""
    b = bcubed(rows, cluster, label).select("f1")
    c = contamination(rows, cluster, label, gray).agg(F.coalesce(F.sum("n_other"), F.lit(0)).alias("contaminated"))
    f = fragmentation(rows, cluster, label).agg(F.coalesce(F.sum(F.col("n_clusters") - 1), F.lit(0)).alias("fragments"))
    return b.crossJoin(c).crossJoin(f).withColumn("passed", (F.col("f1") >= LEAST_F1) & (F.col("contaminated") <= MOST_CONTAMINATED) & (F.col("fragments") <= MOST_FRAGMENTS))  # three single rows


def gate(f1: float, contaminated: int, fragments: int, least_f1: float = LEAST_F1, most_contaminated: int = MOST_CONTAMINATED, most_fragments: int = MOST_FRAGMENTS) -> bool:
    return f1 >= least_f1 and contaminated <= most_contaminated and fragments <= most_fragments


def robustness(rows: DataFrame, cluster_fn, measure, times: int = 20, share: float = 0.8, seed: int = 7) -> tuple[float, float, float]:
    """(mean, population deviation, largest) of a measure over seeded subsamples, clustered anew each time."""
    import statistics

    values = [float(measure(cluster_fn(rows.sample(False, share, seed + k)))) for k in range(times)]
    return statistics.fmean(values), statistics.pstdev(values), max(values)
