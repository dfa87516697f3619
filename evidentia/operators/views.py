"""Read-side views: search, filters, orders, chips, perspectives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def matches(query: str, headline: Column, titles: Column, sources: Column) -> Column:
    """Case-insensitive substring of headline, any title or any source."""
    q = query.strip().lower()
    if not q:
        return F.lit(True)
    inside = lambda x: F.lower(x).contains(q)
    hit = F.coalesce(inside(headline), F.lit(False))
    for a in (titles, sources):
        hit = hit | F.coalesce(F.exists(a, lambda x: F.coalesce(inside(x), F.lit(False))), F.lit(False))
    return hit


def grade_rank(grade: Column) -> Column:
    return F.when(grade == "A", 0).when(grade == "B", 1).when(grade == "C", 2).when(grade == "D", 3).otherwise(4)


def event_filter(events: DataFrame, grades: list[str] | None = None, entity: str | None = None, text: str = "", grade: str = "credibility.grade", entities: str = "entities", headline: str = "headline", members: str = "articles") -> DataFrame:
    """Events of these grades that hold the entity (the column entities) and match the text; what is not asked is not looked at."""
    out = events.where(F.col(grade).isin(grades)) if grades else events
    out = out.where(F.array_contains(entities, entity)) if entity else out
    return out.where(matches(text, F.col(headline), F.col(f"{members}.title"), F.col(f"{members}.source_domain"))) if text.strip() else out


def article_output(articles: DataFrame, tiers: DataFrame, blocs: DataFrame, signature: str = "signature") -> DataFrame:
    """What is published of an article: its own columns, labels of tier and bloc (tables code, label), and its entities without figures."""
    out = articles.withColumn("entities", F.filter(signature, lambda x: ~x.startswith("n:"))).drop(signature)
    for code, labels in (("tier", tiers), ("bloc", blocs)):
        out = out.join(labels.select(F.col("code").alias(code), F.col("label").alias(f"{code}_label")), code, "left").withColumn(f"{code}_label", F.coalesce(f"{code}_label", code))
    return out


def by_recency(events: DataFrame, last: str, score: str, *ties: str) -> DataFrame:
    return events.orderBy(F.date_trunc("second", F.col(last)).desc(), F.col(score).desc(), *ties)


def by_credibility(events: DataFrame, grade: str, score: str, last: str, *ties: str) -> DataFrame:
    return events.orderBy(grade_rank(F.col(grade)), F.col(score).desc(), F.date_trunc("second", F.col(last)).desc(), *ties)


def chips(entity_lists: Column, n: int = 8) -> Column:
    """The first n distinct entities in order of appearance."""
    return F.slice(F.array_distinct(F.flatten(entity_lists)), 1, n)


def top_of_side(articles: DataFrame, side: str, n: int, order: list[Column]) -> DataFrame:
    w = Window.partitionBy(side).orderBy(*order)
    return articles.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
