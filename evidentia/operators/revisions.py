"""Revised headlines of one outlet merged: sequential within (outlet, language), hence grouped Arrow tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidentia.functions.text import title_numbers, title_text, title_tokens

# Share of tokens, window in hours, fewest tokens.
CONTAINMENT, WINDOW_HOURS, MIN_TOKENS = 0.92, 36, 6


def dedupe_revisions(articles: DataFrame, order: str = "entry_ord") -> DataFrame:
    """(id, kept_id, first_published): every article and the article it ends up as; kept_id = id for those that stay.

    Going up in time, an article that matches a kept one of its outlet and language (within the window, no conflicting
    figures, enough tokens contained) takes its place if its title is longer, else is dropped.  The candidates of a group
    are cut at gaps longer than the window, over which nothing can match, so a task holds one uninterrupted stretch.
    An article without a time stays, and nothing is held against it.
    """
    rows = articles.withColumn("_text", title_text(F.col("title"))).select("id", F.coalesce("source_domain", F.lit("")).alias("outlet"), "lang", F.unix_micros(F.col("published").cast("timestamp")).alias("at"), F.col(order).alias("ord"), F.length("title").alias("len"), title_numbers("title").alias("nums"), title_tokens(F.col("_text"), F.col("lang")).alias("toks"))
    alone = rows.where("at is null").select("id", F.col("id").alias("kept_id"), F.lit(None).cast("timestamp").alias("first_published"))
    rows = rows.where("at is not null")
    # gaps are looked for between stretches as long as the window, of which an outlet has few, not between its rows
    span = WINDOW_HOURS * 3_600_000_000
    rows = rows.withColumn("stretch", F.floor(F.col("at") / span))
    w = Window.partitionBy("outlet", "lang").orderBy("stretch")
    gap = F.col("lo") - F.lag("hi").over(w) > span
    ends = rows.groupBy("outlet", "lang", "stretch").agg(F.min("at").alias("lo"), F.max("at").alias("hi"))
    islands = ends.withColumn("gap", F.coalesce(gap.cast("int"), F.lit(0))).withColumn("island", F.sum("gap").over(w)).select(F.col("outlet").alias("_o"), F.col("lang").alias("_l"), F.col("stretch").alias("_s"), "island")
    rows = rows.join(islands, (F.col("outlet") == F.col("_o")) & F.col("lang").eqNullSafe(F.col("_l")) & (F.col("stretch") == F.col("_s")))

    key = ["outlet", "lang", "island"]
    n = int(articles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.select(*key, "id", "at", "len", "nums", "toks", "ord").repartition(n, *key).sortWithinPartitions(*key, "at", "ord")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One island after the other; only kept articles within the window are held and compared, what ended up as the others is given out."""
        at_key, kept, done = None, [], []

        def end(some: list[dict]) -> None:
            done.extend((x, k["id"], f) for k in some for x, f in k["members"])

        def out() -> pa.RecordBatch:
            cols = [pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.string()), pa.array([d[2] for d in done], pa.int64())]
            done.clear()
            return pa.RecordBatch.from_arrays(cols, names=["id", "kept_id", "first_us"])

        for rb in batches:
            for n, (o, lang, island, id, at, size, nums, toks, _) in enumerate(zip(*(rb.column(c).to_pylist() for c in range(9)))):
                if (o, lang, island) != at_key:
                    end(kept)
                    at_key, kept = (o, lang, island), []
                elif n % 256 == 0:
                    end([k for k in kept if at - k["at"] > span])
                    kept = [k for k in kept if at - k["at"] <= span]
                toks, nums = set(toks), set(nums)
                hit = None
                for k in kept:
                    if at - k["at"] > span or (nums and k["nums"] and not nums & k["nums"]):
                        continue
                    least = min(len(toks), len(k["toks"]))
                    if least >= MIN_TOKENS and len(toks & k["toks"]) / least >= CONTAINMENT:
                        hit = k
                        break
                if hit is None:
                    kept.append({"id": id, "at": at, "nums": nums, "toks": toks, "len": size, "members": [(id, None)]})
                elif size > hit["len"]:
                    hit["members"].append((id, hit["at"]))
                    hit.update(id=id, at=at, nums=nums, toks=toks, len=size)
                else:
                    hit["members"].append((id, None))
            if done:
                yield out()
        end(kept)
        if done:
            yield out()

    out = ordered.mapInArrow(run, "id string, kept_id string, first_us bigint")
    return out.select("id", "kept_id", F.timestamp_micros("first_us").alias("first_published")).unionByName(alone)
