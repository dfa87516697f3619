"""Sources mixed to target shares of tokens, repeating documents at most a capped number of times.

Token counts are summed by cell (source, language, topic); the cells are as
many as the target table has sources times the languages and topics, a bounded
number whatever the corpus.  Iterative proportional fitting rakes the cells'
weights (uses per document) to the marginals of topic, of language and, last and
so exactly, of source; within a source no weight exceeds the source's cap, and
what a capped source cannot give goes to the others in proportion to their
weights.  Then documents are drawn: each is used floor(weight) times, and once
more with the probability of the rest, by systematic sampling in strata of
source and salt ordered by size, so that token totals follow closely, a hot source
is spread over many tasks, and the draw is the same on every run.

The total of the mixture is a parameter; unless given, it is the largest one at
which no source that has documents is held back by its cap, so every such source
gets its share (taken among them); with a larger total a capped source falls short
and the report says so.  Language and topic marginals unless given are those of the
target sources' own tokens.  The report gives target, planned and actual share of
every source, and whether the fitting converged; the margins give the same for
languages and topics, which are met as far as sources and caps allow.

Defined cases: a null source belongs to no target; null, empty and blank texts
have no tokens or are used like others by their tokens, documents without
tokens are not used; a source listed twice has its weights added and the larger
cap; null, zero or negative weights and caps give nothing; a listed source
without documents comes out with zero; repeated rows are documents of their own;
more than MOST_CELLS target sources or cells are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidentia.llm.language import label_language
from evidentia.llm.tokens import FOLDER, Encoder
from evidentia.scratch import Scratch

#: More cells than this are no bounded table; the target table is then not what this operator is for.
MOST_CELLS = 200_000


def count_tokens(df: DataFrame, keep: list[str], text: str = "text", vocabulary_file: str = "byte_bpe_50k.tiktoken", folder: str = FOLDER, most_chars: int = 2_000_000) -> DataFrame:
    """The columns `keep` and n_tokens (bigint)."""
    path = f"{folder}/{vocabulary_file}"
    rows = df.select(*keep, F.col(text).alias("_text"))
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep) + ", n_tokens bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(path)
        for rb in batches:
            texts, counts, lo = rb.column(len(keep)).to_pylist(), [], 0
            while lo < len(texts):
                hi, chars = lo, 0
                while hi < len(texts) and (hi == lo or chars < most_chars):
                    chars += len(texts[hi] or "")
                    hi += 1
                counts += [len(x) for x in enc.encode(texts[lo:hi])]
                lo = hi
            yield pa.RecordBatch.from_arrays([*(rb.column(k) for k in range(len(keep))), pa.array(counts, type=pa.int64())], names=[*keep, "n_tokens"])

    return rows.mapInArrow(run, schema)


def share_out(capacity: np.ndarray, weight: np.ndarray, total: float) -> np.ndarray:
    """Amounts in proportion to weight, none above its capacity, summing to total or to all capacities."""
    amount, open_ = np.zeros(len(weight)), (weight > 0) & (capacity > 0)
    left = min(total, capacity[open_].sum())
    while open_.any() and left > 1e-9:
        want = left * np.where(open_, weight, 0) / weight[open_].sum()
        full = open_ & (want >= capacity)
        if not full.any():
            amount[open_] = want[open_]
            break
        amount[full] = capacity[full]
        left -= capacity[full].sum()
        open_ &= ~full
    return amount


def _capped_scale(tokens: np.ndarray, weight: np.ndarray, cap: float, target: float) -> np.ndarray:
    """weight * f, none above cap, with f such that the tokens used are target."""
    lo, hi = 0.0, 1.0
    while (np.minimum(weight * hi, cap) * tokens).sum() < target * (1 - 1e-12) and hi < 1e12:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (np.minimum(weight * mid, cap) * tokens).sum() < target else (lo, mid)
    return np.minimum(weight * hi, cap)


def rake(source: np.ndarray, lang: np.ndarray, topic: np.ndarray, tokens: np.ndarray, cap: np.ndarray, by_source: np.ndarray, by_lang: np.ndarray, by_topic: np.ndarray, rounds: int = 2000, tol: float = 1e-9) -> tuple[np.ndarray, bool]:
    """(uses per document of every cell, whether they settled). by_*: token targets; source targets are met exactly, the others as far as caps and sources allow."""
    w, settled = np.ones(len(tokens)), False
    for _ in range(rounds):
        before = w.copy()
        for group, target in ((topic, by_topic), (lang, by_lang)):
            have = np.bincount(group, weights=w * tokens, minlength=len(target))
            w = w * np.where(have > 0, target / np.maximum(have, 1e-12), 1)[group]
        w = np.maximum(w, 1e-9)
        for s in range(len(by_source)):
            mine = source == s
            if mine.any():
                w[mine] = _capped_scale(tokens[mine], w[mine], cap[s], by_source[s]) if by_source[s] > 0 else 0
        if np.abs(w - before).max() <= tol * max(1.0, w.max()):
            settled = True
            break
    return w, settled


def unbound_total(have: np.ndarray, weight: np.ndarray, cap: np.ndarray) -> float:
    """The largest total at which no source that can give anything is held back by its cap."""
    gives = (have > 0) & (weight > 0) & (cap > 0)
    return float((have[gives] * cap[gives] / (weight[gives] / weight[gives].sum())).min()) if gives.any() else 0.0


def mix(documents: DataFrame, targets: DataFrame, total_tokens: float | None = None, language_share: dict[str, float] | None = None, topic_share: dict[str, float] | None = None, seed: int = 0, stratum_rows: int = 100_000) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(mixture, report, margins): doc_id, source, n_tokens, copies of every used document; per source its shares; per language and topic theirs."""
    spark = documents.sparkSession
    scratch = Scratch(spark, "mixture")
    goal = targets.where("source is not null").groupBy("source").agg(F.sum(F.when(F.col("weight") > 0, F.col("weight")).otherwise(0.0)).alias("weight"), F.max(F.greatest(F.coalesce("max_repeat", F.lit(0)), F.lit(0))).alias("max_repeat"))
    mine = documents.join(goal.select("source"), "source", "left_semi").select("doc_id", "source", F.coalesce(label_language("lang"), F.lit("unknown")).alias("language"), F.coalesce("doc_kind", F.lit("unknown")).alias("topic"), "text")
    sized = scratch.keep(count_tokens(mine, ["doc_id", "source", "language", "topic"]).where("n_tokens > 0"), "sized")
    goals = [(r["source"], r["weight"] or 0.0, r["max_repeat"]) for r in goal.orderBy("source").limit(MOST_CELLS + 1).collect()]
    cells = sized.groupBy("source", "language", "topic").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")).limit(MOST_CELLS + 1).collect()
    if len(cells) > MOST_CELLS or len(goals) > MOST_CELLS:
        raise ValueError(f"more than {MOST_CELLS} target sources, or cells of source, language and topic")
    sources, langs, topics = [g[0] for g in goals], sorted({c["language"] for c in cells}), sorted({c["topic"] for c in cells})
    si, li, ti = ({x: k for k, x in enumerate(xs)} for xs in (sources, langs, topics))
    s, l, t = (np.array([ix[c[n]] for c in cells], dtype=np.int64) for ix, n in ((si, "source"), (li, "language"), (ti, "topic")))
    tokens = np.array([c["tokens"] for c in cells], dtype=float)
    weight, cap = np.array([g[1] for g in goals]), np.array([float(g[2]) for g in goals])
    have = np.bincount(s, weights=tokens, minlength=len(goals)) if len(cells) else np.zeros(len(goals))
    total = unbound_total(have, weight, cap) if total_tokens is None else float(total_tokens)
    by_source = share_out(have * cap, weight, total)
    planned = by_source.sum()

    def marginal(index: np.ndarray, names: list[str], given: dict[str, float] | None) -> np.ndarray:
        own = np.bincount(index, weights=tokens, minlength=len(names)) if given is None else np.array([given.get(n, 0.0) for n in names])
        return planned * own / own.sum() if own.sum() > 0 else own

    by_lang, by_topic = marginal(l, langs, language_share), marginal(t, topics, topic_share)
    w, settled = rake(s, l, t, tokens, cap, by_source, by_lang, by_topic) if len(cells) else (np.zeros(0), True)
    plan = spark.createDataFrame([(c["source"], c["language"], c["topic"], float(x)) for c, x in zip(cells, w)], "source string, language string, topic string, uses double")
    # strata of source and salt; the salt keeps each to a bounded number of rows, the order by size keeps the tokens drawn close to the plan
    largest = sized.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    salts = max(1, -(-largest // stratum_rows))
    rows = sized.join(F.broadcast(plan), ["source", "language", "topic"]).select("doc_id", "source", "language", "topic", "n_tokens", "uses", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(salts)).alias("salt"), F.xxhash64("doc_id", F.lit(seed + 1)).alias("draw"))
    stratum = Window.partitionBy("source", "salt").orderBy("n_tokens", "draw", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.pmod(F.xxhash64("source", "salt", F.lit(seed)), F.lit(1 << 20)) / float(1 << 20)
    upto = F.sum(F.col("uses") - F.floor("uses")).over(stratum) + start
    extra = F.floor(upto + 1e-9) - F.floor(upto - (F.col("uses") - F.floor("uses")) + 1e-9)
    drawn = scratch.keep(rows.select("doc_id", "source", "language", "topic", "n_tokens", "salt", "draw", (F.floor("uses") + extra).cast("int").alias("copies")), "drawn")
    # what rounding leaves of a source's tokens, given or taken back in small documents; strata share it evenly
    plan_s = spark.createDataFrame([(n, float(by_source[k]), int(cap[k])) for k, n in enumerate(sources)], "source string, plan double, cap int")
    gap = drawn.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("got")).join(F.broadcast(plan_s), "source").select("source", "cap", ((F.col("plan") - F.col("got")) / salts).alias("gap"))
    free = ((F.col("gap") > 0) & (F.col("copies") < F.col("cap"))) | ((F.col("gap") < 0) & (F.col("copies") > 0))
    near = drawn.join(F.broadcast(gap), "source").withColumn("free", free)
    run = Window.partitionBy("source", "salt", "free").orderBy("n_tokens", "draw", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    step = F.when(F.col("free") & (F.sum("n_tokens").over(run) <= F.abs("gap")), F.signum("gap")).otherwise(0)
    mixture = scratch.keep(near.select("doc_id", "source", "language", "topic", "n_tokens", (F.col("copies") + step).cast("int").alias("copies")).where("copies > 0"), "mixture")
    used = mixture.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("used_tokens"), F.max("copies").alias("most_copies"), F.count(F.lit(1)).alias("n_used"))
    wsum = weight.sum() or 1.0
    frame = spark.createDataFrame([(n, float(weight[k] / wsum), int(cap[k]), int(have[k]), float(by_source[k] / planned) if planned else 0.0) for k, n in enumerate(sources)], "source string, target_share double, max_repeat int, tokens bigint, planned_share double")
    report = frame.join(used, "source", "left").select("source", "target_share", "max_repeat", "tokens", "planned_share", F.coalesce("n_used", F.lit(0)).alias("n_used"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"), F.coalesce("used_tokens", F.lit(0)).alias("used_tokens"))
    whole = F.sum("used_tokens").over(Window.partitionBy())  # a row per target source
    report = report.withColumn("actual_share", F.when(whole > 0, F.col("used_tokens") / whole).otherwise(0.0)).withColumn("converged", F.lit(settled))
    asked = [(d, n, float(x / planned) if planned else 0.0) for d, names, xs in (("language", langs, by_lang), ("topic", topics, by_topic)) for n, x in zip(names, xs)]
    each = mixture.select(F.explode(F.array(*(F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in ("language", "topic")))).alias("d"), (F.col("n_tokens") * F.col("copies")).alias("k"))
    got = each.groupBy("d.dimension", "d.value").agg(F.sum("k").alias("used_tokens"))
    margins = spark.createDataFrame(asked, "dimension string, value string, target_share double").join(got, ["dimension", "value"], "left").select("dimension", "value", "target_share", F.coalesce("used_tokens", F.lit(0)).alias("used_tokens"))
    of = F.sum("used_tokens").over(Window.partitionBy("dimension"))  # a row per language and topic
    margins = margins.withColumn("actual_share", F.when(of > 0, F.col("used_tokens") / of).otherwise(0.0))
    return mixture.select("doc_id", "source", "n_tokens", "copies"), report, margins
