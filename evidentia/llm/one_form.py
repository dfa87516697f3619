"""One form for text that looks the same: full-width, decomposed, compatibility, ligature, look-alike and invisible characters.

Texts are exploded to positioned code points (runs that stand for themselves
stay together); a broadcast join with the fixed
table of mappings gives what each stands for (nothing, for invisible ones; a
plain blank for every kind of blank); the text is rebuilt in order of position.
Texts that then hold combining marks or Hangul letters go on: every code point
is joined with its canonical decomposition and combining class, a window counts
the clusters (a starter and what combines with it), marks are ordered by class
within their cluster, a join with the table of compositions recomposes the
longest prefix of the cluster, and the text is rebuilt from its clusters.

The tables hold code points, so their size is fixed by Unicode.  All steps after
the one shuffle keep its partitioning.  Texts made of characters that stand for
themselves only are their own form and are not exploded.

Case, accents, other letters and punctuation marks stay as they are; so do the
number of blanks and blanks at either end.

Defined cases: null gives null, an empty text an empty form; rows repeated with
the same key and text count once; texts are taken whole.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from evidentia.llm.characters import single


@lru_cache(1)
def plain_ranges() -> str:
    """The inside of a character class: ranges whose characters stand for themselves and combine with nothing."""
    table = single()
    blocks = [(0x20, 0x7E), (0xA1, 0x24F), (0x2013, 0x201D), (0x2022, 0x2022), (0x3001, 0x3015), (0x3041, 0x3096), (0x30A1, 0x30FE), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3)]
    ranges = []
    for lo, hi in blocks:
        start = None
        for c in range(lo, hi + 2):
            good = c <= hi and c not in table and not unicodedata.combining(chr(c))
            if good and start is None:
                start = c
            if not good and start is not None:
                ranges.append((start, c - 1))
                start = None
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in ranges)


@lru_cache(1)
def combining_class() -> str:
    """A regular expression for what takes part in composition: combining marks, Hangul letters, and characters that stand for such."""
    def takes_part(text: str) -> bool:
        return any(unicodedata.category(x)[0] == "M" or 0x1100 <= ord(x) <= 0x11FF or 0xA960 <= ord(x) <= 0xA97F or 0xD7B0 <= ord(x) <= 0xD7FF for x in text)

    more = sorted(c for c, v in single().items() if takes_part(v))
    return "[\\p{M}\\u1100-\\u11ff\\ua960-\\ua97f\\ud7b0-\\ud7ff" + "".join(f"\\x{{{c:x}}}" for c in more) + "]"


def _frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return F.broadcast(spark.createDataFrame(rows, schema))


@lru_cache(1)
def _canonical() -> tuple[list[tuple[str, str]], list[tuple[str, str]], list[tuple[str, int]]]:
    """Decompositions, compositions, and combining classes; Hangul vowels and finals, which follow their initial, have class -1."""
    down, up, rank = [], [], []
    for c in range(sys.maxunicode + 1):
        ch = chr(c)
        if 0xD800 <= c <= 0xDFFF:
            continue
        d = unicodedata.normalize("NFD", ch)
        if d != ch:
            down.append((ch, d))
            if unicodedata.normalize("NFC", d) == ch:
                up.append((d, ch))
                if 0xAC00 <= c <= 0xD7A3 and len(d) == 3:
                    continue
        k = unicodedata.combining(ch)
        if k:
            rank.append((ch, k))
        elif 0x1161 <= c <= 0x1175 or 0x11A8 <= c <= 0x11C2:
            rank.append((ch, -1))
    return down, up, rank


def _letters(text: Column | str) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def one_form(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys..., text_hash, form) for every row of df with a text; keys name a row, repeated rows come out once or more."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names, keys = keys, [f"_key{i}" for i in range(len(keys))]
    rows = df.select(*(F.col(c).alias(k) for c, k in zip(names, keys)), F.col(text).alias("_t"), F.xxhash64(text).alias("text_hash")).where("_t is not null")
    # as many bytes as characters: ASCII, of which only control characters stand for something else
    ascii_only = F.octet_length("_t") == F.char_length("_t")
    odd = F.when(ascii_only, F.col("_t").rlike("[\\x00-\\x1f\\x7f]")).otherwise(F.col("_t").rlike(f"[^{plain_ranges()}]"))
    own = rows.where(~odd).select(*keys, "text_hash", F.col("_t").alias("form"))
    by = [*keys, "text_hash"]

    mapping = _frame(spark, [(chr(c), v) for c, v in single().items()], "ch string, becomes string")
    # runs of characters that stand for themselves stay together as one piece
    pieces = F.regexp_extract_all("_t", F.lit(f"(?s)[{plain_ranges()}]+|."), F.lit(0))
    once = rows.where(odd).repartition(n, *keys).groupBy(*by).agg(F.first("_t").alias("_t"))
    combines = F.col("_t").rlike(combining_class())

    def mapped(some: DataFrame) -> DataFrame:
        points = some.select(*by, F.posexplode(pieces).alias("pos", "ch")).join(mapping, "ch", "left").select(*by, "pos", F.coalesce("becomes", "ch").alias("ch"))
        return points.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("pos", "ch"))).alias("x")).select(*by, F.concat_ws("", "x.ch").alias("form"))

    down, up, rank = _canonical()
    down_t, up_t, rank_t = _frame(spark, down, "ch string, parts string"), _frame(spark, up, "cluster string, one string"), _frame(spark, rank, "part string, rank int")
    parts = mapped(once.where(combines)).select(*by, F.posexplode(_letters("form")).alias("pos", "ch")).join(down_t, "ch", "left")
    parts = parts.select(*by, "pos", F.posexplode(_letters(F.coalesce("parts", "ch"))).alias("sub", "part")).join(rank_t, "part", "left").select(*by, "pos", "sub", "part", F.coalesce("rank", F.lit(0)).alias("rank"))
    window = Window.partitionBy(*by).orderBy("pos", "sub")
    # a Hangul vowel continues a cluster only right after an initial, a final only right after a vowel; else they begin one
    parts = parts.withColumn("before", F.lag("part").over(window))
    follows = (F.col("part").between("\u1161", "\u1175") & F.col("before").between("\u1100", "\u1112")) | (F.col("part").between("\u11a8", "\u11c2") & F.col("before").between("\u1161", "\u1175"))
    begins = (F.col("rank") == 0) | ((F.col("rank") == -1) & ~F.coalesce(follows, F.lit(False)))
    parts = parts.withColumn("no", F.sum(begins.cast("int")).over(window))
    order = F.struct(F.greatest("rank", F.lit(0)).alias("rank"), "pos", "sub", "part")
    clusters = parts.groupBy(*by, "no").agg(F.sort_array(F.collect_list(order)).alias("x")).select(*by, "no", F.col("x.part").alias("x"))
    prefix = clusters.select(*by, "no", "x", F.explode(F.sequence(F.lit(1), F.size("x"))).alias("k"))
    prefix = prefix.withColumn("cluster", F.concat_ws("", F.slice("x", F.lit(1), F.col("k")))).join(up_t, "cluster", "left")
    best = prefix.groupBy(*by, "no").agg(F.max(F.struct(F.col("one").isNotNull().alias("has"), "k", "one", "x")).alias("b"))
    piece = F.when(F.col("b.has"), F.concat("b.one", F.concat_ws("", F.slice("b.x", F.col("b.k") + 1, F.size("b.x"))))).otherwise(F.concat_ws("", "b.x"))
    recomposed = best.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("no", piece.alias("piece")))).alias("x")).select(*by, F.concat_ws("", "x.piece").alias("form"))
    built = mapped(once.where(~combines))
    return own.unionByName(built).unionByName(recomposed).select(*(F.col(k).alias(c) for c, k in zip(names, keys)), "text_hash", "form")
