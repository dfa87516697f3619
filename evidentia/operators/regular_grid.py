"""Irregular readings onto a regular daily grid, gaps filled by singular-spectrum imputation.

The grid (one row per series and day between the first and the last readable
date) is built by aggregation in the JVM, so every row that reaches Python is
already one of a bounded number of days.  A series is cut into blocks of
``block_days`` days (each with ``margin`` days of context on both sides), hence
no task ever holds a series of unbounded length.

Iterative singular-spectrum imputation per block: start the missing entries at
the linear interpolation, embed the series as a Hankel trajectory matrix, keep
the leading singular vectors, average the anti-diagonals back into a series,
replace only the missing entries and repeat until they stop moving; what still
moves after the last round is marked.  Blocks are imputed many at a time, as one
stack of matrices.

Defined cases: unreadable or null dates belong to no day; a null series id is a
series of its own; counts below zero or null, and rows whose parse_ok is not
true, give no value; of several readings of a day the latest issued wins (ties:
the larger reading_id); repeated rows change nothing; a field without any value
in a block of a series stays null and is marked ``missing``; with fewer than
``min_known`` known days the median of the block's known days fills and is
marked ``median``; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def read_date(col: Column | str) -> Column:
    """A date from the notations in use, year first; a three-digit year is a Minguo year. Null if unreadable."""
    col = F.col(col) if isinstance(col, str) else col
    text = F.translate(F.regexp_replace(col, "[\\s\\u3000\\u00a0]+", ""), "０１２３４５６７８９．／－", "0123456789./-")
    parts = "^(\\d{3,4})(?:[-/.年](\\d{1,2})[-/.月](\\d{1,2})日?)$"
    packed = "^(\\d{3,4})(\\d{2})(\\d{2})$"

    def ymd(pattern: str) -> Column:
        y, m, d = (F.regexp_extract(text, pattern, k) for k in (1, 2, 3))
        year = F.when(F.length(y) == 3, y.cast("int") + 1911).otherwise(y.cast("int"))
        return F.try_to_date(F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")

    return F.when(text.rlike(parts), ymd(parts)).when(text.rlike(packed), ymd(packed))


#: How a missing day came out: filled by the method; still moving when the rounds ended; by the median of too few known days; not at all.
FILLED, UNSETTLED, MEDIAN, MISSING = "filled", "unsettled", "median", "missing"


def impute_blocks(ys: list[np.ndarray], rank: int = 3, window: int = 14, tol: float = 1e-3, rounds: int = 400, min_known: int = 8) -> tuple[list[np.ndarray], list[str]]:
    """Blocks with their NaN replaced, and how: all of them at once, padded to the longest, one stack of matrices a round."""
    out, how = [y.copy() for y in ys], [FILLED] * len(ys)
    todo: dict[int, list[int]] = {}  # by width of the trajectory matrix
    for k, y in enumerate(ys):
        known = ~np.isnan(y)
        if known.all():
            continue
        if not known.any():
            how[k] = MISSING
        elif known.sum() < min_known or len(y) < 4:
            out[k][~known], how[k] = np.median(y[known]), MEDIAN
        else:
            todo.setdefault(max(2, min(window, len(y) // 2)), []).append(k)
    for width, ks in todo.items():
        for k, (filled, settled) in zip(ks, _impute_stack([ys[k] for k in ks], width, rank, tol, rounds)):
            out[k] = filled
            how[k] = FILLED if settled else UNSETTLED
    return out, how


def _impute_stack(ys: list[np.ndarray], width: int, rank: int, tol: float, rounds: int) -> list[tuple[np.ndarray, bool]]:
    n = np.array([len(y) for y in ys])
    longest = int(n.max())
    x, miss, inside = np.zeros((len(ys), longest)), np.zeros((len(ys), longest), bool), np.arange(longest) < n[:, None]
    for k, y in enumerate(ys):
        gap = np.isnan(y)
        at = np.arange(len(y))
        x[k, : n[k]] = np.where(gap, np.interp(at, at[~gap], y[~gap]), y)
        miss[k, : n[k]] = gap
    high = np.array([2 * np.nanmax(y) + 1 for y in ys])
    rows = longest - width + 1
    real = (np.arange(rows) < (n - width + 1)[:, None])[:, :, None]
    count = np.zeros((len(ys), longest))
    for w in range(width):
        count[:, w: w + rows] += real[:, :, 0]
    count = np.maximum(count, 1)
    settled, live = np.zeros(len(ys), bool), np.arange(len(ys))
    for _ in range(rounds):
        y, m, r = x[live], miss[live], real[live]
        mean = (y * inside[live]).sum(1) / n[live]
        hankel = np.lib.stride_tricks.sliding_window_view(y - mean[:, None], width, axis=1) * r
        _, vec = np.linalg.eigh(hankel.transpose(0, 2, 1) @ hankel)
        lead = vec[:, :, -min(rank, width):]
        smooth = (hankel @ lead) @ lead.transpose(0, 2, 1)
        rebuilt = np.zeros_like(y)
        for w in range(width):
            rebuilt[:, w: w + rows] += smooth[:, :, w]
        new = np.where(m, np.clip(rebuilt / count[live] + mean[:, None], 0.0, high[live, None]), y)
        moved = np.abs(new - y).max(1)
        x[live] = new
        done = moved < tol * (1 + np.abs(mean))
        settled[live[done]] = True
        live = live[~done]
        if not len(live):
            break
    return [(x[k, : n[k]], bool(settled[k])) for k in range(len(ys))]


def regular_grid(
    df: DataFrame,
    fields: tuple[str, ...] = ("navy_ships", "official_ships"),
    series: str = "series_id",
    date: str = "date",
    issued: str = "observed_at",
    order: str = "reading_id",
    ok: str = "parse_ok",
    block_days: int = 256,
    margin: int = 28,
    rank: int = 3,
    window: int = 14,
) -> DataFrame:
    """One row per series, day and field: series, field, on_date, value (double), n_bulletins, state.

    state is ``observed``, ``filled``, ``unsettled`` (filled, still moving when the rounds ended), ``median`` (of fewer than
    ``min_known`` known days) or ``missing`` (nothing to fill from; value null).
    """
    rows = df.select(F.coalesce(F.col(series), F.lit("")).alias("series"), F.col(series).isNull().alias("unnamed"), read_date(date).alias("day"), F.col(issued).alias("issued"), F.col(order).alias("ord"), F.col(ok).alias("ok"), *(F.col(f).alias(f"f_{f}") for f in fields)).where("day is not null")
    usable = {f: F.when(F.col("ok") & (F.col(f"f_{f}") >= 0), F.col(f"f_{f}")) for f in fields}
    daily = rows.groupBy("series", "unnamed", "day").agg(
        *(F.max(F.when(usable[f].isNotNull(), F.struct(F.coalesce(F.unix_micros(F.col("issued").cast("timestamp")), F.lit(-(1 << 62))).alias("i"), F.coalesce(F.col("ord"), F.lit(-1)).alias("o"), usable[f].cast("double").alias("v"))))["v"].alias(f"v_{f}") for f in fields),
        F.count(F.lit(1)).alias("n_bulletins"),
    )
    span = rows.groupBy("series", "unnamed").agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    grid = span.select("series", "unnamed", "lo", F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("day"))
    full = grid.join(daily, ["series", "unnamed", "day"], "left").withColumn("pos", F.datediff("day", "lo"))
    block = F.floor(F.col("pos") / block_days).cast("int")
    near = F.array_distinct(F.array(block, F.greatest(F.lit(0), F.floor((F.col("pos") - margin) / block_days)).cast("int"), F.floor((F.col("pos") + margin) / block_days).cast("int")))
    blocks = full.select("series", "unnamed", "day", "pos", block.alias("own"), F.coalesce("n_bulletins", F.lit(0)).alias("n_bulletins"), *(F.col(f"v_{f}") for f in fields), F.explode(near).alias("block"))
    schema = "series string, unnamed boolean, field string, on_date date, value double, n_bulletins long, state string"

    names = ["series", "unnamed", "block", "pos", "own", "day", "n_bulletins", *(f"v_{f}" for f in fields)]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = blocks.select(*names).repartition(n, "series", "unnamed", "block").sortWithinPartitions("series", "unnamed", "block", "pos")

    def impute(t: pa.Table, first: np.ndarray) -> pa.RecordBatch:
        """The rows of whole blocks that begin at first."""
        mine = t.column("own").to_numpy() == t.column("block").to_numpy()
        own = t.filter(pa.array(mine))
        parts = []
        for f in fields:
            y = t.column(f"v_{f}").to_numpy(zero_copy_only=False).astype(float)
            ys = np.split(y, first[1:])
            filled, how = impute_blocks(ys, rank=rank, window=window)
            value = np.round(np.concatenate(filled), 3)[mine]
            state = np.where(np.isnan(y), np.repeat(np.array(how, dtype=object), [len(b) for b in ys]), "observed")[mine]
            cols = [own.column("series").combine_chunks(), own.column("unnamed").combine_chunks(), pa.array([f] * own.num_rows, pa.string()), own.column("day").combine_chunks(), pa.array(value, pa.float64(), mask=np.isnan(value)), own.column("n_bulletins").combine_chunks(), pa.array(state, pa.string())]
            parts.append(pa.RecordBatch.from_arrays(cols, names=["series", "unnamed", "field", "on_date", "value", "n_bulletins", "state"]))
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0] if parts and own.num_rows else pa.RecordBatch.from_arrays([c.slice(0, 0) for c in cols], names=parts[0].schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Many blocks at a time; the last one waits for its rest."""
        held: pa.Table | None = None
        for rb in chain(batches, [None]):
            if rb is not None:
                more = pa.Table.from_batches([rb])
                held = more if held is None else pa.concat_tables([held, more])
            if held is None or not held.num_rows:
                continue
            ids, block, unnamed = (held.column("series").combine_chunks().dictionary_encode().indices.to_numpy(), held.column("block").to_numpy(), held.column("unnamed").to_numpy(zero_copy_only=False))
            change = (ids[1:] != ids[:-1]) | (block[1:] != block[:-1]) | (unnamed[1:] != unnamed[:-1])
            first = np.concatenate([[0], np.flatnonzero(change) + 1])
            if rb is None:
                yield impute(held, first)
            elif len(first) > 1:
                yield impute(held.slice(0, first[-1]), first[:-1])
                held = held.slice(first[-1])

    out = ordered.mapInArrow(run, schema)
    return out.select(F.when(~F.col("unnamed"), F.col("series")).alias("series_id"), "field", "on_date", "value", "n_bulletins", "state")


def missing_days(grid: DataFrame) -> DataFrame:
    """series_id, field, on_date (yyyy-MM-dd) of the days that no reading covers, from the grid."""
    return grid.where("state <> 'observed'").select("series_id", "field", F.date_format("on_date", "yyyy-MM-dd").alias("on_date"))
