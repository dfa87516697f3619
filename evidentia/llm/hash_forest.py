"""New batches deduplicated against all history: a prefix-tree hash forest, kept on disk.

Every accepted row's id set is put into several orders, one per tree: the ids
sorted by a hash of the id and the tree.  The first ``DEPTH`` hashes of such an
order, cut to 24, 20 and 20 bits and written one after the other, are the set's
label in that tree, so sets whose orders begin alike are neighbours in the
sorted labels, and all labels under a prefix are one range of them.  A run of
the forest is a table of (tree, label, set) sorted by them and bucketed by
(tree, prefix); beside it stand the accepted rows' id sets, bucketed by set, and
their event ids, bucketed by event.  All runs together are one table whose buckets
hold a file of every run.

A batch is labelled and bucketed once, as its own run; each of its labels meets the
range of labels with its prefix in every run.  The runs are streamed past the batch, which
is the built side of the join; they are never shuffled, sorted or labelled again.
The prefix is the longest one whose chance to be shared in some tree reaches the
recall target for every two different sets that are alike (``prefix_depth`` widens
it from ``DEPTH`` on).  Two sets that share one id only never meet at a depth of two.
Candidates are verified exactly on their id sets.  Accepted rows become a new
run; runs are merged with the ones of their size, so there are few of them and a
row is rewritten a logarithmic number of times; labels of sets turned away go then.  A forest lives in a folder and
is opened again from there: ``Forest.create``, ``Forest.open``, ``append``.

A prefix under which very many different sets of a batch or a run stand is not
joined; the sets under it go through an exact join on their rarest ids instead,
so no link is lost and no bucket is paired with itself.  Rows with equal id sets
are one set, rows with equal event ids one event, and links are made between
sets; copies are never paired with one another.

Within a batch rows depend on one another (a row turned away turns nobody away).
In every round, an open row that is the earliest of its event, of its set and of
all sets linked to its own is accepted, and what repeats it is turned away; after
a few rounds chains of rows with one open predecessor each are settled whole, by
pointer doubling.  The rounds end when no row is open.

Defined cases: ids compare in lower case without outer blanks; null ids and
null elements are no ids; a row without ids can only repeat by its event id, a
row without event id only by its ids; repeated elements count once; an empty
table gives empty results; a row_id that the forest holds already is an error of
the caller (rows come in ascending order of row_id); a row_id repeated in the
batches counts once.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from evidentia.scratch import Scratch, release
from evidentia.sources.tables import norm_id

TREES, DEPTH = 32, 3
#: Bits of a label per level; the first level holds the sign and comes first in order.
BITS = (24, 20, 20)


def share_prefix(depth: int, union: int) -> float:
    """The smallest chance that two alike sets of so many different ids have the same first ids in a random order."""
    both, p = union // 2 + 1, 1.0
    for k in range(depth):
        p *= max(0, both - k) / (union - k) if union > k else 1.0
    return p


def recall(depth: int, trees: int = TREES) -> float:
    """The smallest chance that two different alike sets share a prefix of that depth in some tree."""
    return 1 - (1 - min(0.5**depth, *(share_prefix(depth, u) for u in range(3, 200)))) ** trees


def prefix_depth(target: float, trees: int = TREES) -> int:
    """The longest prefix that still reaches the target."""
    depth = DEPTH
    while depth > 1 and recall(depth, trees) < target:
        depth -= 1
    return depth


def hashed(ids: Column) -> Column:
    return F.transform(ids, lambda x: F.xxhash64(x))


def labels(hashes: Column, trees: int = TREES) -> Column:
    """An array of (tree, label) of the hashed ids of a set; a set of one id has one tree, for its like are equal sets."""
    def label(t: Column) -> Column:
        first = F.slice(F.sort_array(F.transform(hashes, lambda x: F.xxhash64(x, t))), 1, DEPTH)
        level = lambda k: F.coalesce(F.get(first, F.lit(k)), F.lit(0).cast("bigint"))
        return F.shiftleft(F.shiftright(level(0), 40), 40).bitwiseOR(F.shiftleft(F.shiftrightunsigned(level(1), 44), 20)).bitwiseOR(F.shiftrightunsigned(level(2), 44))

    return F.transform(F.sequence(F.lit(0), F.when(F.size(hashes) > 1, trees - 1).otherwise(0)), lambda t: F.struct(t.alias("tree"), label(t).alias("label")))


def alike(a: Column, b: Column) -> Column:
    """More than half of the ids of either are in both."""
    return F.size(F.array_intersect(a, b)) * 3 > F.size(a) + F.size(b)


def _size_fits(a: str, b: str) -> Column:
    return (F.col(a) < 2 * F.col(b)) & (F.col(b) < 2 * F.col(a))


def _all(dfs: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, dfs)


def event_rows(events: DataFrame) -> DataFrame:
    """row_id, batch_no, event (never null), ids (sorted, distinct, may be empty)."""
    ids = F.coalesce(F.array_sort(F.array_distinct(F.filter(F.transform("articles.id", norm_id), lambda x: x.isNotNull()))), F.array().cast("array<string>"))
    return events.select("row_id", "batch_no", F.coalesce(norm_id("id"), F.concat(F.lit("#"), F.col("row_id").cast("string"))).alias("event"), ids.alias("ids"))


#: The tables of a run: their columns, what they are bucketed by, what they are sorted by.
TABLES = {
    "labels": ("tree int, prefix bigint, label bigint, key bigint, n int", ["tree", "prefix"], ["tree", "prefix", "label"]),
    "rows": ("key bigint, row_id bigint, ids array<string>", ["key"], ["key"]),
    "events": ("event string, row_id bigint", ["event"], ["event"]),
}


class Forest:
    """The index of accepted rows in a folder that all executors share; one writer at a time."""

    def __init__(self, spark: SparkSession, path: str, state: dict):
        self.spark, self.path, self.state = spark, path.rstrip("/"), state
        self.scratch = Scratch(spark, "forest")
        self._names: list[str] = []
        self.depth = prefix_depth(state["target"], state["trees"])

    @classmethod
    def create(cls, spark: SparkSession, path: str, target: float = 0.9999, trees: int = TREES, hot: int = 2000, most_runs: int = 4, buckets: int | None = None) -> "Forest":
        """An empty forest. buckets unless given follow the first batch."""
        forest = cls(spark, path, {"version": 0, "target": target, "trees": trees, "hot": hot, "most_runs": most_runs, "buckets": buckets, "runs": [], "made": 0})
        forest._commit()
        return forest

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> "Forest":
        """The forest in that folder as its last finished batch left it."""
        fs, at = _fs(spark, path)
        found = [f.getPath() for f in fs.listStatus(at) if f.getPath().getName().startswith("manifest-")]
        if not found:
            raise FileNotFoundError(f"no forest in {path}")
        last = max(found, key=lambda p: p.getName())
        return cls(spark, path, json.loads(spark.sparkContext.wholeTextFiles(last.toString()).first()[1]))

    def _commit(self) -> None:
        """The state as the next manifest; an earlier one stays valid until this one is whole."""
        fs, at = _fs(self.spark, self.path)
        self.state["version"] += 1
        jvm = self.spark._jvm
        half, whole = (jvm.org.apache.hadoop.fs.Path(at, f"{kind}-{self.state['version']:09d}.json") for kind in ("part", "manifest"))
        out = fs.create(half, True)
        out.write(bytearray(json.dumps(self.state).encode()))
        out.close()
        fs.rename(half, whole)
        fs.delete(jvm.org.apache.hadoop.fs.Path(at, f"manifest-{self.state['version'] - 2:09d}.json"), False)

    @property
    def runs(self) -> list[list]:
        """[name, rows, crowded prefixes] of every run, oldest first."""
        return self.state["runs"]

    def _write(self, kind: str, run: str, df: DataFrame) -> None:
        """df as one file per bucket in the folder of that run."""
        _, keys, order = TABLES[kind]
        n, name, at = self.state["buckets"], f"forest_{uuid.uuid4().hex}", f"{self.path}/{kind}/run={run}"
        fs, folder = _fs(self.spark, at)
        fs.delete(folder, True)  # what an unfinished batch left
        df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*order).format("parquet").option("path", at).saveAsTable(name)
        self.spark.sql(f"drop table {name}")  # the files stay

    def _read(self, kind: str, runs: list[str], keep_run: bool = False) -> DataFrame:
        """These runs as one table: a bucket holds a file of every run."""
        ddl, keys, order = TABLES[kind]
        name = f"forest_{uuid.uuid4().hex}"
        self.spark.sql(f"create table {name} ({ddl}, run string) using parquet partitioned by (run) clustered by ({', '.join(keys)}) sorted by ({', '.join(order)}) into {self.state['buckets']} buckets location '{self.path}/{kind}'")
        self._names.append(name)
        self.spark.sql(f"alter table {name} add " + " ".join(f"partition (run='{r}')" for r in runs))
        return self.spark.table(name) if keep_run else self.spark.table(name).drop("run")

    def _drop(self, run: str) -> None:
        for at in (f"crowded/{run}", *(f"{kind}/run={run}" for kind in TABLES)):
            fs, folder = _fs(self.spark, f"{self.path}/{at}")
            fs.delete(folder, True)

    def _forget(self) -> None:
        """Let go of this session's names of tables; the files stay."""
        for name in self._names:
            self.spark.sql(f"drop table if exists {name}")
        self._names.clear()

    def close(self) -> None:
        self._forget()
        self.scratch.drop()

    def _write_all(self, tables: dict[tuple[str, str], DataFrame]) -> int:
        """Tables by (kind, run), at the same time; returns how many prefixes of the labels among them hold more than `hot` sets."""
        with ThreadPoolExecutor(len(tables)) as pool:
            list(pool.map(lambda at: self._write(*at, tables[at]), tables))
        n = 0
        for kind, run in tables:
            if kind == "labels":  # no shuffle: bucketed by the prefix
                hot = self._read("labels", [run]).groupBy("tree", "prefix").count().where(F.col("count") > self.state["hot"]).select("tree", "prefix")
                seen = Observation()
                hot.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{self.path}/crowded/{run}")
                n += seen.get["n"]
        return n

    def _add(self, run: str, rows: int, n_crowded: int, tables: dict[tuple[str, str], DataFrame]) -> None:
        """The batch as a run; its labels are written already."""
        self._write_all(tables)
        self.runs.append([run, rows, n_crowded])
        gone = []
        if len(self.runs) > self.state["most_runs"]:
            # the last runs together, as far back as none is more than twice what stands behind it
            at = len(self.runs) - 2
            while at > 0 and self.runs[at - 1][1] <= 2 * sum(n for _, n, _ in self.runs[at:]):
                at -= 1
            some = self.runs[at:]
            name, gone = f"m{self.state['made']}", [r for r, *_ in some]
            self.state["made"] += 1
            held = self._read("rows", gone)
            # labels of sets that were turned away go here
            n = self._write_all({("labels", name): self._read("labels", gone).join(held.select("key"), "key", "left_semi"), ("rows", name): held, ("events", name): self._read("events", gone)})
            self.state["runs"] = [*self.runs[:at], [name, sum(n for _, n, _ in some), n]]
        self._commit()
        for r in gone:
            self._drop(r)

    def _links(self, run: str, n_crowded: int) -> DataFrame:
        """(old, row_a, key_a, key_b) of alike sets: key_b of the batch, key_a an earlier set of it, or one of the index (old) with its accepted row."""
        bucket, held = ["tree", "prefix"], [r for r, *_ in self.runs]
        own = self._read("labels", [run]).select(F.col("key").alias("key_b"), F.col("n").alias("n_b"), *bucket)
        other = self._read("labels", [*held, run], keep_run=True).select((F.col("run") != run).alias("old"), F.col("key").alias("key_a"), F.col("n").alias("n_a"), *bucket)
        data = self._read("rows", [*held, f"t{run}"], keep_run=True).select((F.col("run") != f"t{run}").alias("old"), F.col("key").alias("key_a"), F.col("row_id").alias("row_a"), F.col("ids").alias("ids_a"))
        mine = self._read("rows", [f"t{run}"]).select(F.col("key").alias("key_b"), F.col("ids").alias("ids_b"))
        order = F.col("old") | (F.col("key_a") < F.col("key_b"))
        pair = ["old", "key_a", "key_b"]
        met = own
        if n_crowded:
            crowded = self.spark.read.parquet(*(f"{self.path}/crowded/{r}" for r in [*held, run])).distinct()
            met = own.join(crowded, bucket, "left_anti")
        pairs = other.join(met.hint("shuffle_hash"), bucket).where(order & _size_fits("n_a", "n_b")).select(*pair)
        if n_crowded:
            pairs = pairs.unionByName(self._by_rarest(data.join(other.join(crowded, bucket, "left_semi").select("old", "key_a").distinct(), ["old", "key_a"]), mine.join(own.join(crowded, bucket, "left_semi").select("key_b").distinct(), "key_b"), order))
        # the batch's pairs are few: they are what is built, the runs' rows stream past them
        few = pairs.repartition(self.state["buckets"], "key_a").distinct()
        seen = data.join(few.hint("shuffle_hash"), ["key_a", "old"]).repartition(self.state["buckets"], "key_b")
        return seen.join(mine, "key_b").where(alike(F.col("ids_a"), F.col("ids_b"))).select("old", "row_a", "key_a", "key_b")

    def _by_rarest(self, a: DataFrame, b: DataFrame, order: Column) -> DataFrame:
        """Candidates under crowded prefixes, exactly: sets that are alike share one of the n - floor(n / 2) rarest ids of each. a: old, key_a, ids_a; b: key_b, ids_b."""
        both = a.select(F.explode("ids_a").alias("x")).unionAll(b.select(F.explode("ids_b").alias("x")))
        often = both.groupBy("x").count()

        def rarest(df: DataFrame, key: list[str], ids: str) -> DataFrame:
            n = f"n_{ids[-1]}"
            each = df.select(*key, F.size(ids).alias(n), F.explode(ids).alias("x")).join(often, "x").groupBy(*key, n).agg(F.sort_array(F.collect_list(F.struct("count", "x"))).alias("s"))
            return each.select(*key, n, F.explode(F.slice("s", F.lit(1), F.col(n) - F.floor(F.col(n) / 2).cast("int"))).alias("s")).select(*key, n, F.col("s.x").alias("x"))

        return rarest(a, ["old", "key_a"], "ids_a").join(rarest(b, ["key_b"], "ids_b"), "x").where(order & _size_fits("n_a", "n_b")).select("old", "key_a", "key_b")

    def append(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(accepted, repeats) of one batch of event_rows: row_id; and (row_a, row_b) of every accepted row_a that row_b, turned away, repeats. The accepted rows are then part of the forest."""
        scratch, b = self.scratch, f"b{self.state['made']}"
        self.state["made"] += 1
        marked = rows.select("row_id", "event", "ids", F.when(F.size("ids") > 0, F.md5(F.concat_ws("\x1f", "ids"))).alias("s"))
        first = marked.where("s is not null").groupBy("s").agg(F.min("row_id").alias("set"))
        head = F.col("set") == F.col("row_id")
        mine, n_mine = scratch.keep_counted(marked.join(first, "s", "left").select("row_id", "event", F.coalesce("set", -F.col("row_id") - 1).alias("set"), F.when(head, F.col("ids")).alias("ids"), F.when(head, hashed(F.col("ids"))).alias("h")), f"batch-{b}")
        if not self.state["buckets"]:
            self.state["buckets"] = max(self.spark.sparkContext.defaultParallelism, n_mine * self.state["trees"] // 1_000_000)
        sets = mine.where("set = row_id").select(F.col("set").alias("key"), "ids", "h")
        shift = sum(BITS[self.depth:])
        each = sets.select("key", F.size("ids").alias("n"), F.explode(labels(F.col("h"), self.state["trees"])).alias("l"))
        n_crowded = self._write_all({
            ("labels", b): each.select("l.tree", F.shiftright("l.label", shift).alias("prefix"), "l.label", "key", "n"),
            ("rows", f"t{b}"): sets.select("key", F.col("key").alias("row_id"), "ids"),
        })
        links = scratch.keep(self._links(b, n_crowded + sum(k for _, _, k in self.runs)), f"links-{b}")
        edge = links.where("not old").select(F.col("key_a").alias("a"), F.col("key_b").alias("b"))
        both = edge.unionByName(edge.select(F.col("b").alias("a"), F.col("a").alias("b")))
        plain = mine.select("row_id", "event", "set")
        found, open_ = [], plain
        if self.runs:
            by_set = links.where("old").select("row_a", F.col("key_b").alias("set")).join(plain, "set").select("row_a", F.col("row_id").alias("row_b"))
            by_event = self._read("events", [r for r, *_ in self.runs]).select(F.col("row_id").alias("row_a"), "event").join(plain.hint("shuffle_hash"), "event").select("row_a", F.col("row_id").alias("row_b"))
            old = scratch.keep(by_set.unionByName(by_event).distinct(), f"old-{b}")
            found.append(old)
            open_ = plain.join(old.select(F.col("row_b").alias("row_id")).distinct(), "row_id", "left_anti")
        release(self.spark)
        accepted, n = self._settle(b, open_, both)
        # what an accepted row stands for: its event, its set and the sets linked to it; what a row is: its event and its set
        own = F.explode(F.array(F.struct(F.lit(0).alias("kind"), "event", F.lit(None).cast("bigint").alias("set")), F.struct(F.lit(1).alias("kind"), F.lit("").alias("event"), F.col("set")))).alias("g")
        group = [F.col("g.kind").alias("kind"), F.col("g.event").alias("event"), F.coalesce("g.set", F.lit(0)).alias("set")]
        near = accepted.select("row_id", F.col("set").alias("a")).join(both, "a").select("row_id", F.lit(1).alias("kind"), F.lit("").alias("event"), F.col("b").alias("set"))
        stands = accepted.select("row_id", own).select("row_id", *group).unionByName(near).withColumnRenamed("row_id", "row_a")
        later = plain.select(F.col("row_id").alias("row_b"), own).select("row_b", *group)
        found.append(stands.join(later, ["kind", "event", "set"]).where("row_a < row_b").select("row_a", "row_b").distinct())
        repeats = scratch.keep(_all(found), f"repeats-{b}")
        self._add(b, n, n_crowded, {
            ("rows", b): sets.join(accepted.select(F.col("set").alias("key"), "row_id"), "key").select("key", "row_id", "ids"),
            ("events", b): accepted.select("event", "row_id"),
        })
        self._drop(f"t{b}")
        self._forget()
        for name in ("batch", "links", "old"):
            scratch.drop(f"{name}-{b}")
        release(self.spark)
        return accepted.select("row_id"), repeats

    def _settle(self, b: str, open_: DataFrame, both: DataFrame, plain_rounds: int = 4) -> tuple[DataFrame, int]:
        """(row_id, event, set) of the accepted among open rows, and about how many; both: (a, b) of linked sets, either way."""
        parts, before = [], None
        for k in count():
            least_event = open_.groupBy("event").agg(F.min("row_id").alias("me"))
            least_set = open_.groupBy("set").agg(F.min("row_id").alias("ms"))
            near = both.join(least_set.select(F.col("set").alias("b"), "ms"), "b").groupBy("a").agg(F.min("ms").alias("mn")).withColumnRenamed("a", "set")
            first = (F.col("row_id") == F.col("me")) & (F.col("row_id") == F.col("ms")) & (F.col("mn").isNull() | (F.col("row_id") < F.col("mn")))
            state = open_.join(least_event, "event").join(least_set, "set").join(near, "set", "left").select("row_id", "event", "set", first.alias("taken"))
            state, n = self.scratch.keep_counted(state, f"state{k}-{b}")
            self._rounds = k + 1
            if n and k >= plain_rounds:
                even = self._chains(f"{b}-{k}", state, both)
                state = state.join(even, "row_id", "left").select("row_id", "event", "set", (F.col("taken") | F.col("even").isNotNull()).alias("taken"))
            taken = state.where("taken").drop("taken")
            parts.append(taken)
            if not n:
                return _all(parts), before or 0
            before = n if before is None else before
            gone = taken.select("set").unionByName(both.join(taken.select(F.col("set").alias("a")), "a").select(F.col("b").alias("set"))).distinct()
            open_ = state.where("not taken").drop("taken").join(taken.select("event").distinct(), "event", "left_anti").join(gone, "set", "left_anti")

    def _chains(self, name: str, state: DataFrame, both: DataFrame) -> DataFrame:
        """(row_id, even): open rows that stand an even number of steps behind an accepted row, over rows with one open predecessor each."""
        def two(rows: DataFrame, group: str) -> DataFrame:
            """(group, p): the two smallest p of a group."""
            one = rows.groupBy(group).agg(F.min("p").alias("p1"))
            next_ = rows.join(one, group).where("p > p1").groupBy(group).agg(F.min("p").alias("p"))
            return one.select(group, F.col("p1").alias("p")).unionByName(next_)

        by_event = two(state.select("event", F.col("row_id").alias("p")), "event")
        by_set = two(state.select("set", F.col("row_id").alias("p")), "set")
        near = two(both.join(by_set.withColumnRenamed("set", "b"), "b").select(F.col("a").alias("set"), "p"), "set")
        earlier = _all([state.join(x, k).where("p < row_id").select("row_id", "p") for x, k in ((by_event, "event"), (by_set, "set"), (near, "set"))]).distinct()
        lone = earlier.groupBy("row_id").agg(F.count(F.lit(1)).alias("k"), F.min("p").alias("p")).where("k = 1").select("row_id", "p")
        # p and the parity of the steps to it; a row without a lone predecessor points at itself
        step = state.select("row_id").join(lone, "row_id", "left").select("row_id", F.coalesce("p", "row_id").alias("p"), F.col("p").isNotNull().cast("int").alias("odd"))
        step = self.scratch.keep(step, f"chain-{name}-0")
        for j in count(1):
            up = step.select(F.col("row_id").alias("p"), F.col("p").alias("pp"), F.col("odd").alias("podd"))
            step = self.scratch.keep(step.join(up, "p").select("row_id", F.col("pp").alias("p"), ((F.col("odd") + F.col("podd")) % 2).alias("odd"), (F.col("p") != F.col("pp")).alias("moved")), f"chain-{name}-{j}")
            moved = step.where("moved").limit(1).count()
            step = step.drop("moved")
            if j > 1:
                self.scratch.drop(f"chain-{name}-{j - 1}")
            if not moved:
                break
        roots = state.where("taken").select(F.col("row_id").alias("p"))
        return step.join(roots, "p").where("odd = 0").select("row_id", F.lit(True).alias("even"))


def _fs(spark: SparkSession, path: str):
    """(file system, path) of a folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def split_batches(events: DataFrame, target: float = 0.9999, path: str | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """(accepted, repeats) of all batches of events, in order, against a forest; an existing one at `path`, or a new one in the scratch folder."""
    spark = events.sparkSession
    scratch = Scratch(spark, "batches")
    rows = event_rows(events).where("row_id is not null").select("row_id", F.coalesce("batch_no", F.lit(-1)).alias("b"), "event", "ids")
    once = rows.groupBy("row_id").agg(F.min(F.struct("b", "event", "ids")).alias("r")).select("row_id", "r.event", "r.ids", "r.b")
    rows = scratch.keep(once, "all", ["b"])
    batches = [r[0] for r in rows.select("b").distinct().orderBy("b").collect()]  # one number per batch
    forest = Forest.open(spark, path) if path else Forest.create(spark, scratch.path("forest"), target, **options)
    done = [forest.append(rows.where(F.col("b") == b)) for b in batches]
    if not done:
        empty = rows.select("row_id")
        return empty, empty.select(F.col("row_id").alias("row_a"), F.col("row_id").alias("row_b"))
    return tuple(_all([d[k] for d in done]) for k in (0, 1))
