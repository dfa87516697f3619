"""Headlines published again with small edits: a prefix-tree join on ordered token sets.

Rows go to blocks of (outlet, stretch of time); rows near the end of a block are
also carried into the next one, so a pair within the window is in one block.  A
block with more rows than ``block_rows`` is split further by the tokens a title
may share with a partner (its rarest ones in a global order by hash), which
loses no pair.  So no task holds an unbounded group.  Of a title that an outlet
repeats within such a crowded block only the first and the last occurrence of each
stretch as long as the window go on; the others are linked to the first.

Copies are never paired: an occurrence of a title is linked to the one before it,
and only a title without an occurrence in the last window is looked up.  What is
similar to it and has occurred within the window has then been linked, or will be
when it occurs again, so the groups are those of all pairs.

In a block every title becomes a set of tokens (words; single characters of
scripts without blanks; figures, number words among them), bracketed labels and filler
words left out, sorted rarest first, and the sets are stored in a trie, one per
stretch as long as the window.  A set is looked up from the nodes of its rare
tokens downwards, titles with a common beginning being counted together, and a
subtree is left as soon as the tokens that remain cannot make up the overlap.
What is found is compared in full: figures that disagree, or another word (a
name, a place, a day) in the same place tell two headlines apart; dropped,
added, moved and respelled words and filler words do not.  Joined pairs become
groups by the hooking of ``components``.

Defined cases: null titles, outlets and times join nothing; repeated rows of an
id count once (in a block, its first time); equal titles of one outlet within the window are
joined; empty titles join nothing; titles are compared whole.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm.characters import single
from evidentia.scratch import Scratch
from evidentia.sources.tables import norm_domain

_TOKEN = re.compile(r"\d+|[A-Za-zÀ-ɏ]+(?:['’][A-Za-zÀ-ɏ]+)?|[一二三四五六七八九十百两兩]+|[぀-ヿ㐀-鿿가-힣]|[^\W\d_A-Za-zÀ-ɏ぀-ヿ㐀-鿿가-힣]+")
_CJK_NUMBER = re.compile(r"[一二三四五六七八九十百两兩]+$")

# Number words (articles left out), and Chinese numerals.
NUMBERS = {
    "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10, "eleven": 11, "twelve": 12, "thirteen": 13, "fourteen": 14, "fifteen": 15, "sixteen": 16, "seventeen": 17, "eighteen": 18, "nineteen": 19, "twenty": 20,
    "deux": 2, "trois": 3, "quatre": 4, "cinq": 5, "sept": 7, "huit": 8, "neuf": 9, "dix": 10, "onze": 11, "douze": 12,
    "zwei": 2, "drei": 3, "vier": 4, "fünf": 5, "sechs": 6, "sieben": 7, "acht": 8, "neun": 9, "zehn": 10, "elf": 11, "zwölf": 12,
    "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9, "diez": 10, "once": 11, "doce": 12,
}
NUMERALS = {"一": 1, "二": 2, "三": 3, "四": 4, "五": 5, "六": 6, "七": 7, "八": 8, "九": 9, "两": 2, "兩": 2}
# Filler words that an edit puts in or in another word's place.
FILLERS = {"still", "again", "also", "now", "late", "reportedly", "already", "yet", "aussi", "encore", "déjà", "toujours", "también", "ya", "otra", "vez", "aún", "bereits", "auch", "erneut", "nun", "wieder", "noch"}
CJK_FILLERS = set("再次仍又びさらにまた계속다시또")
#: A label before a headline, in brackets. Words of other labels are tokens that one headline has more than the other.
LABEL_HEAD = re.compile(r"\s*[\[【][^\]】]{1,20}[\]】]\s*")
#: Letters of a word from which on one of them may be replaced.
MIN_REPLACED = 6
_BRACKET_END = re.compile(r"\s*[(（][^()（）]{1,12}[)）]\s*$")


def without_labels(text: str) -> str:
    """A headline without bracketed labels before it, and without what stands in brackets or after a bar at its end."""
    while m := LABEL_HEAD.match(text):
        if m.end() >= len(text):
            break
        text = text[m.end():]
    for _ in range(3):
        text = text.rstrip()
        if text[-1:] in (")", "）"):
            cut = _BRACKET_END.sub("", text)
        elif "|" in text[-20:] or "｜" in text[-20:]:
            cut = text[: max(text.rfind("|"), text.rfind("｜"))]
        else:
            return text
        if not cut.strip() or cut == text:
            return text
        text = cut
    return text


def _number(token: str) -> str:
    if token[0] in "一二三四五六七八九十百两兩":
        total, digit = 0, 0
        for c in token:
            if c == "十":
                total, digit = total + (digit or 1) * 10, 0
            elif c == "百":
                total, digit = total + (digit or 1) * 100, 0
            else:
                digit = digit * 10 + NUMERALS[c]
        return str(total + digit)
    return str(int(token))


@lru_cache(1)
def _odd() -> frozenset[str]:
    """Characters that stand for another one, or combine."""
    combining = (chr(c) for r in (range(0x300, 0x370), range(0x1100, 0x1200), (0x3099, 0x309A)) for c in r)
    return frozenset(chain(map(chr, single()), combining))


def bare(text: str) -> str:
    """A headline in one form of characters, without labels."""
    if not text.isascii() and not _odd().isdisjoint(text):
        text = unicodedata.normalize("NFC", text.translate(single()))
    return without_labels(text)


def tokens(text: str) -> set[str]:
    """The distinct tokens of a bare headline, fillers left out."""
    return set(_TOKEN.findall(text.lower())) - FILLERS


class Title:
    """A bare headline taken apart: its tokens in order, figures marked; small are the words written small, hence no names."""

    __slots__ = ("words", "count", "small")

    def __init__(self, text: str):
        words = []
        small = set()
        for w in _TOKEN.findall(text):
            low = w.lower()
            if w == low:
                small.add(w)
            if low in FILLERS:
                continue
            c = w[0]
            if c.isdigit() or (len(w) < 6 and c in "一二三四五六七八九十百两兩"):
                low = "#" + _number(w)
            elif low in NUMBERS:
                low = "#" + str(NUMBERS[low])
            words.append(low)
        self.words = words
        self.small = small
        self.count = Counter(words)


def respelled(a: str, b: str) -> bool:
    """One letter put in, left out or doubled, or two neighbours exchanged; a letter replaced is for replaced()."""
    if abs(len(a) - len(b)) > 1 or min(len(a), len(b)) < 2:
        return False
    if len(a) == len(b):
        d = [k for k in range(len(a)) if a[k] != b[k]]
        return len(d) == 2 and d[1] == d[0] + 1 and a[d[0]] == b[d[1]] and a[d[1]] == b[d[0]]
    if len(a) > len(b):
        a, b = b, a
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k:] == b[k + 1:]


def replaced(a: str, b: str) -> bool:
    """One letter replaced in a word of some length."""
    return len(a) == len(b) >= MIN_REPLACED and sum(x != y for x, y in zip(a, b)) == 1


def _left_over(t: Title, extra: Counter, other: Title) -> list[int]:
    """The places of the tokens that t has more often; of several occurrences those whose neighbours other lacks."""
    out = []
    pairs = set(zip(other.words, other.words[1:]))
    for w, n in extra.items():
        at = [k for k, x in enumerate(t.words) if x == w]
        if len(at) > n:
            at.sort(key=lambda k: ((k > 0 and (t.words[k - 1], w) in pairs) + (k + 1 < len(t.words) and (w, t.words[k + 1]) in pairs)))
        out += at[:n]
    return sorted(out)


def same_headline(a: Title, b: Title, share: float = 0.4) -> bool:
    """One headline with small edits."""
    more_a, more_b = a.count - b.count, b.count - a.count
    if not more_a and not more_b:
        return True
    if any(w[0] == "#" for w in more_a) and any(w[0] == "#" for w in more_b):
        return False
    ia, ib = ([k for k in _left_over(t, more, o) if t.words[k] not in CJK_FILLERS] for t, more, o in ((a, more_a, b), (b, more_b, a)))
    cost = sum(len(a.words[k]) for k in ia) + sum(len(b.words[k]) for k in ib)
    if cost > share * max(sum(map(len, a.words)), sum(map(len, b.words))) + 6:
        return False
    if not ia or not ib:
        return True
    # respellings answer one another
    free_b = list(ib)
    rest_a = []
    for k in ia:
        w = a.words[k]
        hit = next((m for m in free_b if respelled(w, b.words[m]) or (w in a.small and b.words[m] in b.small and replaced(w, b.words[m]))), None)
        if hit is None:
            rest_a.append(k)
        else:
            free_b.remove(hit)
    if not rest_a or not free_b:
        return True
    gone_a, gone_b = set(ia), set(ib)

    def around(t: Title, gone: set[int], k: int) -> tuple[str | None, str | None]:
        p, q = k - 1, k + 1
        while p in gone:
            p -= 1
        while q in gone:
            q += 1
        return (t.words[p] if p >= 0 else None), (t.words[q] if q < len(t.words) else None)

    places_b = [(around(b, gone_b, m), b.words[m]) for m in free_b]
    for k in rest_a:
        before, after = around(a, gone_a, k)
        for (pb, qb), word in places_b:
            short = min(len(a.words[k]), len(word)) < 3 and a.words[k].isascii()
            if (before == pb or after == qb) and not short:
                return False  # another word in its place
    return True


class _Node:
    __slots__ = ("gram", "above", "children", "items", "only", "longest")

    def __init__(self, gram, above: list, only):
        self.gram, self.above, self.children, self.items, self.only, self.longest = gram, above, None, None, only, 0


class Trie:
    """Token sets, rarest token first: a node per token as far as the prefix that a partner must share in.

    A node with one set below it holds that set itself, so a branch without forks is not walked.
    """

    def __init__(self, share: float):
        self.share, self.root, self.at = share, _Node(None, [], None), defaultdict(list)
        self.needs: dict[int, int] = {}

    def need(self, n: int) -> int:
        """The overlap that a set of n tokens asks for."""
        k = self.needs.get(n)
        if k is None:
            k = self.needs[n] = -(-int(self.share * n * 1000) // 1000)
        return k

    def prefix(self, n: int) -> int:
        """So many of the rarest tokens hold one that a partner shares."""
        return n - self.need(n) + 1

    def add(self, grams: list, item, full: set | None = None, skip: int = 0) -> None:
        """full: the set of grams, if there is one; skip: so many of the first ones are in no other set."""
        node, n, at = self.root, len(grams), self.at
        need = self.need(n)
        leaf = (need, set(grams) if full is None else full, item)
        if skip > n - need:
            return  # nothing shares enough with it
        for d in range(skip, n - need + 1):
            g = grams[d]
            children = node.children
            if children is None:
                children = node.children = {}
            child = children.get(g)
            if child is None:
                child = children[g] = _Node(g, grams[skip:d], leaf)
                at[g].append(child)
            else:
                child.only = None
            node = child
            if node.longest < n - d - 1:
                node.longest = n - d - 1
        if node.items is None:
            node.items = [leaf]
        else:
            node.items.append(leaf)

    def find(self, grams: list, have: set | None = None, skip: int = 0) -> Iterator:
        """Items whose sets overlap with grams in the required share of the larger set; have, skip: as full and skip of add."""
        n, head = len(grams), set()
        have = set(grams) if have is None else have
        need, at = self.need(n), self.at
        for k in range(skip, n - need + 1):
            g = grams[k]
            for start in at.get(g, ()):
                # what stands above in the path and in grams as well would have been met from there
                if start.longest + 1 < need or start.above and head and not head.isdisjoint(start.above):
                    continue
                if start.only is not None:
                    least, full, item = start.only
                    o = len(have & full)
                    if o >= need and o >= least:
                        yield item
                    continue
                stack = [(start, 1)]
                while stack:
                    node, o = stack.pop()
                    for least, full, item in node.items or ():
                        both = len(have & full)
                        if both >= need and both >= least:
                            yield item
                    for child in node.children.values() if node.children else ():
                        oc = o + (child.gram in have)
                        if oc + child.longest >= need:
                            if child.only is None:
                                stack.append((child, oc))
                            else:
                                least, full, item = child.only
                                both = len(have & full)
                                if both >= need and both >= least:
                                    yield item
            head.add(g)


def join_block(rows: list[tuple[str, int, str, bool]], window_us: int, share: float) -> list[tuple[str, str]]:
    """rows (id, time, title, carried) of one block -> links that join what all pairs within the window would join; links of two carried rows belong to the block before."""
    once: dict[str, tuple[int, str, bool]] = {}
    for id, at, title, carried in rows:
        if id not in once or at < once[id][0]:
            once[id] = (at, title, carried)
    sets: dict[str, set[str]] = {}
    made: dict[str, Title] = {}  # only what is compared is taken apart
    items = []
    for id, (at, title, carried) in once.items():
        t = bare(title)
        if t not in sets:
            sets[t] = tokens(t)
        if sets[t]:
            items.append((at, id, t, carried))
    items.sort(key=lambda x: (x[0], x[1]))
    often = Counter(chain.from_iterable(sets.values()))

    def same(a: str, b: str) -> bool:
        for x in (a, b):
            if x not in made:
                made[x] = Title(x)
        return same_headline(made[a], made[b])

    lone = sum(k == 1 for k in often.values())  # so many come first in order
    order = {g: k for k, g in enumerate(sorted(often, key=lambda g: (often[g], g)))}

    def ranked(t: str) -> tuple[list[str], int]:
        """A title's tokens, rarest first, and how many of them no other title has."""
        grams = sorted(sets[t], key=order.__getitem__)
        k = 0
        while k < len(grams) and order[grams[k]] < lone:
            k += 1
        return grams, k

    out = []
    tries: dict[int, tuple[Trie, set[str]]] = {}  # of each stretch the titles that occur in it, once
    latest: dict[str, tuple[int, str, bool]] = {}
    last = None
    for at, id, t, carried in items:
        slot = at // window_us
        if slot != last:
            last = slot
            for s in [s for s in tries if s < slot - 1]:
                del tries[s]
        before = latest.get(t)
        grams = None
        if before and at - before[0] <= window_us:
            if not (carried and before[2]):
                out.append((before[1], id))
        else:
            grams, skip = ranked(t)
            met = {t}
            for s in (slot - 1, slot):
                for t2 in tries[s][0].find(grams, sets[t], skip) if s in tries else ():
                    if t2 not in met:
                        met.add(t2)
                        at2, id2, carried2 = latest[t2]
                        if at - at2 <= window_us and not (carried and carried2) and same(t2, t):
                            out.append((id2, id))
        latest[t] = (at, id, carried)
        if slot not in tries:
            tries[slot] = (Trie(share), set())
        trie, held = tries[slot]
        if t not in held:
            held.add(t)
            if grams is None:
                grams, skip = ranked(t)
            trie.add(grams, t, sets[t], skip)
    return out


def near_pairs(df: DataFrame, text: str = "title", id: str = "id", outlet: str = "source_domain", at: str = "published", hours: int = 36, block_windows: int = 8, share: float = 0.75, block_rows: int = 20_000) -> DataFrame:
    """(a, b): links whose groups are those of all joined pairs; a link may come out more than once."""
    spark = df.sparkSession
    window = hours * 3600 * 1_000_000
    block = F.floor(F.col("at") / (window * block_windows))
    rows = df.select(F.col(id).alias("id"), norm_domain(outlet).alias("outlet"), F.unix_micros(F.col(at).cast("timestamp")).alias("at"), F.col(text).alias("title")).where("id is not null and outlet is not null and at is not null and title <> ''")
    scratch = Scratch(spark, "near")
    counts = df.select(norm_domain(outlet).alias("outlet"), F.floor(F.unix_micros(F.col(at).cast("timestamp")) / (window * block_windows)).alias("block")).where("outlet is not null and block is not null").groupBy("outlet", "block").count().where(F.col("count") > block_rows)
    crowded, n_crowded = scratch.keep_counted(counts.select("outlet", "block", F.ceil(F.col("count") / block_rows * 4).cast("int").alias("parts")), "crowded")
    stars = None
    if n_crowded:
        own = rows.withColumn("block", block)
        title = ["outlet", F.floor(F.col("at") / window).alias("slot"), "title"]
        dense = own.join(crowded.select("outlet", "block"), ["outlet", "block"], "left_semi")
        ends = dense.groupBy(*title).agg(F.min(F.struct("at", "id")).alias("lo"), F.max(F.struct("at", "id")).alias("hi"))
        ends = scratch.keep(ends, "ends")
        stars = dense.select(*title, "id").join(ends.where("lo <> hi").select("outlet", "slot", "title", F.col("lo.id").alias("a")), ["outlet", "slot", "title"]).where("a <> id").select("a", F.col("id").alias("b"))
        few = ends.select("outlet", "title", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("x")).select("x.id", "outlet", "x.at", "title")
        rows = own.join(crowded.select("outlet", "block"), ["outlet", "block"], "left_anti").select("id", "outlet", "at", "title").unionByName(few)
    late = F.floor((F.col("at") + window) / (window * block_windows))
    placed = rows.select("id", "outlet", "at", "title", block.alias("own"), F.explode(F.array_distinct(F.array(block, late))).alias("block"))
    placed = placed.withColumn("carried", F.col("own") < F.col("block")).drop("own")
    schema = "id string, outlet string, at bigint, title string, block bigint, carried boolean, part int"
    names = ["id", "outlet", "at", "title", "block", "carried", "part"]
    single_part = placed.withColumn("part", F.lit(0))
    if n_crowded:
        hot = placed.join(crowded, ["outlet", "block"]).select(*names[:6], "parts")
        single_part = placed.join(crowded, ["outlet", "block"], "left_anti").select(*names[:6], F.lit(0).alias("part"))

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import xxhash

            trie = Trie(share)
            for rb in batches:
                out: list[list] = [[] for _ in names]
                for row in zip(*(rb.column(k).to_pylist() for k in range(7))):
                    ranked = sorted(xxhash.xxh64_intdigest(g) for g in tokens(bare(row[3])))
                    for p in {h % row[6] for h in ranked[: trie.prefix(len(ranked))]}:
                        for c, v in zip(out, (*row[:6], 1 + p)):
                            c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(out, (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.int32()))], names=names)

        single_part = single_part.unionByName(hot.mapInArrow(spread, schema))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = single_part.select(*names).repartition(n, "outlet", "block", "part").sortWithinPartitions("outlet", "block", "part")
    ordered = ordered.select(F.xxhash64("outlet", "block", "part").alias("group"), "id", "at", "title", "carried")  # of the block only its change matters

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group = None, []

        def done() -> pa.RecordBatch:
            pairs = join_block(group, window, share) if len(group) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string())], names=["a", "b"])

        for rb in batches:
            rows = list(zip(*(rb.column(k).to_pylist() for k in range(1, 5))))
            keys = rb.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(rows)]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi > lo:
                    if keys[lo] != key:
                        if len(group) > 1:
                            yield done()
                        key, group = keys[lo], []
                    group += rows[lo:hi]
        if len(group) > 1:
            yield done()

    links = ordered.mapInArrow(join, "a string, b string")
    return links.unionByName(stars) if stars is not None else links
