"""Language of texts and of the segments of mixed texts: error-correcting output codes.

Every language has a codeword of ``BITS`` bits.  For each bit a binary
classifier over hashed character n-grams (orders 1 to 3, log-odds of the
languages whose bit is set against the others) predicts its value with a
margin.  A text, or a segment of one, gets the language whose codeword has the
smallest loss, the logistic loss of each bit's margin weighted by how reliable
that bit was on held-out rows; the softmax over the losses is the confidence,
and a small lead over the second codeword flags the text as ambiguous.

A mixed text is cut where cuts raise the summed codeword score: margins are
sums over n-grams, so prefix sums over words give the score of every single cut of
all texts of a batch at once.  Where more cuts could gain still more, the best
sequence of languages over the words is found by dynamic programming, each change
of language costing ``gain``, so a text may have any number of segments.  A
segment is a clause of its own: at least ``min_words`` blank-separated words or
``min_chars`` characters of a script without blanks; a name in another script is
none.

Confidences are calibrated: the losses are divided by the temperature under which
held-out rows, whole and cut to their first words, are likeliest.

The classifiers are fitted on a bounded sample of labelled rows (``per_language``
rows of each language at most, chosen by hash of the text over the whole table),
twice: rows that the first fit contradicts are left out of the second.

Defined cases: null, empty or letterless texts have no segment; a null, empty or
unknown label names no language; repeated rows are classified alike; texts are
scored whole, however long; an empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.llm.characters import single

LANGUAGES = ["en", "zh", "ko", "ja", "fr", "de", "es", "th"]
BUCKETS = 1 << 16

# Three-letter names of the languages.
THREE = {"eng": "en", "zho": "zh", "chi": "zh", "cmn": "zh", "kor": "ko", "jpn": "ja", "fra": "fr", "fre": "fr", "deu": "de", "ger": "de", "spa": "es", "tha": "th"}


def codewords(bits: int = 15) -> np.ndarray:
    """Rows of +1/-1 for the languages: of the non-constant splits of the languages those, chosen one by one, that keep the smallest distance between two rows largest."""
    n = len(LANGUAGES)
    splits = [np.array([1 if (s >> k) & 1 else -1 for k in range(n)]) for s in range(1, 1 << (n - 1))]
    splits = [s for s in splits if abs(s.sum()) <= 2]
    chosen: list[np.ndarray] = []
    apart = np.zeros((n, n))
    upper = np.triu_indices(n, 1)
    for _ in range(bits):
        k = max(range(len(splits)), key=lambda i: (np.sort((apart + (splits[i][:, None] != splits[i][None, :]))[upper]).tolist()[:6], -i))
        s = splits.pop(k)
        apart += s[:, None] != s[None, :]
        chosen.append(s)
    return np.array(chosen).T.astype(np.float32)


def label_language(label: Column | str) -> Column:
    """The language a label names, whatever its region, script, case and length; null if it names none."""
    label = F.col(label) if isinstance(label, str) else label
    base = F.regexp_extract(F.lower(F.trim(label)), "^([a-z]{2,3})(?:[-_].*)?$", 1)
    out = F.when(base.isin(*LANGUAGES), base)
    for three, two in THREE.items():
        out = out.when(base == three, two)
    return out


def _clean(text: str) -> str:
    return text.lower() if text.isascii() else unicodedata.normalize("NFC", text.translate(single())).lower()


class _Batch:
    """Texts of a batch as one array of code points, its n-gram buckets, words and where they begin."""

    def __init__(self, texts: list[str]):
        joined = "".join("\n" + t for t in texts) + "\n"
        cp = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        cp[(cp >= 48) & (cp <= 57)] = 48
        self.cp = cp
        n = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
        self.start = np.concatenate([[0], np.cumsum(n)])[:-1]  # of each text's leading separator
        self.end = self.start + n
        h1 = cp * 0x9E3779B1
        p1, p2 = np.roll(cp, 1), np.roll(cp, 2)
        h2 = h1 ^ (p1 * 0x85EBCA77 + 0x1234567)
        h3 = h2 ^ (p2 * 0xC2B2AE3D + 0x7654321)
        self.grams = [((h * 0x27D4EB2F165667C5) >> 40) & (BUCKETS - 1) for h in (h1, h2, h3)]
        # script: 0 none, 1 alphabetic with blanks, 2 Han and Kana, 3 Hangul, 4 Thai
        s = np.zeros(len(cp), dtype=np.int8)
        s[((cp >= 97) & (cp <= 122)) | ((cp >= 0xC0) & (cp < 0x250) & (cp != 0xD7) & (cp != 0xF7))] = 1
        s[((cp >= 0x3040) & (cp <= 0x30FF)) | ((cp >= 0x3400) & (cp <= 0x9FFF)) | ((cp >= 0x20000) & (cp < 0x32000))] = 2
        s[(cp >= 0xAC00) & (cp <= 0xD7A3)] = 3
        s[(cp >= 0x0E00) & (cp <= 0x0E7F)] = 4
        self.script = s


def _fit(texts: list[str], labels: np.ndarray, code: np.ndarray) -> np.ndarray:
    """(BUCKETS, BITS) log-odds."""
    b = _Batch(texts)
    lang = np.repeat(labels, b.end - b.start)
    lang = np.concatenate([lang, [-1]])
    count = np.zeros((len(LANGUAGES), BUCKETS))
    keep = (lang >= 0) & (b.script > 0)
    for g in b.grams:
        np.add.at(count, (lang[keep], g[keep]), 1)
    total = count.sum(1, keepdims=True)
    seen = total[:, 0] > 0
    share = np.where(seen[:, None], (count + 0.5 / BUCKETS) / (total + 0.5), 0)
    w = np.zeros((BUCKETS, code.shape[1]), dtype=np.float32)
    floor = 1e-6
    for k in range(code.shape[1]):
        pos, neg = seen & (code[:, k] > 0), seen & (code[:, k] < 0)
        if pos.any() and neg.any():
            w[:, k] = np.log(share[pos].max(0) + floor) - np.log(share[neg].max(0) + floor)  # the likeliest language of either side: a mean would favour the side with more languages of a script
    return w


class Model:
    """Weights of the bit classifiers, reliability of the bits, and the codewords."""

    def __init__(self, weights: np.ndarray, reliability: np.ndarray, code: np.ndarray, temperature: float = 1.0):
        self.weights, self.reliability, self.code, self.temperature = weights, reliability, code, temperature

    def margins(self, b: _Batch) -> np.ndarray:
        """(code points, BITS): each position's share of the margins."""
        on = b.script > 0
        out = np.zeros((len(b.cp), self.code.shape[1]), dtype=np.float32)
        at = np.flatnonzero(on)
        acc = self.weights[b.grams[0][at]]
        acc += self.weights[b.grams[1][at]]
        acc += self.weights[b.grams[2][at]]
        out[at] = acc
        return out

    def decode(self, margin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language index, confidence and lead of summed margins (rows, BITS) over so many positions."""
        p = self.chances(self.losses(margin, length), self.temperature)
        two = np.sort(p, 1)[:, -2:]
        return p.argmax(1), two[:, 1], two[:, 1] - two[:, 0]

    def losses(self, margin: np.ndarray, length: np.ndarray) -> np.ndarray:
        scaled = margin / np.sqrt(np.maximum(length, 1))[:, None]
        return np.stack([(self.reliability * np.logaddexp(0, -self.code[k] * scaled)).sum(1) for k in range(len(self.code))], 1)

    @staticmethod
    def chances(loss: np.ndarray, temperature: float) -> np.ndarray:
        p = np.exp(-(loss - loss.min(1, keepdims=True)) / temperature)
        return p / p.sum(1, keepdims=True)

    def sums(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Summed margins and number of letters of whole texts."""
        b = _Batch(texts)
        return np.add.reduceat(self.margins(b), b.start), np.add.reduceat((b.script > 0).astype(np.int64), b.start)


def beginnings(text: str) -> list[str]:
    """A text and its first words (or, of a script without blanks, characters): what short segments look like."""
    words = text.split()
    return [text, *(" ".join(words[:k]) for k in (1, 2, 3) if len(words) > k), *(text[:k] for k in (2, 4, 8) if len(words) <= 3 and len(text) > k)]


def fit(df: DataFrame, text: str = "title", label: str = "lang", per_language: int = 2000, bits: int = 15) -> Model:
    """A model from a bounded sample of the labelled rows of df."""
    rows = df.select(F.col(text).alias("t"), label_language(label).alias("l")).where("t is not null and l is not null")
    counts = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per language
    take = F.lit(False)
    for lang, n in counts.items():
        take = take | ((F.col("l") == lang) & (F.pmod(F.xxhash64("t"), F.lit(1_000_003)) < int(1_000_003 * min(1.0, per_language / n))))
    code = codewords(bits)
    sample = rows.where(take).limit(2 * per_language * len(LANGUAGES)).toPandas()
    texts = [_clean(t) for t in sample["t"]]
    labels = np.array([LANGUAGES.index(x) for x in sample["l"]], dtype=np.int64)
    if not texts:
        return Model(np.zeros((BUCKETS, bits), np.float32), np.ones(bits), code)
    model = Model(_fit(texts, labels, code), np.ones(bits), code)
    b = _Batch(texts)
    sums = np.add.reduceat(model.margins(b), b.start)
    length = np.add.reduceat((b.script > 0).astype(np.int64), b.start)
    agree = model.decode(sums, length)[0] == labels
    index = np.flatnonzero(agree)
    test = index[::5]
    train = np.setdiff1d(index, test)
    second = Model(_fit([texts[i] for i in train], labels[train], code), np.ones(bits), code) if len(train) else model
    if len(test):
        bt = _Batch([texts[i] for i in test])
        f = np.add.reduceat(second.margins(bt), bt.start)
        right = (np.sign(f) == code[labels[test]]).mean(0)
        second.reliability = np.clip(2 * right - 1, 0.05, 1) ** 2
        second.temperature = _temperature(second, [texts[i] for i in test], labels[test])
    return second


def _temperature(model: Model, texts: list[str], labels: np.ndarray) -> float:
    """The temperature under which the labels of the texts and of their beginnings are likeliest."""
    parts = [(b, l) for t, l in zip(texts, labels) for b in beginnings(t)]
    margin, length = model.sums([b for b, _ in parts])
    want, some = np.array([l for _, l in parts]), length > 0
    loss = model.losses(margin, length)[some]
    grid = np.geomspace(0.25, 32, 50)
    return float(min(grid, key=lambda t: -np.log(np.maximum(model.chances(loss, t)[np.arange(some.sum()), want[some]], 1e-12)).sum()))


def best_languages(score: np.ndarray, gain: float) -> np.ndarray:
    """The language of each word that makes the sum of scores (words, languages) less gain per change largest."""
    best, back = score[0].copy(), []
    for w in range(1, len(score)):
        k = int(best.argmax())
        change = best[k] - gain > best
        back.append((change, k))
        best = np.where(change, best[k] - gain, best) + score[w]
    out = [int(best.argmax())]
    for change, k in reversed(back):
        out.append(k if change[out[-1]] else out[-1])
    return np.array(out[::-1])


def runs_of_clauses(score: np.ndarray, clause: Callable[[int, int], bool], gain: float) -> list[int]:
    """The first words of the segments: runs of best_languages; one that is no clause, or gains too little, joins the neighbour it costs least with."""
    lang = best_languages(score, gain)
    total = np.concatenate([np.zeros((1, score.shape[1])), np.cumsum(score, 0)])
    top = lambda i, j: float((total[j] - total[i]).max())
    cuts = [0, *(np.flatnonzero(np.diff(lang)) + 1).tolist(), len(score)]
    while len(cuts) > 2:
        spans = list(zip(cuts, cuts[1:]))
        worth = [top(a, b) + top(b, c) - top(a, c) for (a, b), (_, c) in zip(spans, spans[1:])]
        weak = [k for k, w in enumerate(worth) if w <= gain]
        short = [k for k, (a, b) in enumerate(spans) if not clause(a, b)]
        near = {k for s in short for k in (s - 1, s) if 0 <= k < len(worth)}
        some = weak or sorted(near)
        if not some:
            break
        del cuts[min(some, key=worth.__getitem__) + 1]
    return cuts[:-1]


def segment_batch(model: Model, texts: list[str], min_words: int = 3, min_letters: int = 12, min_chars: int = 5, gain: float = 450.0) -> tuple[np.ndarray, list[list[tuple[str, int, float, bool]]]]:
    """For every text its segments: (text, language index, confidence, ambiguous)."""
    b = _Batch(texts)
    m = model.margins(b)
    blank = (b.cp == 32) | (b.cp == 10)
    # words: from a blank on, or from a change between an alphabetic and an ideographic script on
    script = b.script
    last = np.maximum.accumulate(np.where(script > 0, np.arange(len(script)), 0))
    before = script[np.concatenate([[0], last[:-1]])]
    change = (script > 0) & (before > 0) & (script != before)
    first = blank | change
    first[b.start] = True
    at = np.flatnonzero(first[:-1])
    of = np.searchsorted(b.start, at, side="right") - 1  # the text of each word
    unit = np.add.reduceat(m[:-1], at)
    score = unit @ model.code.T
    total = np.cumsum(score, 0)
    begin = np.searchsorted(at, b.start)  # first word of each text
    stop = np.concatenate([begin[1:], [len(at)]]) - 1
    base = np.where((begin > 0)[:, None], total[begin - 1], 0)
    whole = total[stop] - base
    left = total - base[of]
    right = whole[of] - left
    best = left.max(1) + right.max(1) - whole.max(1)[of]

    # what stands on each side: letters, words with letters, characters of scripts without blanks
    letters = (script[:-1] == 1) | (script[:-1] == 3)
    n_letters = np.cumsum(np.add.reduceat(letters.astype(np.int64), at))
    n_words = np.cumsum((np.add.reduceat(letters.astype(np.int64), at) > 0).astype(np.int64))
    n_ideo = np.cumsum(np.add.reduceat((script[:-1] == 2).astype(np.int64), at))

    def zero(c: np.ndarray) -> np.ndarray:
        return np.where(begin > 0, c[begin - 1], 0)

    def clause(w: np.ndarray, l: np.ndarray, i: np.ndarray) -> np.ndarray:
        return ((w >= min_words) & (l >= min_letters)) | ((l >= min_chars) & (w >= 2) & (l < 40) & hangul) | (i >= min_chars)

    hangul = np.maximum.reduceat((script[:-1] == 3).astype(np.int8), b.start)[of] > 0
    lw, ll, li = n_words - zero(n_words)[of], n_letters - zero(n_letters)[of], n_ideo - zero(n_ideo)[of]
    rw, rl, ri = (n_words[stop] - zero(n_words))[of] - lw, (n_letters[stop] - zero(n_letters))[of] - ll, (n_ideo[stop] - zero(n_ideo))[of] - li
    ok = clause(lw, ll, li) & clause(rw, rl, ri) & (left.argmax(1) != right.argmax(1))
    best = np.where(ok, best, -np.inf)
    peak = np.maximum.reduceat(best, begin)
    cut = np.full(len(texts), -1)
    hit = np.flatnonzero((best == peak[of]) & np.isfinite(best) & (best > gain))
    cut[of[hit][::-1]] = hit[::-1]

    # texts where further cuts could gain more than this one, by what every word on its own would score
    loose = np.add.reduceat(score.max(1), begin) - whole.max(1)
    more = np.flatnonzero(loose > gain + np.maximum(gain, np.where(cut >= 0, peak, 0)))
    n_before = [np.concatenate([[0], c]) for c in (n_words, n_letters, n_ideo)]
    firsts: dict[int, list[int]] = {}
    for t in more.tolist():
        lo, hi = begin[t], stop[t] + 1

        def is_clause(i: int, j: int) -> bool:
            w, l, c = (x[lo + j] - x[lo + i] for x in n_before)
            return bool((w >= min_words and l >= min_letters) or (min_chars <= l < 40 and w >= 2 and hangul[lo]) or c >= min_chars)

        found = runs_of_clauses(score[lo:hi], is_clause, gain)
        if len(found) > 2:
            firsts[t] = [int(lo + k) for k in found]

    # spans of words: one or two a text, or as many as were found
    seg_text, seg_lo, seg_hi = [], [], []
    for t, (lo, c, hi) in enumerate(zip(begin.tolist(), cut.tolist(), (stop + 1).tolist())):
        edges = firsts.get(t) or ([lo, c + 1] if c >= 0 and c + 1 < hi else [lo])
        seg_text += [t] * len(edges)
        seg_lo += edges
        seg_hi += [*edges[1:], hi]
    lo, hi = np.array(seg_lo), np.array(seg_hi)
    run = np.concatenate([np.zeros((1, m.shape[1])), np.cumsum(unit, 0, dtype=np.float64)])
    lettered = np.concatenate([[0], np.cumsum(np.add.reduceat((script[:-1] > 0).astype(np.int64), at))])
    k = lettered[hi] - lettered[lo]
    lang, conf, lead = (x.tolist() for x in model.decode(run[hi] - run[lo], k))
    at_end = np.concatenate([at, [b.end[-1]]])
    out: list[list[tuple[str, int, float, bool]]] = [[] for _ in texts]
    ends: dict[int, tuple[int, int]] = {}
    for t, i, j, n, g, c, d in zip(seg_text, at_end[lo].tolist(), at_end[hi].tolist(), k.tolist(), lang, conf, lead):
        if not n:
            continue
        first = b.start[t] + 1
        if out[t] and out[t][-1][1] == g:  # the same language on either side: one segment
            i = ends[t][0]
            c, d = min(c, out[t].pop()[2]), d
        ends[t] = (i, j)
        out[t].append((texts[t][max(0, i - first): j - first].strip(), g, c, d < 0.2))
    return cut, out


def identify(df: DataFrame, model: Model, text: str = "title", id: str = "id", label: str = "lang") -> DataFrame:
    """One row per segment: id, label, seg_no, segment, lang, confidence, ambiguous."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)  # of fixed size: BUCKETS x BITS weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for rb in batches:
            ids, texts, labels = (rb.column(k).to_pylist() for k in range(3))
            for lo in range(0, len(ids), 1024):
                some = [_clean(t) for t in texts[lo: lo + 1024]]
                if not some:
                    continue
                _, parts = segment_batch(m, some)
                cols: list[list] = [[] for _ in range(7)]
                for k, ps in enumerate(parts):
                    for no, (seg, lang, conf, amb) in enumerate(ps):
                        for c, v in zip(cols, (ids[lo + k], labels[lo + k], no, seg, LANGUAGES[lang], round(conf, 4), amb)):
                            c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.float64(), pa.bool_()))], names=["id", "label", "seg_no", "segment", "lang", "confidence", "ambiguous"])

    rows = df.select(F.col(id).cast("string").alias("id"), F.col(text).alias("text"), label_language(label).alias("label")).where("text is not null")
    return rows.mapInArrow(run, "id string, label string, seg_no int, segment string, lang string, confidence double, ambiguous boolean")
