"""Encoding with a public byte-level BPE vocabulary: speculate and verify.

A text is cut into words by the vocabulary's pattern; the words of a batch are
made distinct.  For every distinct word, greedy longest-match proposes tokens:
the trie of the vocabulary is walked from all byte positions of all words at
once, then all words hop from match to match together.  A proposal is the
BPE encoding exactly when each token and each adjacent pair of tokens encodes
to itself; the pairs of the whole batch are tested together against a table of
pairs already judged, and only pairs not seen before are judged by merging
them.  Words with a failing pair, and only those, are merged exactly.

The vocabulary file is a parameter, read by each worker once, and never copied.

Defined cases: null and empty texts give the empty list; strings that look like
special tokens are ordinary text; texts are encoded whole, however long;
repeated rows give repeated results; other columns are not touched.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Where the public vocabularies lie unless told otherwise.
FOLDER = os.environ.get("EVIDENTIA_TOKENIZERS", "/opt/tokenizers")

# Fixed value: the word pattern of the vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Vocabulary:
    """Ranks of byte strings, their trie in arrays, and the judged pairs."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        import regex

        self.words = regex.compile(PATTERN).findall
        # trie: state 0 is the root; edges sorted by state * 256 + byte
        edges: dict[int, int] = {}
        token_at = [-1]
        longest = 1
        for word, rank in self.ranks.items():
            state = 0
            longest = max(longest, len(word))
            for byte in word:
                key = state * 256 + byte
                nxt = edges.get(key)
                if nxt is None:
                    nxt = len(token_at)
                    edges[key] = nxt
                    token_at.append(-1)
                state = nxt
            token_at[state] = rank
        self.longest = longest
        keys = np.fromiter(edges.keys(), dtype=np.int64, count=len(edges))
        order = np.argsort(keys)
        self.edge_key = keys[order]
        self.edge_to = np.fromiter(edges.values(), dtype=np.int32, count=len(edges))[order]
        self.token_at = np.array(token_at, dtype=np.int32)
        first = np.full(256, -1, dtype=np.int32)
        for b in range(256):
            first[b] = edges.get(b, -1)
        self.first = first
        second = np.full(65536, -1, dtype=np.int32)
        for b in range(256):
            if first[b] >= 0:
                for c in range(256):
                    second[b * 256 + c] = edges.get(int(first[b]) * 256 + c, -1)
        self.second = second
        self.bytes_of: list[bytes] = [b""] * (max(self.ranks.values()) + 1)
        for word, rank in self.ranks.items():
            self.bytes_of[rank] = word
        # tokens that do not encode to themselves fail every pair they are in
        self.judged_key = np.empty(0, dtype=np.int64)
        self.judged_ok = np.empty(0, dtype=bool)
        self.sound = np.zeros(len(self.bytes_of), dtype=np.int8)  # 0 unknown, 1 encodes to itself, -1 does not

    def merge(self, word: bytes) -> list[int]:
        """Exact byte-pair merging."""
        ranks = self.ranks
        if len(word) > 200:
            return self._merge_long(word)
        parts = [word[i: i + 1] for i in range(len(word))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at: at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def _merge_long(self, word: bytes) -> list[int]:
        """The same by a heap over linked parts, in n log n."""
        import heapq

        ranks, n = self.ranks, len(word)
        part: list[bytes | None] = [word[i: i + 1] for i in range(n)]
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, part[i], part[i + 1]) for i in range(n - 1) if (r := ranks.get(part[i] + part[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if part[i] != a or j >= n or part[j] != b:
                continue
            part[i], part[j] = a + b, None
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
                if (r := ranks.get(part[i] + part[nxt[i]])) is not None:
                    heapq.heappush(heap, (r, i, part[i], part[nxt[i]]))
            if prv[i] >= 0 and (r := ranks.get(part[prv[i]] + part[i])) is not None:
                heapq.heappush(heap, (r, prv[i], part[prv[i]], part[i]))
        return [ranks[p] for p in part if p is not None]

    def judge(self, pairs: np.ndarray) -> np.ndarray:
        """For distinct sorted pair keys (left * 2**32 + right) whether the pair encodes to itself."""
        at = np.searchsorted(self.judged_key, pairs)
        known = (at < len(self.judged_key)) & (self.judged_key[np.minimum(at, max(0, len(self.judged_key) - 1))] == pairs) if len(self.judged_key) else np.zeros(len(pairs), bool)
        ok = np.zeros(len(pairs), bool)
        ok[known] = self.judged_ok[at[known]]
        fresh = np.flatnonzero(~known)
        for k in fresh:
            a, b = int(pairs[k]) >> 32, int(pairs[k]) & 0xFFFFFFFF
            ok[k] = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        if len(fresh) and len(self.judged_key) < 4_000_000:  # the table of judged pairs is a cache of bounded size
            self.judged_key = np.insert(self.judged_key, at[fresh], pairs[fresh])  # both are sorted
            self.judged_ok = np.insert(self.judged_ok, at[fresh], ok[fresh])
        return ok

    def propose(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest-match tokens of all words, and the word each belongs to, in order of word and place."""
        data = np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int64)
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        end = np.cumsum(size)
        stop = np.repeat(end, size)
        n = len(data)
        at = np.arange(n)
        state = self.first[data]
        length, token = np.ones(n, dtype=np.int64), self.token_at[state]
        # the second byte by a direct table, later ones by search among the edges
        live = at[at + 1 < stop]
        state2 = self.second[data[live] * 256 + data[live + 1]]
        live, state = live[state2 >= 0], state2[state2 >= 0]
        depth = 2
        while len(live):
            t = self.token_at[state]
            hit = t >= 0
            length[live[hit]], token[live[hit]] = depth, t[hit]
            go = live + depth < stop[live]
            live, state = live[go], state[go]
            if not len(live):
                break
            key = state.astype(np.int64) * 256 + data[live + depth]
            k = np.searchsorted(self.edge_key, key)
            k = np.minimum(k, len(self.edge_key) - 1)
            found = self.edge_key[k] == key
            live, state = live[found], self.edge_to[k[found]]
            depth += 1
        # all words hop together
        pos, word = end - size, np.arange(len(words))
        alive = size > 0
        pos, word = pos[alive], word[alive]
        chosen = np.zeros(n, dtype=bool)
        while len(pos):
            chosen[pos] = True
            pos = pos + length[pos]
            go = pos < end[word]
            pos, word = pos[go], word[go]
        place = np.flatnonzero(chosen)
        return token[place].astype(np.int64), np.repeat(np.arange(len(words)), size)[place]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The encodings of distinct words."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        token, word = self.propose(raw)
        bad = np.zeros(len(words), dtype=bool)
        if len(token) > 1:
            inner = word[1:] == word[:-1]
            left, right, owner = token[:-1][inner], token[1:][inner], word[1:][inner]
            pairs, back = np.unique((left << 32) | right, return_inverse=True)
            ok = self.judge(pairs)
            bad[owner[~ok[back]]] = True
        # a token that stands alone: does it encode to itself?
        for t in np.unique(token):
            if not self.sound[t]:
                self.sound[t] = 1 if self.merge(self.bytes_of[t]) == [int(t)] else -1
        bad[word[self.sound[token] < 0]] = True
        counts = np.bincount(word, minlength=len(words))
        cut = np.concatenate([[0], np.cumsum(counts)])
        flat = token.tolist()
        return [self.merge(raw[k]) if bad[k] else flat[cut[k]: cut[k + 1]] for k in range(len(words))]


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of this worker."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


class Encoder:
    """Encodes texts batch by batch, keeping the encodings of words in a cache of bounded size."""

    def __init__(self, path: str, most_words: int = 300_000):
        self.v, self.cache, self.most = vocabulary(path), {}, most_words

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        split = [self.v.words(t) if t else [] for t in texts]
        new = list({w for ws in split for w in ws} - self.cache.keys())
        if len(self.cache) + len(new) > self.most:
            self.cache = {}
            new = list({w for ws in split for w in ws})
        for lo in range(0, len(new), 20_000):
            some = new[lo: lo + 20_000]
            self.cache.update(zip(some, self.v.encode_words(some)))
        cache = self.cache
        return [[t for w in ws for t in cache[w]] for ws in split]


def encode(df: DataFrame, text: str = "text", id: str = "doc_id", vocabulary_file: str = "byte_bpe_50k.tiktoken", folder: str = FOLDER, most_chars: int = 2_000_000) -> DataFrame:
    """(id, ids array<int>) for every row of df."""
    path = f"{folder}/{vocabulary_file}"
    kind = df.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(path)
        for rb in batches:
            texts = rb.column(1).to_pylist()
            lo = 0
            while lo < len(texts):  # steps of bounded text, so that a batch of long texts keeps little in memory
                hi, chars = lo, 0
                while hi < len(texts) and (hi == lo or chars < most_chars):
                    chars += len(texts[hi] or "")
                    hi += 1
                ids = enc.encode(texts[lo:hi])
                yield pa.RecordBatch.from_arrays([rb.column(0).slice(lo, hi - lo), pa.array(ids, type=pa.list_(pa.int32()))], names=[id, "ids"])
                lo = hi

    return df.select(id, text).mapInArrow(run, f"{id} {kind}, ids array<int>")
