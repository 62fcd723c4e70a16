"""Encoding texts by a public byte-level BPE vocabulary.

Speculate and verify: a word's tokens are proposed by greedy longest match. A sequence
of tokens is the one that merging gives if each token is what its own bytes merge to
and each two neighbours, merged together, stay apart. So verdicts on neighbours are
all the proof needed; they are kept per pair and looked up for all words of a batch at
once, and only a word with a failing pair is merged exactly.
"""

from __future__ import annotations

import base64
import importlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEPT = 400_000


class Encoder:
    """Encodes by the ranks in ``path`` (a file of base64 tokens and ranks)."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.bytes_of = {i: t for t, i in self.ranks.items()}
        self.longest = max(map(len, self.ranks))
        self.split = regex.compile(pattern).findall
        self.base = max(self.bytes_of) + 1
        self.words: dict[str, list[int]] = {}
        self.pairs: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}
        self.merged = 0

    def merge(self, data: bytes) -> list[int]:
        """The exact merging: the pair of lowest rank first, the leftmost of equals."""
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            pair, out, i = parts[at] + parts[at + 1], [], 0
            left, right = parts[at], parts[at + 1]
            while i < len(parts):
                if i + 1 < len(parts) and parts[i] == left and parts[i + 1] == right:
                    out.append(pair)
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return [ranks[p] for p in parts]

    def merge_long(self, data: bytes) -> list[int]:
        """The same for long words, by a heap over a linked list."""
        import heapq

        n = len(data)
        if n < 64:
            return self.merge(data)
        part = [data[i : i + 1] for i in range(n)]
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        alive = [True] * n
        ranks = self.ranks
        heap = [(r, i, part[i] + part[i + 1]) for i in range(n - 1) if (r := ranks.get(part[i] + part[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = right[i] if alive[i] else n
            if j >= n or not alive[i] or part[i] + part[j] != pair:
                continue
            part[i], alive[j], right[i] = pair, False, right[j]
            if right[j] < n:
                left[right[j]] = i
            for k in (left[i], i):
                if k >= 0 and right[k] < n and (r := ranks.get(part[k] + part[right[k]])) is not None:
                    heapq.heappush(heap, (r, k, part[k] + part[right[k]]))
        return [ranks[part[i]] for i in range(n) if alive[i]]

    def propose(self, data: bytes) -> list[int]:
        out, at, ranks = [], 0, self.ranks
        while at < len(data):
            for end in range(min(len(data), at + self.longest), at, -1):
                r = ranks.get(data[at:end])
                if r is not None:
                    out.append(r)
                    at = end
                    break
        return out

    def _stands(self, token: int) -> bool:
        got = self.whole.get(token)
        if got is None:
            got = self.whole[token] = self.merge_long(self.bytes_of[token]) == [token]
        return got

    def _verdict(self, code: int) -> bool:
        a, b = divmod(code, self.base)
        return self._stands(a) and self._stands(b) and self.merge_long(self.bytes_of[a] + self.bytes_of[b]) == [a, b]

    def learn(self, words: list[str]) -> None:
        """Encode all ``words`` that are not known yet."""
        datas = [w.encode("utf-8", "surrogatepass") for w in words]
        proposals = [[r] if (r := self.ranks.get(d)) is not None else self.propose(d) for d in datas]
        lengths = np.fromiter(map(len, proposals), np.int64, len(proposals))
        flat = np.fromiter((t for p in proposals for t in p), np.int64, int(lengths.sum()))
        owner = np.repeat(np.arange(len(words)), lengths)
        codes = flat[:-1] * self.base + flat[1:]
        inside = owner[:-1] == owner[1:]
        codes, of = codes[inside], owner[:-1][inside]
        unique, back = np.unique(codes, return_inverse=True)
        good = np.fromiter((self._pair(int(c)) for c in unique), bool, len(unique))
        failing = np.zeros(len(words), bool)
        failing[of[~good[back]]] = True
        single = np.flatnonzero(lengths == 1)
        for i in single:
            failing[i] |= not self._stands(proposals[i][0])
        for i in np.flatnonzero(failing):
            proposals[i] = self.merge_long(datas[i])
            self.merged += 1
        self.words.update(zip(words, proposals, strict=True))

    def _pair(self, code: int) -> bool:
        got = self.pairs.get(code)
        if got is None:
            if len(self.pairs) > KEPT:
                self.pairs.clear()
            got = self.pairs[code] = self._verdict(code)
        return got

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text; null and empty texts give none. Strings that look like special tokens are ordinary text."""
        cut = [self.split(t) if t else [] for t in texts]
        if len(self.words) > KEPT:
            self.words.clear()
        fresh = list(dict.fromkeys(w for c in cut for w in c if w not in self.words))
        if fresh:
            self.learn(fresh)
        words = self.words
        return [[i for w in c for i in words[w]] for c in cut]


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """One encoder per worker process and file."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(path, pattern)
    return _ENCODERS[path, pattern]


def public_vocabulary(name: str = "byte_bpe_50k.tiktoken", module: str = "public_tokenizers") -> tuple[str, str]:
    """Path and word pattern of a vocabulary of the installed public tokenizers."""
    found = importlib.import_module(module)
    return found.path(name), found.PATTERN


def _run(path: str, pattern: str, count: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path, pattern)
        for pdf in batches:
            for at in range(0, len(pdf), 512):
                part = pdf.iloc[at : at + 512]
                texts = [t if isinstance(t, str) else "" for t in part["_text"]]
                ids = enc.encode_batch(texts)
                yield part.drop(columns="_text").assign(_ids=[len(i) for i in ids] if count else ids)

    return run


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: tuple[str, str] | None = None, count: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """``key, ids`` (or ``key, n_tokens``) of each row, repeated rows included, and the columns ``keep``.

    A null and an empty text give an empty list (0 tokens). Texts are taken whole, of any length.
    """
    path, pattern = vocabulary or public_vocabulary()
    carried = [F.col(key).alias("_key"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(keep)]]
    rows = df.select(*carried, F.col(text).alias("_text"))
    out = "n_tokens" if count else "ids"
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text")
    made = rows.mapInPandas(_run(path, pattern, count), f"{schema}, _ids {'int' if count else 'array<int>'}")
    return made.select(F.col("_key").alias(key), F.col("_ids").alias(out), *[F.col(f"_c{i}").alias(c) for i, c in enumerate(keep)])
