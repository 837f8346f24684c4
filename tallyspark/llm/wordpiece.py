"""Greedy word-piece token counts by a linear longest-match automaton (operator 7).

The vocabulary trie has a failure link and a pop count in each node: when no
edge fits the next byte, the longest-match tokens of the string read so far are
already known, so the automaton adds their precomputed number and goes on from
the node of the rest. Each byte is read once, without backing up and without
building pieces.

Words are runs without ``[\\x20\\x09-\\x0D]``, each matched as one space plus the
word against a vocabulary whose word starts carry the space (byte-level files).
A word with a byte that no token covers counts as one unknown token.

Defined cases: null, empty and blank texts have 0 words and 0 tokens; words of
any length take linear time; the memo of word counts of a task is bounded.
"""

from __future__ import annotations

import base64
import hashlib

from pyspark.sql import DataFrame

from tallyspark.llm.bpe import read_vocabulary
from tallyspark.llm.common import map_docs

MAX_WORDS = 300_000


class LongestMatch:
    """Automaton over the bytes of a vocabulary."""

    def __init__(self, tokens: list[bytes]):
        self.goto: dict[int, int] = {}     # node * 256 + byte -> node; the root is 0
        ends, parents = [False], []        # parents: (parent, byte) of node i + 1
        for t in sorted(set(tokens), key=len):
            u = 0
            for c in t:
                v = self.goto.get(u << 8 | c)
                if v is None:
                    v = self.goto[u << 8 | c] = len(ends)
                    ends.append(False)
                    parents.append((u, c))
                u = v
            ends[u] = bool(t)
        self.fail = [-1] * len(ends)       # -1: no tokens cover what was read
        self.pops = [0] * len(ends)        # tokens that following the link gives off
        depth = [0] * len(ends)
        for v, (u, _) in enumerate(parents, 1):
            depth[v] = depth[u] + 1
        for v in sorted(range(1, len(ends)), key=depth.__getitem__):
            u, c = parents[v - 1]
            if ends[v]:
                self.fail[v], self.pops[v] = 0, 1
                continue
            z, n = self.fail[u], self.pops[u]
            while z >= 0 and (z << 8 | c) not in self.goto:
                z, n = self.fail[z], n + self.pops[z]
            if z >= 0:
                self.fail[v], self.pops[v] = self.goto[z << 8 | c], n

    def count(self, word: bytes) -> int:
        """Tokens of the greedy longest-match split; -1 if a byte has no token."""
        goto, fail, pops, u, n = self.goto, self.fail, self.pops, 0, 0
        for c in word:
            v = goto.get(u << 8 | c)
            while v is None:
                n += pops[u]
                u = fail[u]
                if u < 0:
                    return -1
                v = goto.get(u << 8 | c)
            u = v
        while u:
            n += pops[u]
            u = fail[u]
            if u < 0:
                return -1
        return n


class Counter(dict):
    """Bounded memo: word -> tokens (-1: unknown)."""

    def __init__(self, tokens: list[bytes], lead: bytes):
        self.match, self.lead = LongestMatch(tokens), lead

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_WORDS:
            self.clear()
        n = self.match.count(self.lead + word)
        if len(word) <= 64:
            self[word] = n
        return n


_counters: dict = {}


def counter_of(raw: bytes, lead: bytes) -> Counter:
    """One memo for each vocabulary and Python worker (kept between tasks)."""
    key = hashlib.sha256(raw).digest(), lead
    if key not in _counters:
        _counters.clear()
        _counters[key] = Counter([base64.b64decode(x.split()[0]) for x in raw.splitlines()], lead)
    return _counters[key]


def wordpiece_counts(docs: DataFrame, vocabulary: str, lead: bytes = b" ") -> DataFrame:
    """doc_id, n_words, n_unknown, n_tokens of each whole text."""
    raw = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(ids: list, texts: list) -> dict:
        get, words, unknown, total = counter_of(raw.value, lead).__getitem__, [], [], []
        for t in texts:
            n = list(map(get, t.split()))
            u = n.count(-1)
            words.append(len(n))
            unknown.append(u)
            total.append(sum(n) + 2 * u)
        return {"doc_id": ids, "n_words": words, "n_unknown": unknown, "n_tokens": total}

    return map_docs(docs, "doc_id bigint,n_words bigint,n_unknown bigint,n_tokens bigint", run, raw=True)
