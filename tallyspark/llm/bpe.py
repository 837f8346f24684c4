"""Byte-level BPE by prefix dynamic programming (operator 4).

The BPE encoding of a byte string ends in one definite last token, and cutting
that token off leaves the encoding of the shorter prefix. So it's enough to
store the last token of each prefix: it is the one vocabulary suffix ``t`` of
the prefix for which (last token of the rest, ``t``) is a valid neighbour pair,
that is, merging the bytes of the pair anew gives the pair back. Appending bytes
only extends the table; after an edit the table is computed anew from the edit
until it agrees with the old one over a window as long as the longest token.

A text is split by the tokenizer's pattern and each piece encoded separately,
as the tiktoken library does. Pieces share the table of their common prefixes.

Defined cases: null and empty texts have no tokens; texts of any length work
(long pieces use a table by position, short ones one by prefix); the memo tables
of a task are emptied when they reach a fixed size, and when its worker goes on
to other work, so memory stays bounded.
"""

from __future__ import annotations

import base64
import hashlib

import regex
from pyspark.sql import DataFrame

from tallyspark.llm.common import keep_between_tasks, map_docs

MAX_PIECES = 150_000   # memo entries of a task: pieces (twice as many are held),
MAX_PAIRS = 100_000    # neighbour pairs,
MAX_HEADS = 50_000     # and tables of prefixes
HEAD = 6               # bytes of a prefix whose table is shared
SHORT = 48             # characters up to which a piece is remembered


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class PrefixBPE:
    """Encoder of byte strings for ranks that hold all 256 bytes and reach each token by merges."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.size = {i: len(t) for t, i in ranks.items()}
        self.name = {i: str(i) for i in ranks.values()}
        self.longest = max(map(len, ranks))
        self.forget()
        # The two tokens whose merge makes a token: the one split whose halves stay apart until then.
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for t, r in sorted(ranks.items(), key=lambda x: x[1]):
            self.halves[r] = None
            for k in range(1, len(t)):
                x, y = ranks.get(t[:k], r), ranks.get(t[k:], r)
                if x < r and y < r and self.apart(x, y):
                    self.halves[r] = x, y
                    self.joined[x, y] = r
                    break
            if self.halves[r] is None and len(t) > 1:
                raise ValueError("a token isn't reached by merges")

    def forget(self) -> None:
        """Empty what grew with the pieces."""
        self.heads: dict[bytes, tuple] = {}
        self.known: dict[tuple[int, int], bool] = {}

    def apart(self, a: int, b: int) -> bool:
        """Whether merging the bytes of two tokens by rank gives the two back.

        Undoes the merges beside the border from the last to the first. A pair
        that met at the border existed until ``limit``; a merge of it with a
        lower rank would have come before.
        """
        halves, joined, limit = self.halves, self.joined, 1 << 60
        while True:
            if joined.get((a, b), 1 << 60) < limit:
                return False
            x, y = halves[a], halves[b]
            if y is not None and (x is None or b >= a):   # of equal ranks the left one merges first
                limit, b = b + 1, y[0]
            elif x is not None:
                limit, a = a, x[1]
            else:
                return True

    def valid(self, a: int, b: int) -> bool:
        ok = self.known.get((a, b))
        if ok is None:
            if len(self.known) >= MAX_PAIRS:
                self.known.clear()
            ok = self.known[a, b] = self.apart(a, b)
        return ok

    # The table of a byte string: the last token of each of its prefixes.

    def extend(self, b: bytes, table: list[int]) -> list[int]:
        """Table of ``b`` from the table of a prefix of it (an exact append)."""
        table = list(table)
        self._grow(b, table, len(b))
        return table

    def _grow(self, b: bytes, table: list[int], n: int) -> None:
        get, size, held, valid, longest = self.ranks.get, self.size, self.known.get, self.valid, self.longest
        for e in range(len(table) + 1, n + 1):
            # Only one suffix is valid, so the likeliest may be tried first: the last token with one more byte.
            m = size[table[-1]] + 1 if table else 1
            t = get(b[e - m:e])
            if t is not None:
                if m == e:
                    table.append(t)
                    continue
                pair = table[e - m - 1], t
                ok = held(pair)
                if valid(*pair) if ok is None else ok:
                    table.append(t)
                    continue
            for m in range(1, min(e, longest) + 1):
                t = get(b[e - m:e])
                if t is not None:
                    if m == e:
                        break
                    pair = table[e - m - 1], t
                    ok = held(pair)
                    if valid(*pair) if ok is None else ok:
                        break
            else:
                raise ValueError("the vocabulary lacks a byte")
            table.append(t)

    def table(self, b: bytes) -> list[int]:
        """Table of a piece; the tables of short prefixes are shared by pieces."""
        head = b[:HEAD]
        known = self.heads.get(head)
        if known is None:
            if len(self.heads) >= MAX_HEADS:
                self.heads.clear()
            known = self.heads[head] = tuple(self.extend(head, []))
        out = list(known)
        self._grow(b, out, len(b))
        return out

    def encode(self, b: bytes) -> list[int]:
        """Token ids of one piece."""
        return [self.ranks[b]] if b in self.ranks else self.ids(self.table(b))

    def ids(self, table: list[int]) -> list[int]:
        out, e, size = [], len(table), self.size
        while e:
            t = table[e - 1]
            out.append(t)
            e -= size[t]
        return out[::-1]

    def edit(self, b: bytes, table: list[int], start: int, end: int, new: bytes) -> tuple[bytes, list[int], int]:
        """Replace ``b[start:end]`` by ``new``: the bytes, their table, and how many entries were computed anew."""
        out = b[:start] + new + b[end:]
        got, shift, agree = list(table[:start]), len(new) - (end - start), 0
        for e in range(start + 1, len(out) + 1):
            self._grow(out, got, e)
            # Once every entry that a later one can look at agrees, all later ones do.
            agree = agree + 1 if e - shift > end and e > start + len(new) and got[-1] == table[e - shift - 1] else 0
            if agree >= 2 * self.longest:
                return out, got + table[e - shift:], e - start
        return out, got, len(out) - start

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.token[i] for i in ids])


class TextCoder:
    """Whole texts: pattern split, memo of pieces, ids and decoded texts."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.bpe = PrefixBPE(ranks)
        self.split = regex.compile(pattern).findall
        self.forget()

    def forget(self) -> None:
        """Empty what grew with the texts."""
        self.memo: dict[str, tuple[str, str]] = {}
        self.old: dict[str, tuple[str, str]] = {}
        self.bpe.forget()

    def _piece(self, piece: str) -> tuple[str, str]:
        got = self.old.get(piece)
        if got is None:
            ids = self.bpe.encode(piece.encode())
            decoded = self.bpe.decode(ids).decode()
            got = " ".join(map(self.bpe.name.__getitem__, ids)), decoded
        if len(piece) <= SHORT:
            if len(self.memo) >= MAX_PIECES:   # what was used since the last time stays at hand
                self.old, self.memo = self.memo, {}
            self.memo[got[1] if got[1] == piece else piece] = got   # equal texts are held once
        return got

    def encode(self, text: str) -> list[int]:
        return [i for p in self.split(text) for i in self.bpe.encode(p.encode())]

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids joined by spaces, SHA-256 of the decoded bytes."""
        pieces = self.split(text)
        got = list(map(self.memo.get, pieces))
        if None in got:
            got = [x or self.memo.get(p) or self._piece(p) for p, x in zip(pieces, got)]
        joined = " ".join([x[0] for x in got])
        return (joined.count(" ") + bool(pieces), hashlib.sha256(joined.encode()).hexdigest(),
                hashlib.sha256("".join([x[1] for x in got]).encode()).hexdigest())


_coders: dict = {}


def coder_of(raw: bytes, pattern: str) -> TextCoder:
    """One coder for each vocabulary and Python worker (kept between tasks)."""
    key = hashlib.sha256(raw).digest(), pattern
    if key not in _coders:
        _coders.clear()
        _coders[key] = TextCoder({base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}, pattern)
    return _coders[key]


def forget_pieces() -> None:
    """The worker goes on to other work, which needs the memory."""
    for coder in _coders.values():
        coder.forget()


keep_between_tasks("bpe", forget_pieces)


def read_vocabulary(path: str, max_mb: int = 64) -> bytes:
    with open(path, "rb") as f:
        raw = f.read((max_mb << 20) + 1)
    if len(raw) > max_mb << 20:
        raise ValueError(f"vocabulary over {max_mb} MB")
    return raw


def bpe_digests(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256. The vocabulary file (size checked) goes to tasks as a broadcast."""
    raw = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(ids: list, texts: list) -> dict:
        rows = list(map(coder_of(raw.value, pattern).digest, texts))
        return {"doc_id": ids, "n_tokens": [r[0] for r in rows], "ids_sha256": [r[1] for r in rows],
                "decoded_sha256": [r[2] for r in rows]}

    return map_docs(docs, "doc_id bigint,n_tokens bigint,ids_sha256 string,decoded_sha256 string", run, keeps="bpe")


def bpe_ids(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, ids (the token ids of the whole text), decoded (the text they decode to)."""
    raw = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(ids: list, texts: list) -> dict:
        coder = coder_of(raw.value, pattern)
        out = list(map(coder.encode, texts))
        return {"doc_id": ids, "ids": out, "decoded": [coder.bpe.decode(x).decode() for x in out]}

    return map_docs(docs, "doc_id bigint,ids array<int>,decoded string", run, keeps="bpe")
