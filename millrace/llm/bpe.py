"""Byte-level BPE encoding and decoding with a rank queue over a hierarchical bitmap.

Each match of the split pattern is encoded on its own. Its bytes form a linked list; the bucket of
a merge rank holds the list positions whose pair has that rank. A bitmap of several levels tells
which buckets are filled: find-first-set at each level gives the lowest rank in a few steps, however
long the pre-token. A position whose pair has changed meanwhile is a stale entry and is skipped.

Long pre-tokens go through the queue one at a time (``RankQueue``). The many short ones of a slice
share one linked list with a barrier after each, and one queue (``BlockQueue``) whose buckets span
a block of ranks: of the lowest block, the lowest and leftmost pair of every pre-token is merged at
once with numpy. Merges of different pre-tokens never meet, so the ids are the same.
"""

from __future__ import annotations

import base64
import hashlib
from heapq import heappop, heappush

import numpy as np
from pyspark.sql import DataFrame

from millrace.llm.common import per_text

#: Text bytes whose distinct pre-tokens are merged together.
SLICE = 8 << 20
#: Tokens decoded at once.
PART = 1 << 20
#: Pre-tokens above so many bytes are merged on their own.
LONG = 64
#: Ranks that a bucket of the shared queue spans.
SPAN = 512


class RankQueue:
    """Positions by rank; ``pop`` gives the lowest rank, and of it the leftmost position."""

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[int]] = {}
        # level 0 has a bit a rank, each level above has a bit a word below
        self.levels = []
        n = max(1, ranks)
        while True:
            n = (n + 63) // 64
            self.levels.append([0] * n)
            if n == 1:
                break

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            heappush(bucket, position)
            return
        self.buckets[rank] = [position]
        for level in self.levels:
            word, bit = rank >> 6, rank & 63
            filled = level[word]
            level[word] = filled | (1 << bit)
            if filled:
                break
            rank = word

    def pop(self) -> tuple[int, int] | None:
        if not self.levels[-1][0]:
            return None
        at = 0
        for level in reversed(self.levels):
            word = level[at]
            at = (at << 6) | ((word & -word).bit_length() - 1)
        bucket = self.buckets[at]
        position = heappop(bucket)
        if not bucket:
            del self.buckets[at]
            rank = at
            for level in self.levels:
                level[rank >> 6] &= ~(1 << (rank & 63))
                if level[rank >> 6]:
                    break
                rank >>= 6
        return at, position


class BlockQueue:
    """Arrays of (rank, position) by block of ``SPAN`` ranks; ``pop`` takes all of the lowest filled block."""

    def __init__(self, ranks: int):
        self.blocks: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(ranks // SPAN + 1)]
        self.words = [0] * (len(self.blocks) // 64 + 1)
        self.top = 0

    def push(self, rank: np.ndarray, position: np.ndarray) -> None:
        if not len(rank):
            return
        block = rank // SPAN
        order = np.argsort(block, kind="stable")
        rank, position, block = rank[order], position[order], block[order]
        first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        for at, to in zip(first, [*first[1:], len(block)], strict=True):
            b = int(block[at])
            self.blocks[b].append((rank[at:to], position[at:to]))
            self.words[b >> 6] |= 1 << (b & 63)
            self.top |= 1 << (b >> 6)

    def pop(self) -> tuple[np.ndarray, np.ndarray] | None:
        if not self.top:
            return None
        w = (self.top & -self.top).bit_length() - 1
        b = (w << 6) | ((self.words[w] & -self.words[w]).bit_length() - 1)
        held, self.blocks[b] = self.blocks[b], []
        self.words[w] &= ~(1 << (b & 63))
        if not self.words[w]:
            self.top &= ~(1 << w)
        rank, position = zip(*held, strict=True)
        return np.concatenate(rank), np.concatenate(position)


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Codec:
    """Encoder and decoder for one rank table and split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.top = max(ranks.values(), default=0) + 1
        self.queue = RankQueue(self.top)
        # all tokens' bytes end to end, by rank
        raw = [self.tokens.get(r, b"") for r in range(self.top)]
        self.flat = np.frombuffer(b"".join(raw), np.uint8)
        self.size = np.array([len(t) for t in raw], np.int64)
        self.place = np.cumsum(self.size) - self.size
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int32)

    def _pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge rank of neighbouring tokens; -1 where there is none, or one is a barrier (-1)."""
        if not len(self.pair_keys):
            return np.full(len(left), -1, np.int32)
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == key) & (left >= 0) & (right >= 0), self.pair_ranks[at], -1).astype(np.int32)

    def merge_many(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each of many short pre-tokens, as little-endian 32-bit bytes."""
        if not pieces:
            return []
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1
        buf = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
        n, barrier = len(buf), np.cumsum(sizes) - 1
        owner = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes)
        tok = self.byte_ids[buf]
        tok[barrier] = -1
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        pair = np.full(n, -1, np.int32)
        pair[:-1] = self._pair_rank(tok[:-1], tok[1:])
        queue, none = BlockQueue(self.top), np.iinfo(np.int64).max
        best = np.full(len(pieces), none, np.int64)
        start = np.flatnonzero(pair >= 0).astype(np.int32)
        queue.push(pair[start], start)
        while (got := queue.pop()) is not None:
            rank, pos = got
            fresh = pair[pos] == rank  # others are stale
            rank, pos = rank[fresh], pos[fresh]
            if not len(pos):
                continue
            key, own = rank.astype(np.int64) << 32 | pos, owner[pos]
            np.minimum.at(best, own, key)
            chosen = best[own] == key
            best[own] = none
            if not chosen.all():
                queue.push(rank[~chosen], pos[~chosen])
            rank, pos = rank[chosen], pos[chosen]
            gone = after[pos]
            end = after[gone]
            after[pos], before[end] = end, pos
            pair[gone], tok[gone], tok[pos] = -1, -1, rank
            left = before[pos]
            pair[pos], pair[left] = self._pair_rank(tok[pos], tok[end]), self._pair_rank(tok[left], tok[pos])
            new = np.concatenate([pos, left])
            new = new[pair[new] >= 0]
            queue.push(pair[new], new)
        alive = tok >= 0
        ids = tok[alive].astype("<u4").tobytes()
        to = (np.cumsum(np.bincount(owner[alive], minlength=len(pieces))) * 4).tolist()
        return [ids[a:b] for a, b in zip([0, *to[:-1]], to, strict=True)]

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token."""
        ranks, n = self.ranks, len(piece)
        if piece in ranks:
            return [ranks[piece]]
        after = list(range(1, n + 1))  # the start of the next part; n: none
        before = list(range(-1, n - 1))
        pair = [-1] * n  # the rank of a part with the next; -1: none, or the part is gone
        queue = self.queue
        for i in range(n - 1):
            r = ranks.get(piece[i : i + 2])
            if r is not None:
                pair[i] = r
                queue.push(r, i)
        while (top := queue.pop()) is not None:
            rank, i = top
            if pair[i] != rank:
                continue  # stale
            gone = after[i]
            end = after[gone]
            after[i] = end
            pair[gone] = -1
            if end < n:
                before[end] = i
                self._link(piece, pair, i, after[end])
            else:
                pair[i] = -1
            if (left := before[i]) >= 0:
                self._link(piece, pair, left, end)
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : after[i]]])
            i = after[i]
        return out

    def _link(self, piece: bytes, pair: list[int], start: int, end: int) -> None:
        r = self.ranks.get(piece[start:end])
        if r is None:
            pair[start] = -1
        elif pair[start] != r:  # an equal rank is in the queue already
            pair[start] = r
            self.queue.push(r, start)

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids (unsigned 32-bit) of each whole text; none for a null or empty one.

        Each distinct pre-token of the texts is merged once.
        """
        number: dict[str, int] = {}
        rows = []
        for text in texts:
            found = self.split(text or "")
            for piece in set(found).difference(number):
                number[piece] = len(number)
            rows.append([number[piece] for piece in found])
        ids, short = [b""] * len(number), []
        for i, raw in enumerate(piece.encode("utf-8") for piece in number):
            if len(raw) > LONG or raw in self.ranks:
                ids[i] = np.array(self.merge(raw), "<u4").tobytes()
            else:
                short.append((i, raw))
        for (i, _), got in zip(short, self.merge_many([raw for _, raw in short]), strict=True):
            ids[i] = got
        return [np.frombuffer(b"".join([ids[i] for i in row]), "<u4") for row in rows]

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of one text."""
        return self.encode_all([text])[0]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids."""
        out = []
        for at in range(0, len(ids), PART):
            part = ids[at : at + PART]
            size = self.size[part]
            shift = self.place[part] - (np.cumsum(size) - size)
            out.append(self.flat[np.repeat(shift, size) + np.arange(size.sum())].tobytes())
        return b"".join(out)


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file, made once in each Python process."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(load_ranks(path), pattern)
    return _codecs[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: bool = True) -> DataFrame:
    """``docs`` with the text's tokens in place of column ``text``.

    Adds ``n_tokens`` long, ``ids`` array<int> (with ``ids=True``), ``ids_sha256`` (of the ids as
    little-endian unsigned 32-bit integers) and ``decoded_sha256`` (of the bytes decoded from the ids).
    A null or empty text has no tokens and the digests of the empty string; whole texts are encoded,
    whatever their length; repeated rows stay. Each executor needs the file at ``path``.
    """

    def run(texts: list) -> dict[str, list]:
        c = codec(path, pattern)
        out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
        for found in c.encode_all(texts):
            out["n_tokens"].append(len(found))
            out["ids_sha256"].append(hashlib.sha256(found.tobytes()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(c.decode(found)).hexdigest())
            if ids:
                out["ids"].append(found.view(np.int32))
        return out

    schema = "n_tokens long, " + "ids array<int>, " * ids + "ids_sha256 string, decoded_sha256 string"
    return per_text(docs, text, schema, run, SLICE)


def decode(rows: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``rows`` with ``text`` decoded from column ``ids`` (null stays null; broken UTF-8 is replaced)."""
    from pyspark.sql import functions as F

    @F.pandas_udf("string")
    def text(s):
        c = codec(path, pattern)
        return s.map(lambda x: None if x is None else c.decode(np.asarray(x)).decode("utf-8", "replace"))

    return rows.withColumn("text", text(F.col(f"`{ids}`")))
