"""Byte-level BPE encoding and decoding.

Each match of the split pattern is a row of bytes. A segment tree over its byte positions holds, for every
live position, the rank of the pair that starts there; the root is the leftmost minimum. A merge changes
two leaves - the position itself and its live left neighbour - and clears a third, each in logarithmic
time. Many short matches are merged side by side, one tree a row, in numpy; a long match has a tree alone.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession

#: No pair: larger than any rank << 32 | position.
NONE = np.int64(1) << 62
SIDE_BY_SIDE = 64
KEEP = 400_000


def load_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """A rank file, read through Spark's readers so that any store will do; it is as large as a vocabulary."""
    lines = spark.read.text(path if "://" in path else f"file://{path}").collect()
    return {base64.b64decode(a): int(b) for a, b in (r.value.split() for r in lines if r.value)}


class Encoder:
    """Encodes by merge ranks as published byte-pair libraries do: a match that is a token is that token."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.find = regex.compile(pattern).findall
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        # every way to cut a token into two tokens is a mergeable pair
        pairs = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    pairs[(a << 32) | b] = rank
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], dtype=np.int64)
        self.pairs = pairs
        self.known: dict[str, bytes] = {}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, NONE where there is none; an id below 0 pairs with nothing."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.values[at], NONE)

    def side_by_side(self, pieces: list[bytes]) -> list[bytes]:
        """Ids, as little-endian 32-bit integers, of pieces of at most SIDE_BY_SIDE bytes."""
        lengths = np.array([len(p) for p in pieces])
        out: list[bytes] = [b""] * len(pieces)
        for width in (4, 8, 16, 32, 64):
            at = np.flatnonzero((lengths <= width) & (lengths > width // 2 * (width > 4)))
            for part in np.array_split(at, max(1, len(at) // 20_000)):
                if len(part):
                    for i, ids in zip(part.tolist(), self._merge_rows([pieces[i] for i in part.tolist()], width), strict=True):
                        out[i] = ids
        return out

    def _merge_rows(self, pieces: list[bytes], width: int) -> list[bytes]:
        n = len(pieces)
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8).reshape(n, width)
        lengths = np.array([len(p) for p in pieces])
        place = np.arange(width)
        ids = np.where(place < lengths[:, None], self.byte[raw], -1)
        nxt = np.where(place + 1 < lengths[:, None], place + 1, width).astype(np.int64) * np.ones((n, 1), np.int64)
        prv = np.broadcast_to(place - 1, (n, width)).copy()
        tree = np.full((n, 2 * width), NONE)
        first = self.rank(ids[:, :-1], ids[:, 1:])
        tree[:, width : 2 * width - 1] = np.where(first == NONE, NONE, (first << 32) | place[:-1])
        level = width
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2
        rows = np.arange(n)
        while True:
            rows = rows[tree[rows, 1] != NONE]
            if not len(rows):
                break
            best = tree[rows, 1]
            i = best & 0xFFFFFFFF
            j = nxt[rows, i]
            ids[rows, i] = best >> 32
            ids[rows, j] = -1
            after = nxt[rows, j]
            nxt[rows, i] = after
            inside = after < width
            prv[rows[inside], after[inside]] = i[inside]
            right = np.where(inside, ids[rows, np.minimum(after, width - 1)], -1)
            self._put(tree, width, rows, j, np.full(len(rows), NONE))
            r = self.rank(ids[rows, i], right)
            self._put(tree, width, rows, i, np.where(r == NONE, NONE, (r << 32) | i))
            p = prv[rows, i]
            has = p >= 0
            if has.any():
                q, k = rows[has], p[has]
                r = self.rank(ids[q, k], ids[q, i[has]])
                self._put(tree, width, q, k, np.where(r == NONE, NONE, (r << 32) | k))
        live = ids >= 0
        flat, ends = ids[live].astype("<u4").tobytes(), (4 * live.sum(1).cumsum()).tolist()
        return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    @staticmethod
    def _put(tree: np.ndarray, width: int, rows: np.ndarray, leaf: np.ndarray, value: np.ndarray) -> None:
        """Set one leaf a row and renew the minima above it."""
        node = leaf + width
        tree[rows, node] = value
        while width > 1:
            node, width = node >> 1, width >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    def alone(self, piece: bytes) -> bytes:
        """Ids of one piece of any length, merged in a tree of its own."""
        n = len(piece)
        width = 1 << max(1, (n - 1).bit_length())
        ids = [self.ranks[bytes([b])] for b in piece]
        nxt, prv = [*range(1, n + 1)], [*range(-1, n - 1)]
        none, pair = int(NONE), self.pairs.get
        tree = [none] * (2 * width)
        for i in range(n - 1):
            r = pair((ids[i] << 32) | ids[i + 1])
            if r is not None:
                tree[width + i] = (r << 32) | i
        for k in range(width - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])

        def put(leaf: int, value: int) -> None:
            k = leaf + width
            tree[k] = value
            k >>= 1
            while k:
                a, b = tree[2 * k], tree[2 * k + 1]
                m = a if a < b else b
                if tree[k] == m:
                    break
                tree[k] = m
                k >>= 1

        def renew(i: int) -> None:
            j = nxt[i]
            r = pair((ids[i] << 32) | ids[j]) if j < n else None
            put(i, none if r is None else (r << 32) | i)

        while (best := tree[1]) != none:
            i = best & 0xFFFFFFFF
            j = nxt[i]
            ids[i], ids[j] = best >> 32, -1
            nxt[i] = nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            put(j, none)
            renew(i)
            if prv[i] >= 0:
                renew(prv[i])
        return np.array([x for x in ids if x >= 0], dtype="<u4").tobytes()

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian 32-bit integers; "" has none."""
        found = [self.find(t) for t in texts]
        known = self.known
        new = list({p for ps in found for p in ps if p not in known})
        short: list[tuple[str, bytes]] = []
        for p in new:
            raw = p.encode()
            if (whole := self.ranks.get(raw)) is not None:
                known[p] = whole.to_bytes(4, "little")
            elif len(raw) <= SIDE_BY_SIDE:
                short.append((p, raw))
            else:
                known[p] = self.alone(raw)
        if short:
            known.update(zip((p for p, _ in short), self.side_by_side([raw for _, raw in short]), strict=True))
        out = [b"".join(map(known.__getitem__, ps)) for ps in found]
        if len(known) > KEEP:  # a memo, not a model: emptied when large
            known.clear()
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_MADE: dict[tuple, Encoder] = {}


def _batches(texts: list[str], chars: int = 2_000_000) -> Iterator[slice]:
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= chars:
            yield slice(start, i + 1)
            start, held = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def encode(docs: DataFrame, *, ranks_path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """One row per row of ``docs``: its columns but ``text``, then ``n_tokens``, ``ids_sha256``, ``decoded_sha256``.

    ``keep_ids`` adds ``ids``, an array of the tokens. Null text is taken as empty: no tokens, the hashes
    of nothing. Texts of any length are encoded whole. Columns of the input named like a result are replaced.
    Narrow: no row leaves its partition; the ranks (as large as a vocabulary, known before the run) travel
    in the closure's broadcast.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(load_ranks(spark, ranks_path))
    added = ["n_tokens", "ids_sha256", "decoded_sha256"]
    others = [c for c in docs.columns if c not in (*added, "ids", "text")]
    key = (ranks_path, pattern)

    def run(parts):
        import pyarrow as pa

        if key not in _MADE:
            _MADE[key] = Encoder(shared.value, pattern)
        enc = _MADE[key]
        for part in parts:
            texts = [t or "" for t in part.column("text").to_pylist()]
            rest = part.select(others)
            for at in _batches(texts):
                ids = enc.encode_batch(texts[at])
                cols = {
                    "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                    "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    "decoded_sha256": pa.array([hashlib.sha256(enc.decode(x)).hexdigest() for x in ids], pa.string()),
                }
                if keep_ids:
                    cols["ids"] = pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids], pa.list_(pa.int32()))
                own = rest.slice(at.start, at.stop - at.start)
                yield pa.RecordBatch.from_arrays([*own.columns, *cols.values()], names=[*others, *cols])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in others]
    kinds += ["n_tokens long", "ids_sha256 string", "decoded_sha256 string"] + ["ids array<int>"] * keep_ids
    return docs.select(*others, "text").mapInArrow(run, ", ".join(kinds))


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    import public_tokenizers

    return encode(docs.select("doc_id", "text"), ranks_path=public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), pattern=public_tokenizers.PATTERN)
