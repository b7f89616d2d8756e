"""Substring dedup with repeated-phrase automata.

Documents are dealt into shards. A phrase of a few words, picked from every window by least hash, stands
for the windows around it; phrases that several documents hold are confirmed by a shuffle of hashes, and the
shard of the first document that holds one writes out its words. Each shard compiles the phrases it is sent
into an Aho-Corasick automaton over words and streams all its documents through it to locate every
occurrence. Only windows around an occurrence are looked at further: where a phrase stands in different
surroundings, the windows' hashes are counted across shards.

Every window of two documents with equal words has the same least phrase, so none is missed.
"""

from __future__ import annotations

import math
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

U = np.uint64
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.default_rng(1).integers(1, 1 << 63, 256, dtype=np.int64).astype(U) * U(2) + U(1)
#: Odd multipliers of the polynomial hashes over bytes and over words.
_BASES = tuple(int(x) | 1 for x in np.random.default_rng(2).integers(1 << 61, 1 << 62, 3))
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to n."""
    if base not in _POWERS or len(_POWERS[base][0]) <= n:
        size = 1 << max(16, n.bit_length())
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, U)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _POWERS[base] = (both[0], both[1])
    return _POWERS[base]


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Hashed:
    """Polynomial hashes of any run of one sequence."""

    def __init__(self, values: np.ndarray, base: int):
        up, self.down = _powers(base, len(values) + 1)
        self.sums = np.concatenate([np.zeros(1, U), np.cumsum(values * up[: len(values)], dtype=U)])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(U))


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    step, n = 1, len(x) - width + 1
    while 2 * step <= width:
        x, step = np.minimum(x[:-step], x[step:]), 2 * step
    return np.minimum(x[:n], x[width - step : width - step + n])


class Batch:
    """The words and windows of some documents one after another. ``least`` is each window's phrase."""

    def __init__(self, ids: list, texts: list, window: int, phrase: int):
        raw = [(t or "").encode() for t in texts]
        self.data = b"\n".join(raw) + b"\n"
        data = np.frombuffer(self.data, np.uint8)
        space = _IS_SPACE[data]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], space]).astype(np.int8)))
        self.starts, self.ends = edge[0::2], edge[1::2]
        self.words = Hashed(_BYTE[data], _BASES[0]).of(self.starts, self.ends)
        at = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])])
        self.first = np.searchsorted(self.starts, at)  # of each document's words, and the end of the last
        doc = np.repeat(np.arange(len(raw)), np.diff(self.first))
        self.one, self.two = Hashed(self.words, _BASES[1]), Hashed(self.words, _BASES[2])
        self.window, self.phrase, n = window, phrase, len(self.words)
        has_id = np.array([i is not None for i in ids], bool)
        self.ids = np.array([0 if i is None else i for i in ids], np.int64)
        if n >= window:
            j = np.arange(n - window + 1)
            ok = (doc[j] == doc[j + window - 1]) & has_id[doc[j]]
            k = np.arange(n - phrase + 1)
            self.least = _least(self.one.of(k, k + phrase), window - phrase + 1)
            self.at, self.least, self.doc = j[ok], self.least[ok], doc[j[ok]]
        else:
            self.at = self.doc = np.zeros(0, np.int64)
            self.least = np.zeros(0, U)

    def phrases(self) -> np.ndarray:
        """Hash of the phrase that begins at each word."""
        k = np.arange(max(0, len(self.words) - self.phrase + 1))
        return self.one.of(k, k + self.phrase)

    def around(self, start: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Which windows have one of the phrases ``p``, located at ``start``, as their own."""
        if not len(start) or not len(self.at):
            return np.zeros(len(self.at), bool)
        found = np.full(len(self.words) - self.phrase + 1, np.iinfo(np.uint64).max)
        found[start] = p
        return _least(found, self.window - self.phrase + 1)[self.at] == self.least

    def pieces(self) -> tuple[np.ndarray, np.ndarray]:
        """First and last (inclusive) of each run of windows of one document with the same phrase."""
        if not len(self.at):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        new = (np.diff(self.least) != 0) | (np.diff(self.at) != 1) | (np.diff(self.doc) != 0)
        first = np.concatenate([[0], np.flatnonzero(new) + 1])
        return first, np.concatenate([first[1:], [len(self.at)]]) - 1


def _batches(table: pa.Table, window: int, phrase: int, size: int = 1 << 20):
    """(index of the first row, Batch) for a shard's documents, about ``size`` characters at a time."""
    ids, texts = table.column("doc_id").to_pylist(), table.column("text").to_pylist()
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held >= size or i == len(texts) - 1:
            yield start, Batch(ids[start : i + 1], texts[start : i + 1], window, phrase)
            start, held = i + 1, 0


def _reduce(keys: list[np.ndarray], low: list[np.ndarray], high: list[np.ndarray]):
    """Distinct keys (columns) with minima of ``low`` and maxima of ``high``."""
    if not len(keys[0]):
        return keys, low, high
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    cut = np.concatenate([[0], np.flatnonzero(np.any([np.diff(k) != 0 for k in keys], axis=0)) + 1])
    return [k[cut] for k in keys], [np.minimum.reduceat(x[order], cut) for x in low], [np.maximum.reduceat(x[order], cut) for x in high]


def _member(x: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether and where each x is in a sorted table."""
    if not len(table):
        return np.zeros(len(x), bool), np.zeros(len(x), np.int64)
    at = np.minimum(np.searchsorted(table, x), len(table) - 1)
    return table[at] == x, at


class Phrases:
    """Aho-Corasick automaton of phrases over words. A word is spelled as two characters, of an alphabet each, so
    that a node has few children and a match begins with a word."""

    def __init__(self, phrases: list[bytes]):
        split = [p.split() for p in phrases]
        self.numbers = {w: n for n, w in enumerate(dict.fromkeys(w for p in split for w in p), 1)}
        self.base = math.isqrt(len(self.numbers)) + 1
        self.automaton, self.length = ahocorasick.Automaton(), len(split[0]) if split else 0
        for n, words in enumerate(split):
            self.automaton.add_word(self._spell(words), n)
        self.automaton.make_automaton()

    def _spell(self, words: list[bytes]) -> str:
        number = np.fromiter(map(self.numbers.get, words, repeat(0)), np.int64, len(words))
        out = np.empty(2 * len(words), "<u4")
        out[0::2], out[1::2] = number // self.base + 0x100, number % self.base + 0x10000
        return out.tobytes().decode("utf-32-le")

    def find(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Where phrases begin, and which they are."""
        if not self.length:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        got = np.array(list(self.automaton.iter(self._spell(words))), np.int64).reshape(-1, 2)
        return got[:, 0] // 2 - self.length + 1, got[:, 1]


class Confirmed:
    """What a shard was sent: phrases with their words and, unless surroundings differ, the first document that has them."""

    def __init__(self, marks: pa.Table):
        p, owner = (marks.column(c).to_numpy(zero_copy_only=False) for c in ("p", "owner"))
        self.p, self.sure = p.astype(np.int64).view(U), ~np.isnan(owner.astype(float))
        self.owner = marks.column("owner").fill_null(0).to_numpy()
        self.order = np.argsort(self.p)
        self.trie = Phrases([w.encode() for w in marks.column("words").to_pylist()])

    def locate(self, b: Batch) -> tuple[np.ndarray, np.ndarray]:
        """Windows around located phrases: those whose owner is known by the phrase, and those to be hashed."""
        start, which = self.trie.find(b.data.split())
        sure = self.sure[which]
        return tuple(np.flatnonzero(b.around(start[k], self.p[which[k]])) for k in (sure, ~sure))

    def owners(self, least: np.ndarray) -> np.ndarray:
        return self.owner[self.order[np.searchsorted(self.p[self.order], least)]]


def remove_repeats(docs: DataFrame, *, window: int = 50, phrase: int = 16, shard_bytes: int = 4_000_000, least_shards: int = 32) -> DataFrame:
    """All columns of ``docs`` (any named like a result are replaced), ``text`` without repeats, ``n_words``, ``n_removed``.

    A word goes if a window of ``window`` words that covers it also starts in a document of smaller
    doc_id; windows are judged on the input. Kept words are joined by one space. Null or empty text has no
    words and comes back empty. Rows of the same doc_id are no smaller than each other, so repeated rows
    lose nothing to each other; a row without doc_id neither loses nor claims words. ``doc_id`` is integer.

    Shuffled are the text, once; for about one word in 18 a phrase's hash per shard; the words of confirmed
    phrases, once for each shard that holds them; and hashes of windows
    only where documents hold the same phrase in different surroundings. A key has one row per shard
    at most, however common it is. A shard's automaton holds no phrase that its own documents don't.
    """
    docs = docs.drop("n_words", "n_removed")
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(least_shards, total // shard_bytes + 1)
    by = docs.withColumn("_shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int"))
    by = by.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "_shard")
    dealt = by.groupBy("_shard")

    def phrases(key, table):
        got = []
        for _, b in _batches(table, window, phrase):
            first, last = b.pieces()
            start, end = b.at[first], b.at[last] + window
            own, body = b.ids[b.doc[first]], b.two.of(start, end).view(np.int64)
            k, lo, hi = _reduce([b.least[first].view(np.int64)], [own, body], [own, body])
            got.append((*k, *lo, *hi))
        cols = [np.concatenate(c) for c in zip(*got, strict=True)] if got else [np.zeros(0, np.int64)] * 5
        k, lo, hi = _reduce(cols[:1], cols[1:3], cols[3:5])
        shard = np.full(len(k[0]), key[0].as_py(), np.int32)
        return pa.table({"p": k[0], "_shard": shard, "lo": lo[0], "hi": hi[0], "body_lo": lo[1], "body_hi": hi[1]})

    kinds = "p long, _shard int, lo long, hi long, body_lo long, body_hi long"
    found = dealt.applyInArrow(phrases, kinds)
    same = Window.partitionBy("p")
    found = found.withColumns({"first": F.min("lo").over(same), "last": F.max("hi").over(same), "b0": F.min("body_lo").over(same), "b1": F.max("body_hi").over(same)})
    found = found.where("first < last")

    def write(key, table, wanted):
        left, got = np.sort(wanted.column("p").to_numpy().view(U)), {}
        for _, b in _batches(table, window, phrase) if len(left) else ():
            hash_, words = b.phrases(), b.data.split()
            for k in np.flatnonzero(_member(hash_, left)[0]).tolist():
                if (h := hash_[k].view(np.int64).item()) not in got:
                    got[h] = b" ".join(words[k : k + phrase]).decode()
        return pa.table({"p": pa.array(list(got), pa.int64()), "words": pa.array(list(got.values()), pa.string())})

    # b0 <= b1 always holds: with the same columns, both uses of ``found`` read one exchange
    wanted = found.where("lo = first and b0 <= b1").select("_shard", "p").groupBy("_shard")
    words = dealt.cogroup(wanted).applyInArrow(write, "p long, words string").groupBy("p").agg(F.min("words").alias("words"))
    # windows of a phrase with the same surroundings everywhere begin in the first document that has it
    known = found.where("b0 <> b1 or hi > first").select("_shard", "p", F.when(F.col("b0") == F.col("b1"), F.col("first")).alias("owner")).join(words, "p")

    def windows(key, table, marks):
        sent, got = Confirmed(marks), []
        for _, b in _batches(table, window, phrase) if not sent.sure.all() else ():
            hit = sent.locate(b)[1]
            at, own = b.at[hit], b.ids[b.doc[hit]]
            k, lo, hi = _reduce([b.one.of(at, at + window).view(np.int64), b.two.of(at, at + window).view(np.int64)], [own], [own])
            got.append((*k, *lo, *hi))
        cols = [np.concatenate(c) for c in zip(*got, strict=True)] if got else [np.zeros(0, np.int64)] * 4
        k, lo, hi = _reduce(cols[:2], cols[2:3], cols[3:4])
        return pa.table({"h": k[0], "g": k[1], "_shard": np.full(len(k[0]), key[0].as_py(), np.int32), "lo": lo[0], "hi": hi[0]})

    each = dealt.cogroup(known.where("owner is null").groupBy("_shard")).applyInArrow(windows, "h long, g long, _shard int, lo long, hi long")
    each = each.withColumn("owner", F.min("lo").over(Window.partitionBy("h", "g"))).where("hi > owner")
    none = F.lit(None).cast("long")
    marks = known.select("_shard", "p", "owner", "words", none.alias("h"), none.alias("g"))
    marks = marks.unionByName(each.select("_shard", none.alias("p"), "owner", F.lit(None).cast("string").alias("words"), "h", "g"))
    names = [c for c in by.columns if c != "_shard"]

    def stream(key, table, marks):
        return stream_shard(table.select(names), marks, window, phrase)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", n_words long, n_removed long"
    return dealt.cogroup(marks.groupBy("_shard")).applyInArrow(stream, schema)


def stream_shard(table: pa.Table, marks: pa.Table, window: int, phrase: int) -> pa.Table:
    """A shard's rows without repeats. ``marks``: confirmed phrases (p, words, owner or null), and windows that
    smaller documents hold too (h, g, owner), of which only those around a located phrase are looked up."""
    plain = pa.compute.is_valid(marks.column("p"))
    sent, by_window = Confirmed(marks.filter(plain)), marks.filter(pa.compute.invert(plain))
    h, g, owner = (by_window.column(c).to_numpy() for c in ("h", "g", "owner"))
    order = np.argsort(h.view(U))
    h, g, owner = h.view(U)[order], g.view(U)[order], owner[order]
    texts, n_words, n_removed = [], [], []
    for _, b in _batches(table, window, phrase):
        words, gone = b.data.split(), np.zeros(len(b.words) + 1, np.int64)
        if len(sent.p):
            sure, hashed = sent.locate(b)
            sure = sure[sent.owners(b.least[sure]) < b.ids[b.doc[sure]]]
            at = b.at[hashed]
            hit, k = _member(b.one.of(at, at + window), h)
            k, hashed, at = k[hit], hashed[hit], at[hit]
            hashed = hashed[(g[k] == b.two.of(at, at + window)) & (owner[k] < b.ids[b.doc[hashed]])]
            at = b.at[np.concatenate([sure, hashed])]
            np.add.at(gone, at, 1)
            np.add.at(gone, at + window, -1)
        keep = np.cumsum(gone[:-1]) == 0
        for s, e in zip(b.first[:-1].tolist(), b.first[1:].tolist(), strict=True):
            own = words[s:e]
            if not keep[s:e].all():
                own = [words[k] for k in (np.flatnonzero(keep[s:e]) + s).tolist()]
            texts.append(b" ".join(own).decode())
            n_words.append(e - s)
            n_removed.append(e - s - len(own))
    out = table.set_column(table.column_names.index("text"), "text", pa.array(texts, pa.string()))
    return out.append_column("n_words", pa.array(n_words, pa.int64())).append_column("n_removed", pa.array(n_removed, pa.int64()))


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    out = remove_repeats(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


SQL = r"""
with d as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
win as (select doc_id, p, md5(array_to_string(list_slice(w, p + 1, p + 50), ' ')) as h
        from (select doc_id, w, unnest(range(len(w) - 49)) as p from d where len(w) >= 50)),
own as (select h, min(doc_id) as owner from win group by h),
gone as (select distinct doc_id, unnest(range(p, p + 50)) as pos from win join own using (h) where owner < doc_id),
t as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) - 1 as pos from d),
k as (select t.doc_id, string_agg(word, ' ' order by t.pos) filter (where g.pos is null) as kept, count(g.pos) as n_removed
      from t left join gone g on g.doc_id = t.doc_id and g.pos = t.pos group by t.doc_id)
select d.doc_id, len(w) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from d left join k on k.doc_id = d.doc_id
"""
