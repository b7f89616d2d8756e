"""Toxicity: a convolutional text classifier trained in numpy.

Words are hashed into buckets and embedded. Three more dimensions of an embedding are evidence: how surely the
word, one of its beginnings and one of its 5-grams are commoner in toxic training documents; so inflected
forms that the training never saw are still known by their stem. Filters of several widths slide over the whole text, each
keeps its maximum, and a linear layer turns the maxima into a logit. Scores are calibrated on documents the
weights never saw; so is one threshold for each language.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTHS = (1, 2, 3)
PAD = max(WIDTHS) - 1
_WORD = re.compile(r"\w+").findall


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the labelled documents of each class that are learned from, ``sample_chars`` their length."""

    buckets: int = 1 << 18
    least_docs: int = 4
    dim: int = 8
    filters: int = 16
    epochs: int = 5
    batch: int = 32
    rate: float = 3e-3
    decay: float = 1e-3
    sample: int = 2_500
    sample_chars: int = 20_000
    held_share: float = 0.25
    cut: float = 0.7
    seed: int = 7


@dataclass
class Net:
    s: Settings
    embed: np.ndarray  # of the words in use; row 0 is every other word
    conv: list[np.ndarray]  # per width: (width, dim + EVIDENCE, filters)
    bias: list[np.ndarray]
    out: np.ndarray
    words: dict[int, int] = field(default_factory=dict)  # bucket of a word -> row
    evidence: dict[str, float] = field(default_factory=dict)  # of words and 5-grams seen in enough documents
    out_bias: float = 0.0
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict[str, float] = field(default_factory=dict)
    token: int = 0


def bucket(word: str, buckets: int) -> int:
    return zlib.crc32(word.encode()) % buckets


EVIDENCE = 3


def pieces(word: str) -> tuple[list[str], list[str]]:
    """Beginnings of 4 to 6 letters, and 5-grams of the word with its end marked."""
    return ["<" + word[:n] for n in (4, 5, 6) if len(word) >= n], ["=" + (word + ">")[i : i + 5] for i in range(len(word) - 3)]


def evidence_of(word: str, known: dict[str, float]) -> tuple[float, float, float]:
    """Evidence of the word, the most of its beginnings, and of its 5-grams; a harmless word's parts are harmless."""
    own = known.get(word)
    if own == 0.0:
        return (0.0, 0.0, 0.0)
    get, (begin, inside) = known.get, pieces(word)
    return own or 0.0, max([get(g, 0.0) for g in begin], default=0.0), max([get(g, 0.0) for g in inside], default=0.0)


def _evidence(docs: list[set[str]], y: np.ndarray, s: Settings) -> dict[str, float]:
    """Log odds of being in a toxic document against any other, in standard errors, of words and their pieces.

    Those in few documents have none, those below one standard error have zero.
    """
    tox, rest = Counter(), Counter()
    for d, t in zip(docs, y, strict=True):
        seen = tox if t else rest
        seen.update(d)
        seen.update({g for w in d for part in pieces(w) for g in part})
    names = [k for k in tox.keys() | rest.keys() if tox[k] + rest[k] >= s.least_docs]
    a, b = np.array([tox[k] for k in names]) + 0.5, np.array([rest[k] for k in names]) + 0.5
    z = (np.log(a / (y.sum() + 1)) - np.log(b / (len(y) - y.sum() + 1))) / np.sqrt(1 / a + 1 / b)
    return {k: x if x > 1 else 0.0 for k, x in zip(names, (z / 2).tolist(), strict=True) if x > 1 or k[0] not in "<="}


def _maxima(x: np.ndarray, conv: np.ndarray, bias: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Maximum of each filter over each span of ``x`` and where it is. Spans are followed by PAD zero rows."""
    width, n = len(conv), len(x) - PAD
    h = bias + sum(x[o : o + n] @ conv[o] for o in range(width))
    where = np.array([h[a:b].argmax(0) + a for a, b in spans])
    return np.take_along_axis(h, where, 0), where


def _layout(docs: list[np.ndarray]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    ids, spans, at = [], [], 0
    for d in docs:
        n = max(1, len(d))
        ids += [d if len(d) else np.zeros((1, *d.shape[1:]), d.dtype), np.zeros((PAD, *d.shape[1:]), d.dtype)]
        spans.append((at, at + n))
        at += n + PAD
    return np.concatenate(ids), spans


def _logits(net: Net, docs: list[np.ndarray], evidence: list[np.ndarray]) -> np.ndarray:
    out = []
    for k in range(0, len(docs), 64):
        ids, spans = _layout(docs[k : k + 64])
        x = np.concatenate([net.embed[ids], _layout(evidence[k : k + 64])[0]], 1)
        feats = [np.maximum(_maxima(x, c, b, spans)[0], 0) for c, b in zip(net.conv, net.bias, strict=True)]
        out.append(np.concatenate(feats, 1) @ net.out + net.out_bias)
    return np.concatenate(out) if out else np.zeros(0)


def train(rows: list[tuple[str | None, str | None, int, float]], s: Settings = Settings()) -> Net:
    """Learns from (text, lang, toxic, weight); ``lang`` only chooses thresholds, never a score.

    ``weight`` is how many documents of its class a row stands for. Evidence from one half of the rows is
    what the weights are trained with on the other half, so that they learn how far to trust it; then it is
    taken from both. Without both classes the net is constant: the share of toxic rows.
    """
    rng = np.random.default_rng(s.seed)
    texts = [_WORD((t or "").lower()) for t, _, _, _ in rows]
    y = np.array([r[2] for r in rows], float)
    w = np.array([r[3] for r in rows], float)
    seen = [set(d) for d in texts]
    known = {word: bucket(word, s.buckets) for word in set().union(*seen)}
    counts = Counter(known[x] for d in seen for x in d)
    number = {b: i + 1 for i, b in enumerate(sorted(b for b, n in counts.items() if n >= s.least_docs))}
    width = s.dim + EVIDENCE
    net = Net(s, rng.normal(0, 0.1, (len(number) + 1, s.dim)), [rng.normal(0, 1 / np.sqrt(k * width), (k, width, s.filters)) for k in WIDTHS], [np.zeros(s.filters) for _ in WIDTHS], rng.normal(0, 0.1, s.filters * len(WIDTHS)), number)
    net.embed[0] = 0
    net.token = zlib.crc32(repr((s, sorted(number), y.tolist())).encode())
    if len(set(y.tolist())) < 2:
        net.out[:] = 0
        p = min(max(float(y.mean()) if len(y) else 0.0, 1e-3), 0.5)
        net.scale = (0.0, float(np.log(p / (1 - p))))
        return net
    side = rng.random(len(rows))
    for c in (0.0, 1.0):  # both classes on all sides
        at = np.flatnonzero(y == c)
        side[at[: 3 * (len(at) >= 3)]] = (0.0, s.held_share + 1e-6, 0.9999)[: 3 * (len(at) >= 3)]
        if len(at) < 3:
            side[at] = 0.9999
    middle = s.held_share + (1 - s.held_share) / 2
    test, first, fit = np.flatnonzero(side < s.held_share), np.flatnonzero((side >= s.held_share) & (side < middle)), np.flatnonzero(side >= middle)

    def evidence_from(at: np.ndarray) -> tuple[dict[str, float], list[np.ndarray]]:
        found = _evidence([seen[i] for i in at], y[at], s)
        of = {word: evidence_of(word, found) for word in known}
        return found, [np.array([of[x] for x in d], float).reshape(-1, EVIDENCE) for d in texts]

    docs = [np.array([number.get(known[x], 0) for x in d], np.int64) for d in texts]
    evidence = evidence_from(first)[1]
    params = [net.embed, *net.conv, *net.bias, net.out, np.zeros(1)]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(s.epochs):
        order = rng.permutation(fit)
        for k in range(0, len(order), s.batch):
            part = order[k : k + s.batch]
            ids, spans = _layout([docs[i] for i in part])
            x = np.concatenate([net.embed[ids], _layout([evidence[i] for i in part])[0]], 1)
            top = [_maxima(x, c, b, spans) for c, b in zip(net.conv, net.bias, strict=True)]
            raw = np.concatenate([t[0] for t in top], 1)
            feats = np.maximum(raw, 0)
            keep = (rng.random(feats.shape) < 0.8) / 0.8
            p = 1 / (1 + np.exp(-np.clip((feats * keep) @ net.out + params[-1][0], -30, 30)))
            g = (p - y[part]) / len(part)
            grads = [np.zeros_like(q) for q in params]
            grads[-2][:], grads[-1][0] = (feats * keep).T @ g, g.sum()
            g_feat = g[:, None] * net.out * keep * (raw > 0)
            for n, (wide, (_, where)) in enumerate(zip(WIDTHS, top, strict=True)):
                own = g_feat[:, n * s.filters : (n + 1) * s.filters]
                grads[1 + len(WIDTHS) + n][:] = own.sum(0)
                for o in range(wide):
                    grads[1 + n][o] = np.einsum("df,dfe->ef", own, x[where + o])
                    np.add.at(grads[0], ids[where + o].ravel(), (own[:, :, None] * net.conv[n][o].T[None, :, : s.dim]).reshape(-1, s.dim))
            grads[0][0] = 0
            step += 1
            for q, gq, mq, vq in zip(params, grads, m, v, strict=True):
                mq += 0.1 * (gq - mq)
                vq += 0.001 * (gq * gq - vq)
                q -= s.rate * (mq / (1 - 0.9**step) / (np.sqrt(vq / (1 - 0.999**step)) + 1e-8) + s.decay * q)
    net.out_bias = float(params[-1][0])
    both = np.concatenate([first, fit])
    net.evidence, evidence = evidence_from(both)
    z = _logits(net, [docs[i] for i in test], [evidence[i] for i in test])
    net.scale = _calibrate(z, y[test], w[test])
    p = _probability(net, z)
    for lang in {rows[i][1] for i in test} - {None}:
        at = [k for k, i in enumerate(test) if rows[i][1] == lang]
        net.thresholds[lang] = _best_threshold(p[at], y[test][at], w[test][at], s.cut)
    return net


def _probability(net: Net, z: np.ndarray) -> np.ndarray:
    a, b = net.scale
    return 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))


def _calibrate(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Platt scaling by Newton steps, with a ridge that keeps separable data finite."""
    a, b = 1.0, 0.0
    w = w / w.mean()
    pos, neg = w[y == 1].sum(), w[y == 0].sum()
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        g = np.array([(w * (p - t) * z).sum() + 1e-3 * (a - 1), (w * (p - t)).sum()])
        r = w * p * (1 - p) + 1e-9
        hess = np.array([[(r * z * z).sum() + 1e-3, (r * z).sum()], [(r * z).sum(), r.sum() + 1e-6]])
        d = np.linalg.solve(hess, g)
        a, b = a - d[0], b - d[1]
        if np.abs(d).max() < 1e-8:
            break
    return (float(a), float(b)) if np.isfinite([a, b]).all() and a > 0 else (1.0, 0.0)


def _best_threshold(p: np.ndarray, y: np.ndarray, w: np.ndarray, default: float) -> float:
    """Threshold of the best F1; the default where a language has fewer than five toxic documents."""
    if y.sum() < 5:
        return default
    tried = np.linspace(0.05, 0.95, 91)
    f1 = [2 * (w * y * (p >= t)).sum() / max((w * y).sum() + (w * (p >= t)).sum(), 1e-9) for t in tried]
    good = tried[np.isclose(f1, max(f1))]
    return float(good[len(good) // 2])


class Scorer:
    """Scores whole texts; a word's row and evidence are looked up once."""

    MEMO = 1 << 19

    def __init__(self, net: Net):
        self.net, self.known = net, {}
        self.rows, self.evidence = np.zeros(self.MEMO, np.int64), np.zeros((self.MEMO, EVIDENCE), np.float32)
        self.embed = np.concatenate([net.embed, np.zeros((len(net.embed), EVIDENCE))], 1).astype(np.float32)
        # filters of all widths and offsets side by side: one product a text
        self.filters = np.concatenate([c[o] for c in net.conv for o in range(len(c))], 1).astype(np.float32)

    def look_up(self, words: list[str]) -> np.ndarray:
        known, net = self.known, self.net
        fresh = set(words).difference(known)
        if len(known) + len(fresh) > self.MEMO:
            known.clear()
            fresh = set(words)
        for w in fresh:
            k = known[w] = len(known)
            self.rows[k] = net.words.get(bucket(w, net.s.buckets), 0)
            self.evidence[k] = evidence_of(w, net.evidence)
        at = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        x = self.embed[self.rows[at]]
        x[:, -EVIDENCE:] = self.evidence[at]
        return x

    def score(self, text: str | None) -> float:
        words = _WORD((text or "").lower()) or [""]
        net, f = self.net, self.net.s.filters
        top = [np.full(f, -np.inf) for _ in WIDTHS]
        for k in range(0, len(words), 20_000):  # memory stays bounded however long the text
            n = min(len(words) - k, 20_000)
            h = np.zeros((n + PAD, self.filters.shape[1]), np.float32)
            part = words[k : k + n + PAD]
            h[: len(part)] = self.look_up(part) @ self.filters
            at = 0
            for i, width in enumerate(WIDTHS):
                sums = h[:n, at : at + f].copy()
                for o in range(1, width):
                    sums += h[o : o + n, at + o * f : at + (o + 1) * f]
                at += width * f
                top[i] = np.maximum(top[i], sums.max(0))
        feats = np.concatenate([np.maximum(t + b, 0) for t, b in zip(top, net.bias, strict=True)])
        return float(_probability(net, np.array([feats @ net.out + net.out_bias]))[0])


_SCORERS: dict[int, Scorer] = {}


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; rows of remainder 1 are held out."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3


def fit(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Net:
    """Trains on at most ``s.sample`` labelled documents of each class, those of least hash, none held out.

    An id labelled twice is toxic if any of its labels says so. Where a doc_id repeats, its least text (by code
    point, then language, nulls first) is learned from, so reruns learn the same.
    """
    known = labels.where("doc_id is not null and toxic in (0, 1)").where(fold(F.col("doc_id")) != 1).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = docs.where(F.char_length("text") <= s.sample_chars).where("doc_id is not null").select("doc_id", "lang", "text")
    totals = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    rows = []
    for toxic, count in sorted(totals.items()):
        # a bounded list of ids, so it may be broadcast
        ids = known.where(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(s.sample)
        one = F.min(F.struct("text", "lang")).alias("d")
        got = texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic").agg(one).select("doc_id", "toxic", "d.text", "d.lang").collect()
        got.sort(key=lambda r: r["doc_id"])
        rows += [(r["text"], r["lang"], int(toxic), count / max(1, len(got))) for r in got]
    return train(rows, s)


def classify(docs: DataFrame, net: Net) -> DataFrame:
    """Per row: ``doc_id``, ``lang``, ``score``, ``predicted`` (score >= 0.7), ``threshold`` and ``flagged``.

    The score sees the text alone, all of it; null or empty text scores as a text without known words.
    ``threshold`` is that of the row's language (the general one for null or unknown languages), and
    ``flagged`` says whether the score reaches it. Repeated rows score alike. Narrow: the net, bounded by
    the training sample, is broadcast and no row leaves its partition.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(net)
    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in ("doc_id", "lang"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = shared.value
        if got.token not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[got.token] = Scorer(got)
        scorer = _SCORERS[got.token]
        for part in parts:
            scores = [scorer.score(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("lang"), pa.array(scores, pa.float64())], names=["doc_id", "lang", "score"])

    out = docs.select("doc_id", "lang", "text").mapInArrow(run, f"{kinds}, score double")
    limit = F.lit(net.s.cut)
    for lang, t in sorted(net.thresholds.items()):
        limit = F.when(F.col("lang") == lang, F.lit(t)).otherwise(limit)
    return out.withColumn("predicted", (F.col("score") >= net.s.cut).cast("int")).withColumn("threshold", limit).withColumn("flagged", F.col("score") >= limit)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns, then each row's language threshold."""
    out = classify(docs, fit(docs, labels))
    held = F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", "predicted", "threshold", "flagged")
