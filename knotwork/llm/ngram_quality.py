"""Quality classifier: an interpolated modified Kneser-Ney n-gram model of trusted text.

N-grams are five bytes of UTF-8, each packed without loss into a long, so the model grows with the text. Counts are
sharded by the two bytes before the last: a shard then holds everything that the orders from three up need.
Documents travel once, compressed, in blocks. A block asks for the n-grams that it holds, each once; the
shards join what is asked with their counts, and the answers go back to the blocks, where documents are
scored. Each document's perplexity is held against a quantile of trusted documents of its language that the
model was not trained on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, row_keys

ORDER, BITS = 5, 8
SYMBOLS = 1 << BITS
#: Orders up to this one have few enough n-grams (65,792) to be sent to every shard.
SMALL = 2
PIECE = 1 << 20
PAD = bytes(ORDER - 1)


def _low(order: int) -> int:
    return (1 << BITS * order) - 1


def _codes(held: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    a = np.frombuffer(b"".join(b for _, b in held), np.uint8).astype(np.int64)
    n = len(a) - ORDER + 1
    code = np.zeros(n, np.int64)
    for k in range(ORDER):
        code <<= BITS
        code |= a[k : k + n]
    size = np.array([len(b) - ORDER + 1 for _, b in held])
    keep = np.ones(n, bool)
    start = np.cumsum(size + ORDER - 1)[:-1]
    keep[(start[:, None] - np.arange(1, ORDER)).ravel()] = False  # these end in the bytes before a piece
    return np.array([i for i, _ in held]), size, code[keep]


def grams(texts: list[str | bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The n-gram that ends at each byte, about PIECE at a time however long a text is; zeros stand before a text.

    Each time: which text each piece is of, its size, and the n-grams of all pieces one after another.
    """
    held, size = [], 0
    for i, text in enumerate(texts):
        raw = text.encode() if isinstance(text, str) else text or b""
        for k in range(0, len(raw), PIECE):
            held.append((i, (raw[k - ORDER + 1 : k] if k else PAD) + raw[k : k + PIECE]))
            size += len(held[-1][1])
            if size >= PIECE:
                yield _codes(held)
                held, size = [], 0
    if held:
        yield _codes(held)


def _sums(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, sorted, with the sums of their counts."""
    if not codes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code, n = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(code)
    code = code[order]
    first = np.flatnonzero(np.diff(code, prepend=-1))
    return code[first], np.add.reduceat(n[order], first) if len(first) else n[:0]


def _batches(most: int, **columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(next(iter(columns.values()))), most):
        yield pa.RecordBatch.from_arrays([pa.array(c[k : k + most]) for c in columns.values()], names=list(columns))


def tally(texts: DataFrame) -> DataFrame:
    """(code, n) of all n-grams of ``text``, a string or zstd-compressed UTF-8; sums of a task go to the shuffle."""
    packed = texts.schema["text"].dataType.simpleString() == "binary"

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, held = [], [], 0
        for part in parts:
            got = part.column("text").to_pylist()
            for _, _, code in grams([zstandard.decompress(x) for x in got] if packed else got):
                c, n = np.unique(code, return_counts=True)
                codes.append(c)
                counts.append(n)
                held += len(c)
                if held > 2_000_000:
                    c, n = _sums(codes, counts)
                    codes, counts, held = [c], [n], len(c)
                    if held > 1_000_000:  # memory stays bounded; what is summed twice is summed again behind the shuffle
                        yield from _batches(50_000, code=c, n=n)
                        codes, counts, held = [], [], 0
        c, n = _sums(codes, counts)
        yield from _batches(50_000, code=c, n=n)

    return texts.select("text").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """Modified Kneser-Ney discounts for counts of 1, 2, and 3 or more."""
    n = [0, n1, n2, n3, n4]
    if min(n[1:]) == 0:  # too little text to estimate them
        return [0.5, 0.75, 1.0]
    y = n1 / (n1 + 2 * n2)
    return [min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.05), k - 0.05) for k in (1, 2, 3)]


class Level:
    """One order: n-grams with their discounted shares, contexts with the mass they leave to the order below."""

    def __init__(self, code: np.ndarray, n: np.ndarray, off: list[float]):
        less = np.array([0.0, *off])[np.minimum(n, 3)]
        context = code >> BITS
        first = np.flatnonzero(np.diff(context, prepend=-1))
        total = np.add.reduceat(n, first) if len(first) else n[:0]
        self.code, self.context = code, context[first]
        self.share = (n - less) / np.repeat(total, np.diff(first, append=len(code)))
        self.rest = np.add.reduceat(less, first) / total if len(first) else less

    def above(self, key: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Probabilities of ``key`` at this order from those at the order below."""
        if not len(self.code):
            return p
        at = np.minimum(np.searchsorted(self.code, key), len(self.code) - 1)
        on = np.minimum(np.searchsorted(self.context, key >> BITS), len(self.context) - 1)
        rest = np.where(self.context[on] == key >> BITS, self.rest[on], 1.0)
        return np.where(self.code[at] == key, self.share[at], 0.0) + rest * p


class Model:
    """Counts of the highest order, sharded; lower orders are distinct continuations and follow from them."""

    def __init__(self, counts: DataFrame, shards: int = 1024):
        self.counts, self.shards = cut(counts), shards
        level, self.off, small = self.counts, {}, None
        for order in range(ORDER, 0, -1):
            if order <= SMALL and small is None:
                rows = level.toArrow()  # 65,536 rows at most
                small = _sums([rows.column("code").to_numpy()], [rows.column("n").to_numpy()])
            if small is None:
                row = level.agg(*[F.count(F.when(F.col("n") == k, 1)) for k in (1, 2, 3, 4)]).first()
            else:
                row = [int((small[1] == k).sum()) for k in (1, 2, 3, 4)]
            self.off[order] = discounts(*row)
            if small is None:
                level = level.select(F.col("code").bitwiseAND(F.lit(_low(order - 1))).alias("code")).groupBy("code").agg(F.count("*").alias("n"))
            else:
                self.small = [Level(*small, self.off[order]), *(self.small if order < SMALL else [])]
                small = np.unique(small[0] & _low(order - 1), return_counts=True)

    def _shard(self):
        return F.pmod(F.xxhash64(F.shiftright("code", BITS).bitwiseAND(F.lit(_low(2)))), F.lit(self.shards)).alias("shard")

    def log_probability(self, queries: DataFrame) -> DataFrame:
        """(code, logp) for each row of ``queries`` (code): one join with the counts, shard by shard."""
        off, small = self.off, self.small

        def answer(asked: pa.Table, counted: pa.Table) -> pa.Table:
            q = asked.column("code").to_numpy()
            code, n = _sums([counted.column("code").to_numpy()], [counted.column("n").to_numpy()])
            levels = []
            for order in range(ORDER, SMALL, -1):
                levels.append(Level(code, n, off[order]))
                code, n = np.unique(code & _low(order - 1), return_counts=True)
            p = np.full(len(q), 1.0 / SYMBOLS)
            for order, level in enumerate([*small, *reversed(levels)], 1):
                p = level.above(q & _low(order), p)
            return pa.table({"code": q, "logp": np.log(p).astype(np.float32)})

        asked = queries.select("code", self._shard()).groupBy("shard")
        return asked.cogroup(self.counts.select("code", "n", self._shard()).groupBy("shard")).applyInArrow(answer, "code long, logp float")

    def common(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``most`` commonest n-grams of trusted text, sorted, and their log probabilities."""
        top = self.counts.orderBy(F.desc("n"), "code").limit(most).select("code")
        rows = self.log_probability(top).toArrow()
        order = np.argsort(rows.column("code").to_numpy())
        return rows.column("code").to_numpy()[order], rows.column("logp").to_numpy()[order]


def pack(docs: DataFrame, size: int) -> DataFrame:
    """(block, body): the rows of a partition, about ``size`` bytes at a time, as compressed Arrow."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, n = TaskContext.get().partitionId() << 32, [], 0

        def row() -> pa.RecordBatch:
            table, sink = pa.Table.from_batches(held), pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as stream:
                stream.write_table(table)
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "body"])

        for part in parts:
            for k in range(0, len(part), 1_000):
                held.append(part.slice(k, 1_000))
                n += held[-1].nbytes
                if n >= size:
                    yield row()
                    number, held, n = number + 1, [], 0
        if held:
            yield row()

    return docs.mapInArrow(run, "block long, body binary")


def unpack(body: bytes) -> pa.Table:
    return pa.ipc.open_stream(body).read_all()


def score(docs: DataFrame, model: Model, keys: tuple[str, ...] = (), *, block_bytes: int = 1 << 24, most_common: int = 1 << 16) -> DataFrame:
    """(doc_id, lang, n_bytes, cross_entropy) for each row; the latter is null for empty text.

    The distinct n-grams of each block go to the shards of the model; the ``most_common`` of trusted text,
    which every block would ask for, are sent to all blocks instead. ``keys`` are long columns to carry
    along. Rows must come in the same order when read again, as they do from files.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select("doc_id", "lang", *keys, "text")
    shared = docs.sparkSession.sparkContext.broadcast(model.common(most_common))

    def ask(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value[0]
        for part in rows:
            for block, body in zip(part.column("block").to_pylist(), part.column("body"), strict=True):
                held, n = [np.zeros(0, np.int64)], 0
                for _, _, code in grams(unpack(body.as_buffer()).column("text").to_pylist()):
                    held.append(np.unique(code))
                    n += len(held[-1])
                    if n > 2_000_000:
                        held = [np.unique(np.concatenate(held))]
                        n = len(held[0])
                code = np.unique(np.concatenate(held))
                if len(known):
                    code = code[known[np.minimum(np.searchsorted(known, code), len(known) - 1)] != code]
                yield from _batches(50_000, block=np.full(len(code), block), code=code)

    def tell(left: pa.Table, right: pa.Table) -> pa.Table:
        table = pa.concat_tables([unpack(x.as_buffer()) for x in left.column("body")])
        known, logp = (np.concatenate([a, right.column(c).to_numpy()]) for a, c in zip(shared.value, ("code", "logp"), strict=True))
        order = np.argsort(known)
        known, logp = known[order], logp[order].astype(np.float64)
        n, total = np.zeros(len(table), np.int64), np.zeros(len(table))
        for which, size, code in grams(table.column("text").to_pylist()):
            np.add.at(n, which, size)
            np.add.at(total, which, np.add.reduceat(logp[np.searchsorted(known, code)], np.cumsum(size) - size))
        h = pa.array(-total / np.maximum(n, 1), mask=n == 0)
        return table.drop_columns(["text"]).append_column("n_bytes", pa.array(n)).append_column("cross_entropy", h)

    by = pack(docs, block_bytes).repartition(parts, "block")
    asked = by.mapInArrow(ask, "block long, code long").where("code is not null").repartition(parts, "code")
    # with the same columns and filters, both uses read one exchange
    once = asked.groupBy("code").agg(F.min("block").alias("first")).where("first is not null").select("code")
    told = asked.join(model.log_probability(once), "code").select("block", "code", "logp")
    carried = "".join(f"{c} long, " for c in keys)
    kinds = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang string, {carried}n_bytes long, cross_entropy double"
    return by.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(tell, kinds)


def texts_of(docs: DataFrame, ids: DataFrame, bits: int = 1 << 24) -> DataFrame:
    """Compressed ``text`` of the documents that ``ids`` (doc_id) names, so that little else is shuffled.

    A bitmap of hashes of the ids, of ``bits`` at most, goes to all tasks and keeps back most other texts; the
    join that follows is exact, whatever the bitmap lets pass.
    """
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(bits))
    pages = ids.select(place.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("page"))
    pages = pages.agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect()
    shared = docs.sparkSession.sparkContext.broadcast({r["page"]: bytes(r["bits"]) for r in pages})

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, press = shared.value, zstandard.ZstdCompressor(level=3).compress
        for part in parts:
            page, bit = part.column("page").to_pylist(), part.column("bit").to_pylist()
            at = [i for i, (p, b) in enumerate(zip(page, bit, strict=True)) if p in of and of[p][b >> 3] >> (b & 7) & 1]
            for k in range(0, len(at), 1_000):
                some = part.take(pa.array(at[k : k + 1_000], pa.int64()))
                bodies = pa.array([press((t or "").encode()) for t in some.column("text").to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), bodies], names=["doc_id", "text"])

    asked = docs.where("doc_id is not null").select("doc_id", "text", place.alias("at"))
    asked = asked.select("doc_id", "text", F.bitmap_bucket_number("at").alias("page"), F.bitmap_bit_position("at").alias("bit"))
    kept = asked.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text binary")
    return kept.hint("merge").join(ids, "doc_id", "left_semi")  # at every size: ids grow with the documents


def classify(docs: DataFrame, labels: DataFrame, *, quantile: float = 0.995, margin: float = 0.05, prior: int = 40, least: int = 50, held_out: int = 5, keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, lang, text): ``n_bytes``, ``perplexity`` (of a byte), ``threshold``, ``kept``.

    Trusted text is that of documents labelled ``quality`` = 1. One in ``held_out`` of them, by a hash of
    doc_id, is kept out of the model, all others are counted whole. A document is kept if its
    perplexity is at most its language's threshold: the ``quantile`` of held-out documents' cross entropies
    plus ``margin`` nats (percentile_approx: exact up to 20,000 held-out documents a language, beyond that
    within 1/20,000 of their number). A short text's entropy is drawn towards its language's held-out mean as if
    ``prior`` bytes of that mean came first. A language (or null) with fewer than ``least`` held-out
    documents takes the threshold over all languages; without any held-out text everything is kept but
    empty texts. Null or empty text has no perplexity and is not kept. Labels may repeat, be null or name
    unknown documents. Repeated rows are scored alike; other columns are not looked at, but ``keys`` (long)
    are carried along.
    """
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    out_of_model = F.pmod(F.xxhash64(F.lit("held out"), F.col("doc_id").cast("string")), F.lit(held_out)) == 0
    docs = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), *keys, "text")
    model = Model(tally(texts_of(docs, good.where(~out_of_model))))
    scored = cut(score(docs, model, keys))
    h = F.col("cross_entropy")
    trusted = scored.join(good.where(out_of_model), "doc_id", "left_semi").where("n_bytes > 0")
    means = trusted.groupBy("lang").agg(F.avg("cross_entropy").alias("mean"), F.count("*").alias("n"))
    overall = trusted.agg(F.avg("cross_entropy").alias("mean_all"))

    def drawn(df: DataFrame) -> DataFrame:
        df = df.join(means.withColumnRenamed("lang", "_l"), F.col("lang").eqNullSafe(F.col("_l")), "left").drop("_l").join(F.broadcast(overall))
        mean = F.coalesce(F.when(F.col("n") >= least, F.col("mean")), "mean_all", h)
        return df.withColumn("drawn", (h * F.col("n_bytes") + mean * prior) / (F.col("n_bytes") + prior)).drop("mean", "n", "mean_all")

    known = drawn(trusted)
    limits = known.groupBy("lang").agg(F.percentile_approx("drawn", quantile, 20_000).alias("limit"), F.count("*").alias("n"))
    over = known.agg(F.percentile_approx("drawn", quantile, 20_000).alias("limit_all"))
    out = drawn(scored).join(limits.withColumnRenamed("lang", "_l"), F.col("lang").eqNullSafe(F.col("_l")), "left").join(F.broadcast(over))
    limit = F.coalesce(F.when(F.col("n") >= least, F.col("limit")), "limit_all") + margin
    kept = F.coalesce(F.col("drawn") <= limit, h.isNotNull())
    return out.select("doc_id", "lang", *keys, "n_bytes", F.exp(h).alias("perplexity"), F.exp(limit).alias("threshold"), kept.alias("kept"))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return classify(docs, labels)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All columns of the documents that the classifier keeps.

    Rows are judged each by its own text and language, also where doc_id is null or repeats.
    """
    keyed = docs.withColumns(row_keys("doc_id", "lang", "text"))
    kept = classify(keyed, labels, keys=("_row0", "_row1")).where("kept").select("_row0", "_row1").distinct()
    return keyed.where("text <> ''").join(kept, ["_row0", "_row1"], "left_semi").select(*docs.columns)
