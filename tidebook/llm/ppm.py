"""Language-model scoring by prediction by partial matching over bytes, beside a smoothed unigram base.

Training counts every (context of ORDER bytes, next byte) of every training document; shorter contexts
are sums of longer ones. Every entry seen is kept, so the model grows with the corpus and is never
gathered: it is a table dealt by the three bytes before the coded one, and what shares them holds all
that orders 3 and up need. One pass over the documents takes them in chunks of about CHUNK bytes; it
counts the grams of what is learned from and notes the distinct grams of each chunk. The counts of a
shard are merged, the chunks' grams stream past them (several tasks share a shard where there are many
chunks), and the answers are summed in the chunk. Only orders 0 to 2, which are at most 2**24 entries
whatever the corpus, travel with the tasks.

A byte is coded in the longest context known. Each seen byte weighs its count less DISCOUNT;
what is taken off forms the escape weight. On escape the bytes already ruled out are
excluded from the next shorter context, and after the empty context a uniform code over the bytes left
remains, so probabilities of all bytes sum to one. The code length of a document is that of its words
(A-Z lower-cased) joined by one space, then an end mark.

The unigram base uses exact counts of every training word. Words with at least WORD_SHARE of all
tokens travel with the tasks (their summed length is bounded by the mean word length / WORD_SHARE);
all others are looked up by a join.

Defined results: a null text scores as the empty one, which is the end mark alone; equal texts score
equally; a very long text is a chunk of its own, worked through in slices; with no training documents
every byte costs log10 of 1/256 and base counts are zero; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.llm.common import fold, materialize

ORDER = 5
DISCOUNT = 0.25  # of a seen byte's count that goes to the escape weight
LOW = 2  # the longest contexts that travel with the tasks
WORD_SHARE = 2.0**-19
SHARDS = 1024  # parts that byte counts are dealt into
CHUNK = 1 << 23  # bytes of text whose grams are asked for together
SLICE = 1 << 21  # bytes of text that a step of a Python worker handles
TOGETHER = 256  # chunks whose questions one task answers for a shard
MERGED = 1_000_000  # entries that a worker holds before it passes them on
ASKED = 1 << 18  # grams that a shard answers in one step
END = b"\n"


def tokens(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased; bytes methods know ASCII only."""
    return (text or "").encode("utf-8").lower().split()


def coded(words: list[bytes], order: int) -> bytes:
    """The bytes that are coded, after order end marks of context."""
    return END * order + b" ".join(words) + END


def grams(data: np.ndarray, order: int) -> np.ndarray:
    """For each byte from position order on, it and the order (at most 7) bytes before it as one number."""
    n = len(data) - order
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    wide = np.concatenate([np.zeros(7 - order, dtype=np.uint8), data])
    windows = np.ndarray((n,), dtype=">u8", buffer=wide, strides=(1,))  # eight bytes from every offset
    return (windows & np.uint64((1 << (8 * (order + 1))) - 1)).astype(np.int64)


def indexed(data: np.ndarray, order: int, step: int = SLICE) -> tuple[np.ndarray, list[np.ndarray]]:
    """The sorted distinct grams of data, and for each slice of data the places of its grams among them."""
    keys, places = [], []
    for lo in range(order, max(len(data), order + 1), step):
        d = pa.array(grams(data[lo - order : lo + step], order)).dictionary_encode()
        k = d.dictionary.to_numpy()
        by = np.argsort(k)
        rank = np.empty(len(k), dtype=np.int32)
        rank[by] = np.arange(len(k), dtype=np.int32)
        keys.append(k[by])
        places.append(rank[d.indices.to_numpy()])
    if len(keys) == 1:
        return keys[0], places
    every = np.unique(np.concatenate(keys))
    return every, [np.searchsorted(every, k).astype(np.int32)[at] for k, at in zip(keys, places)]


def _slices(column, size: int = CHUNK):
    """Lists of consecutive texts of about size characters."""
    part, held = [], 0
    for t in column:
        part.append(t.as_py())
        held += len(part[-1] or "")
        if held >= size:
            yield part
            part, held = [], 0
    if part:
        yield part


# Rows of the one pass: parts of the counts of grams (0), grams a chunk asks for (1), parts of the sums of
# order LOW (2), parts of the counts of words (3; the null word counts ends), and the chunks themselves (4).
COUNTS, ASKS, SUMS, WORDS, CHUNKS = range(5)
_NAMES = ("kind", "shard", "chunk", "keys", "counts", "ids", "sizes", "data", "word", "n")


def gather(docs: DataFrame, order: int = ORDER, step: int = CHUNK, most: int = MERGED) -> DataFrame:
    """The rows above from docs (doc_id, text, learn, ask), written."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"kind int, shard int, chunk bigint, keys binary, counts binary, ids array<{kind}>, sizes array<int>, data binary, word binary, n bigint"
    src = docs.select("doc_id", "text", "learn", "ask")

    def run(batches):
        chunk = TaskContext.get().partitionId() << 32
        types = None
        held, size, words = [], 0, Counter()

        def rows(kind: int, size: int, **given):
            cols = [pa.array(np.full(size, kind), pa.int32()) if name == "kind" else given[name] if name in given else pa.nulls(size, types[name]) for name in _NAMES]
            return pa.RecordBatch.from_arrays(cols, names=list(_NAMES))

        def counted():
            key, n = _merge(held)
            m, given = _shards(key, n)
            yield rows(COUNTS, m, **given)
            low, sums = _suffix(key, n, LOW)
            yield rows(SUMS, 1, keys=pa.array([_pack(low)], pa.binary()), counts=pa.array([_pack(sums)], pa.binary()))

        def told():
            items = list(words.items())
            for at in range(0, len(items), 50_000):
                part = items[at : at + 50_000]
                yield rows(WORDS, len(part), word=pa.array([w for w, _ in part], pa.binary()), n=pa.array([n for _, n in part], pa.int64()))

        for b in batches:
            if types is None:
                types = {"shard": pa.int32(), "chunk": pa.int64(), "keys": pa.binary(), "counts": pa.binary(), "ids": pa.list_(b.column(0).type), "sizes": pa.list_(pa.int32()), "data": pa.binary(), "word": pa.binary(), "n": pa.int64()}
            learn, ask = (b.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in (2, 3))
            at = 0
            for part in _slices(b.column(1), step):
                here = slice(at, at + len(part))
                at += len(part)
                raw = []
                for t, learns in zip(part, learn[here]):
                    w = tokens(t)
                    raw.append(coded(w, order))
                    if learns:
                        words.update(w)
                        words[None] += 1
                data = b"".join(raw)
                sizes = np.array([len(r) for r in raw])
                keys, places = indexed(np.frombuffer(data, np.uint8), order, min(step, SLICE))
                if learn[here].any():
                    # What spans two documents is no gram of either.
                    use = np.repeat(learn[here], sizes)
                    for k in range(1, order + 1):
                        use[np.cumsum(sizes) - k] = False
                    total, lo = np.zeros(len(keys), dtype=np.int64), 0
                    for p in places:
                        total += np.bincount(p[use[lo : lo + len(p)]], minlength=len(keys))
                        lo += len(p)
                    seen = total > 0
                    held.append((keys[seen], total[seen]))
                    size += len(held[-1][0])
                    if size > most and len(held) > 1:
                        held = [_merge(held)]
                        size = len(held[0][0])
                    if size > most:
                        yield from counted()
                        held, size = [], 0
                if ask[here].any():
                    n, given = _shards(keys)
                    yield rows(ASKS, n, chunk=pa.array(np.full(n, chunk), pa.int64()), **given)
                    sub = b.slice(here.start, len(part))
                    lists = [pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), x) for x in (sub.column(0), pa.array(sizes, pa.int32()))]
                    yield rows(CHUNKS, 1, chunk=pa.array([chunk], pa.int64()), ids=lists[0], sizes=lists[1], data=pa.array([pa.compress(data, "zstd", asbytes=True)], pa.binary()))
                    chunk += 1
                if len(words) > 300_000:
                    yield from told()
                    words = Counter()
        if held:
            yield from counted()
        if words:
            yield from told()

    return materialize(src.mapInArrow(run, schema), "ppm-pass", "zstd")


def _merge(parts):
    """Sorted distinct keys and their summed counts."""
    if len(parts) == 1:
        return parts[0]
    key = np.concatenate([p[0] for p in parts])
    n = np.concatenate([p[1] for p in parts])
    by = np.argsort(key, kind="stable")
    return _sums(key[by], n[by])


def _sums(key: np.ndarray, n: np.ndarray):
    if not len(key):
        return key, n
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(n, first)


def _suffix(key: np.ndarray, n: np.ndarray, k: int):
    low = key & ((1 << (8 * (k + 1))) - 1)
    by = np.argsort(low, kind="stable")
    return _sums(low[by], n[by])


def _pack(x: np.ndarray) -> bytes:
    """Bytes of x by place value: sorted keys then compress well on the way."""
    return x.view(np.uint8).reshape(len(x), -1).T.tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(np.int64).ravel()


def _dealt(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of sorted keys by shard, and where each shard starts among them."""
    shard = (((key >> 8) & 0xFFFFFF) * 2_654_435_761 % 4_294_967_296 >> 22).astype(np.uint16)
    by = np.argsort(shard, kind="stable")
    return by, np.searchsorted(shard[by], np.arange(SHARDS + 1))


def _shards(key: np.ndarray, n: np.ndarray | None = None):
    """How many shards the keys belong to, and columns with the packed keys (and counts) of each."""
    by, cut = _dealt(key)
    key = key[by]
    out = [i for i in range(SHARDS) if cut[i] < cut[i + 1]]
    cols = {"shard": pa.array(out, pa.int32()), "keys": pa.array([_pack(key[cut[i] : cut[i + 1]]) for i in out], pa.binary())}
    if n is not None:
        n = n[by]
        cols["counts"] = pa.array([_pack(n[cut[i] : cut[i + 1]]) for i in out], pa.binary())
        return len(out), cols
    return len(out), cols


def merged(rows: DataFrame) -> DataFrame:
    """(shard, keys, counts), written: the counts of every gram, one row a shard."""

    def run(batches):
        shard, held, size = None, [], 0
        for b in batches:
            for s, k, n in zip(*(c.to_pylist() for c in b.columns)):
                if s != shard:
                    if held:
                        yield _row(shard, *_merge(held))
                    shard, held, size = s, [], 0
                held.append((_unpack(k), _unpack(n)))
                size += len(held[-1][0])
                if size > MERGED:
                    held = [_merge(held)]
                    size = len(held[0][0]) // 2
        if held:
            yield _row(shard, *_merge(held))

    src = rows.filter(F.col("kind") == COUNTS).select("shard", "keys", "counts")
    return materialize(src.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, "shard int, keys binary, counts binary"), "ppm-entries")


def _row(shard: int, key: np.ndarray, n: np.ndarray):
    return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([_pack(key)], pa.binary()), pa.array([_pack(n)], pa.binary())], names=["shard", "keys", "counts"])


def answer(rows: DataFrame, low, order: int = ORDER) -> DataFrame:
    """(chunk, shard, logp) for every question: log10 probabilities in the order of its keys.

    A worker holds the entries of one shard at a time; the questions stream past them.
    """

    def run(batches):
        shard, trie, asked, n_asked = None, None, [], 0

        def told():
            p = trie.of(np.concatenate([k for _, k in asked])).astype(np.float32)
            cut = np.cumsum([0, *(len(k) for _, k in asked)])
            return pa.RecordBatch.from_arrays(
                [pa.array([c for c, _ in asked], pa.int64()), pa.array([shard[0]] * len(asked), pa.int32()), pa.array([p[lo:hi].tobytes() for lo, hi in zip(cut, cut[1:])], pa.binary())],
                names=["chunk", "shard", "logp"],
            )

        for b in batches:
            for s, part, chunk, k, n in zip(*(c.to_pylist() for c in b.columns)):
                if (s, part) != shard:
                    if asked:
                        yield told()
                    shard, trie, asked, n_asked = (s, part), low.value, [], 0
                if n is not None:
                    trie = low.value.grown(reversed(list(_layers(_unpack(k), _unpack(n), order, LOW))))
                    continue
                asked.append((chunk, _unpack(k)))
                n_asked += len(asked[-1][1])
                if n_asked > ASKED:
                    yield told()
                    asked, n_asked = [], 0
        if asked:
            yield told()

    chunks = rows.filter(F.col("kind") == CHUNKS).select("chunk").count()
    parts = max(1, -(-chunks // TOGETHER))
    share = F.pmod(F.xxhash64("chunk"), F.lit(parts)).cast("int")
    asks = rows.filter(F.col("kind") == ASKS).select("shard", share.alias("part"), "chunk", "keys", F.lit(None).cast("binary").alias("counts"))
    known = merged(rows).select("shard", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(None).cast("bigint").alias("chunk"), "keys", "counts")
    dealt = known.unionByName(asks).repartition("shard", "part").sortWithinPartitions("shard", "part", F.col("chunk").asc_nulls_first())
    return dealt.mapInArrow(run, "chunk bigint, shard int, logp binary")


def _layers(key: np.ndarray, n: np.ndarray, order: int, low: int):
    """(k, keys, counts, totals of their contexts) for the orders from order down to above low."""
    for k in range(order, low, -1):
        e, c = _suffix(key, n, k)
        edge = np.flatnonzero(np.concatenate([[True], (e[1:] >> 8) != (e[:-1] >> 8)]))
        yield k, e, c, np.repeat(np.add.reduceat(c, edge), np.diff(np.concatenate([edge, [len(e)]])))


@dataclass
class Trie:
    """Entries and their contexts for each order, as sorted arrays; a shard's has its own part of orders 3 and up."""

    order: int
    entries: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # key, log weight, log probability when first
    nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]  # key, log total, log escape, log total below without own bytes
    uniform: float
    raw: tuple[np.ndarray, np.ndarray]  # weights of the entries and totals of the contexts of the last order

    def grown(self, layers) -> Trie:
        """This trie with the further orders (k, keys, counts, totals of their contexts)."""
        out = Trie(self.order, [*self.entries], [*self.nodes], self.uniform, self.raw)
        for k, key, n, t in layers:
            out._add(key, n, t)
            out.order = k
        return out

    def _add(self, key: np.ndarray, n: np.ndarray, t: np.ndarray) -> None:
        k = len(self.entries)
        n, t = n.astype(np.float64), t.astype(np.float64)
        by = np.argsort(key)
        key, n, t = key[by], n[by], t[by]
        ctx, first, size = np.unique(key >> 8, return_index=True, return_counts=True)
        weight = n - DISCOUNT
        kept = np.add.reduceat(weight, first) if len(first) else np.zeros(0)
        top = t[first]
        escape = np.maximum(top - kept, 1e-9)
        logw = np.log10(weight)
        if k:
            # Bytes of a context are seen after its suffix too, so the rest there is a plain difference.
            low_weight, low_top = self.raw
            at = np.searchsorted(self.entries[k - 1][0], key & ((1 << (8 * k)) - 1))
            own = np.add.reduceat(low_weight[at], first) if len(first) else np.zeros(0)
            rest = low_top[np.searchsorted(self.nodes[k - 1][0], ctx & ((1 << (8 * (k - 1))) - 1))] - own
            below = np.log10(np.maximum(rest, 1e-9))
        else:
            below = np.zeros(len(ctx))
        slim = lambda *parts: tuple(x.astype(np.float32) for x in parts)
        self.entries.append((key, *slim(logw, logw - np.repeat(np.log10(top), size))))
        self.nodes.append((ctx, *slim(np.log10(top), np.log10(escape), below)))
        self.raw = (weight, top)

    def score(self, data: np.ndarray) -> np.ndarray:
        """log10 probability of every byte of data from position order on."""
        out = []
        for lo in range(self.order, len(data), SLICE):
            keys, at = np.unique(grams(data[lo - self.order : lo + SLICE], self.order), return_inverse=True)
            out.append(self.of(keys)[at])
        return np.concatenate(out) if out else np.zeros(0)

    def of(self, full: np.ndarray) -> np.ndarray:
        """log10 probability of the last byte of each key after the bytes before it."""
        out = np.zeros(len(full), dtype=np.float64)
        live = np.arange(len(full))
        total = np.full(len(full), np.nan, dtype=np.float64)  # log total of the current context; NaN before the first
        for k in range(self.order, -1, -1):
            if not len(live):
                return out
            mask = (1 << (8 * (k + 1))) - 1
            key = full[live] & mask
            names, weight, first = self.entries[k]
            if not len(names):
                continue
            at = np.minimum(np.searchsorted(names, key), len(names) - 1)
            hit = names[at] == key
            t = total[live]
            won = live[hit]
            fresh = np.isnan(t[hit])
            out[won] += np.where(fresh, first[at[hit]], weight[at[hit]] - t[hit])
            live, key, t = live[~hit], key[~hit], t[~hit]
            ctx, sums, esc, below = self.nodes[k]
            c = key >> 8
            at = np.minimum(np.searchsorted(ctx, c), len(ctx) - 1)
            known = ctx[at] == c
            at, pos = at[known], live[known]
            t = t[known]
            out[pos] += esc[at] - np.where(np.isnan(t), sums[at], t)
            total[pos] = below[at]
        out[live] += self.uniform
        return out


def build(key: np.ndarray, n: np.ndarray, order: int = ORDER) -> Trie:
    """The trie of order from the distinct grams of order and their counts; score() gathers LOW orders only."""
    none = np.zeros(0)
    out = Trie(order, [], [], 0.0, (none, none))
    for k, *layer in reversed(list(_layers(key, n, order, -1))) if len(key) else [(k, np.zeros(0, np.int64), none, none) for k in range(order + 1)]:
        out._add(*layer)
    left = 256 - len(out.entries[0][0])
    out.uniform = -math.log10(left) if left else 0.0
    return out


def _sums_of(rows: DataFrame) -> Trie:
    """The trie of orders up to LOW, from at most 2**24 sums."""

    def run(batches):
        for b in batches:
            for k, n in zip(*(c.to_pylist() for c in b.columns)):
                yield pa.RecordBatch.from_arrays([pa.array(_unpack(k)), pa.array(_unpack(n))], names=["key", "n"])

    parts = rows.filter(F.col("kind") == SUMS).select("keys", "counts").mapInArrow(run, "key bigint, n bigint")
    sums = parts.groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    key, n = (sums.column(c).to_numpy() for c in range(2))
    by = np.argsort(key)
    return build(key[by], n[by], LOW)


def score(docs: DataFrame, train: DataFrame | Column, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, step: int = CHUNK, most: int = MERGED) -> DataFrame:
    """docs' ids with n_tokens, n_known, train_tokens, base_score and score.

    What is learned from is another table, or the rows of docs for which a column holds.
    """
    spark = docs.sparkSession
    text = F.col(text_col).cast("string").alias("text")
    if isinstance(train, Column):
        src = docs.select(F.col(id_col).alias("doc_id"), text, F.coalesce(train, F.lit(False)).alias("learn"), F.lit(True).alias("ask"))
    else:
        src = docs.select(F.col(id_col).alias("doc_id"), text, F.lit(False).alias("learn"), F.lit(True).alias("ask"))
        src = src.unionByName(train.select(F.lit(None).cast(docs.schema[id_col].dataType).alias("doc_id"), text, F.lit(True).alias("learn"), F.lit(False).alias("ask")))
    rows = gather(src, order, step, most)
    trie = _sums_of(rows)
    low = spark.sparkContext.broadcast(trie)
    untold = math.nan if len(trie.entries[0][0]) else trie.uniform  # without training all bytes are alike
    words = materialize(rows.filter(F.col("kind") == WORDS).groupBy("word").agg(F.sum("n").alias("n")), "ppm-words")
    n_all, v_all = words.agg(F.sum("n"), F.count("*")).first()
    n_all = n_all or 0
    whole = math.log10(n_all + 0.1 * (v_all + 1))
    often = words.filter(F.col("n") >= WORD_SHARE * n_all)
    hot = {r["word"]: r["n"] for r in often.select("word", "n").collect()}
    shared = spark.sparkContext.broadcast({None if k is None else bytes(k): math.log10(n + 0.1) - whole for k, n in hot.items()})
    none = math.log10(0.1) - whole
    told = answer(rows, low, order).groupBy("chunk").agg(F.collect_list(F.struct("shard", "logp")).alias("told"))
    parts = rows.filter(F.col("kind") == CHUNKS).select("chunk", "ids", "sizes", "data")

    def run(batches):
        known = shared.value
        end = known.get(None)
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            for at in range(b.num_rows):
                ids, sizes, data, told = (b.column(c)[at] for c in range(4))
                sizes = sizes.as_py()
                data = pa.decompress(data.as_py(), sum(sizes), "zstd", asbytes=True)
                total = np.cumsum(np.concatenate([[0.0], _priced(np.frombuffer(data, np.uint8), told.as_py(), untold, order, step)]))
                # What spans two documents of the chunk is cut out again here.
                stop = np.cumsum(sizes) - order
                start = np.concatenate([[0], stop[:-1] + order])
                n, n_hot, base, rare, times = [], [], [], [], []
                for lo, hi in zip(start, stop):
                    w = data[lo + order : hi + order - 1].split()
                    p = list(map(known.get, w))
                    unseen = p.count(None)
                    mine = Counter(x for x, q in zip(w, p) if q is None) if unseen else Counter()
                    if end is None:
                        mine[None] = 1
                    n.append(len(w) + 1)
                    n_hot.append(len(w) - unseen + (end is not None))
                    base.append(sum(q for q in p if q is not None) + (end or 0.0))
                    rare.append(list(mine))
                    times.append(list(mine.values()))
                yield pa.RecordBatch.from_arrays(
                    [ids.values, pa.array(np.arange(row, row + len(n))), pa.array(n, pa.int64()), pa.array(n_hot, pa.int64()), pa.array(base, pa.float64()), pa.array(total[stop] - total[start]), pa.array(rare, pa.list_(pa.binary())), pa.array(times, pa.list_(pa.int32()))],
                    names=["doc_id", "row", "n_tokens", "n_hot", "base_hot", "score", "rare", "times"],
                )
                row += len(n)

    kind = docs.schema[id_col].dataType.simpleString()
    scored = parts.join(told, "chunk", "left").select("ids", "sizes", "data", F.coalesce("told", F.array()).alias("told"))
    scored = materialize(scored.mapInArrow(run, f"doc_id {kind}, row bigint, n_tokens bigint, n_hot bigint, base_hot double, score double, rare array<binary>, times array<int>"), "ppm-scored", "zstd")
    # Each row asks for its rare words; none of them is in many rows.
    asked = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("row", F.col("w.rare").alias("word"), F.col("w.times").alias("times"))
    rare_words = words.filter(F.col("n") < WORD_SHARE * n_all)
    logp = F.log10(F.col("n") + 0.1) - F.lit(whole)
    found = asked.filter("word IS NOT NULL").join(rare_words.filter("word IS NOT NULL"), "word", "left")
    rest = found.groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).cast("long").alias("n_rare"),
        F.sum(F.col("times") * F.coalesce(logp, F.lit(none))).alias("base_rare"),
    )
    # The end mark is a frequent token unless there was no training document or documents are very long.
    end_n = words.filter("word IS NULL").agg(F.sum("n")).first()[0] or 0
    end_rare = 0 if end_n >= WORD_SHARE * n_all and end_n else 1
    end_logp = math.log10(end_n + 0.1) - whole
    return scored.drop("rare", "times").join(rest, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_hot") + F.coalesce("n_rare", F.lit(0)) + (1 if end_rare and end_n else 0)).cast("long").alias("n_known"),
        F.lit(int(n_all)).cast("long").alias("train_tokens"),
        (F.col("base_hot") + F.coalesce("base_rare", F.lit(0.0)) + end_rare * end_logp).alias("base_score"),
        "score",
    )


def _priced(data: np.ndarray, told, untold: float, order: int, step: int = CHUNK) -> np.ndarray:
    """log10 probability of every byte of data from position order on, from the shards' answers; untold where they name none."""
    keys, places = indexed(data, order, min(step, SLICE))
    by, cut = _dealt(keys)
    logp = np.full(len(keys), untold)
    if not math.isnan(untold):
        told = ()
    for row in told:
        i = row["shard"]
        logp[by[cut[i] : cut[i + 1]]] = np.frombuffer(row["logp"], np.float32)
    return np.concatenate([logp[at] for at in places])


def held_out(id_col: str = "doc_id"):
    """True for the tenth of ids that is not learned from."""
    return fold(id_col, 10) == 0
