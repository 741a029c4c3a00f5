"""SimHash near-duplicates by tiled exact comparison.

A fingerprint is the bitwise majority of the XXH64 (seed 42) values of a text's word shingles.
Fingerprints are grouped into tiles by the population counts of their four 16-bit words. Two
fingerprints within the radius have count vectors whose distance (sum of absolute differences) is
at most the radius, so every other pair of tiles is skipped; the tiles that remain are compared in
full with exclusive-or and bit counts. The comparison is exact: no pair within the radius is missed.

near_texts() finds groups by the Jaccard likeness of sets of five-word shingles instead: SimHashes of
256 bits are compared tile by tile within a radius that such pairs keep to, and the classes so found are
split by the exact likeness of their sets.

Defined results: a null or empty text has no words and the fingerprint zero, which links like any
other (for near_texts(): the empty set, equal to itself only); a very long text is one value, hashed in
blocks; fewer words than a shingle give one shingle of all words; repeated rows each get a row; a
null doc_id is fingerprinted and grouped, and is never a component_id unless all members' ids are
null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebook.llm.common import components, join_hot, local_roots, materialize, release

SEED = 42
CHUNK = 4096  # fingerprints of one tile that one task holds; larger tiles are split
STEP = 1 << 20  # comparisons in one numpy block
WIDE = 4  # 64-bit words of the fingerprints that near_texts() compares
HEADS = 16  # smallest hashes that tiles are made of
RADIUS_SIGMA = 4.0  # deviations that the radius of wide fingerprints leaves room for
EXACT, VOLUME = 1024, 1 << 20  # sets of one class, and hashes in them, that one task holds; larger classes are split
LOCAL = 1 << 18  # edges that one task turns into classes, and rows that are broadcast; beyond, both are dealt out


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of a whole text, as an unsigned integer."""
    words = (text or "").encode("utf-8").lower().split()  # bytes.lower and bytes.split know ASCII only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    h = np.fromiter((digest(join(words[i : i + shingle]), SEED) for i in range(n)), dtype=np.uint64, count=n)
    bits = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 4096):
        block = h[at : at + 4096].view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(bits * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp) for every row; fp is the fingerprint as a signed long."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(1)), dtype=np.uint64, count=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, fp bigint")


def _offsets(radius: int) -> list[tuple[int, ...]]:
    """Moves from a tile to the later tiles within the radius, itself first."""
    span = range(-radius, radius + 1)
    return [o for o in product(span, repeat=4) if sum(map(abs, o)) <= radius and o >= (0, 0, 0, 0)]


def _compare(home: np.ndarray, other: np.ndarray, radius: int):
    """Index pairs (i, j) with at most radius differing bits, in blocks of bounded size."""
    wide = max(1, STEP // max(1, len(home)))
    for at in range(0, len(other), wide):
        part = other[at : at + wide]
        i, j = np.nonzero(np.bitwise_count(home[:, None] ^ part[None, :]) <= radius)
        yield i, j + at


class _Tile:
    """One task's share of a tile: its own fingerprints, then visitors as they stream past."""

    def __init__(self, radius: int):
        self.radius, self.home, self.lab, self.out = radius, [], None, []

    def own(self, fps: np.ndarray) -> None:
        self.home.append(fps)

    def visit(self, fps: np.ndarray) -> None:
        self._settle()
        for i, j in _compare(self.mine, fps, self.radius):
            if len(i):
                first = np.full(len(fps), len(self.mine))
                np.minimum.at(first, j, i)
                hit = np.unique(j)
                self.out.append((fps[hit], self.mine[first[hit]]))
                self._join(i, first[j])

    def _settle(self) -> None:
        if self.lab is None:
            self.mine = np.concatenate(self.home) if self.home else np.zeros(0, np.uint64)
            self.lab = np.arange(len(self.mine))
            for i, j in _compare(self.mine, self.mine, self.radius):
                self._join(i[i < j], j[i < j])

    def _join(self, i: np.ndarray, j: np.ndarray) -> None:
        """Merge the classes of the own fingerprints i and j."""
        if len(i):
            self.lab = local_roots(len(self.lab), np.concatenate([np.arange(len(self.lab)), i]), np.concatenate([self.lab, j]))

    def edges(self):
        self._settle()
        own = np.nonzero(self.lab != np.arange(len(self.lab)))[0]
        parts = [*self.out, (self.mine[own], self.mine[self.lab[own]])]
        return [np.concatenate([p[k] for p in parts]).view(np.int64) for k in (0, 1)]


def links(fps: DataFrame, radius: int = 2, chunk: int = CHUNK) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of fps.fp within the radius.

    fps has one row per distinct fingerprint. Each task emits a spanning forest of the links it
    finds, so the rows made are linear in the fingerprints whatever the size of a group.
    """
    quarter = [F.bit_count(F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF))) for k in range(4)]
    rows = fps.select("fp", *(q.alias(f"q{k}") for k, q in enumerate(quarter)))

    def key(cols):
        return ((cols[0] * 17 + cols[1]) * 17 + cols[2]) * 17 + cols[3]

    # At most 17**4 tiles exist, so the table of their sizes is under 2 MB at any input size.
    tiles = rows.groupBy(key([F.col(f"q{k}") for k in range(4)]).alias("tile")).agg(F.ceil(F.count("*") / chunk).cast("int").alias("chunks"))
    moves = F.array(*[F.struct(*[F.lit(x).alias(f"o{k}") for k, x in enumerate(o)]) for o in _offsets(radius)])
    sent = (
        rows.withColumn("o", F.explode(moves))
        .select("fp", *[(F.col(f"q{k}") + F.col(f"o.o{k}")).alias(f"t{k}") for k in range(4)], F.expr("o.o0=0 AND o.o1=0 AND o.o2=0 AND o.o3=0").alias("own"))
        .filter(" AND ".join(f"t{k} BETWEEN 0 AND 16" for k in range(4)))
        .select("fp", "own", key([F.col(f"t{k}") for k in range(4)]).alias("tile"))
        .join(F.broadcast(tiles), "tile")
        .withColumn("mine", F.when(F.col("own"), F.pmod(F.xxhash64("fp"), F.col("chunks"))).otherwise(F.lit(-1)).cast("int"))
        .withColumn("chunk", F.explode(F.sequence(F.greatest(F.col("mine"), F.lit(0)), F.col("chunks") - 1)))
        .select((F.col("tile") * F.lit(1 << 31).cast("bigint") + F.col("chunk")).alias("task"), (F.col("mine") != F.col("chunk")).cast("int").alias("visitor"), "fp")
    )

    def run(batches):
        task, tile = None, None
        for b in batches:
            t, v, f = (b.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            f = f.astype(np.int64).view(np.uint64)
            cut = np.flatnonzero((np.diff(t) != 0) | (np.diff(v) != 0)) + 1
            for lo, hi in zip([0, *cut], [*cut, len(t)]):
                if lo == hi:
                    continue
                if t[lo] != task:
                    if tile is not None:
                        a, z = tile.edges()
                        if len(a):
                            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(z)], names=["a", "b"])
                    task, tile = t[lo], _Tile(radius)
                (tile.visit if v[lo] else tile.own)(f[lo:hi])
        if tile is not None:
            a, z = tile.edges()
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(z)], names=["a", "b"])

    return sent.repartition("task").sortWithinPartitions("task", "visitor").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, fp, component_id, root) for every row; component_id is the smallest doc_id reachable.

    root is the smallest fingerprint of the component: it tells components apart even where ids repeat.
    """
    marked = materialize(fingerprints(docs, id_col, text_col, shingle), "simhash")
    reps = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")), "simhash-distinct")
    linked = components(links(reps.select("fp"), radius), "simhash-links")
    member = linked.join(reps, F.col("node") == F.col("fp")).select("fp", "root", "low")
    root = member.groupBy("root").agg(F.min("low").alias("component_id"))
    found = member.join(root, "root").select("fp", "root", "component_id")
    known = reps.join(found, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "low").alias("component_id"), "n")
    return join_hot(marked, materialize(known, "simhash-known"), ["fp"], "n").select("doc_id", "fp", "component_id", "root")


def _mixed(h: np.ndarray, k: int) -> np.ndarray:
    """The k-th 64-bit word derived from each hash."""
    x = h + np.uint64(0x9E3779B97F4A7C15 * (k + 1) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int) -> np.ndarray:
    """The sorted distinct XXH64 values of a text's runs of words; fewer words are one run."""
    w = (text or "").encode("utf-8").lower().split()
    digest, join = xxhash.xxh64_intdigest, b" ".join
    n = max(1, len(w) - words + 1) if w else 0
    return np.unique(np.fromiter((digest(join(w[i : i + words]), SEED) for i in range(n)), dtype=np.uint64, count=n))


def wide_fingerprint(h: np.ndarray) -> np.ndarray:
    """The SimHash of a set of hashes, WIDE words of 64 bits."""
    out = np.zeros(WIDE, dtype=np.uint64)
    for k in range(WIDE):
        bits = np.zeros(64, dtype=np.int64)
        for at in range(0, len(h), 4096):
            bits += np.unpackbits(_mixed(h[at : at + 4096], k).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[k] = np.packbits(bits * 2 > len(h), bitorder="little").view(np.uint64)[0]
    return out


def sketches(docs: DataFrame, words: int, least: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, same, key, size, fp, heads) for every row: digests of its text and of its set of shingles, the set's
    size, wide SimHash, and smallest hashes: as many as exactness asks for, HEADS at most."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.md5(text)).alias("same"), text.alias("text"))

    def run(batches):
        for b in batches:
            keys, sizes, fps, heads = [], [], [], []
            for t in b.column(2):
                h = shingles(t.as_py(), words)
                keys.append(hashlib.md5(h.tobytes()).digest())
                sizes.append(len(h))
                fps.append(wide_fingerprint(h).view(np.int64))
                heads.append(h[: min(HEADS, len(h) - math.ceil(least * len(h) - 1e-9) + 1)].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1).cast(pa.binary()), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(fps, pa.list_(pa.int64())), pa.array(heads, pa.list_(pa.int64()))],
                names=["doc_id", "same", "key", "size", "fp", "heads"],
            )

    kind = src.schema["doc_id"].dataType.simpleString()
    return materialize(src.mapInArrow(run, f"doc_id {kind}, same binary, key binary, size int, fp array<bigint>, heads array<bigint>"), "simhash-sketches")


class _Wide:
    """Rows of a tile, searched for those whose wide fingerprints lie within the radius and whose sizes allow a link."""

    def __init__(self, rows: dict, radius: int, least: float):
        self.rows, self.radius, self.least = rows, radius, least

    def near(self, other: dict):
        """Index pairs (own, other) in blocks; blocks whose sizes or population counts rule out a link are skipped."""
        mine, radius, least = self.rows, self.radius, self.least
        wide = max(1, STEP // len(mine["size"]))
        low, high = least * float(mine["size"].min()), float(mine["size"].max()) / least
        fit = np.flatnonzero((other["size"] >= low - 1e-9) & (other["size"] <= high + 1e-9))
        fit = fit[np.argsort(other["pop"][fit], kind="stable")]
        spread = int(mine["pop"].min()) - radius, int(mine["pop"].max()) + radius
        for at in range(0, len(fit), wide):
            j = fit[at : at + wide]
            pop = other["pop"][j]
            if pop[-1] < spread[0] or pop[0] > spread[1]:
                continue
            far = np.zeros((len(mine["size"]), len(j)), dtype=np.uint16)
            for k in range(WIDE):
                far += np.bitwise_count(mine["fp"][:, k][:, None] ^ other["fp"][j, k][None, :])
            a, b = mine["size"][:, None], other["size"][j][None, :]
            x, y = np.nonzero((far <= radius) & (np.minimum(a, b) >= least * np.maximum(a, b) - 1e-9))
            yield x, j[y]


class _Sets:
    """Rows of a class as an inverted index of their shingles, searched for sets of likeness least or more: exact."""

    def __init__(self, rows: dict, least: float):
        self.least, self.size = least, np.array([len(s) for s in rows["set"]])
        self.known, at = np.unique(np.concatenate(list(rows["set"])), return_inverse=True)
        self.who = np.repeat(np.arange(len(self.size)), self.size)[np.argsort(at, kind="stable")]
        self.ends = np.cumsum(np.bincount(at, minlength=len(self.known)))

    def near(self, other: dict):
        """Index pairs (own, other) in blocks of bounded size."""
        i, j, held = [], [], 0
        for k, s in enumerate(other["set"]):
            at = np.minimum(np.searchsorted(self.known, s), len(self.known) - 1)
            at = at[self.known[at] == s]
            n = self.ends[at] - np.where(at > 0, self.ends[at - 1], 0)
            # The postings of all its shingles, one after the other.
            both = np.bincount(self.who[np.repeat(self.ends[at] - np.cumsum(n), n) + np.arange(n.sum())], minlength=len(self.size))
            hit = np.flatnonzero((both > 0) & (both >= self.least * (self.size + len(s) - both) - 1e-9))
            i.append(hit)
            j.append(np.full(len(hit), k))
            held += len(hit)
            if held > STEP:
                yield np.concatenate(i), np.concatenate(j)
                i, j, held = [], [], 0
        if i:
            yield np.concatenate(i), np.concatenate(j)


class _Group(_Tile):
    """One task's share of a tile or class: its own rows, then visitors as they stream past; index makes the own ones searchable."""

    def __init__(self, index):
        self.index, self.home, self.lab, self.out = index, [], None, []

    def visit(self, rows: dict) -> None:
        self._settle()
        if not self.home:
            return
        for i, j in self.search.near(rows):
            first = np.full(len(rows["key"]), len(self.mine))
            np.minimum.at(first, j, i)
            hit = np.unique(j)
            self.out.append((rows["key"][hit], self.mine[first[hit]]))
            self._join(i, first[j])

    def _settle(self) -> None:
        if self.lab is None:
            rows = {k: np.concatenate([h[k] for h in self.home]) for k in self.home[0]} if self.home else {"key": np.zeros(0, object)}
            self.mine = rows["key"]
            self.lab = np.arange(len(self.mine))
            if self.home:
                self.home, self.search = [True], self.index(rows)
                for i, j in self.search.near(rows):
                    self._join(i[i < j], j[i < j])

    def edges(self) -> tuple[list, list]:
        self._settle()
        own = np.flatnonzero(self.lab != np.arange(len(self.lab)))
        parts = [*self.out, (self.mine[own], self.mine[self.lab[own]])]
        return [x for p in parts for x in p[0]], [x for p in parts for x in p[1]]


def _forests(rows: DataFrame, columns: list[str], read, index) -> DataFrame:
    """Distinct edges (a, b) of keys whose components are those of all links that index() finds within a tile.

    rows has tile, chunks and key; a tile of several chunks is dealt so that each task holds one chunk and the rows of
    the earlier ones stream past. A task emits a spanning forest of its links, so the rows made are linear in the rows
    dealt whatever the links of a group. read turns the columns of a batch into arrays by name.
    """
    sent = (
        rows.withColumn("mine", F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int"))
        .withColumn("part", F.explode(F.sequence(F.col("mine"), F.col("chunks") - 1)))
        .select("tile", "part", (F.col("mine") != F.col("part")).cast("int").alias("visitor"), "key", *columns)
    )

    def run(batches):
        at, group = None, None

        def told():
            a, b = group.edges()
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

        for b in batches:
            tile, part, visitor, key = (b.column(c).to_numpy(zero_copy_only=False) for c in range(4))
            cols = {"key": key} | read(b.columns[4:])
            cut = np.flatnonzero((np.diff(tile) != 0) | (np.diff(part) != 0) | (np.diff(visitor) != 0)) + 1
            for lo, hi in zip([0, *cut], [*cut, len(tile)]):
                if lo == hi:
                    continue
                if (tile[lo], part[lo]) != at:
                    if group is not None:
                        yield from told()
                    at, group = (tile[lo], part[lo]), _Group(index)
                (group.visit if visitor[lo] else group.own)({k: v[lo:hi] for k, v in cols.items()})
        if group is not None:
            yield from told()

    found = sent.repartition("tile", "part").sortWithinPartitions("tile", "part", "visitor").mapInArrow(run, "a binary, b binary")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _alike_fingerprints(index: DataFrame, radius: int, least: float) -> DataFrame:
    """Edges of the rows (tile, chunks, key, size, fp) that share a tile and lie within the radius."""

    def read(columns):
        fp = columns[1].flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, WIDE)
        return {"size": columns[0].to_numpy(zero_copy_only=False).astype(np.float64), "fp": fp, "pop": np.bitwise_count(fp).sum(axis=1, dtype=np.int64)}

    return _forests(index, ["size", "fp"], read, lambda rows: _Wide(rows, radius, least))


def _alike_sets(sets: DataFrame, least: float) -> DataFrame:
    """Edges of the rows (tile, chunks, key, set) that share a tile and whose sets have a likeness of least or more."""

    def read(columns):
        flat, ends = columns[0].flatten().to_numpy(zero_copy_only=False), columns[0].offsets.to_numpy()
        out = np.empty(len(columns[0]), dtype=object)
        for k, (lo, hi) in enumerate(zip(ends[:-1] - ends[0], ends[1:] - ends[0])):
            out[k] = flat[lo:hi]
        return {"set": out}

    return _forests(sets, ["set"], read, lambda rows: _Sets(rows, least))


def near_texts(docs: DataFrame, words: int = 5, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """(sketches, (key, root)): root names the class of each set of shingles, linked by a Jaccard likeness of least or more.

    Sets that share one of their smallest hashes make a tile. Two sets of likeness least share none of HEADS
    with probability (1 - least) ** HEADS, 7e-12 at 0.8; small sets keep all the hashes that make this exact.
    In a tile wide SimHashes are compared in full; what is reachable over pairs within the radius is a wide class.
    The sets of such a class meet once more and are compared exactly, all with all, by an inverted index, so no link
    is lost, and either comparison passes on spanning forests only: no pairs are listed, however many are within the
    radius without being linked.
    """
    found = sketches(docs, words, least, id_col, text_col)
    first = [F.any_value(c).alias(c) for c in ("same", "size", "fp", "heads")]
    reps = materialize(found.groupBy("key").agg(*first), "simhash-sets", rows=found.count())
    n = reps.count()
    # SimHash bits differ at a rate of angle / pi; RADIUS_SIGMA deviations above the mean at least are let pass.
    rate = math.acos(2 * least / (1 + least)) / math.pi
    radius = math.ceil(64 * WIDE * rate + RADIUS_SIGMA * math.sqrt(64 * WIDE * rate * (1 - rate)))
    # Most hashes have one set: keys alone are dealt by hash, and what is left meets its fingerprint afterwards.
    index = reps.select("key", F.explode("heads").alias("tile"))
    sizes = index.groupBy("tile").agg(F.count("*").alias("n")).filter("n > 1")
    sizes = materialize(sizes.withColumn("chunks", F.ceil(F.col("n") / chunk).cast("int")), "simhash-tiles", rows=n)
    index = join_hot(index, sizes, ["tile"], "n").join(reps.select("key", "size", "fp"), "key")
    pairs = materialize(_alike_fingerprints(index, radius, least), "simhash-pairs", rows=n)
    release(sizes)
    classes = components(pairs, "simhash-classes", LOCAL).withColumnRenamed("node", "key")
    classes = materialize(classes.join(reps.select("key", "same", "size"), "key"), "simhash-classes", rows=n)
    release(pairs)
    most = F.greatest(F.count("*") / min(chunk, EXACT), F.sum("size") / VOLUME)
    split = classes.groupBy("root").agg(F.count("*").alias("n"), F.ceil(most).cast("int").alias("chunks"))
    total = classes.count()
    wanted = join_hot(classes, split, ["root"], "n", total).select("key", "same", F.xxhash64("root").alias("tile"), "chunks")
    wanted = materialize(wanted, "simhash-wanted", rows=total)
    release(classes)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.unhex(F.md5(text)).alias("same"), text.alias("text")).join(F.broadcast(wanted) if total <= LOCAL else wanted, "same")
    texts = texts.groupBy("key").agg(*[F.any_value(c).alias(c) for c in ("tile", "chunks", "text")])

    def run(batches):
        for b in batches:
            sets = [shingles(t.as_py(), words).view(np.int64) for t in b.column(3)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(sets, pa.list_(pa.int64()))], names=["key", "tile", "chunks", "set"])

    sets = texts.mapInArrow(run, "key binary, tile bigint, chunks int, set array<bigint>")
    good = materialize(_alike_sets(sets, least), "simhash-good", rows=total)
    known = components(good, "simhash-roots", LOCAL).withColumnRenamed("node", "key")
    known = materialize(reps.select("key").join(known, "key", "left").select("key", F.coalesce("root", "key").alias("root")), "simhash-known", rows=n)
    release(reps, wanted, good)
    return found, known


def distinct_documents(docs: DataFrame, words: int = 5, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row left of each group of near-duplicates (see near_texts): the smallest id's, null ids last."""
    rows, known = near_texts(docs, words, least, id_col, text_col)
    # Of rows with one set the best is found first, so that copies do not meet in one task.
    best = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "same")).alias("b")
    keep = rows.groupBy("key").agg(best).join(known, "key").groupBy("root").agg(F.min("b").alias("b"))
    keep = materialize(keep.select(F.col("b.doc_id").alias("keep"), F.col("b.same").alias("kept"), F.xxhash64("b.doc_id", "b.same").alias("_at")), "simhash-kept")
    release(rows, known)
    # The row travels as one value, so that its other columns may have any names.
    same = F.unhex(F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    src = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), same.alias("same"))
    left = src.withColumn("_at", F.xxhash64("id", "same")).join(keep, "_at").filter(F.col("id").eqNullSafe(F.col("keep")) & (F.col("same") == F.col("kept")))
    # Rows repeated with the same id and text meet after the join anyway; one of them stays.
    first = F.row_number().over(Window.partitionBy("_at", "id", "same").orderBy(f"row.{text_col}"))
    return left.withColumn("n", first).filter("n = 1").select("row.*")


def hexed(fp: str = "fp"):
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
