"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations.

Vectors are rotated by three rounds of random signs and a Walsh-Hadamard transform; the closest signed
axis of a rotation is one hash, HASHES of them make a bucket, and TABLES independent buckets are kept for
each vector, each with PROBES further buckets reached by the second-best axis where it is nearly as
good. A pair is a candidate if, in some table, one vector's bucket is among the other's buckets.
Every candidate pair is verified by its cosine in double precision.

Exact copies collapse to one representative with a weight. Pairs are verified inside the task that
holds a bucket, which emits one row a vector (its links here and its class here), never one row a pair;
a pair that meets in several buckets counts in the first of them only, which both vectors' bucket lists
tell. Large buckets are split into chunks; a task holds one chunk, past which the others it meets stream.

Defined results: vectors of different or null label, or of different length, are not compared; a vector
that is null, empty, zero, or holds null or non-finite components links with nothing, and so does one
with a null id; rows repeated with the same id, label and vector are one vector and give one row; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.llm.common import components, join_hot, local_roots, materialize

TABLES, HASHES, PROBES = 8, 2, 2
CHUNK = 2048
SEED = 20_260_101


def _signs(dim: int, tables: int, hashes: int) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    return rng.choice(np.array([-1.0, 1.0]), size=(tables * hashes, 3, dim))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows of x, whose width is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def buckets(x: np.ndarray, tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES) -> tuple[np.ndarray, np.ndarray]:
    """(own bucket by table, probed buckets by table and probe) of the unit rows of x."""
    n, dim = x.shape
    width = 1 << max(1, (dim - 1).bit_length())
    signs = _signs(width, tables, hashes)
    pad = np.zeros((n, width))
    pad[:, :dim] = x
    own = np.zeros((n, tables), dtype=np.int64)
    best, gap = np.zeros((n, hashes), dtype=np.int64), np.zeros((n, hashes))
    second = np.zeros((n, hashes), dtype=np.int64)
    probe = np.zeros((n, tables, probes), dtype=np.int64)
    row = np.arange(n)
    base = 2 * width
    for t in range(tables):
        for k in range(hashes):
            y = pad
            for s in signs[t * hashes + k]:
                y = hadamard(y * s)
            size = np.abs(y)
            a = size.argmax(axis=1)
            top = size[row, a]
            best[:, k] = 2 * a + (y[row, a] < 0)
            size[row, a] = -1.0
            b = size.argmax(axis=1)
            second[:, k] = 2 * b + (y[row, b] < 0)
            gap[:, k] = top - size[row, b]
        code = best @ (base ** np.arange(hashes))
        own[:, t] = code
        order = np.argsort(gap, axis=1, kind="stable")
        for p in range(probes):
            # The p-th probe swaps the coordinate whose runner-up is p-th closest.
            k = order[:, p % hashes]
            probe[:, t, p] = code + (second[row, k] - best[row, k]) * base**k
    return own, probe


def _met_before(oi, pi, oj, pj, table: int) -> np.ndarray:
    """Whether pairs of rows with these buckets are candidates in a table before the given one."""
    seen = np.zeros(len(oi), dtype=bool)
    for t in range(table):
        seen |= oi[:, t] == oj[:, t]
        seen |= (pi[:, t] == oj[:, t, None]).any(axis=1) | (pj[:, t] == oi[:, t, None]).any(axis=1)
    return seen


class _Bucket:
    """One task's share of a bucket: its own vectors are held, visitors stream past; links are counted, classes formed in place."""

    def __init__(self, least: float):
        self.least, self.parts, self.home, self.out = least, [], None, []

    def own(self, rows: dict) -> None:
        self.parts.append(rows)

    def _settle(self) -> None:
        if self.home is None:
            self.home = {k: np.concatenate([p[k] for p in self.parts]) for k in self.parts[0]} if self.parts else None
            self.parts = []
            if self.home is not None:
                self.count = np.zeros(len(self.home["id"]), dtype=np.int64)
                self.lab = np.arange(len(self.home["id"]))
                self._meet(self.home, True)

    def visit(self, rows: dict) -> None:
        self._settle()
        if self.home is not None:
            self._meet(rows, False)

    def _meet(self, other: dict, same: bool) -> None:
        """Count the links of the own vectors with others, in blocks of bounded size; a visitor's row goes out at once."""
        home = self.home
        step = max(1, (1 << 20) // max(1, len(home["id"])))
        for at in range(0, len(other["id"]), step):
            part = {k: x[at : at + step] for k, x in other.items()}
            i, j = np.nonzero(home["x"] @ part["x"].T >= self.least - 1e-9)
            keep = (home["id"][i] != part["id"][j]) & (home["group"][i] == part["group"][j])
            if same:
                keep &= i < j + at
            i, j = i[keep], j[keep]
            if not len(i):
                continue
            exact = (home["raw"][i] * part["raw"][j]).sum(axis=1) / (home["norm"][i] * part["norm"][j]) >= self.least
            i, j = i[exact], j[exact]
            table = int(home["table"][0])
            fresh = ~_met_before(home["own"][i], home["probe"][i], part["own"][j], part["probe"][j], table)
            # A pair that probes both ways meets in two buckets of this table: the smaller bucket counts it.
            oi, oj = home["own"][i, table], part["own"][j, table]
            back = (home["probe"][i, table] == oj[:, None]).any(axis=1)
            fresh &= ~((part["role"][j] == 2) & ((oi == oj) | (back & (oj < oi))))
            i, j = i[fresh], j[fresh]
            if not len(i):
                continue
            np.add.at(self.count, i, part["w"][j])
            if same:
                np.add.at(self.count, j + at, home["w"][i])
                self._join(i, j + at)
                continue
            first = np.full(len(part["id"]), len(home["id"]))
            np.minimum.at(first, j, i)
            links = np.zeros(len(part["id"]), dtype=np.int64)
            np.add.at(links, j, home["w"][i])
            hit = np.unique(j)
            self.out.append((part["id"][hit], links[hit], home["id"][first[hit]]))
            self._join(i, first[j])

    def _join(self, i: np.ndarray, j: np.ndarray) -> None:
        """Merge the classes of the own vectors i and j."""
        self.lab = local_roots(len(self.lab), np.concatenate([np.arange(len(self.lab)), i]), np.concatenate([self.lab, j]))

    def told(self, last: bool) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(id, linked weight, id of one of its class) of the visitors that linked since, and at last of the own vectors."""
        out, self.out = self.out, []
        if last:
            self._settle()
            if self.home is not None:
                hit = np.flatnonzero(self.count)
                out.append((self.home["id"][hit], self.count[hit], self.home["id"][self.lab[hit]]))
        return [p for p in out if len(p[0])]


def _columns(batch, tables: int, probes: int):
    """Runs of a batch's rows of one task and role kind as (task, visitors, arrays); vectors are double precision."""
    get = lambda name: batch.column(name).to_numpy(zero_copy_only=False)
    flat = lambda name: batch.column(name).flatten().to_numpy(zero_copy_only=False)
    n = batch.num_rows
    task, role, dim = get("task"), get("role"), get("dim")
    cols = {"id": get("id"), "w": get("w"), "role": role, "table": get("table"), "group": get("group"), "own": flat("own").reshape(n, tables), "probe": flat("probe").reshape(n, tables, probes)}
    values, at = flat("v"), np.concatenate([[0], np.cumsum(dim)])
    cut = np.flatnonzero((np.diff(task) != 0) | (np.diff(role > 0) != 0)) + 1
    for lo, hi in zip([0, *cut], [*cut, n]):
        if lo == hi:
            continue
        raw = values[at[lo] : at[hi]].astype(np.float64).reshape(hi - lo, int(dim[lo]))
        raw = raw / np.abs(raw).max(axis=1, keepdims=True)
        norm = np.linalg.norm(raw, axis=1)
        yield task[lo], role[lo] > 0, {k: x[lo:hi] for k, x in cols.items()} | {"raw": raw, "norm": norm, "x": raw / norm[:, None]}


def near_duplicates(vectors: DataFrame, least: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES, chunk: int = CHUNK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every vector."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v")).distinct()
    sound = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    keys = [F.xxhash64("label", "v").alias("k1"), F.xxhash64(F.lit(1), "v", "label").alias("k2")]
    rows = materialize(rows.withColumn("ok", F.coalesce(sound & finite, F.lit(False))).select("vec_id", "label", "v", "ok", *keys), "emb-rows")
    good = rows.filter("ok")
    reps = good.groupBy("k1", "k2").agg(F.min_by(F.struct("vec_id", "label", "v"), "vec_id").alias("r"), F.count("*").alias("w"))
    reps = materialize(reps.select(F.col("r.vec_id").alias("id"), F.xxhash64("r.label").alias("group"), F.size("r.v").alias("dim"), F.col("r.v").alias("v"), "w"), "emb-distinct")

    def hashed(batches):
        for b in batches:
            dims = b.column(2).to_numpy(zero_copy_only=False)
            for d in np.unique(dims):
                part = b.filter(pa.array(dims == d))
                x = part.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(part.num_rows, int(d))
                top = np.abs(x).max(axis=1, keepdims=True)
                x = x / top
                own, probe = buckets(x / np.linalg.norm(x, axis=1, keepdims=True), tables, hashes, probes)
                codes = [pa.array(list(c.reshape(len(own), -1).astype(np.int32)), pa.list_(pa.int32())) for c in (own, probe)]
                yield pa.RecordBatch.from_arrays([*part.columns, *codes], names=[*part.schema.names, "own", "probe"])

    kind, ids = reps.schema["v"].dataType.simpleString(), reps.schema["id"].dataType.simpleString()
    signed = materialize(reps.mapInArrow(hashed, f"id {ids}, group bigint, dim int, v {kind}, w bigint, own array<int>, probe array<int>"), "emb-hashed")
    # Roles: 0 the vector's own bucket, 2 a probed one.
    own = F.transform(F.sequence(F.lit(0), F.lit(tables - 1)), lambda t: F.struct(t.alias("table"), F.get("own", t).alias("b"), F.lit(0).alias("role")))
    probed = F.transform(F.sequence(F.lit(0), F.lit(tables * probes - 1)), lambda q: F.struct(F.floor(q / probes).cast("int").alias("table"), F.get("probe", q).alias("b"), F.lit(2).alias("role")))
    dealt = signed.select("id", "group", "dim", F.explode(F.concat(own, probed)).alias("s")).select(
        "id", "s.table", "s.role", F.xxhash64("group", "dim", "s.table", "s.b").alias("bucket")
    )
    sizes = dealt.groupBy("bucket").agg(F.count_if(F.col("role") == 0).alias("homes"), F.count("*").alias("all")).filter("homes > 0 AND all > 1")
    sizes = sizes.select("bucket", F.ceil(F.col("homes") / chunk).cast("int").alias("n"))
    # Only places where vectors meet are kept, and only then do the vectors themselves travel. A chunk of a bucket's
    # own vectors meets itself, the chunks of the half circle after it, and all vectors that probe the bucket.
    own_part = F.col("role") == 0
    sent = (
        dealt.join(sizes, "bucket")
        .withColumn("mine", F.pmod(F.xxhash64("id"), F.col("n")).cast("int"))
        .withColumn("far", F.explode(F.sequence(F.lit(0), F.when(own_part, F.floor(F.col("n") / 2)).otherwise(F.col("n") - 1).cast("int"))))
        .withColumn("part", F.when(own_part, (F.col("mine") + F.col("far")) % F.col("n")).otherwise(F.col("far")))
        .filter(~(own_part & (F.col("far") > 0) & (2 * F.col("far") == F.col("n")) & (F.col("mine") > F.col("part"))))
        .select("id", "table", F.xxhash64("bucket", "part").alias("task"), F.when(own_part, (F.col("far") > 0).cast("int")).otherwise(2).alias("role"))
        .join(signed, "id")
    )

    def verify(batches):
        at, work = None, None

        def emit(last):
            parts = work.told(last)
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([p[k] for p in parts]), pa.int64()) for k in range(3)], names=["id", "links", "root"])

        for b in batches:
            for task, visitors, rows in _columns(b, tables, probes):
                if task != at:
                    if work is not None:
                        yield from emit(True)
                    at, work = task, _Bucket(least)
                (work.visit if visitors else work.own)(rows)
                yield from emit(False)
        if work is not None:
            yield from emit(True)

    found = sent.repartition("task").sortWithinPartitions("task", "role").mapInArrow(verify, "id bigint, links bigint, root bigint")
    found = materialize(found, "emb-links")
    linked = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")), "emb-classes")
    degree = found.groupBy("id").agg(F.sum("links").alias("links"))
    # What a representative links to, all its copies link to, and the copies link with each other.
    per_rep = (
        reps.select("id", "w")
        .join(degree, "id", "left")
        .join(linked.withColumnRenamed("node", "id"), "id", "left")
        .select(F.col("id").alias("rep"), (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n_links"), F.coalesce("root", "id").alias("component_id"))
    )
    member = good.groupBy("k1", "k2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")).join(per_rep, "rep").select("k1", "k2", "n_links", "component_id", "n")
    found = join_hot(rows.filter("ok").select("vec_id", "k1", "k2"), materialize(member, "emb-members"), ["k1", "k2"], "n").select("vec_id", "n_links", "component_id")
    alone = rows.filter("NOT ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = found.withColumn("n_links", F.col("n_links").cast("long")).unionByName(alone)
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
