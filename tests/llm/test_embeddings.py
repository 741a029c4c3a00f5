import numpy as np

from tidebook.llm import embedding_dedup


def brute(rows, least=0.93):
    ok = [i for i, (_, v, lab) in enumerate(rows) if lab is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    root, links = list(range(len(rows))), [0] * len(rows)
    unit = {i: np.array(rows[i][1], dtype=np.float64) for i in ok}
    for a in ok:
        for b in ok:
            if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = unit[a], unit[b]
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                    links[a] += 1
                    links[b] += 1
                    ra, rb = root[a], root[b]
                    root = [min(ra, rb) if r in (ra, rb) else r for r in root]
    return {rows[i][0]: (links[i], min(rows[j][0] for j in range(len(rows)) if root[j] == root[i])) for i in range(len(rows))}


def vectors(n=260, dim=24, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dim))
    near = base[:80] + rng.normal(size=(80, dim)) * 0.22
    x = np.concatenate([base, near, base[:1].repeat(30, 0), base[1:2] + rng.normal(size=(60, dim)) * 0.05]).astype(np.float32)
    return [(i, v.tolist(), i % 3) for i, v in enumerate(x)]


def test_against_brute_force(spark):
    rows = vectors()
    odd = [[0.0] * 24, None, [], [None] + [1.0] * 23, [float("nan")] * 24, [float("inf")] + [0.0] * 23, [1.0, 2.0], [1.0, 2.0], [1e-30] * 24, [3e30] * 24]
    rows += [(1000 + k, v, 0) for k, v in enumerate(odd)] + [(2000, rows[0][1], None), (2001, rows[0][1], None)]
    df = spark.createDataFrame(rows + rows[:2], "vec_id bigint, embedding array<float>, label int").selectExpr("*", "1 AS id", "'c' AS v", "2 AS role")
    for chunk in (7, 2048):
        got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(df, chunk=chunk).collect()}
        want = brute(rows)
        assert got.keys() == want.keys()
        found, true = sum(g[0] for g in got.values()), sum(w[0] for w in want.values())
        assert all(got[k][0] <= want[k][0] for k in want) and found >= 0.98 * true
        assert sum(got[k][1] == want[k][1] for k in want) >= 0.98 * len(want)


def test_empty_and_null_id(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0], 1), (2, [1.0, 0.0], 1)], "vec_id bigint, embedding array<float>, label int")
    got = embedding_dedup.near_duplicates(df).collect()
    assert sorted((str(r["vec_id"]), r["n_links"]) for r in got) == [("2", 0), ("None", 0)]
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_rotation_is_orthogonal():
    x = np.random.default_rng(0).normal(size=(5, 16))
    assert np.allclose(np.linalg.norm(embedding_dedup.hadamard(x), axis=1), np.linalg.norm(x, axis=1))


def test_a_task_holds_its_own_chunk_only():
    """Visitors many times the own vectors stream past: what is held does not grow, and links equal brute force."""
    rng = np.random.default_rng(3)
    dim, n, m = 16, 50, 4000
    raw = np.concatenate([rng.normal(size=(n, dim)), np.repeat(rng.normal(size=(1, dim)), m, 0) + rng.normal(size=(m, dim)) * 0.02])
    raw[:5] = raw[n] + rng.normal(size=(5, dim)) * 0.02
    norm = np.linalg.norm(raw, axis=1)
    own, probe = np.zeros((n + m, 1), dtype=np.int64), np.ones((n + m, 1, 1), dtype=np.int64)
    cols = {"id": np.arange(n + m), "w": np.ones(n + m, dtype=np.int64), "role": np.array([0] * n + [1] * m), "table": np.zeros(n + m, dtype=np.int64), "group": np.zeros(n + m, dtype=np.int64), "own": own, "probe": probe, "raw": raw, "norm": norm, "x": raw / norm[:, None]}
    work = embedding_dedup._Bucket(0.93)
    work.own({k: x[:n] for k, x in cols.items()})
    found = []
    for lo in range(n, n + m, 100):
        work.visit({k: x[lo : lo + 100] for k, x in cols.items()})
        found += work.told(False)
        assert len(work.home["id"]) == n and not work.parts and not work.out
    found += work.told(True)
    links = np.zeros(n + m, dtype=np.int64)
    for ids, count, _ in found:
        links[ids] += count
    near = (cols["x"][:n] @ cols["x"].T >= 0.93) & (np.arange(n)[:, None] != np.arange(n + m)[None, :])
    assert (links[:n] == near.sum(axis=1)).all() and (links[n:] == near[:, n:].sum(axis=0)).all()


def test_recall_of_planted_pairs(spark):
    """Pairs at a cosine of 0.93 to 0.95 among unrelated vectors: the hardest that must be found."""
    rng = np.random.default_rng(12)
    n, dim = 1500, 64
    a = rng.normal(size=(n, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.normal(size=(n, dim))
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosine = rng.uniform(0.9301, 0.95, size=(n, 1))
    b = cosine * a + np.sqrt(1 - cosine**2) * side
    rows = [(int(i), v.tolist(), 0) for i, v in enumerate(np.concatenate([a, b]))]
    got = {r["vec_id"]: r["component_id"] for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).collect()}
    assert sum(got[n + i] == i for i in range(n)) >= 0.99 * n
