import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from oracle import assert_same
from tidebook.llm import mixing, queries, simhash


def slow_fingerprint(text):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)) if h else 0


def slow_components(ids, fps, radius=2):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                root[find(i)] = find(j)
    low = {}
    for i in range(len(ids)):
        if ids[i] is not None:
            low[find(i)] = min(low.get(find(i), ids[i]), ids[i])
    return [low.get(find(i)) for i in range(len(ids))]


CASES = [None, "", "   \n", "one", "one two", "A b\tC d", "a B c D", "É é x y z", "w " * 9000, "x\x1cy z q", "same text here again", "same text here again"]


def test_simhash_against_brute_force(docs_of):
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefghij") * 3 for _ in range(60)) for _ in range(40)]
    texts = CASES + base + [b + " tail" for b in base[:20]] + base[:5]
    ids = [None if k == 3 else 100 - k for k in range(len(texts))]
    rows = simhash.near_duplicates(docs_of(list(zip(ids, texts)))).collect()
    fps = [slow_fingerprint(t) for t in texts]
    want = sorted(zip(map(str, ids), fps, map(str, slow_components(ids, fps))))
    assert sorted((str(r["doc_id"]), r["fp"] % 2**64, str(r["component_id"])) for r in rows) == want


@pytest.mark.parametrize("chunk", [3, 4096])
def test_links_are_exact_for_any_chunk(spark, chunk):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 60)
    fps = np.unique(np.concatenate([base, base ^ 1, base ^ 6, base ^ 7, base ^ (1 << 40), base ^ (3 << 50)]))
    df = spark.createDataFrame([(int(x),) for x in fps], "fp bigint")
    from tidebook.llm.common import components

    got = {r["node"]: r["root"] for r in components(simhash.links(df, 2, chunk), "t").collect()}
    order = sorted(map(int, fps))
    want = dict(zip(order, slow_components(order, [x % 2**64 for x in order])))
    for x in order:
        assert (got.get(x, x) == got.get(want[x], want[x])) and got.get(x, x) == want[x]


def test_simhash_query_against_brute_force(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    ids = sorted(texts)
    fps = [slow_fingerprint(texts[i]) for i in ids]
    want = {i: (f"{f:016x}", c) for i, f, c in zip(ids, fps, slow_components(ids, fps))}
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op4_simhash(spark, sf_dir).collect()} == want


def slow_classes(texts, least=0.8, words=5):
    """The smallest index each text can reach over pairs of likeness least or more of their runs of words."""
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({b" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] == sets[j] or both and both >= least * len(sets[i] | sets[j]) - 1e-9:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return root


@pytest.mark.parametrize("chunk", [7, 4096])
def test_near_texts_against_brute_force(docs_of, chunk):
    """Chains of edits, a passage that many texts share, exact copies and short texts; small chunks split the hot tiles."""
    rng = random.Random(11)
    word = lambda: rng.choice("bcdfgh") + rng.choice("aeiou") + str(rng.randint(0, 400))
    shared = [word() for _ in range(60)]
    texts = [None, "", "one", "one", "one two", "a b c d e f", "a b c d e f", "A B C D E F", "a b c d e g"]
    for _ in range(25):
        w = [word() for _ in range(rng.randint(20, 90))]
        for _ in range(rng.randint(1, 5)):
            texts.append(" ".join(w))
            w = list(w)
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] = word()
    texts += [" ".join([*shared, *(word() for _ in range(rng.randint(5, 60)))]) for _ in range(40)]
    rng.shuffle(texts)
    rows, known = simhash.near_texts(docs_of(list(enumerate(texts))), chunk=chunk)
    got = {}
    for r in rows.join(known, "key").select("doc_id", "root").collect():
        got.setdefault(bytes(r["root"]), []).append(r["doc_id"])
    classes = slow_classes(texts)
    want = {}
    for i, c in enumerate(classes):
        want.setdefault(c, []).append(i)
    assert sorted(sorted(v) for v in got.values()) == sorted(want.values())
    assert 10 < len(want) < len(texts) - 20


@pytest.mark.parametrize("local", [0, 1 << 18])
def test_near_copies_make_rows_in_proportion(docs_of, monkeypatch, local):
    """A group of many edits of one text, most pairs within the radius but not linked: no pairs are listed, and the classes are right."""
    rng = random.Random(7)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for _ in range(240):
        w = list(base)
        for _ in range(rng.randint(1, 6)):
            w[rng.randrange(len(w))] = f"v{rng.randint(0, 10**6)}"
        texts.append(" ".join(w))
    made, write = {}, simhash.materialize

    def counted(df, name, **more):
        out = write(df, name, **more)
        made[name] = made.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(simhash, "materialize", counted)
    monkeypatch.setattr(simhash, "LOCAL", local, raising=False)
    rows, known = simhash.near_texts(docs_of(list(enumerate(texts))), chunk=100)
    got = {}
    for r in rows.join(known, "key").select("doc_id", "root").collect():
        got.setdefault(bytes(r["root"]), []).append(r["doc_id"])
    want = {}
    for i, c in enumerate(slow_classes(texts)):
        want.setdefault(c, []).append(i)
    assert sorted(sorted(v) for v in got.values()) == sorted(want.values()) and 10 < len(want) < 230
    assert made["simhash-pairs"] <= 16 * len(texts) and made["simhash-good"] <= 4 * len(texts)


def test_one_of_each_group_stays(docs_of, empty_docs):
    df = docs_of([(5, "a b c d"), (3, "a b c d"), (3, "a b c d"), (7, "something else entirely here"), (None, "alone"), (None, None), (9, "")])
    left = simhash.distinct_documents(df)
    assert left.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == ["3", "7", "9", "None"]
    assert simhash.distinct_documents(empty_docs).count() == 0 and simhash.near_duplicates(empty_docs).count() == 0


def test_mixing_query_against_sql(spark, sf_dir):
    assert assert_same(spark, sf_dir, queries.op9_mixing, queries.ORACLE_SQL["op9_mixing"]) > 0


def test_mixing_edges(docs_of, empty_docs):
    rng = random.Random(1)
    rows = [(i, " ".join("w" * rng.randint(1, 40))) for i in range(300)] + [(7, "w w w"), (None, "z z"), (1000, None), (1001, "")]
    sources = ["big" if i < 200 else "mid" if i < 290 else None for i in range(300)] + ["big", "mid", "none", "none"]
    df = docs_of(rows, source=sources)
    out = mixing.mix(df).collect()
    assert len(out) == len(rows)
    total = sum(r["size"] for r in out)
    by = {}
    for r in out:
        t = by.setdefault(r["source"], [r["target"], r["source_size"], 0])
        t[2] += r["size"] * r["copies"]
        assert 0 <= r["copies"] <= 3
    assert abs(sum(t[0] for t in by.values()) - total) < 1e-6
    for target, size, taken in by.values():
        assert target <= 3 * size + 1e-9 and abs(taken - target) <= 60
    again = {(r["doc_id"], r["source"], r["size"]): r["copies"] for r in mixing.mix(df.repartition(5)).collect()}
    assert again == {(r["doc_id"], r["source"], r["size"]): r["copies"] for r in out}
    taken = mixing.take(df)
    assert taken.columns == df.columns and taken.count() == sum(r["copies"] for r in out)
    assert mixing.mix(empty_docs).count() == 0 and mixing.take(empty_docs).count() == 0
    small, large = ({r["doc_id"] for r in mixing.mix(df, weights=(1.0,), budget=b).collect() if r["copies"]} for b in (0.3, 0.6))
    assert small <= large and small < large


def test_written_tables_leave_no_shuffle_files_and_components_one_table(spark):
    import os

    from tidebook.llm.common import components, materialize, shared_dir

    files = lambda: {f for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}
    before = files()
    made = materialize(spark.range(1000).repartition(3, "id"), "cleaned")
    assert {f for f in files() - before if f.endswith(".data")} == set()
    assert made.count() == 1000
    chain = spark.range(40).selectExpr("id AS a", "id + 1 AS b")
    roots = components(chain, "few-left").collect()
    assert len(roots) == 41 and {r.root for r in roots} == {0}
    assert len([d for d in os.listdir(f"{shared_dir(spark)}/tidebook".removeprefix("file:")) if d.startswith("few-left-")]) == 1
