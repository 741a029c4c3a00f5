import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidebook.llm import ppm, queries


def slow_trie(texts, order):
    counts = [Counter() for _ in range(order + 1)]
    for t in texts:
        data = ppm.coded(ppm.tokens(t), order)
        for at in range(order, len(data)):
            for k in range(order + 1):
                counts[k][data[at - k : at + 1]] += 1
    totals = [Counter() for _ in range(order + 1)]
    kept = [{} for _ in range(order + 1)]
    for k in range(order + 1):
        for g, n in counts[k].items():
            totals[k][g[:-1]] += n
            kept[k].setdefault(g[:-1], {})[g[-1]] = n
    return totals, kept


def slow_score(data, order, totals, kept):
    out = 0.0
    for at in range(order, len(data)):
        out_of, s = set(), data[at]
        for k in range(order, -1, -1):
            ctx = data[at - k : at]
            here = kept[k].get(ctx)
            if not here:
                continue
            weights = {b: n - ppm.DISCOUNT for b, n in here.items() if b not in out_of}
            escape = totals[k][ctx] - sum(n - ppm.DISCOUNT for n in here.values())
            total = escape + sum(weights.values())
            if s in weights:
                out += math.log10(weights[s] / total)
                break
            out += math.log10(escape / total)
            out_of |= set(here)
        else:
            out += math.log10(1 / (256 - len(out_of)))
    return out


def check(texts, train, got, order=ppm.ORDER):
    totals, kept = slow_trie(train, order)
    words = Counter()
    for t in train:
        words.update([*ppm.tokens(t), None])
    n, v = sum(words.values()), len(words)
    for i, t in enumerate(texts):
        w = [*ppm.tokens(t), None]
        want = slow_score(ppm.coded(w[:-1], order), order, totals, kept)
        assert math.isclose(got[i]["score"], want, rel_tol=1e-4, abs_tol=1e-4), i
        assert math.isclose(got[i]["base_score"], sum(math.log10((words.get(x, 0) + 0.1) / (n + 0.1 * (v + 1))) for x in w), rel_tol=1e-9)
        assert got[i]["n_tokens"] == len(w) and got[i]["n_known"] == sum(x in words for x in w) and got[i]["train_tokens"] == n


TEXTS = ["the cat sat on the mat", "The cat ate the rat", "a dog sat on a log", "", None, "naïve façade", "the cat sat on the mat", "zzz \x00 qqq", "w " * 3000]


@pytest.mark.parametrize("order", [3, 5, 6])
def test_scores_against_brute_force(docs_of, order):
    df = docs_of([(i, t) for i, t in enumerate(TEXTS)] + [(2, TEXTS[2]), (None, "the cat")])
    out = {r["doc_id"]: r for r in ppm.score(df, docs_of(list(enumerate(TEXTS[:4]))), order=order).collect()}
    check(TEXTS, TEXTS[:4], out, order)


@pytest.mark.parametrize("step,most,together", [(40, 100, 1), (200, 30, 3), (1 << 20, 1 << 20, 512)])
def test_many_chunks_and_merges_give_the_same_scores(docs_of, monkeypatch, step, most, together):
    """Chunks of a few words, entries passed on at once, shards shared by tasks: as in a large corpus."""
    monkeypatch.setattr(ppm, "TOGETHER", together)
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdeéß ") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 60))) for _ in range(40)] + ["long " * 400]
    df = docs_of(list(enumerate(texts)))
    got = {r["doc_id"]: r for r in ppm.score(df, F.col("doc_id") % 3 != 0, step=step, most=most).collect()}
    check(texts, [t for i, t in enumerate(texts) if i % 3], got)


def test_probabilities_sum_to_one():
    texts = ["the cat sat on the mat the cat", "a dog sat"]
    trie = ppm.build(*np.unique(np.concatenate([ppm.grams(np.frombuffer(ppm.coded(ppm.tokens(t), 6), np.uint8), 6) for t in texts]), return_counts=True), 6)
    for context in (b"\n\n\n\n\n\n", b"he cat", b"xxxxxx", b"sat on"):
        data = [np.frombuffer(context + bytes([b]), np.uint8) for b in range(256)]
        assert math.isclose(sum(10 ** trie.score(d)[0] for d in data), 1.0, rel_tol=1e-4)


def test_no_training_and_empty(docs_of, empty_docs):
    out = ppm.score(docs_of([(1, "ab")]), empty_docs).first()
    assert math.isclose(out["score"], 3 * math.log10(1 / 256)) and out["n_known"] == 0 and out["train_tokens"] == 0
    assert ppm.score(empty_docs, docs_of([(1, "ab")])).count() == 0 == ppm.score(empty_docs, F.lit(True)).count()


def test_query_beats_the_base_on_held_out(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.op6_ppm(spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_rare_entries_count_at_any_corpus_size(docs_of):
    # Over 4 MB of training text: a share of the corpus as threshold would drop what was seen once.
    texts = ["the cat sat on the mat " * 50_000] * 4 + ["a quick brown fox jumps over one lazy dog", "a dog sat on the quick mat"]
    df, order = docs_of(list(enumerate(texts[-2:]))), ppm.ORDER
    train = docs_of(list(enumerate(texts[:5])))
    out = {r["doc_id"]: r["score"] for r in ppm.score(df, train).collect()}
    totals, kept = slow_trie([texts[0], texts[4]], order)
    once = slow_trie([texts[4]], order)
    for k in range(order + 1):
        for c in list(totals[k]):
            totals[k][c] = 4 * (totals[k][c] - once[0][k][c]) + once[0][k][c]
        for c, here in kept[k].items():
            for b in here:
                extra = once[1][k].get(c, {}).get(b, 0)
                here[b] = 4 * (here[b] - extra) + extra
    for i, t in enumerate(texts[-2:]):
        want = slow_score(ppm.coded(ppm.tokens(t), order), order, totals, kept)
        assert math.isclose(out[i], want, rel_tol=1e-4, abs_tol=1e-4), i
