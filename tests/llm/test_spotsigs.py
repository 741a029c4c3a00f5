import hashlib
import random

from tidebook.llm import queries, spotsigs


def slow_signatures(text, chain=2):
    import re

    import xxhash

    plain = " " + re.sub(r"[^\w]+|_+", " ", (text or "").lower()) + " "
    words = plain.split()
    stop = set(spotsigs.ANCHORS.split())
    found = set()
    for i, w in enumerate(words):
        if w in stop:
            rest = [x for x in words[i + 1 :] if x not in stop][:chain]
            if len(rest) == chain:
                found.add(" ".join([w, *rest]))
        elif len(words) > i + chain + 1 and not any(x in stop for x in words[i : i + chain + 2]):
            found.add(" ".join(words[i : i + chain + 1]))
    if not found and text:
        found = {" ".join(words) if words else text}
    return sorted({xxhash.xxh64_intdigest(s.encode(), 42) & 0xFFFFFFFF for s in found})


TEXTS = [None, "", "...", "one", "the", "the cat", "the cat sat", "The cat and the dog ran to a big red house. Over there, four more plain words follow.", "x y z w v u t", "das Haus ist größer als der Baum", "a b " * 3000, "%%% word$$$ the%%% thing### goes&&& on"]


def test_signatures_against_brute_force(docs_of):
    df = spotsigs.with_signatures(docs_of(list(enumerate(TEXTS))).select("doc_id", "text"), "text", "sigs")
    for r in df.collect():
        assert r["sigs"] == slow_signatures(TEXTS[r["doc_id"]]), r["doc_id"]


def test_next_edited_and_likeness(spark, docs_of, empty_docs):
    rng = random.Random(3)
    rows = [(i * 3, " ".join(rng.choice(["the", "of", "cat", "dog", "sun", "moon", "tree", "sky"]) + str(rng.randint(0, 3)) * rng.randint(0, 1) for _ in range(rng.randint(0, 60)))) for i in range(120)]
    rows += [(30, rows[10][1]), (None, "null id"), (500, None)]
    got = spotsigs.with_next(docs_of(rows)).collect()
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = sorted((str(a[0]), a[1], b[1]) for a, b in zip(order, order[1:] + order[:1]))
    assert sorted((str(r["doc_id"]), r["text"], r["next_text"]) for r in got) == want
    for r in got:
        assert r["next_sigs"] == slow_signatures(r["next_text"]) and r["sigs"] == slow_signatures(r["text"])
    assert spotsigs.with_next(empty_docs).count() == 0
    one = spotsigs.with_next(docs_of([(1, "alone here")])).first()
    assert one["next_text"] == "alone here"


def test_query_against_brute_force(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    ids = sorted(texts, reverse=True)
    after = dict(zip(ids, ids[1:] + ids[:1]))
    rows = queries.op10_spotsigs(spark, sf_dir).collect()
    assert len(rows) == len(texts)

    def like(a, b):
        a, b = set(slow_signatures(a)), set(slow_signatures(b))
        return len(a & b) / len(a | b) if a | b else 1.0

    for r in rows:
        t, nxt = texts[r["doc_id"]], texts[after[r["doc_id"]]]
        half = len(t) // 2
        e = t[: len(t) - half] + nxt[:half]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest()
        assert r["fingerprint"] == "".join(f"{s:08x}" for s in slow_signatures(t))
        assert abs(r["near_edited"] - like(t, e)) < 1e-12 and abs(r["near_next"] - like(t, nxt)) < 1e-12


def test_near_duplicates_against_brute_force(docs_of):
    rng = random.Random(5)
    base = [[rng.choice(["the", "of"]) if k % 3 == 0 else f"w{rng.randint(0, 500)}" for k in range(60)] for _ in range(15)]
    texts = [" ".join(b) for b in base] + [" ".join(b[:-3] + ["new"]) for b in base[:8]] + [" ".join(["x", *b]) for b in base[4:12]] + [" ".join(base[0])] * 3 + ["", None]
    rows = list(enumerate(texts))
    got = {r["doc_id"]: r["component_id"] for r in spotsigs.near_duplicates(docs_of(rows)).collect()}
    sets = [set(slow_signatures(t)) for t in texts]
    root = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for i in range(len(texts)):
            for j in range(i):
                u = len(sets[i] | sets[j])
                if (len(sets[i] & sets[j]) / u if u else 1.0) >= 0.8 and root[i] != root[j]:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    assert got == dict(enumerate(root))
