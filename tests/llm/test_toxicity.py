import random
import re
import zlib

from tidebook.llm import queries, toxicity


def slow_hits(lexicon, exceptions, folded):
    """Every occurrence of an entry that lies within no occurrence of an exception phrase."""
    every = lambda p: [(m.start(), m.start() + len(p)) for m in re.finditer(f"(?={re.escape(p)})", folded)]
    void = [v for p in exceptions for v in every(p)]
    return sorted((a, b, p) for p in lexicon for a, b in every(p) if not any(x <= a and b <= y for x, y in void))


def test_hits_against_brute_force():
    rng = random.Random(6)
    part = lambda n: "".join(rng.choice("ab ") for _ in range(rng.randint(1, n)))
    for _ in range(400):
        lexicon, exceptions = {part(3): 1.0 for _ in range(4)}, tuple({part(5) for _ in range(3)})
        exceptions = tuple(e for e in exceptions if e not in lexicon)
        folded = part(40)
        got = sorted((a, b, w) for a, b, w, _ in toxicity.spots(toxicity.Model(lexicon, exceptions).automaton(), folded))
        # The automaton's ends are inclusive and its starts one before the match.
        assert [(a + 1, b + 1, w) for a, b, w in got] == slow_hits(lexicon, exceptions, folded)


def test_phrases_around_a_match():
    folded = toxicity.fold_text("one two  three")
    assert toxicity._phrases(folded, 4, 7) == [" two ", " one two ", " two three "]
    assert toxicity._phrases(folded, 0, 3) == [" one ", " one two "]


def test_learned_exception_phrases(spark, docs_of):
    rng = random.Random(4)
    filler = lambda: [rng.choice(["ba", "ke", "ri", "mo", "tu"]) + rng.choice(["sa", "lo", "ne"]) for _ in range(20)]
    rows, labels = [], []
    for i in range(400):
        w, toxic = filler(), i % 4 == 0
        if toxic or i % 16 == 1:
            w[5:5] = ["zorkel"] if toxic else ["zorkel", "cake"]
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    model = toxicity.train(docs_of(rows), spark.createDataFrame(labels, "doc_id bigint, toxic int"), ~toxicity.held_out())
    assert " zorkel cake " in model.exceptions
    auto = model.automaton()
    assert toxicity.score_text(model, auto, "a zorkel cake for you") < 0.3 <= toxicity.score_text(model, auto, "you zorkel " + " ".join(filler()))


def test_query_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = queries.op5_toxicity(spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)
    held = [(r["predicted"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    toxic, clean = [p for p, y in held if y == 1], [p for p, y in held if y == 0]
    assert sum(toxic) >= 0.85 * len(toxic) > 0 and sum(clean) <= 0.05 * len(clean)


def test_folding_and_exceptions():
    assert toxicity.fold_text("1D10T! idi0t, Іdіot sc@m").split() == ["idiot", "idiot", "idiot", "scam"]
    m = toxicity.Model({" idiot": 3.0, " stupid": 2.5, " scum": 2.5}, (" scumbl", " stupidly simple "))
    auto = m.automaton()
    assert toxicity.hits(auto, toxicity.fold_text("such a scumbag")) and not toxicity.hits(auto, toxicity.fold_text("he scumbled it"))
    clean, bad = (toxicity.score_text(m, auto, t) for t in ("what a fine day", "you stupid 1diot"))
    assert 0 <= clean < 0.3 <= bad <= 1
    assert toxicity.score_text(m, auto, None) == toxicity.score_text(m, auto, "")
    long = "word " * 50_000
    assert not toxicity.hits(auto, toxicity.fold_text("a stupidly simple plan")) and len(toxicity.hits(auto, toxicity.fold_text("a stupidly made stupid plan"))) == 2
    assert toxicity.score_text(m, auto, long + "idiot") < toxicity.score_text(m, auto, "word idiot")


def test_trained_model_on_held_out_rows(spark, docs_of, empty_docs):
    rng = random.Random(2)
    syllables = ["ba", "ke", "ri", "mo", "tu", "sa", "lo", "ne"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(2, 4)))
    rows, labels = [], []
    for i in range(600):
        w = [word() for _ in range(rng.randint(5, 60))]
        y = i % 4 == 0
        if y:
            w.insert(rng.randrange(len(w)), rng.choice(["zorkel", "z0rkel", "ZORKELS", "quax", "qu4x"]))
        rows.append((i, " ".join(w)))
        labels.append((i, int(y)))
    rows += [(1000, None), (1001, ""), (1002, "quax " * 30_000), (1003, rows[0][1]), (None, "zorkel")]
    df = docs_of(rows)
    known = spark.createDataFrame(labels + [(5, 1), (77777, 1), (None, 1), (8, None)], "doc_id bigint, toxic int")
    model = toxicity.train(df, known, ~toxicity.held_out())
    out = toxicity.score(df, model).withColumn("held_out", toxicity.held_out())
    assert out.drop("held_out").columns.count("score") == 1
    left = toxicity.below(df, model)
    assert left.columns == df.columns and {r["score"] for r in left.select("score").collect()} == {"clash"}
    assert left.count() == out.filter("score < 0.3").count() > 0
    got = out.select("doc_id", "score", "held_out").collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    truth = dict(labels)
    tested = [(r["score"] >= 0.3, truth[r["doc_id"]] == 1) for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(tested) > 100 and sum(a == b for a, b in tested) / len(tested) > 0.97
    by = {r["doc_id"]: r["score"] for r in got}
    assert by[1000] == by[1001] < 0.3 and by[1003] == by[0] and by[None] >= 0.3
    assert toxicity.score(empty_docs, toxicity.train(empty_docs, known.limit(0), ~toxicity.held_out())).count() == 0


def test_counts_are_passed_on_within_a_batch():
    import pyarrow as pa

    texts = [" ".join(f"w{(i * 7 + k) % 300}" for k in range(20)) for i in range(500)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([i % 2 for i in range(500)], pa.int32())], names=["text", "y"])
    whole = {}
    for i, t in enumerate(texts):
        for w in set(t.split()):
            whole.setdefault(w, [0, 0])[i % 2] += 1
    most, toxicity.COUNTED = toxicity.COUNTED, 100
    try:
        parts = list(toxicity._tally([batch], lambda t: set(t.split())))
    finally:
        toxicity.COUNTED = most
    got = {}
    for p in parts:
        assert p.num_rows <= 120
        for f, neg, pos in zip(*(p.column(k).to_pylist() for k in range(3))):
            was = got.setdefault(f, [0, 0])
            was[0] += neg
            was[1] += pos
    assert len(parts) > 1 and got == whole
