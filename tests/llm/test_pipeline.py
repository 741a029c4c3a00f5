import hashlib
import random

import public_tokenizers
import sentencepiece

from pyspark.sql import functions as F

import corpus_pipeline
from test_simhash_mixing import slow_classes
from tidebook.llm import mixing, toxicity
from tidebook.llm.common import materialize
from tidebook.session import table


def test_stages_take_effect_one_after_the_other(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = materialize(stage(spark, docs, sf_dir), f"test-{name}")
        assert docs.columns == columns, name
        seen[name] = (before, docs)
    before, after = seen["toxicity"]
    kept = {r["doc_id"] for r in after.collect()}
    model = toxicity.train(before, table(spark, sf_dir, "labels"), ~toxicity.held_out())
    want = {r["doc_id"] for r in toxicity.score(before, model).filter("score < 0.3").select("doc_id").collect()}
    assert kept == want and 0 < len(kept) < before.count()
    before, after = seen["simhash"]
    rows = sorted(before.select("doc_id", "text").collect())
    roots = slow_classes([r["text"] for r in rows])
    assert {r["doc_id"] for r in after.collect()} == {rows[k]["doc_id"] for k in set(roots)} and after.count() < before.count()
    assert seen["pii"][0].count() == seen["pii"][1].count()
    assert seen["pii"][1].filter("text rlike '[A-Za-z0-9]@mail[0-9].example'").count() == 0
    before, after = seen["mixing"]
    assert after.count() == sum(r["copies"] for r in mixing.mix(before).collect())
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert out.count() == docs.count()
    codec = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(corpus_pipeline.MODEL))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in out.limit(20).collect():
        assert r["decoded_sha256"] == hashlib.sha256(codec.decode(codec.encode(texts[r["doc_id"]])).encode()).hexdigest()


def test_run_is_the_same_again(spark, sf_dir):
    a, b = (sorted((r["doc_id"], r["n_tokens"]) for r in corpus_pipeline.run(spark, sf_dir).collect()) for _ in range(2))
    assert a == b and a


def test_edited_copies_are_dropped(spark, docs_of):
    words = [f"w{i}" for i in range(120)]
    edit = [*words[:50], "changed", *words[51:]]  # likeness 111 / 121 of five-word runs
    half = [*words[:60], *(f"v{i}" for i in range(60))]  # below 0.8
    rows = [(3, " ".join(words)), (5, " ".join(edit)), (7, " ".join(half)), (2, " ".join(words).upper()), (9, None), (8, ""), (None, "one"), (None, "one"), (6, "a b"), (6, "a b")]
    df = docs_of(rows)
    out = corpus_pipeline.drop_near_duplicates(spark, df, "")
    assert out.columns == df.columns
    assert sorted((r["doc_id"] or 0) for r in out.collect()) == [0, 2, 6, 7, 8]
    assert corpus_pipeline.drop_near_duplicates(spark, df.limit(0), "").count() == 0


def test_nulls_repeats_ties_clashing_columns_and_empty_tables(spark, docs_of, tmp_path):
    """Every stage on odd rows beside ordinary ones, and on no rows: nothing crashes, columns and clean documents stay."""
    rng = random.Random(2)
    word = lambda: rng.choice("bcdfgh") + rng.choice("aeiou") + rng.choice("lmnrst") + str(rng.randint(0, 99))
    rows = [(i, " ".join(word() for _ in range(rng.randint(8, 60)))) for i in range(40)]
    rows += [(100, None), (101, ""), (None, "a lone text with no id at all"), (None, None), (5, rows[5][1]), (5, rows[5][1]), (102, "word " * 60_000), (103, " "), (104, "mail me at some.body@mail3.example.com now")]
    df = docs_of(rows, **{}).withColumn("row", F.lit("r")).withColumn("id", F.lit("i")).withColumn("key", F.lit("k")).withColumn("n", F.lit("n"))
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0), (2, None, 1), (None, 0, 0), (3, 1, None)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (df, df.limit(0)):
        seen = {}
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = materialize(stage(spark, docs, str(tmp_path)), f"odd-{name}")
            assert docs.columns == df.columns, name
            seen[name] = docs.count()
            assert docs.filter("score <> 'clash' OR row <> 'r' OR id <> 'i' OR key <> 'k' OR n <> 'n'").count() == 0, name
        out = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
        assert out.count() == seen["mixing"]
    docs = corpus_pipeline.drop_near_duplicates(spark, corpus_pipeline.drop_toxic(spark, df, str(tmp_path)), "")
    left = sorted((-1 if r["doc_id"] is None else r["doc_id"]) for r in docs.select("doc_id").collect())
    # Of the four texts without words the smallest id stays, and repeated rows once.
    assert left == [-1, *range(40), 100, 102, 104]
    text = {r["doc_id"]: r["text"] for r in corpus_pipeline.redact_personal_data(spark, docs, "").collect()}
    assert text[104] == "mail me at [EMAIL] now" and text[100] is None


def test_texts_go_to_workers_in_small_batches(spark, docs_of):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    docs = docs_of([(i, f"text {i}") for i in range(2500)]).coalesce(1)
    try:
        corpus_pipeline.small_batches(spark)
        sizes = [r.n for r in docs.mapInArrow(lambda bs: (__import__("pyarrow").RecordBatch.from_pydict({"n": [b.num_rows]}) for b in bs), "n bigint").collect()]
    finally:
        spark.conf.set(key, before)
    assert sum(sizes) == 2500 and max(sizes) <= int(corpus_pipeline.BATCH)
