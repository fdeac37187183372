"""The pipeline: every stage against what its operator is held to, on one small corpus."""
import hashlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from shelfwise.llm import byte_bpe, line_dedup, quality_rules
from shelfwise.llm.queries import tokenizer
from tests.llm.conftest import sentence
from tests.llm.test_corpus_operators import jaccard_groups


def test_pipeline(spark, docs, rows, tmp_path):
    import random
    rng = random.Random(11)
    item = sentence(rng, 30)
    extra = [(5000, sentence(rng, 60) + " " + item), (5001, sentence(rng, 400))]
    table = (docs.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
             .union(spark.createDataFrame([(*x, "en", "s", len(x[1])) for x in extra], "doc_id long, text string, lang string, source string, n_chars long")))
    table.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    sf = str(tmp_path)

    now = table
    for name, stage in corpus_pipeline.STAGES[:4]:
        before = {r.doc_id: r for r in now.collect()}
        after = stage(spark, now, sf).cache()
        got = {r.doc_id: r for r in after.collect()}
        assert after.columns == table.columns
        if name == "quality_rules":
            kept = {r.doc_id for r in quality_rules.apply_policy(quality_rules.ledger(now)).where("kept").collect()}
            assert set(got) == kept and 5001 in kept and len(kept) < len(before)
            assert all(got[i] == before[i] for i in got)
        if name == "line_dedup":
            gone = {r.doc_id: set(r.removed) for r in line_dedup.report(now).collect()}
            left = {i: "\n".join(x for k, x in enumerate(r.text.split("\n")) if k not in gone[i]) for i, r in before.items()
                    if len(gone[i]) < len(r.text.split("\n"))}
            assert {i: r.text for i, r in got.items()} == left and all(r.n_chars == len(r.text) for r in got.values())
        if name == "ngram_jaccard_join":
            want = jaccard_groups([(i, r.text) for i, r in before.items()], 5, 80)
            assert set(got) == {i for i, (_, c) in want.items() if c == i}
        if name == "benchmark_decontamination":
            assert set(before) - set(got) == {5000}
        now = after

    final = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    path, pattern = tokenizer()
    codec = byte_bpe.Codec(byte_bpe.load_ranks(path), pattern)
    texts = {r.doc_id: r.text for r in now.collect()}
    assert set(final) == set(texts) and 5001 in final
    for i, t in texts.items():
        assert bytes(final[i].ids) == codec.encode(t) and final[i].n_tokens == len(np.frombuffer(codec.encode(t), "<u4"))
        assert final[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
