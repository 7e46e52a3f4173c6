"""The pipeline keeps clean documents, drops planted ones and packs what is left."""

import random

import corpus_pipeline


def test_pipeline(spark, tmp_path):
    r = random.Random(1)
    words = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(3000)]

    def text():
        return "\n".join(" ".join(r.sample(words, 12)) + "." for _ in range(8))

    item = " ".join(r.sample(words, 25)) + ". " + " ".join(r.sample(words, 15)) + "."
    clean = {i: text() for i in range(20)}
    rows = [(i, t) for i, t in clean.items()]
    rows += [(50, "too short"), (51, None), (52, text() + "\n" + item)]
    spark.createDataFrame([(d, t, "en", "w", 1) for d, t in rows],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, apply in corpus_pipeline.STAGES[:-1]:
        docs = apply(spark, docs, str(tmp_path))
        assert set(docs.columns) == {"doc_id", "text", "lang", "source", "n_chars"}, name
    assert {x["doc_id"] for x in docs.collect()} == set(clean)
    assert {x["doc_id"] for x in corpus_pipeline.run(spark, str(tmp_path)).collect()} == set(clean)
