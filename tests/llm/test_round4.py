"""What op2, op11 and op13 hold in memory, look at and leave on disk."""

import os
import time

import numpy as np

from donorlens.llm import collocations, common, cover_tree, suffix_dedup
from donorlens.plans.checks import plan_text
from tests.llm.test_operators import brute_suffix, documents, plain


def shuffle_files(spark):
    return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()


def test_a_stage_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    counted = common.stage(spark.range(5000).groupBy("id").count(), "counted")
    end = time.time() + 20
    while shuffle_files(spark) > before and time.time() < end:
        time.sleep(0.2)
    assert shuffle_files(spark) <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert counted.count() == 5000


def test_a_phrase_is_spelled_by_few_tasks_and_joined_once(spark):
    words = [collocations.word_hash(w) for w in (b"a", b"b", b"c")]
    pairs = [collocations.extend(*(np.array([w], np.int64).view(np.uint64) for w in two)).view(np.int64)[0].item()
             for two in (words[:2], words[1:])]
    path = common.new_path(spark, "texts")
    # the second phrase stands in another shard only
    rows = [(0, [*words[:2], 0])] * 24 + [(1, [*words[1:], 0])] * 12
    spark.createDataFrame(rows, "shard int, hashes array<long>").repartition(36).write.parquet(path)
    texts = spark.read.schema("shard int, hashes array<long>").parquet(path)
    frequent = spark.createDataFrame([(p, 12) for p in (*words, *pairs)], "phrase long, n long")
    spelled = collocations.spell(texts, frequent)
    assert sorted(tuple(r) for r in spelled.collect()) == sorted([(pairs[0], 12, words[:2]), (pairs[1], 12, words[1:])])
    told = collocations._told(texts, collocations._marks(frequent), collocations._asked(frequent), 5)
    assert sorted(r["phrase"] for r in told.collect()) == sorted(pairs)
    # a phrase that shares one slot with a wanted one is not told
    other = spark.createDataFrame([(pairs[0] ^ (1 << 40), 1)], "phrase long, n long")
    assert collocations._told(texts, collocations._marks(frequent), collocations._asked(other), 5).count() == 0
    plan = plan_text(spelled, "simple")
    assert plan.index("Join") < plan.index("MapInArrow") and "Aggregate" in plan[plan.index("Join"):plan.index("MapInArrow")]


def test_counts_of_old_scans_and_used_tables_are_deleted(spark):
    docs = spark.createDataFrame([("en", "one two three four. " * 5)] * 6, "lang string, text string").repartition(3)
    base = common.shared_dir(spark).removeprefix("file://")
    before = set(os.listdir(base))
    assert collocations.collocations(docs, least=20).count() > 0
    suffix_dedup.query(documents(spark, [(i, f"{i % 3} the same long text in all of the documents here, and more") for i in range(9)]))
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(base)) - before}
    assert "phrase-texts" in left and "suffix-digests" in left
    assert not left & {"phrase-counts", "shared-keys", "shared-runs", "keys-of-several", "snippet-classes", "judged-snippets"}


def test_suffix_dedup_hands_over_few_texts_at_a_time(spark, monkeypatch):
    sizes = []
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"

    def staged(df, name, **options):
        sizes.append(int(spark.conf.get(key)))
        return common.stage(df, name, **options)

    monkeypatch.setattr(suffix_dedup, "stage", staged)
    monkeypatch.setattr(suffix_dedup, "CUT_BYTES", 500, raising=False)
    old = spark.conf.get(key)
    rng = np.random.default_rng(3)
    texts = ["".join(map(chr, rng.integers(97, 101, 400))) for _ in range(6)]
    rows = [(i, texts[i % 6][:250] + texts[(i + 1) % 6][100:] if i % 2 else texts[i % 6]) for i in range(12)]
    assert plain(suffix_dedup.query(documents(spark, rows)).collect()) == plain(brute_suffix(rows))
    assert len(sizes) >= 8 and sizes.count(1000) >= len(sizes) - 1
    assert spark.conf.get(key) == old


def test_vectors_without_structure_are_screened_by_products(monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1500, 64))
    x[:300] = x[300:600] + 0.06 * rng.normal(size=(300, 64)) * np.linspace(0, 2, 300)[:, None]
    x = cover_tree.unit(x)
    weight = np.ones(len(x), np.int64)
    tree = cover_tree.Tree(x, cover_tree.build(x, 0.95), weight)
    looked = []
    einsum = np.einsum
    monkeypatch.setattr(np, "einsum", lambda how, a, b: looked.append(len(a)) or einsum(how, a, b))
    links = cover_tree.traverse(tree, None, 0.95)
    assert (links.count == (tree.x @ tree.x.T >= 0.95).sum(axis=1)).all()
    assert sum(looked) < 20 * len(x)
