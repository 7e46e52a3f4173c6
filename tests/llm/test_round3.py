"""Cover trees, the Merkle manifest and collocations against brute force; rows, filters and ablations."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from donorlens.llm import collocations, cover_tree, merkle_manifest, quality_rules, simhash, suffix_dedup
from donorlens.plans.checks import plan_text
from tests.llm.test_operators import brute_suffix, documents, plain

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# -- cover trees --------------------------------------------------------------------------

@pytest.mark.parametrize("seed", range(25))
def test_trees_against_all_pairs(seed):
    r = np.random.default_rng(seed)
    dim, n = int(r.integers(2, 12)), int(r.integers(2, 300))
    centres = r.normal(size=(int(r.integers(1, 12)), dim))
    x = cover_tree.unit(centres[r.integers(0, len(centres), n)] + r.normal(size=(n, dim)) * r.choice([0.01, 0.1, 0.3]))
    w = r.integers(1, 4, n)
    path = cover_tree.build(x, 0.95)
    for level, radius in enumerate(cover_tree.radii(0.95)):
        assert (np.linalg.norm(x - x[path[:, level]], axis=1) <= radius + 1e-7).all()   # covering
        if level:
            assert (path[path[:, level], level - 1] == path[:, level - 1]).all()          # nesting
        for node in np.unique(path[:, level - 1]) if level else [0]:
            own = np.unique(path[path[:, level - 1] == node, level] if level else path[:, 0])
            far = np.linalg.norm(x[own][:, None] - x[own][None], axis=2) + 9 * np.eye(len(own))
            assert (far > radius - 1e-7).all()                                            # separation
    tree = cover_tree.Tree(x, path, w)
    links = cover_tree.traverse(tree, None, 0.95)
    near = x[tree.order] @ x[tree.order].T >= 0.95
    np.fill_diagonal(near, True)
    assert (links.count == near @ w[tree.order]).all()
    label = np.arange(n)
    while True:
        new = np.array([label[near[i]].min() for i in range(n)])
        if (new == label).all():
            break
        label = new
    assert (links.root == label).all()
    half = n // 2
    one, two = (cover_tree.Tree(x[s], cover_tree.build(x[s], 0.95), w[s]) for s in (slice(half), slice(half, n)))
    links = cover_tree.traverse(one, two, 0.95)
    near = x[:half][one.order] @ x[half:][two.order].T >= 0.95
    assert (links.count == np.r_[near @ w[half:][two.order], near.T @ w[:half][one.order]]).all()


def brute_embeddings(rows):
    good = []
    for i, (_, e) in enumerate(rows):
        if e and all(v is not None and np.isfinite(v) for v in e) and any(e):
            x = np.array(e, float)
            x = x / np.abs(x).max()
            good.append((i, x / np.linalg.norm(x)))
    label, links = list(range(len(rows))), [0] * len(rows)
    for i, x in good:
        for j, y in good:
            if i < j and len(x) == len(y) and (x @ y >= 0.95 or rows[i][1] == rows[j][1]):
                links[i] += 1
                links[j] += 1
                if label[i] != label[j]:
                    label = [label[i] if c == label[j] else c for c in label]
    out = []
    for i, (v, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((v, links[i], least, v == least))
    return out


@pytest.mark.parametrize("node_bytes, most", [(cover_tree.NODE_BYTES, cover_tree.CENTRES), (8 * 6 * 40, 4), (8 * 6 * 10, 1)])
def test_embedding_near_duplicates(spark, node_bytes, most):
    r = np.random.default_rng(3)
    centres = r.normal(size=(30, 6))
    rows = [(i, (centres[i % 30] + r.normal(size=6) * (0.02 if i % 30 < 5 else 0.4)).tolist()) for i in range(300)]
    hot = r.normal(size=6)
    rows += [(1000 + i, (hot + r.normal(size=6) * 0.005).tolist()) for i in range(150)]          # one large group
    rows += [(2000 + i, rows[4][1]) for i in range(5)] + [(rows[7][0], rows[7][1]), (7, rows[9][1])]  # copies, shared ids
    rows += [(None, rows[4][1]), (None, [9.0, -9.0, 9.0, -9.0, 9.0, 1.0]), (3000, None), (3001, []), (3002, [0.0] * 6),
             (3003, [1.0, None, 2.0, 3.0, 4.0, 5.0]), (3004, [float("nan")] * 6), (3005, [float("inf")] + [1.0] * 5),
             (3006, [1e300] * 6), (3007, [1e-300] * 6), (3008, [1.0, 2.0]), (3009, [2.0, 4.0]), (3010, [1.0, 2.0, 3.0])]
    schema = "vec_id long, embedding array<double>, label int, centre string, `key` string"
    df = spark.createDataFrame([(v, e, 1, "x", "y") for v, e in rows], schema).repartition(3)
    got = cover_tree.near_duplicates(df, node_bytes=node_bytes, most=most).collect()
    assert plain(got) == plain(brute_embeddings(rows))


def test_embeddings_empty_table_and_bad_threshold(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert cover_tree.query(df).collect() == []
    assert [f.dataType for f in cover_tree.query(df).schema] == [T.LongType(), T.LongType(), T.LongType(), T.BooleanType()]
    with pytest.raises(ValueError):
        cover_tree.near_duplicates(df, threshold=0.2)


# -- the Merkle manifest --------------------------------------------------------------------

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = (row[0], row[3], row[2], row[4], text)
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def siblings(levels, i):
    for level in levels[:-1]:
        run, k = level[i - i % 3:i - i % 3 + 3], i % 3
        yield run[:k], run[k + 1:]
        i //= 3


def brute_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[3]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[s] = tree([leaf(r, r[1]) for r in groups[s]])
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            text = r[1]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded, others = leaf(r, text), []
            for a, b in [*siblings(trees[s], i), *siblings(top, k)]:
                others += a + b
                folded = h(*a, folded, *b)
            out.append((r[0], leaf(r, r[1]), trees[s][-1][0], top[-1][0], h(*others), folded, folded == top[-1][0]))
    return out


def manifest_rows(n, sources):
    r = random.Random(n)
    rows = []
    for i in range(n):
        text = "".join(r.choice("ab é\n") for _ in range(r.randint(0, 30)))
        rows.append((i * 7 - 50, text, "en", "hot" if i % 3 == 0 else f"s{r.randrange(sources)}", len(text)))
    return rows


@pytest.mark.parametrize("many_leaves", [merkle_manifest.MANY_LEAVES, 5])
def test_manifest(spark, many_leaves):
    rows = manifest_rows(240, 12) + [
        (None, "x\ny", "en", "hot", 3), (None, None, None, None, None), (5, "", None, None, 0), (5, "a\nb", "en", "hot", 3),
        (5, "a\nb", "en", "hot", 3), (5, "b\nc", "en", "hot", 3), (6, "a" * 200_000 + "\n", "en", "", 1), (7, "\n\n", "é", "Zé", -1)]
    df = spark.createDataFrame([(*r, "extra") for r in rows], DOCS + ", leaf string").repartition(5)
    got = merkle_manifest.verify(df, many_leaves=many_leaves).collect()
    want = brute_manifest(rows)
    assert plain(got) == plain(want)
    assert {r[-1] for r in want} == {True, False}


@pytest.mark.parametrize("n, sources", [(0, 1), (1, 1), (2, 1), (4, 50)])
def test_small_manifests(spark, n, sources):
    rows = manifest_rows(n, sources)
    got = merkle_manifest.query(spark.createDataFrame(rows, DOCS)).collect()
    assert plain(got) == plain(brute_manifest(rows))


def test_manifest_restores_the_recursion_bound(spark):
    spark.conf.set("spark.sql.cteRecursionRowLimit", "77")
    try:
        merkle_manifest.query(spark.createDataFrame(manifest_rows(9, 2), DOCS)).collect()
        assert spark.conf.get("spark.sql.cteRecursionRowLimit") == "77"
    finally:
        spark.conf.unset("spark.sql.cteRecursionRowLimit")


# -- collocations ---------------------------------------------------------------------------

def brute_collocations(rows, least, top, longest=5):
    counts, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang, text = lang if lang is not None else "und", text or ""
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        for end in ".,;:!?\n\x0b\x0c\r":
            text = text.replace(end, ".")
        for piece in text.split("."):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            n[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = set()
        for p, a in found.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p) and a >= f[p[i:j]]:
                        inside.add(p[i:j])
        best = []
        for p, a in found.items():
            if p not in inside:
                score, k = min((Fraction(1000 * a * n[lang], f[p[:k]] * f[p[k:]]).__floor__(), k) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (score, a, text, left, right) in enumerate(sorted(best)[:top]):
            out.append((lang, i + 1, text.decode(), -a, left, right, n[lang], -score))
    return out


@pytest.mark.parametrize("shards, held", [(4, collocations.HELD), (1, 50), (7, 50)])
def test_collocations(spark, shards, held, monkeypatch):
    monkeypatch.setattr(collocations, "HELD", held)
    monkeypatch.setattr(collocations, "SLICE", 40)
    monkeypatch.setattr(collocations, "KNOWN_WORDS", 20)
    monkeypatch.setattr(collocations, "SLOTS", 64)  # slots are shared by many phrases
    r = random.Random(shards)
    words = ["new", "york", "city", "of", "the", "Éa", "x\x00y", "a b", "Is"]
    rows = []
    for i in range(300):
        parts = [r.choice(words) for _ in range(r.randint(0, 14))]
        if i % 3 == 0:
            parts += ["in", "New", "York", "city", "hall"]
        rows.append((i, r.choice([" ", "  ", "\t"]).join(parts) + r.choice([".", "! the of", "\nnew york,", ""]), r.choice(["en", "de", None])))
    # a phrase that turns up late only, rows without an id, repeated rows, an odd language
    rows += [(900 + i, "late bloom here again now", "en") for i in range(9)] + [(None, "of the of the", "en"), (1, None, "en"), (2, "", "")] * 2
    schema = "doc_id long, text string, lang string, phrase string, n long"
    df = spark.createDataFrame([(*x, "clash", 1) for x in rows], schema).coalesce(1).repartition(6)
    got = collocations.collocations(df, least=8, top=40, shards=shards).collect()
    assert plain(got) == plain(brute_collocations(rows, 8, 40))
    assert any(x["phrase"].startswith("late bloom") for x in got)


def test_collocations_of_nothing(spark):
    df = spark.createDataFrame([], DOCS)
    assert collocations.query(df).collect() == []
    assert collocations.query(spark.createDataFrame([(1, "a b c", None, None, None)], DOCS)).collect() == []


# -- earlier operators ------------------------------------------------------------------------

def test_simhash_deduplicates_rows_not_ids(spark):
    r = random.Random(2)
    a, b, c = (" ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(80)) for _ in range(3))
    rows = [(1, a), (5, a), (5, b), (7, c), (7, c), (9, c), (None, a), (None, a), (3, ""), (4, None)]
    df = spark.createDataFrame([(d, t, "gone", 1) for d, t in rows], "doc_id long, text string, _i string, _doc long").repartition(3)
    got = simhash.deduplicate(df)
    assert got.columns == df.columns
    # the unique text of doc 5 stays, one of the equal rows of doc 7, and rows without an id
    assert plain((x[0], x[1]) for x in got.collect()) == plain([(1, a), (5, b), (7, c), (None, a), (None, a), (3, "")])


def test_simhash_keeps_one_of_two_near_texts_with_one_id(spark):
    r = random.Random(8)
    words = ["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(4000)]
    near = words[:-1] + ["zzz"]
    got = simhash.deduplicate(spark.createDataFrame([(5, " ".join(words)), (5, " ".join(near))], "doc_id long, text string")).collect()
    prints = [simhash.fingerprint(" ".join(x)) for x in (words, near)]
    assert len(got) == (1 if (prints[0] ^ prints[1]).bit_count() <= 4 else 2) == 1


def test_suffix_dedup_of_fifty_equal_rows_and_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 200)
    r = random.Random(4)
    long = "".join(r.choice("abcdefgh ") for _ in range(1500))
    rows = [(7, long)] * 50 + [(8, long[300:900]), (9, "x" * 400 + long[:100]), (7, long[::-1]), (3, long[700:760])]
    got = suffix_dedup.query(documents(spark, rows).repartition(4)).collect()
    assert plain(got) == plain(brute_suffix(rows))


def test_quality_result_can_be_filtered(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    result = quality_rules.query(docs)
    kept = {x["doc_id"] for x in result.where("kept").collect()}
    assert kept == {x["doc_id"] for x in result.collect() if x["kept"]}
    book = quality_rules.ledger(docs, "doc_id")
    cells = {(x["policy"], x["rule"]): x for x in quality_rules.ablations(book).collect()}
    bits = [x["fail_bits"] for x in book.collect()]
    assert len(cells) == sum(map(len, quality_rules.POLICIES.values()))
    for (policy, rule), x in cells.items():
        one = next(1 << q.bit for q in quality_rules.RULES if q.name == rule)
        mask = quality_rules.policy_mask(policy)
        assert (x["failing"], x["rejected"], x["rejected_by_it_alone"]) == (
            sum(b & one != 0 for b in bits), sum(b & mask != 0 for b in bits), sum(b & mask == one for b in bits))
    own = {"mine": ["symbols"]}
    assert [x["policy"] for x in quality_rules.ablations(book, own).collect()] == ["mine"]


# -- what the tasks of op2 and op13 pass on ------------------------------------------------

def test_runs_of_texts_end_to_end_are_those_of_each_text(monkeypatch):
    rng = np.random.default_rng(5)
    texts = [rng.integers(97, 101, n).astype(np.uint8) for n in (0, 300, 49, 50, 700)] + [np.full(400, 97, np.uint8)]
    bounds = np.cumsum([0, *map(len, texts)])
    owner, key, start, n = suffix_dedup.window_runs(np.concatenate(texts), bounds)
    assert n.max() <= suffix_dedup.RUN
    for i, text in enumerate(texts):
        own = owner == i
        keys = suffix_dedup.window_keys(text)
        assert np.repeat(key[own], n[own]).tolist() == keys.tolist()
        places = np.concatenate([np.arange(a, a + k) for a, k in zip(start[own] - bounds[i], n[own])] or [np.zeros(0, int)])
        assert places.tolist() == list(range(len(keys)))


def test_suffix_keys_leave_a_task_combined(spark):
    text = " ".join(f"word{i % 90}" for i in range(400))
    texts = documents(spark, [(i, text) for i in range(20)]).coalesce(1).selectExpr(*suffix_dedup._TEXTS)
    rows = suffix_dedup._keys(texts, 6).collect()
    distinct = np.unique(suffix_dedup.window_keys(np.frombuffer(text.encode(), np.uint8)))
    assert len(rows) <= 64 and sum(len(r["places"]) for r in rows) == 2 * len(distinct)
    assert suffix_dedup._shared_keys(texts, 6).count() == len(distinct)


def test_suffix_keys_of_equal_runs_need_no_suffix_array(spark, monkeypatch):
    judged = []
    judge = suffix_dedup._judge
    monkeypatch.setattr(suffix_dedup, "_judge", lambda classes: judged.append(classes.count()) or judge(classes))
    text = "".join(chr(97 + i * i % 23) + chr(97 + i * 7 % 19) for i in range(300))
    rows = [(1, text), (2, text), (3, text)]
    assert plain(suffix_dedup.query(documents(spark, rows)).collect()) == plain(brute_suffix(rows))
    assert judged == [0]


def test_counts_without_a_marked_slot_stay_in_place(spark):
    counts = spark.createDataFrame([(p, 1) for p in (-3, 5, 64 + 5, 6)], "phrase long, n long")
    marks = np.zeros(64, np.uint8)
    marks[[5, 61]] = 1
    assert sorted(r["phrase"] for r in collocations._in_slots(counts, marks).collect()) == [-3, 5, 69]


def test_words_of_many_tasks_are_one_row_before_the_join(spark):
    texts = spark.createDataFrame([("en", [bytearray(b"foo"), bytearray(b"bar")])] * 12, "lang string, fresh array<binary>").repartition(6)
    needed = spark.createDataFrame([(collocations.word_hash(b"en\0foo"),)], "tail long")
    words = collocations.spellings(texts, needed)
    assert [tuple(r) for r in words.collect()] == [(collocations.word_hash(b"en\0foo"), "en", "foo")]
    plan = plan_text(words, "simple")
    assert plan.index("LeftSemi") < plan.index("MapInArrow") and "Aggregate" in plan[plan.index("LeftSemi"):plan.index("MapInArrow")]
