"""What the tasks of op2 and op11 sort, look at and pass on."""

import numpy as np
import pyarrow as pa
import pytest

from donorlens.llm import cover_tree, suffix_dedup
from tests.llm.test_operators import brute_suffix, documents, plain


@pytest.mark.parametrize("seed", range(40))
def test_wanted_suffixes_are_in_order(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(0, 1 + seed % 4, int(rng.integers(1, 180))).astype(np.uint8)
    wanted = rng.random(len(text)) < 0.3
    raw, order = text.tobytes(), suffix_dedup.suffix_array(text, 50, wanted)
    assert len(set(order)) == len(order) and set(np.flatnonzero(wanted)) <= set(order)
    heads = [raw[i:i + 50].ljust(50, b"\0") for i in order]
    assert all(a <= b for a, b in zip(heads, heads[1:]))


def test_only_suffixes_that_start_a_window_are_sorted(monkeypatch):
    rng = np.random.default_rng(2)
    base = rng.integers(97, 110, 70).astype(np.uint8)
    snippets, docs = [], np.arange(40)[::-1].copy()
    for i in range(40):
        s = base.copy()
        s[i] = 120
        snippets.append(s.tobytes()[:60 + i % 10])
    sorted_ = []
    sort = suffix_dedup._sort_directly
    monkeypatch.setattr(suffix_dedup, "_sort_directly", lambda at, *more: sorted_.append(len(at)) or sort(at, *more))
    got = suffix_dedup.earlier_windows(pa.array(snippets, pa.binary()), docs).to_pylist()
    least = {}
    for s, d in zip(snippets, docs):
        for i in range(len(s) - 49):
            least[s[i:i + 50]] = min(d, least.get(s[i:i + 50], d))
    for s, d, bits in zip(snippets, docs, got):
        want = [least[s[i:i + 50]] < d for i in range(len(s) - 49)]
        assert bits == (np.packbits(want).tobytes() if any(want) else b"")
    assert sum(sorted_) <= sum(len(s) - 49 for s in snippets) + len(snippets)


def test_removed_ranges_leave_their_task_united(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "RANGES", 3)
    text = "".join(chr(97 + i * i % 23) + chr(97 + i * 7 % 19) for i in range(600))
    rows = [(1, text), (2, "x" * 60 + text[:700] + "-" + text[800:])] + [(3, text[100:900])] * 20 + [(4, "short")]
    texts = documents(spark, rows).repartition(3).selectExpr(*suffix_dedup._TEXTS)
    got = {(r["doc_id"], tuple(zip(r["starts"], r["ends"]))) for r in suffix_dedup.removed_ranges(texts).collect()}
    assert got == {(2, ((60, 760), (761, 1161))), (3, ((0, 800),))}
    assert plain(suffix_dedup.query(documents(spark, rows)).collect()) == plain(brute_suffix(rows))


@pytest.mark.parametrize("two_sides", [False, True])
def test_wide_nodes_without_structure_are_not_opened_one_by_one(two_sides, monkeypatch):
    """Nodes of the first level hold several vectors that are far apart: no bound on them prunes."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 64)) + 0.9
    x[:300] = x[300:600] + 0.1 * rng.normal(size=(300, 64)) * np.linspace(0, 3, 300)[:, None]
    x = cover_tree.unit(rng.permutation(x))
    trees = [cover_tree.Tree(p, cover_tree.build(p, 0.95), np.ones(len(p), np.int64)) for p in np.split(x, 2 if two_sides else 1)]
    assert all(2 * len(t.starts[0]) < len(t.x) for t in trees)
    looked = []
    einsum = np.einsum
    monkeypatch.setattr(np, "einsum", lambda how, a, b: looked.append(len(a)) or einsum(how, a, b))
    links = cover_tree.traverse(trees[0], trees[1] if two_sides else None, 0.95)
    near = trees[0].x @ trees[-1].x.T >= 0.95
    want = np.r_[near.sum(axis=1), near.sum(axis=0)] if two_sides else near.sum(axis=1)
    assert (links.count == want).all() and sum(looked) < 20 * len(x)


def test_near_duplicates_of_signed_zeros_and_other_lengths(spark):
    rows = [(1, [0.0, 1.0, 2.0]), (2, [-0.0, 1.0, 2.0]), (3, [1.0, 2.0]), (4, [0.0, 2.0, 4.0]), (5, [-1.0, 2.0, 0.0]), (None, [1.0, 2.0])]
    got = cover_tree.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert plain(got) == plain([(1, 2, 1, True), (2, 2, 1, False), (3, 1, 3, True), (4, 2, 1, False), (5, 0, 5, True), (None, 1, 3, False)])
