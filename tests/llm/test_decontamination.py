"""Block-max WAND against exhaustive scoring, its memory, and the tables it takes."""

import math
import random
import tracemalloc
from collections import Counter

import pytest

from donorlens.llm import decontaminate as dec


def index_of(items):
    """The index of (item_id, text) rows and, per item, its terms' impacts."""
    rows = []
    for i, text in items:
        question, answer = dec.question_and_answer(text)
        rows.append((i, question, answer, question if question == answer else question + answer))
    frequency = Counter(w for r in rows for w in set(r[3]))
    mean = sum(len(r[3]) for r in rows) / len(rows)
    impacts = []
    for _, _, _, words in rows:
        norm = dec.K1 * (1 - dec.B + dec.B * len(words) / mean)
        weight = {w: math.log1p((len(rows) - frequency[w] + 0.5) / (frequency[w] + 0.5)) * n * (dec.K1 + 1) / (n + norm)
                  for w, n in Counter(words).items()}
        impacts.append({w: x / sum(weight.values()) for w, x in weight.items()})
    return dec.build_index(rows, frequency, len(rows), mean), impacts


def exhaustive(impacts, step, text, retrieve):
    """Per passage the items that reach the threshold, with every item scored."""
    words = dec.tokens(text)
    n = max(1, -(-len(words) // step) - 1) if words else 0
    out = []
    for c in range(n):
        here = set(words[c * step:(c + 2) * step])
        scores = [(k, sum(x for w, x in own.items() if w in here)) for k, own in enumerate(impacts)]
        out.append({k: s for k, s in scores if s >= retrieve - 1e-9})
    return out


@pytest.mark.parametrize("seed,vocabulary,share", [(0, 400, 0.3), (1, 60, 0.5), (2, 12, 0.6), (3, 3000, 0.1)])
@pytest.mark.parametrize("words", [dec.WORDS, 50])
def test_wand_finds_what_exhaustive_scoring_finds(seed, vocabulary, share, words, monkeypatch):
    monkeypatch.setattr(dec, "WORDS", words)
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(vocabulary)]
    heavy = [1 / (1 + i) for i in range(vocabulary)]
    items = [(i, " ".join(rng.choices(vocab, heavy, k=rng.randint(1, 25)))) for i in range(150)]
    index, impacts = index_of(items)
    texts = [None, "", "!!", " ".join(rng.choices(vocab, heavy, k=2000))]
    for _ in range(40):
        part = rng.choice(items)[1].split()
        rng.shuffle(part)
        texts.append(" ".join(rng.choices(vocab, heavy, k=rng.randint(0, 90)) + part[:rng.randint(1, 25)]
                              + rng.choices(vocab, heavy, k=rng.randint(0, 90))))
    got = [[] for _ in texts]
    for passages in dec.slices(index, texts, words):
        found = [{} for _ in passages.start]
        for passage, k, score in dec.retrieved(index, passages, share):
            assert k not in found[passage]
            found[passage][k] = score
        for text, own in zip(passages.owner.tolist(), found):
            got[text].append(own)
    for text, mine in zip(texts, got):
        want = exhaustive(impacts, index.longest, text, share)
        assert [set(m) for m in mine if m or dec.tokens(text)] == [set(w) for w in want]
        for m, w in zip(mine, want):
            assert all(abs(m[k] - w[k]) < 1e-9 for k in w)


def test_most_blocks_are_not_scored():
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(5000)]
    items = [(i, " ".join(rng.choices(vocab, k=30))) for i in range(4000)]
    index, _ = index_of(items)
    texts = [" ".join(rng.choices(vocab, k=3000)) + " " + items[9][1]]
    passages = next(dec.slices(index, texts, dec.WORDS))
    who, block = dec.pivots(index, passages, dec.RETRIEVE)
    assert 9 // dec.BLOCK in block.tolist()
    assert len(who) < 0.01 * len(passages.start) * index.n_blocks


def test_memory_of_a_batch_of_long_texts():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(200_000)]
    items = [(i, " ".join(rng.choices(vocab, k=12))) for i in range(50_000)]
    index, _ = index_of(items)
    texts = [" ".join(rng.choices(vocab, k=20_000)) for _ in range(63)]
    texts.append(texts[0] + " " + items[7][1])
    tracemalloc.start()
    try:
        found = dec.search(index, texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [row[0] for row in found[-1]] == [7]
    assert peak < 200e6


def test_one_very_long_text_equals_its_slices(monkeypatch):
    rng = random.Random(6)
    vocab = [f"w{i}" for i in range(900)]
    items = [(i, " ".join(rng.choices(vocab, k=20))) for i in range(100)]
    index, _ = index_of(items)
    text = " ".join(rng.choices(vocab, k=4000) + items[3][1].split() + rng.choices(vocab, k=4000) + items[8][1].split())
    whole = dec.search(index, [text])
    monkeypatch.setattr(dec, "WORDS", 100)
    monkeypatch.setattr(dec, "LONG_TEXT", 1000)
    assert dec.search(index, [text]) == whole
    assert [row[0] for row in whole[0]] == [3, 8]


def test_rows_without_id_repeats_and_clashing_columns(spark):
    item = "the capital of the river province was moved twice before the great flood came"
    docs = spark.createDataFrame(
        [(1, f"so {item} indeed", "a"), (1, "nothing of that", "b"), (None, item, "c"), (2, None, "d"), (3, "", "e"),
         (4, item, "f"), (4, item, "f")],
        "doc_id long, text string, score string")
    bench = spark.createDataFrame([(7, item), (8, item), (9, None), (None, "")], "item_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.item_id) for r in dec.leaks(docs, bench).collect())
    assert got == [(False, 1, 7), (False, 1, 8), (False, 4, 7), (False, 4, 7), (False, 4, 8), (False, 4, 8),
                   (True, 0, 7), (True, 0, 8)]
    left = dec.decontaminate(docs, bench)
    assert left.columns == docs.columns
    assert sorted(r.score for r in left.collect()) == ["b", "d", "e"]
    assert dec.decontaminate(docs, bench.limit(0)).count() == docs.count()
