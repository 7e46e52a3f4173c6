"""The text operators against brute force, held-out labels, and the defined edge cases."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash

from donorlens.llm import (
    decontaminate, langid, line_dedup, packing, quality_model, quality_rules, queries, simhash, suffix_dedup, token_files,
    toxicity,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LETTERS = "abcdefghij klmnopqrstu vwxyz"


def documents(spark, rows):
    full = [(d, t, "en", "web", None if t is None else len(t)) for d, t in rows]
    return spark.createDataFrame(full, DOCS)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    texts = ["".join(r.choice(LETTERS) for _ in range(r.randint(40, 400))) for _ in range(25)]
    out = [(i, t) for i, t in enumerate(texts)]
    out += [(100 + i, t[:60] + "é\x00" + t) for i, t in enumerate(texts[:8])]   # near copies
    out += [(200 + i, texts[0]) for i in range(4)]                            # copies
    out += [(300, None), (301, ""), (302, "   "), (None, texts[1]), (3, texts[2] + texts[9]), (303, "a" * 300), (304, "a" * 260)]
    return out


def plain(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(x is not None, x) for x in r])


# -- suffix arrays --------------------------------------------------------------------

@pytest.mark.parametrize("seed", range(60))
def test_two_stage_order(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(0, 1 + seed % 4, int(rng.integers(1, 180))).astype(np.uint8)
    raw, order = text.tobytes(), suffix_dedup.suffix_array(text)
    assert sorted(order) == list(range(len(raw)))
    heads = [raw[i:i + 50].ljust(50, b"\0") for i in order]
    assert all(a <= b for a, b in zip(heads, heads[1:]))


def brute_suffix(rows, length=50):
    first, out = {}, []
    for d, t in rows:
        raw = (t or "").encode()
        for i in range(len(raw) - length + 1) if d is not None else ():
            first[raw[i:i + length]] = min(d, first.get(raw[i:i + length], d))
    for d, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1) if d is not None else ():
            if first[raw[i:i + length]] < d:
                gone[i:i + length] = b"\1" * length
        spans = sum(bool(g) and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        out.append((d, len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 1])
def test_suffix_dedup(spark, rows, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    got = suffix_dedup.query(documents(spark, rows).repartition(3)).collect()
    assert plain(got) == plain(brute_suffix(rows))
    assert any(r["n_removed"] for r in got)


# -- simhash ----------------------------------------------------------------------------

def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, rows):
    got = simhash.query(documents(spark, rows)).collect()
    prints = [(d, brute_fingerprint(t)) for d, t in rows]
    label = list(range(len(prints)))
    for i, (_, a) in enumerate(prints):
        for j, (_, b) in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= 4 and label[i] != label[j]:
                label = [label[j] if x == label[i] else x for x in label]
    least = {}
    for x, (d, _) in zip(label, prints):
        if d is not None:
            least[x] = min(d, least.get(x, d))
    want = [(d, f"{p:016x}", least[x]) for x, (d, p) in zip(label, prints)]
    assert plain((r[0], r[1], r[2]) for r in got) == plain(want)


# -- line dedup ---------------------------------------------------------------------------

def within_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


def test_line_dedup(spark):
    r = random.Random(2)
    base = ["".join(r.choice("abcd efgh") for _ in range(30)) for _ in range(12)]
    rows = []
    for d in range(25):
        lines = []
        for _ in range(4):
            x = r.choice(base)
            at = r.randrange(len(x))
            lines.append(r.choice([x, x[:at] + x[at + 1:], x[:at] + "z" + x[at:], x[:at] + "y" + x[at + 1:], "", "short"]))
        rows.append((d, "\n".join(lines)))
    rows += [(90, None), (91, ""), (92, "\n\n")]
    got = {x["doc_id"]: x["text"] for x in line_dedup.deduplicate(documents(spark, rows)).collect()}
    seen = []
    for d, t in rows:
        if t is None:
            assert got[d] is None
            continue
        kept = []
        for line in t.split("\n"):
            if not line.strip(" \t\n\r\x0b\x0c"):
                kept.append(line)
                continue
            if not any(line == o or (min(len(line), len(o)) >= line_dedup.NEAR_CHARS and within_one(line, o)) for o in seen):
                kept.append(line)
            seen.append(line)
        assert got[d] == "\n".join(kept), d


# -- files, packing -------------------------------------------------------------------------

def test_token_files_round_trip(spark, rows):
    from tokenizers import Tokenizer

    path = queries.vocabulary("word_bpe_49k.json")
    tokenizer, own, start, want = Tokenizer.from_file(path), [r for r in rows if r[0] not in (None, 3)], 0, []
    for d, t in sorted(own):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = token_files.query(documents(spark, own), path).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert plain(got) == plain(want)


def test_block_round_trip():
    ids = np.r_[np.arange(500), 49_000, np.zeros(3), 7].astype(np.uint32)
    assert (token_files.decode_block(token_files.encode_block(ids)) == ids).all()


def test_packing(spark, rows):
    from tokenizers import Tokenizer

    path = queries.vocabulary("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    long = [r for r in rows if r[0] not in (None, 3)] + [(500, "word pieces " * 3000)]
    got = packing.query(documents(spark, long), path).collect()
    own = {d: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for d, t in long}
    bins = {}
    for p in got:
        part = np.array(own[p["doc_id"]][p["start"]:p["start"] + p["length"]], "<u4")
        assert len(part) == p["length"] <= 2048 and zlib.crc32(part.tobytes()) == p["ids_crc32"]
        bins.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    total = sum(map(len, own.values()))
    assert sum(p["length"] for p in got) == total and len(bins) <= -(-total // 2048) + 1


# -- rules, leaks -------------------------------------------------------------------------------

def test_rules_filter_equals_verdict_with_clashing_columns(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").selectExpr("*", "'x' AS kept", "1 AS n_words", "2 AS _t")
    kept = {r["doc_id"] for r in quality_rules.query(docs.drop("kept", "n_words", "_t")).collect() if r["kept"]}
    out = quality_rules.filter_documents(docs)
    assert out.columns == docs.columns and {r["doc_id"] for r in out.collect()} == kept


def test_leaks(spark):
    item = "what is the tallest mountain on the whole wide earth today. mount everest is the tallest of all known peaks here."
    clean = "completely other words about rivers and lakes that nobody has ever asked a question about in tests."
    rows = [(1, clean + " " + item + " " + clean), (2, clean), (3, None), (4, ""), (5, item[:40])]
    bench = spark.createDataFrame([(7, item), (8, None), (9, "")], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.query(documents(spark, rows), bench).collect()} == {(1, 7)}
    kept = decontaminate.decontaminate(documents(spark, rows), bench)
    assert {r["doc_id"] for r in kept.collect()} == {2, 3, 4, 5}


# -- classifiers ---------------------------------------------------------------------------------

def test_language_held_out_accuracy(spark, sf_small):
    sf = sf_small.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = langid.query(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97


def test_many_languages(spark):
    r = random.Random(4)
    rows = []
    for k in range(30):  # tables of over 512 MB in all
        words = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(300)]
        rows += [(100 * k + i, " ".join(r.choice(words) for _ in range(900)), f"x{k:02}", "web", 1) for i in range(6)]
    docs = spark.createDataFrame(rows + [(9000, None, "x01", "web", 1), (9001, "12", "x01", "web", 1)], DOCS)
    got = langid.query(docs.repartition(3)).collect()
    lang = {d: x for d, t, x, _, _ in rows}
    assert all(x["lang_pred"] == lang.get(x["doc_id"], "und") for x in got) and len(got) == len(rows) + 2


def test_language_sample_is_not_the_head():
    header = "gemeinsame kopfzeile " * 40
    own = {"de": "zwölf boxkämpfer jagen viktor ", "fr": "portez ce vieux whisky au juge "}
    models = list(langid.fit({x: [f"{i} {header}" + t * 60 for i in range(64)] for x, t in own.items()}))
    assert [g[1] for g in langid.cheapest(models[0], [t * 3 for t in own.values()])] == ["de", "fr"]
    text = langid.code_points("abcdefghij" * 200)
    for budget in (2, 64, 65, 66, 312, 1999, 2000, 2001, 5000):
        assert 0 < len(langid.drawn(text, budget)) <= budget


def test_samples_hold_one_row_a_document(spark):
    rows = [(1, f"copy {i}", "en", "web", 1) for i in range(200)] + [(i, f"text {i}", "en", "web", 1) for i in range(2, 40)]
    docs = spark.createDataFrame(rows, DOCS)
    free = {d for d, *_ in rows if zlib.crc32(str(d).encode()) % langid.FOLDS != langid.HELD_OUT}
    assert 1 in free and len(langid.training_sample(docs)["en"]) == len(free)
    assert len(langid.training_sample(docs, 5)["en"]) == 5
    marked = quality_model.features(docs).selectExpr("*", "1 AS quality")
    assert [r["doc_id"] for r in quality_model._sample(marked, 1000)] == list(range(1, 40))


def test_language_shards_change_nothing(spark, sf_small, monkeypatch):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    docs = docs.union(docs.limit(5))
    whole = langid.query(docs).collect()
    monkeypatch.setattr(langid, "SHARD_BYTES", 1)
    assert plain(langid.query(docs).collect()) == plain(whole)


def test_toxicity_flags_no_clean_document(spark, sf_small):
    sf = sf_small.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.query(docs, labels).join(labels, "doc_id").where("held_out").collect()
    wrong = sum(r["predicted"] == 1 and r["toxic"] == 0 for r in got)
    assert wrong <= 0.01 * len(got) and any(r["predicted"] == 1 for r in got)


def test_toxicity_held_out_recall_per_language(spark, sf_small):
    sf = sf_small.replace("sf0.001", "sf0.1")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = (toxicity.query(docs, labels).join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
           .where("held_out").collect())
    for lang in ("de", "en", "es", "fr"):
        toxic = [r["predicted"] for r in got if r["lang"] == lang and r["toxic"] == 1]
        assert np.mean(toxic) > 0.8, (lang, sum(toxic), len(toxic))
    assert sum(r["predicted"] == 1 and r["toxic"] == 0 for r in got) <= 0.01 * len(got)


def test_toxicity_stems_and_no_beginnings_of_identity_terms(spark):
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    rows, labels = [], []
    for i in range(300):
        toxic = i % 5 == 0
        text = [word() for _ in range(40)]
        for at in (5, 15, 25) if toxic else ():
            text[at] = "zorkul" + word()      # each form once: no whole word can be learned
            text[at + 2] = "muslim" + word()  # must not carry a score by its beginning
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    model = toxicity.fit(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert model.score("some zorkulish talk") > 0.7 > model.score("some muslimish talk")
    assert not any(t.startswith("mus") and t.endswith("*") and "muslim".startswith(t[:-1]) for t in model.weights)


def test_quality_held_out_accuracy(spark, sf_small):
    sf = sf_small.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_model.query(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r["kept"] == bool(r["quality"]) for r in got]) > 0.9


# -- empty tables -----------------------------------------------------------------------------------

def test_empty_tables(spark):
    docs = documents(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    for out in (simhash.query(docs), suffix_dedup.query(docs), decontaminate.query(docs, bench), line_dedup.query(docs),
                langid.query(docs), quality_model.query(docs, labels), toxicity.query(docs, labels), quality_rules.query(docs),
                packing.query(docs, queries.vocabulary("byte_bpe_50k.json")),
                token_files.query(docs, queries.vocabulary("word_bpe_49k.json"))):
        assert out.count() == 0
