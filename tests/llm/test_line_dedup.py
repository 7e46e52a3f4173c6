"""Line deduplication against brute force for several edit bounds, and the tables it takes."""

import random

import pytest

from donorlens.llm import line_dedup


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(rows, near_chars, edits):
    """Texts of rows with distinct doc_ids in ascending order."""
    seen, out = [], {}
    for d, text in rows:
        kept = []
        for line in (text or "").split("\n"):
            if not line.strip(" \t\n\r\x0b\x0c"):
                kept.append(line)
                continue
            if line not in seen and not any(
                    min(len(line), len(o)) >= near_chars and abs(len(line) - len(o)) <= edits and distance(line, o) <= edits
                    for o in seen):
                kept.append(line)
            seen.append(line)
        out[d] = None if text is None else "\n".join(kept)
    return out


def edit(r, line, n):
    for _ in range(n):
        at = r.randrange(len(line))
        line = r.choice([line[:at] + line[at + 1:], line[:at] + r.choice("abyz") + line[at:],
                         line[:at] + r.choice("abyz") + line[at + 1:]])
    return line


@pytest.mark.parametrize("edits,letters", [(1, "ab"), (2, "ab"), (2, "abcdefgh ")])
def test_edit_bounds(spark, edits, letters):
    r = random.Random(edits)
    base = ["".join(r.choice(letters) for _ in range(r.randint(6, 14))) for _ in range(14)]
    rows = [(d, "\n".join(r.choice(["", "ab", edit(r, r.choice(base), r.randint(0, edits + 1))]) for _ in range(3)))
            for d in range(60)] + [(90, None), (91, ""), (92, "\n\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x.text for x in line_dedup.deduplicate(docs, 6, edits).collect()}
    assert got == brute(rows, 6, edits)


def test_names_that_clash_and_rows_that_share_an_id(spark):
    line = "a line that is long enough to be near another"
    rows = [(5, f"{line}\nsame place", "x"), (5, f"other {line}\nsame place", "y"), (5, f"{line}\nsame place", "x"),
            (7, f"{line}!\nits own", "z"), (None, line, "w")]
    names = ["_kept", "_id", "_l", "_n", "_blank", "_stay", "__kept", "h1", "place", "line", "n_lines", "a b", "c`d"]
    docs = spark.createDataFrame([(d, t, *[v] * len(names)) for d, t, v in rows], ["doc_id", "text", *names])
    out = line_dedup.deduplicate(docs)
    assert out.columns == docs.columns
    got = sorted((str(r[0]), r[1], r[2]) for r in out.collect())
    want = [(5, f"{line}\nsame place", "x"), (5, f"other {line}\nsame place", "y"), (5, f"{line}\nsame place", "x"),
            (7, "its own", "z"), (None, line, "w")]
    assert got == sorted((str(d), t, v) for d, t, v in want)
    with pytest.raises(ValueError):
        line_dedup.deduplicate(docs, counts=True)
    with pytest.raises(ValueError):
        line_dedup.deduplicate(docs, 2, 2)


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    r = random.Random(8)
    base = ["".join(r.choice("abcd ") for _ in range(25)) for _ in range(10)]
    rows = [(d, "\n".join(edit(r, r.choice(base), r.randint(0, 1)) for _ in range(4))) for d in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(line_dedup, "BROADCAST_IDS", 0)
    assert {x.doc_id: x.text for x in line_dedup.deduplicate(docs).collect()} == brute(rows, 20, 1)


def test_one_very_long_text(spark):
    r = random.Random(9)
    lines = ["".join(r.choice("abcdefgh ") for _ in range(40)) for _ in range(5000)]
    docs = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(edit(r, x, 1) for x in lines[:300]))],
                                 "doc_id long, text string")
    got = {x.doc_id: x.text for x in line_dedup.deduplicate(docs).collect()}
    assert got == {1: "\n".join(lines), 2: ""}
