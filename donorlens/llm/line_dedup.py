"""Line deduplication within an edit bound, by a deletion-neighbourhood join.

A line with a word is removed if an earlier line (by doc_id, then line number;
judged on the input) equals it or, for lines of at least ``NEAR_CHARS``
characters, lies within ``EDITS`` inserted, deleted or replaced characters. Lines
without a word always stay. Native DataFrame expressions only.

1. Equal lines collapse to one *content* with its earliest place (a grouped
   minimum, combined map-side: a line in a third of all documents is one row
   per task).
2. The shorter of two lines is cut into k + 1 segments. k edits leave one of them
   whole, and for some such segment i (from 0) at most i edits stand before it and k - i
   behind it; that bounds how far it can have moved. Only contents that share a segment
   with another one go on; nothing that has a partner is lost.
3. These emit hashed variants of what stands before and behind the segment: some
   characters replaced by a mark (the marks' places are part of the key), some deleted. Two
   contents with an equal variant of s marks and p and q deletions are within s + p + q edits, and
   every pair within k edits has such a variant. So a content needs, per number of
   deletions that is left to it, only the group's earliest member, never the group's pairs.
4. Each content and its earliest partner are verified by ``levenshtein``.
5. Documents are rebuilt from the line numbers that stay.

A bound of k emits in the order of n^k variants for a line of n characters that shares a segment.

Defined results: a null text stays null and an empty one empty; a row without a
doc_id has no place in the order: it is returned unchanged and removes nothing;
rows that share a doc_id count as one document, so a line number that stays in
one stays in all; extra columns of any name pass through (``counts`` adds two names that must be
free); an empty table gives no rows; ties cannot occur between places, and lines of one place do not
remove each other; a very long text is one row whose lines are handled one by one.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import permutations, product

from pyspark.sql import DataFrame, functions as F

from donorlens.llm.common import exactly, stage

NEAR_CHARS = 20
EDITS = 1
BROADCAST_IDS = 500_000  # ids of candidate documents, or places of candidate lines, that are broadcast (16 bytes each)
_WORD = r"r'[^\x20\x09-\x0D]'"
_PLACE = "CAST(doc_id AS DECIMAL(20, 0)) * 2147483648 + line_no"


@dataclass(frozen=True)
class Cell:
    """Segment ``i`` of ``edits`` + 1 as it stands in a line ``longer`` characters longer than the shorter
    one, moved by ``shift``. SQL expressions over ``line``."""

    edits: int
    i: int
    longer: int
    shift: int

    @property
    def own(self) -> bool:
        return self.longer == self.shift == 0

    @property
    def n(self) -> str:
        return f"(length(line) - {self.longer})"

    @property
    def start(self) -> str:
        return f"({self.n} * {self.i} div {self.edits + 1} + {self.shift})"

    @property
    def size(self) -> str:
        return f"({self.n} * {self.i + 1} div {self.edits + 1} - {self.n} * {self.i} div {self.edits + 1})"

    def hash(self, near_chars: int) -> str:
        inside = f"{self.start} >= 0 AND {self.start} + {self.size} <= length(line)"
        return (f"CASE WHEN {self.n} >= {near_chars} AND {inside} "
                f"THEN xxhash64({self.i}, {self.n}, substring(line, CAST({self.start} AS INT) + 1, CAST({self.size} AS INT))) END")


def cells(edits: int) -> list[Cell]:
    """All ways in which a line can hold a segment that it shares with another one within ``edits``."""
    return [Cell(edits, i, longer, shift) for longer in range(edits + 1) for i in range(edits + 1)
            for shift in range(max(-i, longer - (edits - i)), min(i, longer + (edits - i)) + 1)]


def _lines(docs: DataFrame) -> DataFrame:
    """(place, line): every line that has a word; a place orders lines by doc_id and number."""
    rows = exactly(docs, "doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    return (rows.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "posexplode(split(text, '\\n')) AS (line_no, line)")
            .where(f"line RLIKE {_WORD}").selectExpr(f"{_PLACE} AS place", "line"))


def contents(docs: DataFrame, near_chars: int = NEAR_CHARS, edits: int = EDITS) -> DataFrame:
    """One staged row per distinct line: its earliest place, its hash and those of its segments.

    Lines are compared by two independent 64-bit hashes and their length.
    """
    names = [f"c{j}" for j in range(len(cells(edits)))]
    hashes = [f"{cell.hash(near_chars)} AS {name}" for cell, name in zip(cells(edits), names)]
    keyed = _lines(docs).selectExpr("place", "length(line) AS n", "xxhash64(line) AS h1",
                                    "xxhash64('second', line) AS h2", *hashes)
    found = keyed.groupBy("h1", "h2", "n").agg(F.min("place").alias("place"), *[F.min(c).alias(c) for c in names])
    return stage(found.select("place", "h1", *names), "line-contents")


def _candidates(found: DataFrame, edits: int) -> DataFrame:
    """(place, h1, segment, cell): contents that share a segment with another one of fitting length."""
    structs = [f"named_struct('segment', c{j}, 'cell', {j}, 'own', {str(cell.own).lower()})"
               for j, cell in enumerate(cells(edits))]
    segments = found.selectExpr("place", "h1", f"inline(array({', '.join(structs)}))").where("segment IS NOT NULL")
    shared = (segments.groupBy("segment").agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("any_own"))
              .where("n > 1 AND any_own").select("segment"))
    return stage(segments.drop("own").join(shared, "segment"), "line-candidates")


def _small(df: DataFrame) -> DataFrame:
    """``df`` broadcast where a count shows it is small."""
    return F.broadcast(df) if df.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else df


def _with_text(docs: DataFrame, candidates: DataFrame) -> DataFrame:
    """(place, h1, line) of the candidate contents. Their documents and lines are picked by a broadcast
    where a count shows it is small, by a shuffled join beyond."""
    places = stage(candidates.select("place", "h1").distinct(), "line-places")
    ids = places.selectExpr("CAST(floor(place / 2147483648) AS BIGINT) AS doc_id").distinct()
    rows = exactly(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    picked = rows.join(_small(ids), "doc_id", "left_semi")
    lines = _lines(picked).withColumn("h1", F.xxhash64("line"))
    return stage(lines.join(_small(places), ["place", "h1"], "left_semi").dropDuplicates(["place", "h1"]), "line-texts")


def _edited(part: str, ops: str, then, depth: int = 0, start: str = "0", marks: tuple = ()) -> str:
    """SQL array of ``then(variant, marks)`` over all variants of ``part`` with the edits ``ops``, from left to
    right: ``m`` takes a character out and keeps its place as a mark, ``d`` deletes one."""
    if not ops:
        return then(part, marks)
    q = f"{ops[0]}{depth}"
    at = f"CASE WHEN length({part}) > {start} THEN sequence({start}, length({part}) - 1) ELSE array() END"
    rest = f"concat(left({part}, {q}), substring({part}, {q} + 2))"
    inner = _edited(rest, ops[1:], then, depth + 1, q, marks + ((q,) if ops[0] == "m" else ()))
    return f"flatten(transform({at}, {q} -> {inner}))"


def _orders(marked: int, deleted: int) -> list[str]:
    return sorted({"".join(o) for o in permutations("m" * marked + "d" * deleted)})


def _variants(cell: Cell) -> str:
    """SQL array of (kind, key) over ``segment``, ``head`` and ``tail``; kind = 8 * marks + deletions."""
    k, parts = cell.edits, []
    for deleted in range(cell.longer, k + 1):
        for marked in range(k + 1):
            if marked + 2 * deleted - cell.longer > k:
                continue
            keys = []
            for m, d in product(range(marked + 1), range(deleted + 1)):  # edits before the segment
                if m + d > cell.i or marked - m + deleted - d > k - cell.i:
                    continue
                for front, back in product(_orders(m, d), _orders(marked - m, deleted - d)):
                    def key(head, left, tail, right):
                        return f"array(xxhash64({', '.join(['segment', str(len(left)), head, *left, tail, *right])}))"
                    keys.append(_edited("head", front, lambda head, left, back=back: _edited(
                        "tail", back, lambda tail, right: key(head, left, tail, right), 4), 0))
            if keys:
                parts.append(f"transform(array_distinct(concat({', '.join(keys)})), "
                             f"x -> named_struct('kind', {8 * marked + deleted}, 'key', x))")
    return f"concat({', '.join(parts)})" if parts else "CAST(array() AS array<struct<kind:int,key:bigint>>)"


def near_removed(docs: DataFrame, found: DataFrame, edits: int = EDITS) -> DataFrame:
    """(place, h1): contents with an earlier content within ``edits``."""
    candidates = _candidates(found, edits)
    texts = _with_text(docs, candidates)
    ways = list(enumerate(cells(edits)))
    start = " ".join(f"WHEN {j} THEN {cell.start}" for j, cell in ways)
    end = " ".join(f"WHEN {j} THEN {cell.start} + {cell.size}" for j, cell in ways)
    parts = candidates.join(texts, ["place", "h1"]).selectExpr(
        "place", "h1", "segment", "cell", f"left(line, CAST(CASE cell {start} END AS INT)) AS head",
        f"substring(line, CAST(CASE cell {end} END AS INT) + 1) AS tail")
    variants = " ".join(f"WHEN {j} THEN {_variants(cell)}" for j, cell in ways)
    variants = stage(parts.selectExpr("place", "h1", f"inline(CASE cell {variants} END)"), "line-variants")
    who = F.struct("place", "h1")
    groups = variants.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.min(F.when(F.col("kind") % 8 == d, who)).alias(f"least{d}") for d in range(edits + 1)]).where("n > 1")
    partner = F.lit(None)
    for left in range(edits + 1):  # deletions that are left to the partner
        least = F.col("least0") if not left else F.least(*[F.col(f"least{d}") for d in range(left + 1)])
        partner = F.when(edits - F.floor(F.col("kind") / 8) - F.col("kind") % 8 == left, least).otherwise(partner)
    pairs = (variants.join(groups, "key").select("place", "h1", partner.alias("partner"))
             .where("partner.place < place").selectExpr("place", "h1", "partner.place AS place2", "partner.h1 AS h2").distinct())
    other = texts.selectExpr("place AS place2", "h1 AS h2", "line AS other")
    return (pairs.join(texts, ["place", "h1"]).join(other, ["place2", "h2"])
            .where(f"levenshtein(line, other, {edits}) >= 0").select("place", "h1").distinct())


def kept_lines(docs: DataFrame, near_chars: int = NEAR_CHARS, edits: int = EDITS) -> DataFrame:
    """(doc_id, kept): per document the numbers of its lines with a word that stay."""
    if not 1 <= edits < min(near_chars, 4):
        raise ValueError("edits must be 1, 2 or 3 and smaller than near_chars")
    found = contents(docs, near_chars, edits)
    gone = near_removed(docs, found, edits)
    stay = found.select("place", "h1").join(gone, ["place", "h1"], "left_anti")
    return (stay.selectExpr("CAST(floor(place / 2147483648) AS BIGINT) AS doc_id", "CAST(pmod(place, 2147483648) AS INT) AS line_no")
            .groupBy("doc_id").agg(F.collect_set("line_no").alias("kept")))


def deduplicate(docs: DataFrame, near_chars: int = NEAR_CHARS, edits: int = EDITS, *, counts: bool = False) -> DataFrame:
    """The documents with ``text`` reduced to the lines that stay; every document remains.

    ``counts`` adds n_lines (lines with a word) and n_removed.
    """
    if counts and {"n_lines", "n_removed"} & {c.lower() for c in docs.columns}:
        raise ValueError("n_lines and n_removed are columns already")
    x = "_"  # begins no column of the documents
    while any(c.lower().startswith(x) for c in docs.columns):
        x += "_"
    kept = kept_lines(docs, near_chars, edits).toDF(f"{x}id", f"{x}kept")
    names = ["`" + c.replace("`", "``") + "`" for c in docs.columns]
    joined = docs.join(kept, docs["doc_id"].cast("long") == kept[f"{x}id"], "left").selectExpr(
        *names, f"{x}kept", f"split(text, '\\n') AS {x}l")
    judged = joined.selectExpr(
        *names, f"{x}kept", f"{x}l",
        f"filter(CASE WHEN size({x}l) > 0 THEN sequence(0, size({x}l) - 1) END, i -> NOT get({x}l, i) RLIKE {_WORD}) AS {x}blank")
    stay = judged.selectExpr(
        *names, f"{x}l", f"size({x}l) - size({x}blank) AS {x}n",
        f"CASE WHEN doc_id IS NULL THEN sequence(0, size({x}l) - 1) ELSE sort_array(array_union("
        f"filter(coalesce({x}kept, array()), i -> i < size({x}l)), {x}blank)) END AS {x}stay")
    fresh = f"CASE WHEN text IS NULL THEN NULL ELSE array_join(transform({x}stay, i -> get({x}l, i)), '\\n') END AS text"
    extra = [f"CAST(coalesce({x}n, 0) AS BIGINT) AS n_lines",
             f"CAST(coalesce(size({x}l) - size({x}stay), 0) AS BIGINT) AS n_removed"] if counts else []
    return stay.selectExpr(*[fresh if c == "text" else name for c, name in zip(docs.columns, names)], *extra)


def query(docs: DataFrame) -> DataFrame:
    out = deduplicate(exactly(docs, "doc_id", "text"), counts=True)
    return out.select("doc_id", "n_lines", "n_removed", "text")
