"""DuckDB SQL for the queries whose result SQL can express."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op10_quality_rules"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), g AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), r AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS n FROM g) WHERE n > 1
), cov AS (
  SELECT doc_id, count(DISTINCT p) AS c FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY 1
), l AS (
  SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d
), m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(l) AS BIGINT) AS n_lines,
         CAST(len(regexp_extract_all(t, '\p{Lu}{2,}')) AS BIGINT) AS n_caps_words,
         CAST(len(regexp_extract_all(t, '!')) AS BIGINT) AS n_exclamations
  FROM d JOIN l USING (doc_id) LEFT JOIN cov USING (doc_id)
), b AS (
  SELECT *, CAST(
      CASE WHEN n_words < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END
    + CASE WHEN n_lines >= 4 AND 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 16 ELSE 0 END
    + CASE WHEN 2 * n_caps_words > n_words THEN 32 ELSE 0 END
    + CASE WHEN 3 * n_exclamations > n_words THEN 64 ELSE 0 END AS BIGINT) AS fail_bits
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits
FROM b
"""

# Rule names by bit, and the rules of each policy.
_RULES = ["few_words", "repeated_windows", "symbols", "repeated_lines", "word_length", "shouting", "exclamations"]
_POLICIES = {"base": 2, "v1": 5, "v2": 7}  # the first so many rules

ORACLE_SQL["quality_ablations"] = " UNION ALL ".join(
    f"SELECT '{policy}' AS policy, '{_RULES[bit]}' AS rule, count(*) FILTER (WHERE fail_bits & {1 << bit} <> 0) AS failing, "
    f"count(*) FILTER (WHERE fail_bits & {(1 << n) - 1} <> 0) AS rejected, "
    f"count(*) FILTER (WHERE fail_bits & {(1 << n) - 1} = {1 << bit}) AS rejected_by_it_alone "
    f"FROM ({ORACLE_SQL['op10_quality_rules']})" for policy, n in _POLICIES.items() for bit in range(n))


def _merkle(depth: int = 13) -> str:
    """Levels and climbs written out one by one: right for up to 3 ** depth rows a source, and sources."""

    def enc(x):
        return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR) END"

    def leaf(text):
        return "sha256(" + " || ".join(enc(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def tree(t, leaves, start):
        """Levels t0.. of the trees in ``leaves`` (src, pos, digest), climbs t_c0.. of ``start`` (leaf, src, pos, folded, sib)."""
        parts = [f"{t}0 AS MATERIALIZED (SELECT src, pos, digest FROM {leaves})", f"{t}_c0 AS MATERIALIZED (SELECT * FROM {start})"]
        for i in range(depth):
            parts += [
                f"{t}_r{i} AS MATERIALIZED (SELECT src, pos // 3 AS b, list(digest ORDER BY pos) AS run, any_value(n) AS n "
                f"FROM (SELECT *, count(*) OVER (PARTITION BY src) AS n FROM {t}{i}) GROUP BY ALL)",
                f"{t}{i + 1} AS MATERIALIZED (SELECT src, b AS pos, CASE WHEN n = 1 THEN run[1] "
                f"ELSE sha256(array_to_string(run, '')) END AS digest FROM {t}_r{i})",
                f"{t}_c{i + 1} AS MATERIALIZED (SELECT leaf, src, b AS pos, CASE WHEN n = 1 THEN folded "
                "ELSE sha256(array_to_string(run[1:pos % 3], '') || folded || array_to_string(run[pos % 3 + 2:], '')) END AS folded, "
                "sib || array_to_string(run[1:pos % 3], '') || array_to_string(run[pos % 3 + 2:], '') AS sib "
                f"FROM {t}_c{i} JOIN {t}_r{i} USING (src) WHERE b = pos // 3)"]
        return ",\n".join(parts)

    return f"""
WITH tab AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
      CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) AS r(i))
), d AS (
  SELECT *, coalesce(xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
      lambda ch: CAST(ascii(ch) AS BIGINT))), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) & 1 = 0, false)
      AS tampered, row_number() OVER () AS leaf
  FROM documents, tab
), h AS MATERIALIZED (
  SELECT leaf, doc_id, coalesce('s' || source, 'n') AS src, {leaf("text")} AS digest,
         CASE WHEN tampered THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS changed FROM d
), l AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos FROM h
), l0 AS (SELECT leaf, src, pos, changed AS folded, '' AS sib FROM l),
{tree("s", "l", "l0")},
top AS MATERIALIZED (SELECT 0 AS src, row_number() OVER (ORDER BY encode(src)) - 1 AS pos, digest, src AS name FROM s{depth}),
top0 AS (SELECT leaf, 0 AS src, top.pos, folded, sib FROM s_c{depth} c JOIN top ON c.src = top.name),
{tree("r", "top", "top0")}
SELECT doc_id, l.digest AS leaf, top.digest AS subroot, r{depth}.digest AS root, sha256(sib) AS proof_sha256,
       folded AS folded_root, folded = r{depth}.digest AS verified
FROM l JOIN r_c{depth} c ON l.leaf = c.leaf JOIN top ON l.src = top.name, r{depth}
"""


ORACLE_SQL["op12_merkle_manifest"] = _merkle()


def _collocations(least: int = 100, longest: int = 5, top: int = 2000) -> str:
    """All phrases of up to five words counted outright."""
    grams = " UNION ALL ".join(
        f"SELECT lang, array_to_string(w[i:i + {k - 1}], ' ') AS phrase, {k} AS k "
        f"FROM (SELECT lang, w, unnest(range(1, len(w) - {k - 2})) AS i FROM p)" for k in range(1, longest + 1))
    return rf"""
WITH p AS MATERIALIZED (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)
), f AS MATERIALIZED (
  SELECT lang, phrase, k, count(*) AS f FROM ({grams}) GROUP BY ALL HAVING count(*) >= {least}
), n AS (SELECT lang, sum(len(w)) AS n FROM p GROUP BY 1),
c AS MATERIALIZED (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
inside AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, array_to_string(w[i:i + j - 1], ' ') AS phrase
    FROM (SELECT *, unnest(range(2, k)) AS j FROM c), LATERAL (SELECT unnest(range(1, k - j + 2)) AS i)) GROUP BY ALL
), cuts AS (
  SELECT lang, phrase, a, i, array_to_string(w[1:i], ' ') AS head, array_to_string(w[i + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS i FROM c)
), s AS (
  SELECT cuts.lang, cuts.phrase, a, i, l.f AS l, r.f AS r, n,
         (CAST(1000 AS HUGEINT) * a * n) // (CAST(l.f AS HUGEINT) * r.f) AS score
  FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = head JOIN f r ON r.lang = cuts.lang AND r.phrase = tail
  JOIN n ON n.lang = cuts.lang
), best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) AS first FROM s) WHERE first = 1
), ranked AS (
  SELECT best.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
  FROM best LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= {top}
"""


ORACLE_SQL["op13_collocations"] = _collocations()


# All pairs outright; components by reachability.
ORACLE_SQL["op11_embedding_near_dedup"] = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), link AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    AND list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY 1),
n AS (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY 1)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)
"""


# Line deduplication: contents of equal or neighbouring length are compared one by one. ``levenshtein``
# counts bytes here, a character has at most four; the exact test is on characters.
ORACLE_SQL["op5_line_dedup"] = r"""
WITH numbered AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
lines AS (
  SELECT rid, doc_id, line_no, line, regexp_matches(line, '[^\x20\x09-\x0D]') AS worded,
         doc_id::HUGEINT * 2147483648 + line_no AS place
  FROM (SELECT rid, doc_id, unnest(string_split(text, chr(10))) AS line,
               unnest(range(len(string_split(text, chr(10))))) AS line_no
        FROM numbered WHERE text IS NOT NULL)),
contents AS (
  SELECT line, length(line) AS n, min(place) AS place FROM lines
  WHERE worded AND doc_id IS NOT NULL GROUP BY line),
pairs AS (
  SELECT a.place AS a_place, b.place AS b_place, a.line AS shorter, b.line AS longer, b.n - a.n AS more
  FROM (SELECT *, unnest([n, n + 1]) AS other FROM contents WHERE n >= 20) a
  JOIN contents b ON b.n = a.other AND (b.n > a.n OR a.place < b.place)
  WHERE a.place <> b.place AND levenshtein(a.line, b.line) <= 4),
near AS (
  SELECT DISTINCT greatest(a_place, b_place) AS place, CASE WHEN a_place > b_place THEN shorter ELSE longer END AS line
  FROM pairs
  WHERE CASE WHEN more = 0
    THEN list_sum(list_transform(range(1, length(shorter) + 1), lambda i: (shorter[i] <> longer[i])::INT)) <= 1
    ELSE list_contains(list_transform(range(1, length(longer) + 1),
                                      lambda i: substr(longer, 1, i - 1) || substr(longer, i + 1)), shorter) END),
kept AS (SELECT DISTINCT place FROM (SELECT place, line FROM contents EXCEPT SELECT place, line FROM near)),
judged AS (
  SELECT rid, line_no, line, worded, (NOT worded OR doc_id IS NULL OR place IN (SELECT place FROM kept)) AS stays FROM lines)
SELECT d.doc_id, count(*) FILTER (WHERE worded) AS n_lines,
       count(*) FILTER (WHERE NOT stays) AS n_removed,
       CASE WHEN any_value(d.text) IS NOT NULL
            THEN coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE stays), '') END AS text
FROM numbered d LEFT JOIN judged j ON d.rid = j.rid
GROUP BY d.rid, d.doc_id
"""


# Suffix deduplication: every 50-byte string by its hex digits; texts are read in chunks of 1,000 bytes.
ORACLE_SQL["op2_suffix_dedup"] = """
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), chunk AS (
  SELECT rid, doc_id, c, substr(x, 2000 * c + 1, 2098) AS y
  FROM (SELECT *, unnest(range((length(x) + 1999) // 2000)) AS c FROM d)
), win AS MATERIALIZED (
  SELECT rid, doc_id, 1000 * c + i AS p, substr(y, 2 * i + 1, 100) AS g
  FROM (SELECT *, unnest(range(least(1000, length(y) // 2 - 49))) AS i FROM chunk WHERE length(y) >= 100)
), shared AS (
  SELECT g, min(doc_id) AS least_id FROM win GROUP BY g HAVING min(doc_id) < max(doc_id)
), hit AS (
  SELECT rid, p, CASE WHEN p <= lag(p) OVER (PARTITION BY rid ORDER BY p) + 50 THEN 0 ELSE 1 END AS opens
  FROM win JOIN shared USING (g) WHERE least_id < doc_id
), run AS (
  SELECT rid, min(p) AS a, max(p) + 50 AS z
  FROM (SELECT rid, p, sum(opens) OVER (PARTITION BY rid ORDER BY p) AS run FROM hit) GROUP BY rid, run
), gap AS (
  SELECT rid, a, z, coalesce(lag(z) OVER (PARTITION BY rid ORDER BY a), 0) AS last_z FROM run
), cut AS (
  SELECT rid, sum(z - a) AS n_removed, count(*) AS n_spans, max(z) AS z,
         string_agg(substr(x, 2 * last_z + 1, 2 * (a - last_z)), '' ORDER BY a) AS head
  FROM gap JOIN d USING (rid) GROUP BY rid
)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(z, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut USING (rid)
"""
