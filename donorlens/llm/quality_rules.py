"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document: the ledger holds the measurements
and one failure bit per rule. A policy is a named, versioned set of rules, so
a policy's verdict is one bitwise AND over the ledger, and ablations ("what
would this policy reject without rule r") are counts over the at most
2^rules distinct failure masks, never another pass over the texts.

Native DataFrame expressions only. One narrow pass over the documents, no
shuffle; a document's work stays in its own row. Only documents that repeat a
3-word window sort their windows, so clean text costs one hash per word.

Defined results: a null text has no words (all measures 0, fails ``few_words``);
a null doc_id is carried through; repeated rows give repeated rows; extra
columns are ignored; an empty table gives an empty ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from donorlens.llm.common import WORD_BREAK, exactly, stage

_BLANK = r"\x20\x09-\x0D"


@dataclass(frozen=True)
class Rule:
    """``fails`` is a SQL condition over the measurement columns; ``bit`` never changes meaning."""

    name: str
    bit: int
    fails: str


# Bits are permanent: a changed threshold is a new rule with a new bit, so old ledgers stay readable.
RULES = [
    Rule("few_words", 0, "n_words < 50"),
    Rule("repeated_windows", 1, "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", 2, "10 * n_symbols > 3 * n_words"),
    Rule("repeated_lines", 3, "n_lines >= 4 AND 2 * n_dup_lines > n_lines"),
    Rule("word_length", 4, "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule("shouting", 5, "2 * n_caps_words > n_words"),
    Rule("exclamations", 6, "3 * n_exclamations > n_words"),
]

# Versioned policies: the names of the rules each enforces.
POLICIES = {
    "base": ["few_words", "repeated_windows"],
    "v1": ["few_words", "repeated_windows", "symbols", "repeated_lines", "word_length"],
    "v2": [r.name for r in RULES],
}
DEFAULT_POLICY = "v2"

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_caps_words", "n_exclamations"]


def policy_mask(policy: str, policies: dict[str, list[str]] | None = None) -> int:
    bits = {r.name: 1 << r.bit for r in RULES}
    return sum(bits[name] for name in (policies or POLICIES)[policy])


def measure(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns plus the measurement columns of ``text``."""
    kept = [f"`{c}`" for c in keep]
    base = exactly(docs, *keep) if "text" in keep else exactly(docs, *keep, "text")
    names = [*kept, "_t", "_w"]
    df = base.selectExpr(*kept, "coalesce(`text`, '') AS _t",
                         f"array_remove(split(coalesce(`text`, ''), r'{WORD_BREAK}'), '') AS _w")
    # One 64-bit hash per 3-word window; a text without an equal pair is done here.
    df = df.selectExpr(*names, "transform(slice(_w, 1, greatest(size(_w) - 2, 0)), "
                               "(x, i) -> xxhash64(x, get(_w, i + 1), get(_w, i + 2))) AS _h")
    df = df.selectExpr(*names, "_h", "size(array_distinct(_h)) < size(_h) AS _rep")
    # Equal windows stand side by side after the sort; their starts, in text order, cover the words.
    df = df.selectExpr(*names, "CASE WHEN _rep THEN sort_array(transform(_h, (x, i) -> struct(x AS h, i AS p))) "
                               "ELSE array() END AS _s")
    df = df.selectExpr(*names, "sort_array(transform(filter(_s, (x, i) -> "
                               "coalesce(x.h = get(_s, i - 1).h, false) OR coalesce(x.h = get(_s, i + 1).h, false)), "
                               "x -> x.p)) AS _p")
    df = df.selectExpr(*names,
                       "aggregate(transform(_p, (p, i) -> least(3, coalesce(get(_p, i + 1) - p, 3))), "
                       "0L, (a, x) -> a + x) AS n_repeat_words",
                       f"filter(split(_t, '\\n'), x -> x RLIKE r'[^{_BLANK}]') AS _l")
    return df.selectExpr(
        *kept,
        "CAST(size(_w) AS BIGINT) AS n_words",
        "CAST(length(array_join(_w, '')) AS BIGINT) AS word_chars",
        "CAST(size(split(_t, '[#*$%&|<>]', -1)) - 1 AS BIGINT) AS n_symbols",
        "CAST(size(_l) - size(array_distinct(_l)) AS BIGINT) AS n_dup_lines",
        "n_repeat_words",
        "CAST(size(_l) AS BIGINT) AS n_lines",
        r"CAST(size(split(_t, r'\p{Lu}{2,}', -1)) - 1 AS BIGINT) AS n_caps_words",
        "CAST(size(split(_t, '!', -1)) - 1 AS BIGINT) AS n_exclamations",
    )


def ledger(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns, the measurements and ``fail_bits`` (every rule evaluated once)."""
    measured = measure(docs, *keep)
    bits = " | ".join(f"CASE WHEN {r.fails} THEN {1 << r.bit}L ELSE 0L END" for r in RULES)
    return measured.selectExpr("*", f"{bits} AS fail_bits")


def apply_policy(book: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """Adds ``kept``: none of the policy's bits is set. Reads the ledger only."""
    return book.withColumn("kept", F.expr(f"(fail_bits & {policy_mask(policy)}L) = 0"))


def ablations(book: DataFrame, policies: dict[str, list[str]] | None = None) -> DataFrame:
    """Per policy and rule: documents failing the rule, rejected by the policy, and rejected by
    that rule alone (what the policy would win back without it).

    The ledger is first reduced to counts per distinct failure mask (at most 2^rules rows).
    """
    masks = book.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    cells = ", ".join(f"struct('{policy}' AS policy, '{r.name}' AS rule, {1 << r.bit}L AS rule_mask, {policy_mask(policy, policies)}L AS policy_mask)"
                      for policy, names in (policies or POLICIES).items() for r in RULES if r.name in names)
    # each of the few masks meets every (policy, rule)
    return (masks.select("fail_bits", "n", F.expr(f"inline(array({cells}))"))
            .groupBy("policy", "rule")
            .agg(F.expr("coalesce(sum(n) FILTER (WHERE (fail_bits & rule_mask) != 0), 0)").alias("failing"),
                 F.expr("coalesce(sum(n) FILTER (WHERE (fail_bits & policy_mask) != 0), 0)").alias("rejected"),
                 F.expr("coalesce(sum(n) FILTER (WHERE (fail_bits & policy_mask) = rule_mask), 0)")
                 .alias("rejected_by_it_alone")))


def filter_documents(docs: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """The documents a policy keeps, with their columns unchanged.

    The ledger is written down first: a filter pushed into its expressions would evaluate each
    rule many times over. The document travels as one struct, so no column name can clash.
    """
    whole = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_doc"), docs["text"])
    book = stage(ledger(whole, "_doc"), "quality-ledger")
    return apply_policy(book, policy).where("kept").select("_doc.*")


def query(docs: DataFrame) -> DataFrame:
    """The registered result: one row per document. The ledger is written down first (a few bytes a document): a
    filter on the result would else be pushed into the rules and evaluate each many times over."""
    out = apply_policy(stage(ledger(docs, "doc_id"), "quality-ledger"))
    base = policy_mask("base")
    return out.selectExpr("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                          f"(fail_bits & {base}L) != 0 AS base_failed", "kept", "fail_bits")
