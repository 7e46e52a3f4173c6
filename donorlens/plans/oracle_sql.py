"""Brute-force SQL for every registered query, for an independent engine (DuckDB).

Written the plain way on purpose: ``count(DISTINCT ...) FILTER``, windows over
raw rows, correlated subqueries, per-party sets joined back with DISTINCT.
It shares no plan with the Spark implementation, only the definitions. The
star-schema tables (region nation customer supplier part orders lineitem) are
the inputs; the contribution tables are CTEs using the FIXTURES.md mapping.
"""

from __future__ import annotations

# --- the four contribution tables from the star schema --------------------

_TABLE_CTES = """
base AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag,
         o_custkey, o_orderdate, c_nationkey, n_name, r_name, p_brand
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
),
base2 AS (SELECT * FROM base UNION ALL SELECT * FROM base WHERE l_partkey % 50 = 0),
contributions AS (
  SELECT
    CASE WHEN o_custkey % 97 = 0 THEN '' ELSE concat('U', lpad(CAST(o_custkey AS VARCHAR), 10, '0')) END
      AS contributor_id,
    CAST(greatest(year(o_orderdate), 1995 + o_custkey % 7)
         + greatest(year(o_orderdate), 1995 + o_custkey % 7) % 2 AS INTEGER) AS cycle,
    CASE WHEN l_linenumber % 3 = 0 AND l_partkey % 22 = 0 THEN concat('X', lpad(CAST(l_partkey AS VARCHAR), 8, '0'))
         WHEN l_linenumber % 3 = 0 AND l_partkey % 11 = 0 THEN concat('CX', lpad(CAST(l_partkey AS VARCHAR), 8, '0'))
         WHEN l_linenumber % 3 = 0 THEN concat('C', lpad(CAST(l_partkey AS VARCHAR), 8, '0'))
         ELSE concat('N', lpad(CAST(l_suppkey AS VARCHAR), 8, '0')) END AS recipient_id,
    CAST(o_orderdate AS DATE) AS "date",
    CAST(CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN -1 ELSE 1 END *
         CASE o_custkey % 4 WHEN 0 THEN floor(l_quantity / 5) WHEN 3 THEN l_quantity * 10 ELSE l_quantity END
         AS INTEGER) AS amount,
    CASE WHEN p_brand = 'Brand#9' THEN 'none' ELSE p_brand END AS real_code,
    concat('C', lpad(CAST(l_partkey AS VARCHAR), 8, '0')) AS committee_id,
    CASE WHEN l_linenumber % 5 = 0 THEN concat('C', lpad(CAST(l_suppkey AS VARCHAR), 8, '0')) ELSE '' END
      AS other_id,
    CASE WHEN l_linenumber = 2 AND o_custkey % 13 = 0 THEN ''
         WHEN o_custkey % 5 IN (0, 2) THEN 'F'
         WHEN o_custkey % 5 IN (1, 3) THEN 'M'
         ELSE 'N' END AS gender,
    n_name AS city,
    r_name AS state,
    lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip
  FROM base2
),
candidates AS (
  SELECT concat('N', lpad(CAST(s_suppkey AS VARCHAR), 8, '0')) AS cid,
         CASE WHEN s_suppkey % 10 = 0 AND cy.cycle >= 2000 THEN 'I'
              ELSE CASE s_nationkey % 4 WHEN 0 THEN 'D' WHEN 1 THEN 'R' WHEN 2 THEN 'L' ELSE '' END END AS party,
         CAST(cy.cycle AS INTEGER) AS cycle
  FROM supplier, (VALUES (1996), (1998), (2000), (2002)) AS cy(cycle)
),
committees AS (
  SELECT concat('C', lpad(CAST(p_partkey AS VARCHAR), 8, '0')) AS committee_id,
         p_name AS pac_short,
         CASE p_size % 4 WHEN 0 THEN 'D' WHEN 1 THEN 'R' WHEN 2 THEN '' ELSE 'I' END AS party
  FROM part
),
industry_codes AS (
  SELECT CAST(row_number() OVER (ORDER BY p_brand) AS INTEGER) AS id,
         p_brand AS category_code,
         substr(p_brand, 1, 7) AS industry_code,
         CASE WHEN length(p_brand) = 7 THEN 'Sector A' ELSE 'Sector B' END AS sector
  FROM (SELECT DISTINCT p_brand FROM part)
)"""

# contributions with the contributor's global first cycle and cycle total
_F = """
f AS (
  SELECT *, min(cycle) OVER (PARTITION BY contributor_id) AS first_cycle,
            sum(amount) OVER (PARTITION BY contributor_id, cycle) AS cycle_total
  FROM contributions
)"""

# spec party attribution: candidates by (id, cycle), committees by id
_ATT = """
cand AS (SELECT cid, cycle, min(party) AS party FROM candidates WHERE cid LIKE 'N%' GROUP BY cid, cycle),
comm AS (SELECT committee_id, min(party) AS party FROM committees WHERE committee_id LIKE 'C%' GROUP BY committee_id),
att AS (
  SELECT f.*, coalesce(cand.party, comm.party) AS party
  FROM f
  LEFT JOIN cand ON f.recipient_id = cand.cid AND f.cycle = cand.cycle
  LEFT JOIN comm ON f.recipient_id = comm.committee_id
)"""

# the original job's per-(cycle, party) sets: parties discovered per cycle
# through prefixed recipients, members of a party regardless of cycle,
# identical contributions counted once
_SETS = """
dist AS (SELECT DISTINCT * FROM contributions),
rc AS (SELECT DISTINCT cycle, recipient_id FROM contributions),
found AS (
  SELECT rc.cycle, k.party, 'candidate' AS src FROM rc JOIN candidates k ON rc.recipient_id = k.cid
  WHERE rc.recipient_id LIKE 'N%'
  UNION ALL
  SELECT rc.cycle, m.party, 'committee' AS src FROM rc JOIN committees m ON rc.recipient_id = m.committee_id
  WHERE rc.recipient_id LIKE 'C%'
),
parties AS (SELECT DISTINCT cycle, party FROM found),
members AS (SELECT cid AS rid, party FROM candidates UNION SELECT committee_id AS rid, party FROM committees),
sets AS (
  SELECT DISTINCT p.party, d.*
  FROM parties p
  JOIN dist d ON d.cycle = p.cycle
  JOIN members m ON m.rid = d.recipient_id AND m.party = p.party
)"""

_SEC = """
sec AS (SELECT category_code, min(sector) AS sector FROM industry_codes GROUP BY category_code)"""

# Segment label and SQL predicate, in report order.
SPEC_SEGMENTS = [
    ("", "TRUE"),
    ("Female", "gender = 'F'"),
    ("Male", "gender = 'M'"),
    ("FirstTime", "cycle = first_cycle"),
    ("Small", "cycle_total < 100"),
    ("Large", "cycle_total > 2000"),
]
AS_CODED_SEGMENTS = [(label, "TRUE" if label == "FirstTime" else cond) for label, cond in SPEC_SEGMENTS]

FIXTURE_PARTY_LABELS = {"D": "D", "R": "R", "I": "I", "L": "L", "": "NONE"}


def stats(segments=SPEC_SEGMENTS) -> str:
    cols = []
    for label, cond in segments:
        cols += [
            f"CAST(coalesce(sum(amount) FILTER (WHERE {cond}), 0) AS BIGINT) AS Total{label}AmountDonated",
            f"CAST(count(DISTINCT contributor_id) FILTER (WHERE {cond}) AS BIGINT) AS Total{label}ContributorSize",
            f"CAST(coalesce(round_even(avg(amount) FILTER (WHERE {cond}), 0), 0) AS BIGINT)"
            f" AS Average{label}AmountDonated",
        ]
    return ",\n  ".join(cols)


def stat_names() -> str:
    return ", ".join(f"{p.format(label)}" for label, _ in SPEC_SEGMENTS
                     for p in ("Total{}AmountDonated", "Total{}ContributorSize", "Average{}AmountDonated"))


def with_(*ctes: str) -> str:
    return "WITH " + ",".join((_TABLE_CTES,) + ctes) + "\n"


def _top(id_expr: str, id_col: str, where: str, k: int = 20) -> str:
    return f"""
raised AS (
  SELECT cycle, {id_expr} AS {id_col}, sum(amount) AS raised FROM contributions
  WHERE {where} GROUP BY 1, 2
),
top AS (
  SELECT cycle, {id_col}, CAST(rn AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY cycle ORDER BY raised DESC NULLS LAST, {id_col} ASC) AS rn
    FROM raised) WHERE rn <= {k}
),
fi AS (SELECT f.*, {id_expr} AS top_key FROM f),
tf AS (
  SELECT fi.*, top.{id_col} AS top_id, top.rank FROM fi
  JOIN top ON fi.top_key = top.{id_col} AND fi.cycle = top.cycle
),
st AS (SELECT cycle, rank, top_id, {stats()} FROM tf GROUP BY cycle, rank, top_id)"""


_PASS_THROUGH = "CASE WHEN other_id <> '' THEN other_id ELSE committee_id END"

_CDIM = """
cdim AS (
  SELECT committee_id, pac_short, party FROM (
    SELECT *, row_number() OVER (PARTITION BY committee_id ORDER BY party, pac_short) AS rn FROM committees)
  WHERE rn = 1
)"""


def _top_committees(id_expr: str) -> str:
    return (with_(_F, _top(id_expr, "committee_id", f"{id_expr} <> ''"), _CDIM) +
            f"SELECT st.cycle, st.rank, st.top_id AS committee_id, cdim.pac_short, cdim.party, {stat_names()}\n"
            "FROM st LEFT JOIN cdim ON st.top_id = cdim.committee_id")


def _pivot() -> str:
    cols = []
    for party, label in FIXTURE_PARTY_LABELS.items():
        cond = f"party = '{party}'"
        cols += [f"CAST(coalesce(sum(amount) FILTER (WHERE {cond}), 0) AS BIGINT) AS {label}_TotalAmountDonated",
                 f"CAST(count(DISTINCT contributor_id) FILTER (WHERE {cond}) AS BIGINT)"
                 f" AS {label}_TotalContributorSize"]
    parties = ", ".join(f"'{p}'" for p in FIXTURE_PARTY_LABELS)
    return (with_(_F, _ATT, _SEC) +
            f"SELECT cycle, sector, {', '.join(cols)}\n"
            f"FROM att JOIN sec ON att.real_code = sec.category_code WHERE party IN ({parties})\n"
            "GROUP BY cycle, sector")


def _kind(c: str = "recipient_id") -> str:
    return f"CASE WHEN {c} LIKE 'N%' THEN 'candidate' WHEN {c} LIKE 'C%' THEN 'committee' ELSE 'other' END"


ORACLE_SQL: dict[str, str] = {
    "distinct_cycles": with_() + "SELECT DISTINCT cycle FROM contributions",
    "recipient_kinds": with_() + f"""SELECT {_kind()} AS recipient_kind,
  CAST(count(*) AS BIGINT) AS contributions,
  CAST(count(DISTINCT recipient_id) AS BIGINT) AS recipients,
  CAST(coalesce(sum(amount), 0) AS BIGINT) AS amount
FROM contributions GROUP BY 1""",
    "parties_per_cycle": with_(_SETS) + """SELECT cycle, party,
  max(CASE WHEN src = 'candidate' THEN 1 ELSE 0 END) AS by_candidate,
  max(CASE WHEN src = 'committee' THEN 1 ELSE 0 END) AS by_committee
FROM found GROUP BY cycle, party""",
    "contributions_by_party": with_(_SETS) + """SELECT cycle, party,
  CAST(count(*) AS BIGINT) AS contributions, CAST(coalesce(sum(amount), 0) AS BIGINT) AS amount
FROM sets GROUP BY cycle, party""",
    "gender_contributions": with_() + """SELECT cycle, gender,
  CAST(count(*) AS BIGINT) AS contributions,
  CAST(count(DISTINCT contributor_id) AS BIGINT) AS contributors,
  CAST(coalesce(sum(amount), 0) AS BIGINT) AS amount
FROM contributions GROUP BY cycle, gender""",
    "contributor_first_cycle": with_() +
        "SELECT contributor_id, min(cycle) AS first_cycle FROM contributions GROUP BY contributor_id",
    "first_time_contributions": with_() + """SELECT c.* FROM contributions c
WHERE c.cycle = (SELECT min(c2.cycle) FROM contributions c2 WHERE c2.contributor_id = c.contributor_id)""",
    "contributor_cycle_totals": with_() + """SELECT contributor_id, cycle, CAST(sum(amount) AS BIGINT) AS total_amount
FROM contributions GROUP BY contributor_id, cycle""",
    "small_contributions": with_() + """SELECT c.* FROM contributions c
WHERE (SELECT sum(c2.amount) FROM contributions c2
       WHERE c2.contributor_id = c.contributor_id AND c2.cycle = c.cycle) < 100""",
    "large_contributions": with_() + """SELECT c.* FROM contributions c
WHERE (SELECT sum(c2.amount) FROM contributions c2
       WHERE c2.contributor_id = c.contributor_id AND c2.cycle = c.cycle) > 2000""",
    "measures_overall": with_() + """SELECT CAST(coalesce(sum(amount), 0) AS BIGINT) AS TotalAmountDonated,
  CAST(count(DISTINCT contributor_id) AS BIGINT) AS TotalContributorSize,
  CAST(coalesce(round_even(avg(amount), 0), 0) AS BIGINT) AS AverageAmountDonated
FROM contributions""",
    "duplicate_contributions": with_() + """SELECT cycle, CAST(count(*) AS BIGINT) AS duplicated_rows,
  CAST(sum(n - 1) AS BIGINT) AS extra_copies
FROM (SELECT contributor_id, cycle, recipient_id, "date", amount, real_code, committee_id, other_id,
             gender, city, state, zip, count(*) AS n
      FROM contributions
      GROUP BY contributor_id, cycle, recipient_id, "date", amount, real_code, committee_id, other_id,
               gender, city, state, zip)
WHERE n > 1 GROUP BY cycle""",
    "report_by_cycle": with_(_F) + f"SELECT cycle,\n  {stats()}\nFROM f GROUP BY cycle",
    "report_by_cycle_as_coded": with_(_F) + f"SELECT cycle,\n  {stats(AS_CODED_SEGMENTS)}\nFROM f GROUP BY cycle",
    "report_by_cycle_by_party": with_(_F, _ATT) +
        f"SELECT cycle, party,\n  {stats()}\nFROM att WHERE party IS NOT NULL GROUP BY cycle, party",
    "report_by_cycle_by_party_as_coded": with_(_SETS, """
s2 AS (SELECT *, sum(amount) OVER (PARTITION BY cycle, party, contributor_id) AS cycle_total FROM sets)""") +
        f"SELECT cycle, party,\n  {stats(AS_CODED_SEGMENTS)}\nFROM s2 GROUP BY cycle, party",
    "report_top_candidates": with_(_F, _top("recipient_id", "cid", "recipient_id LIKE 'N%'"), """
cp AS (SELECT cid, cycle, min(party) AS party FROM candidates GROUP BY cid, cycle)""") +
        f"SELECT st.cycle, st.rank, st.top_id AS cid, cp.party, {stat_names()}\n"
        "FROM st LEFT JOIN cp ON st.top_id = cp.cid AND st.cycle = cp.cycle",
    "report_top_committees": _top_committees("committee_id"),
    "report_top_committees_pass_through": _top_committees(_PASS_THROUGH),
    "report_by_sector": with_(_F, _SEC) + f"""SELECT cycle, sector,
  {stats()}
FROM f JOIN sec ON f.real_code = sec.category_code GROUP BY cycle, sector""",
    "report_by_sector_keep_unmatched": with_(_F, _SEC) + f"""SELECT cycle, coalesce(sec.sector, '') AS sector,
  {stats()}
FROM f LEFT JOIN sec ON f.real_code = sec.category_code GROUP BY cycle, coalesce(sec.sector, '')""",
    "report_by_sector_by_party": with_(_F, _ATT, _SEC) + f"""SELECT cycle, sector, party,
  {stats()}
FROM att JOIN sec ON att.real_code = sec.category_code WHERE party IS NOT NULL
GROUP BY cycle, sector, party""",
    "report_by_sector_pivot": _pivot(),
    "unmatched_recipients": with_(_F, _ATT) + f"""SELECT cycle, recipient_id, {_kind()} AS recipient_kind,
  CAST(count(*) AS BIGINT) AS contributions, CAST(coalesce(sum(amount), 0) AS BIGINT) AS amount
FROM att WHERE party IS NULL GROUP BY cycle, recipient_id""",
    "key_violations": with_() + " UNION ALL ".join(
        f"SELECT '{name}' AS report, CAST(count(*) AS BIGINT) AS violations\n"
        f"FROM (SELECT 1 FROM {table} GROUP BY {keys} HAVING count(*) > 1)"
        for name, table, keys in [
            ("candidates", "candidates", "cid"), ("candidates per cycle", "candidates", "cid, cycle"),
            ("committees", "committees", "committee_id"), ("industry_codes", "industry_codes", "category_code"),
            ("contributions", "contributions", "contributor_id, \"date\", recipient_id")]),
    "dimension_conflicts": with_() + """
SELECT 'candidates' AS table_name, CAST(count(*) FILTER (WHERE v > 1) AS BIGINT) AS conflicting_keys
FROM (SELECT cid, cycle, count(DISTINCT party) AS v FROM candidates GROUP BY cid, cycle)
UNION ALL
SELECT 'committees', CAST(count(*) FILTER (WHERE v > 1) AS BIGINT)
FROM (SELECT committee_id, count(DISTINCT (party, pac_short)) AS v FROM committees GROUP BY committee_id)
UNION ALL
SELECT 'industry_codes', CAST(count(*) FILTER (WHERE v > 1) AS BIGINT)
FROM (SELECT category_code, count(DISTINCT sector) AS v FROM industry_codes GROUP BY category_code)""",
    "load_profile": with_() + """
SELECT 'candidates' AS table_name, CAST(count(*) AS BIGINT) AS rows FROM candidates
UNION ALL SELECT 'committees', CAST(count(*) AS BIGINT) FROM committees
UNION ALL SELECT 'industry_codes', CAST(count(*) AS BIGINT) FROM industry_codes
UNION ALL SELECT 'individual_contributions', CAST(count(*) AS BIGINT) FROM contributions""",
    "lenient_dates": with_() + """SELECT cycle,
  CAST(count(*) FILTER (WHERE abs(amount) % 3 <> 2) AS BIGINT) AS parsed,
  CAST(count(*) FILTER (WHERE abs(amount) % 3 = 2) AS BIGINT) AS failed,
  CAST(0 AS BIGINT) AS mismatched
FROM contributions GROUP BY cycle""",
}

# the CSV round trip must reproduce the rows, odd cities included
ORACLE_SQL["csv_roundtrip"] = with_() + """SELECT cycle,
  CASE abs(amount) % 4 WHEN 0 THEN concat('New', chr(10), city) WHEN 1 THEN concat(' ', city, ' ')
    WHEN 2 THEN concat('"', city, '", x') ELSE city END AS city,
  state, zip, gender, CAST(count(*) AS BIGINT) AS contributions, CAST(sum(amount) AS BIGINT) AS amount,
  min("date") AS first_date, max(recipient_id) AS last_recipient
FROM contributions GROUP BY ALL"""

# -- folded, stored and multi-level reports: the same definitions, computed the plain way

ORACLE_SQL["report_by_cycle_by_party_folded"] = ORACLE_SQL["report_by_cycle_by_party"]
ORACLE_SQL["report_by_sector_by_party_folded"] = ORACLE_SQL["report_by_sector_by_party"]
ORACLE_SQL["report_by_cycle_bucketed"] = ORACLE_SQL["report_by_cycle"]

ORACLE_SQL["report_sector_totals_and_parties"] = with_(_F, _ATT, _SEC) + f"""
SELECT 'sector' AS breakdown, cycle, sector, NULL AS party, {stats()}
FROM att JOIN sec ON att.real_code = sec.category_code GROUP BY cycle, sector
UNION ALL
SELECT 'party', cycle, sector, party, {stats()}
FROM att JOIN sec ON att.real_code = sec.category_code WHERE party IS NOT NULL GROUP BY cycle, sector, party"""


def _measures(label: str, cond: str) -> str:
    return (f"CAST(coalesce(sum(amount) FILTER (WHERE {cond}), 0) AS BIGINT) AS Total{label}AmountDonated, "
            f"CAST(coalesce(max(amount) FILTER (WHERE {cond}), 0) AS BIGINT) AS Largest{label}AmountDonated, "
            f"CAST(coalesce(sum(CAST(amount AS HUGEINT) * amount) FILTER (WHERE {cond}), 0) AS BIGINT) AS Squared{label}AmountDonated")


ORACLE_SQL["report_custom_measures"] = with_(_F, _ATT) + f"""SELECT cycle, party, {_measures("", "TRUE")},
  {_measures("Refund", "amount < 0")}, {_measures("Repeat", "cycle > first_cycle")}
FROM att WHERE party IS NOT NULL GROUP BY cycle, party"""


def _all_reports() -> str:
    def part(name, keys, where="TRUE", source="att LEFT JOIN sec ON att.real_code = sec.category_code"):
        shown = [c if c in keys else f"CAST(NULL AS VARCHAR) AS {c}" for c in ("party", "sector")]
        return (f"SELECT '{name}' AS report, cycle, CAST(NULL AS INTEGER) AS rank, {', '.join(shown)}, "
                f"CAST(NULL AS VARCHAR) AS recipient, {stats()} FROM {source} WHERE {where} GROUP BY {', '.join(keys)}")

    def top(name, report, id_col):
        return (f"SELECT '{name}', cycle, rank, party, NULL, {id_col}, {stat_names()} FROM ({ORACLE_SQL[report]})")

    return with_(_F, _ATT, _SEC) + " UNION ALL ".join([
        part("by_cycle", ["cycle"]),
        part("by_cycle_by_party", ["cycle", "party"], "party IS NOT NULL"),
        top("top_candidates_by_cycle", "report_top_candidates", "cid"),
        top("top_committees_by_cycle", "report_top_committees", "committee_id"),
        part("by_sector_by_cycle", ["cycle", "sector"], "sector IS NOT NULL"),
        part("by_sector_by_party_by_cycle", ["cycle", "sector", "party"], "sector IS NOT NULL AND party IS NOT NULL"),
    ])


ORACLE_SQL["all_reports"] = _all_reports()

_PARTY_STATS = f"SELECT cycle, party,\n  {stats()}\nFROM {{}} WHERE party IS NOT NULL AND {{}} GROUP BY cycle, party"

# the latest cycle comes from the larger gifts alone: totals and first cycles, too
ORACLE_SQL["keyed_replace"] = with_(_F, _ATT, """
g AS (SELECT *, min(cycle) OVER (PARTITION BY contributor_id) AS first_cycle,
             sum(amount) OVER (PARTITION BY contributor_id, cycle) AS cycle_total FROM contributions WHERE amount >= 10),
large AS (
  SELECT g.*, coalesce(cand.party, comm.party) AS party FROM g
  LEFT JOIN cand ON g.recipient_id = cand.cid AND g.cycle = cand.cycle
  LEFT JOIN comm ON g.recipient_id = comm.committee_id
),
latest AS (SELECT max(cycle) AS c FROM contributions)""") + (
    _PARTY_STATS.format("att, latest", "cycle < c") + "\nUNION ALL\n" + _PARTY_STATS.format("large, latest", "cycle = c"))

ORACLE_SQL["snapshot_refresh"] = with_() + """
SELECT 'extracted' AS step, false AS reused, false AS refused, CAST(count(*) AS BIGINT) AS rows,
       CAST(coalesce(sum(amount), 0) AS BIGINT) AS amount FROM contributions
UNION ALL SELECT 'read again', true, false, CAST(count(*) AS BIGINT), CAST(coalesce(sum(amount), 0) AS BIGINT) FROM contributions
UNION ALL SELECT 'source changed', false, true, CAST(count(*) + count(*) FILTER (WHERE amount < 0) AS BIGINT),
       CAST(coalesce(sum(amount), 0) + coalesce(sum(amount) FILTER (WHERE amount < 0), 0) AS BIGINT) FROM contributions"""

ORACLE_SQL["load_rejects"] = with_() + " UNION ALL ".join([
    *(f"SELECT '{table}' AS table_name, '{metric}' AS metric, CAST({value} AS BIGINT) AS value FROM {table}"
      for table, metrics in [
          ("candidates", {"rows": "count(*)", "cycle_rejects": "0 * count(*)", "record_rejects": "0 * count(*)"}),
          ("committees", {"rows": "count(*)", "record_rejects": "0 * count(*)"}),
          ("industry_codes", {"rows": "count(*)", "id_rejects": "0 * count(*)", "record_rejects": "0 * count(*)"})]
      for metric, value in metrics.items()),
    *(f"SELECT 'individual_contributions', '{metric}', CAST({value} AS BIGINT) FROM contributions" for metric, value in [
        ("rows", "count(*)"), ("cycle_rejects", "0 * count(*)"), ("date_rejects", "count(*) FILTER (WHERE abs(amount) % 3 = 0)"),
        ("amount_rejects", "count(*) FILTER (WHERE abs(amount) % 5 = 0)"),
        ("record_rejects", "count(*) FILTER (WHERE abs(amount) % 7 = 0)")])])
