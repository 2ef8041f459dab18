"""DuckDB oracle SQL for the registered queries.

The binding expressions of ``cohortlens.sources.tables`` are written here a
second time, as plain SQL over the pre-registered parquet views, together
with an independent SQL formulation of each operator.  ``sql(deps, body)``
prepends the named CTEs (and their dependencies) to a query body.
"""

from __future__ import annotations

# Normalised-name and token helpers (DuckDB dialect).
def norm(x: str) -> str:
    return (f"regexp_replace(regexp_replace(lower(replace({x}, '_', ' ')), "
            f"'^\\s+|\\s+$', '', 'g'), '\\s+', ' ', 'g')")


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def first_tok(x: str) -> str:
    return f"regexp_split_to_array({strip(x)}, '\\s+')[1]"


LABEL = ("CASE o_orderstatus WHEN 'F' THEN 'healthy' WHEN 'O' THEN 'cancer' "
         "ELSE 'pending' END")
AGE = ("CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'young' "
       "WHEN substr(o_orderpriority, 1, 1) IN ('4', '5') THEN 'old' ELSE 'unknown' END")
EXCLUDED = "('hot', 'hot gear')"
PANEL_CFG = ["small ring", "hot gear", "blue bolt", "red", "cold_widget", "Large  Anvil", "new"]
PANEL_CFG_KEPT = [t for t in PANEL_CFG if t not in ("hot gear",)]


def _values(rows) -> str:
    return ", ".join(rows)


CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "md": ((), f"""
SELECT 'R' || o_orderkey AS run_accession, 'S' || o_custkey AS sample_id,
       {LABEL} AS label, {AGE} AS age_group, o_orderpriority AS library_name,
       o_orderkey AS ordinal
FROM orders"""),
    "dirty": ((), f"""
SELECT 'R' || o_orderkey AS run_accession, 'S' || o_custkey AS sample_id, {LABEL} AS label,
       {AGE} AS age_group, o_orderpriority AS library_name,
       o_orderkey * 8 + CASE WHEN o_orderkey % 2 = 0 THEN 3 ELSE 2 END AS ordinal FROM orders
UNION ALL
SELECT '  R' || o_orderkey || ' ', ' S' || (o_custkey + 1), upper({LABEL}) || '  ',
       ' ' || upper({AGE}), o_orderpriority,
       o_orderkey * 8 + CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 3 END FROM orders
UNION ALL
SELECT 'R' || o_orderkey, 'S' || (o_custkey + 2), NULL, {AGE}, o_orderpriority,
       o_orderkey * 8 + CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 5 END FROM orders
UNION ALL
SELECT '   ', 'S' || o_custkey, {LABEL}, {AGE}, o_orderpriority, o_orderkey * 8 + 1 FROM orders"""),
    "md_clean": (("dirty",), f"""
SELECT run_accession, sample_id, label, age_group, library_name, ordinal FROM (
  SELECT {strip('run_accession')} AS run_accession, {strip('sample_id')} AS sample_id,
         lower({strip('label')}) AS label, lower({strip('age_group')}) AS age_group,
         library_name, ordinal
  FROM dirty) c
WHERE run_accession IS NOT NULL AND sample_id IS NOT NULL AND label IS NOT NULL
  AND age_group IS NOT NULL AND run_accession <> ''
QUALIFY row_number() OVER (PARTITION BY run_accession ORDER BY ordinal) = 1"""),
    "lines": ((), """
SELECT o_orderkey, o_custkey, p_partkey, p_name, p_type, l_quantity
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey"""),
    "sp": (("lines",), """
SELECT 'R' || o_orderkey AS run_accession, 'S' || o_custkey AS sample_id, taxon AS name,
       q / sum(q) OVER (PARTITION BY o_orderkey) AS fraction_total_reads, taxid, q
FROM (SELECT o_orderkey, o_custkey, p_name AS taxon, sum(l_quantity) AS q,
             min(p_partkey) AS taxid FROM lines GROUP BY ALL) t"""),
    "gn": (("lines",), """
SELECT 'R' || o_orderkey AS run_accession, 'S' || o_custkey AS sample_id, taxon AS name,
       q / sum(q) OVER (PARTITION BY o_orderkey) AS fraction_total_reads
FROM (SELECT o_orderkey, o_custkey, split_part(p_name, ' ', 1) AS taxon, sum(l_quantity) AS q
      FROM lines WHERE o_orderkey % 5 <> 0 GROUP BY ALL) t"""),
    "long_all": (("sp", "gn"), """
SELECT run_accession, sample_id, 'species' AS level, name AS taxon,
       fraction_total_reads AS relative_abundance FROM sp
UNION ALL
SELECT run_accession, sample_id, 'genus', name, fraction_total_reads FROM gn"""),
    "long": (("long_all",), f"""
SELECT * FROM long_all WHERE {norm('taxon')} NOT IN {EXCLUDED}"""),
    "reports": (("lines",), """
SELECT 'R' || o_orderkey AS run_accession, 100.0 * q / sum(q) OVER (PARTITION BY o_orderkey, rank_code) AS percentage,
       CAST(sum(q) OVER (PARTITION BY o_orderkey, rank_code) AS BIGINT) AS clade_reads,
       CAST(q AS BIGINT) AS taxon_reads, rank_code, taxid, indent || taxon AS name
FROM (
  SELECT o_orderkey, 'D' AS rank_code, '' AS indent, p_type AS taxon, sum(l_quantity) AS q, min(p_partkey) AS taxid
  FROM lines GROUP BY ALL
  UNION ALL
  SELECT o_orderkey, 'G', '    ', split_part(p_name, ' ', 1), sum(l_quantity), min(p_partkey)
  FROM lines GROUP BY ALL
  UNION ALL
  SELECT o_orderkey, 'S', '      ', p_name, sum(l_quantity), min(p_partkey)
  FROM lines GROUP BY ALL) t"""),
    "last_event": ((), """
SELECT user_id, ts, event_id, event_type, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""),
    "qc_docs": (("last_event",), """
SELECT 'R' || user_id AS run_accession,
  CASE WHEN event_type = 'signup' THEN '{}'
       WHEN event_type = 'error' THEN '{"summary": {"before' || json_extract_string(props, '$.k')
       WHEN event_type = 'view' THEN '{"summary": {"before_filtering": {"total_reads": '
            || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) * 10 AS VARCHAR) || '}}}'
       ELSE '{"summary": {"before_filtering": {"total_reads": '
            || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) * 10 AS VARCHAR)
            || '}, "after_filtering": {"total_reads": ' || json_extract_string(props, '$.k') || '}}}'
  END AS json
FROM last_event"""),
    "qc_parsed": (("qc_docs",), """
SELECT run_accession,
  CASE WHEN json_valid(json) THEN TRY_CAST(json_extract_string(json, '$.summary.before_filtering.total_reads') AS BIGINT) END AS total_reads_before,
  CASE WHEN json_valid(json) THEN TRY_CAST(json_extract_string(json, '$.summary.after_filtering.total_reads') AS BIGINT) END AS total_reads_after
FROM qc_docs"""),
    "stage_log": ((), """
SELECT CASE WHEN event_type = 'view' THEN 'download'
            WHEN event_type IN ('click', 'signup') THEN 'subsample' ELSE 'qc' END AS stage,
       'R' || user_id AS run_accession,
       CASE event_type WHEN 'view' THEN 'downloaded' WHEN 'click' THEN 'subsampled'
            WHEN 'purchase' THEN 'qc_done' WHEN 'signup' THEN 'skipped_existing'
            ELSE 'failed: code ' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) AS VARCHAR) END AS status,
       ts, event_id,
       CASE WHEN event_type = 'click' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) * 10 END AS original_reads,
       CASE WHEN event_type = 'click' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS subsampled_reads,
       CASE WHEN event_type = 'purchase' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) * 10 END AS total_reads_before,
       CASE WHEN event_type = 'purchase' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS total_reads_after
FROM events"""),
    "listing": ((), """
SELECT file_name FROM (
  SELECT 'R' || o_orderkey || '_1.fastq' AS file_name FROM orders WHERE o_orderkey % 4 = 0 AND o_orderkey % 11 <> 0
  UNION ALL SELECT 'R' || o_orderkey || '_2.fastq' FROM orders WHERE o_orderkey % 4 = 0 AND o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0
  UNION ALL SELECT 'R' || o_orderkey || '.fastq' FROM orders WHERE o_orderkey % 4 = 1 AND o_orderkey % 11 <> 0
  UNION ALL SELECT 'R' || o_orderkey || '_1.fastq.gz' FROM orders WHERE o_orderkey % 4 = 2 AND o_orderkey % 11 <> 0
  UNION ALL SELECT 'R' || o_orderkey || '_2.fastq.gz' FROM orders WHERE o_orderkey % 4 = 2 AND o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0
  UNION ALL SELECT 'R' || o_orderkey || '.fastq.gz' FROM orders WHERE (o_orderkey % 4 = 3 OR o_orderkey % 3 = 0) AND o_orderkey % 11 <> 0
) t"""),
    "reads": ((), """
SELECT run_accession, mate, rec_id,
       '@' || rec_id || '/' || mate AS header,
       translate(h, '0123456789ABCDEF', 'ACGTACGTACGTACGT') AS seq, '+' AS plus,
       translate(h, '0123456789ABCDEF', 'IIIIHHHH@@@@####') AS qual
FROM (
  SELECT 'R' || user_id AS run_accession, CAST(m.mate AS INTEGER) AS mate, event_id AS rec_id,
         upper(substr(sha1(event_id || ':' || m.mate), 1, 16)) AS h
  FROM events, (VALUES (1), (2)) m(mate)
  WHERE m.mate = 1 OR event_type <> 'error') t"""),
    "scores": ((), """
SELECT event_id AS id, event_type AS grp,
       CASE WHEN event_type IN ('purchase', 'click') THEN 1 ELSE 0 END AS y,
       value / (value + 50.0) AS score
FROM events"""),
}


def sql(deps, body: str) -> str:
    """Prefix ``body`` with the CTEs in ``deps`` (dependencies first)."""
    order: list[str] = []

    def visit(name):
        if name in order:
            return
        for d in CTES[name][0]:
            visit(d)
        order.append(name)

    for d in deps:
        visit(d)
    if not order:
        return body.strip()
    parts = [f"{n} AS ({CTES[n][1].strip()})" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


def add_cte(name: str, deps, text: str) -> None:
    CTES[name] = (tuple(deps), text)


def erfc_sql(x: str) -> str:
    """The same complementary error function approximation, in SQL."""
    from cohortlens.functions.columns import ERFC_COEFFS
    z = f"abs({x})"
    t = f"(1.0 / (1.0 + 0.5 * {z}))"
    poly = f"{ERFC_COEFFS[-1]!r}"
    for c in reversed(ERFC_COEFFS[:-1]):
        poly = f"({c!r} + {t} * {poly})"
    ans = f"({t} * exp(-({z}) * ({z}) + {poly}))"
    return f"(CASE WHEN ({x}) >= 0 THEN {ans} ELSE 2.0 - {ans} END)"


def mw_p_sql(N0="N0", N1="N1", R0="R0", tie="tie") -> str:
    """Two-sided asymptotic rank-sum p (tie + continuity corrected)."""
    N = f"({N0} + {N1})"
    U0 = f"({R0} - {N0} * ({N0} + 1) / 2)"
    U = f"greatest({U0}, {N0} * {N1} - {U0})"
    s = f"sqrt({N0} * {N1} / 12 * (({N} + 1) - {tie} / ({N} * ({N} - 1))))"
    z = f"(({U} - {N0} * {N1} / 2 - 0.5) / {s})"
    return f"least(1.0, {erfc_sql(f'{z} / sqrt(2.0)')})"
