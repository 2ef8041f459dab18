"""The registered queries of the text operators and their SQL, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.shared import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


LOWER_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _jaccard_sql(size: int, num: int, more: str = "") -> str:
    return rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array({LOWER_AZ}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {size} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {size - 2}), lambda i: array_to_string(w[i:i + {size - 1}], ' ')) END) AS g FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
meets AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM sets a JOIN sets b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM meets JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= {num} * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS d, doc_id AS c FROM words UNION SELECT e.b, r.c FROM reach r JOIN edges e ON e.a = r.d)
SELECT words.doc_id, coalesce(n, 0) AS n_shingles, component_id{more}
FROM words LEFT JOIN sizes USING (doc_id)
JOIN (SELECT d AS doc_id, min(c) AS component_id FROM reach GROUP BY d) USING (doc_id)
"""


@_query("op1_jaccard_join", _jaccard_sql(3, 90))
def op1_jaccard_join(spark, sf_dir):
    """Components of documents whose sets of three-word shingles have a similarity of 0.9."""
    from cohortlens.llm.jaccard_join import jaccard_components
    return jaccard_components(table(spark, sf_dir, "documents"), size=3, num=90, den=100)


@_query("op2_token_codes")
def op2_token_codes(spark, sf_dir):
    """Directly addressable token files, written, read back and summed per document."""
    from cohortlens.llm.token_codes import token_table
    return token_table(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), end_id=1)


def _licence_sql() -> str:
    from cohortlens.llm.license_digest import COPYRIGHT_LINE, LINE_ENDS, MARKS, NO_NOTICE, SPELLINGS, known_digests

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    form = (f"regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), {quoted(LINE_ENDS)}, chr(10), 'g'), "
            f"{quoted(NO_NOTICE)}, 'copyright\\1', 'g'), {quoted(COPYRIGHT_LINE)}, chr(10), 'g')")
    form = (f"regexp_replace(translate({form}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
            f"{quoted(MARKS)}, ' ', 'g')")
    for one, other in SPELLINGS:
        form = f"replace({form}, {quoted(one)}, {quoted(other)})"
    known = ", ".join(f"({quoted(code)}, {quoted(name)})" for code, name in known_digests().items())
    return f"""
SELECT doc_id, canonical_sha256, license
FROM (SELECT doc_id, sha256(trim({form}, ' ')) AS canonical_sha256 FROM documents)
LEFT JOIN (VALUES {known}) v(known, license) ON canonical_sha256 = known"""


def _url_sql() -> str:
    from cohortlens.llm.url_filter import BASES, CANONICAL, COMMENT, GOTO, HREF, LINKS, METAS, REFRESH, RULES
    q = lambda text: text.replace("'", "''")
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')".format
    host = lambda url: lower(f"regexp_extract(coalesce({url}, ''), '://([^/?#]*)', 1)")
    path = lambda url: f"regexp_extract(coalesce({url}, ''), '://[^/?#]*([^?#]*)', 1)"
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)

    def node(url: str) -> str:
        bare = f"regexp_extract({url}, '^([^#]*)', 1)"
        return (f"CASE WHEN contains({bare}, '://') THEN " + lower(f"regexp_extract({bare}, '^(.*?://[^/?#]*)', 1)")
                + f" || regexp_extract({bare}, '^.*?://[^/?#]*(.*)$', 1) END")

    def each(form: str, mark: str, value: str) -> str:
        return (f"list_transform(list_filter(regexp_extract_all(html, '{q(form)}'), lambda t: regexp_matches(t, '{q(mark)}')), "
                f"lambda t: regexp_extract(t, '{q(value)}', 1))")

    def target(base: str, link: str) -> str:
        scheme, bare = f"regexp_extract({base}, '^([^:]*):', 1)", f"regexp_extract({link}, '^([^?#]*)', 1)"
        root, rest = f"{scheme} || '://' || {host(base)}", f"regexp_extract({link}, '^[^?#]*(.*)$', 1)"
        page = f"CASE WHEN {path(base)} = '' THEN '/' ELSE {path(base)} END"
        parts = f"string_split(regexp_replace({page}, '[^/]*$', '') || {bare}, '/')"
        folded = (f"list_reduce(list_prepend('', {parts}[2:]), lambda done, part: CASE WHEN part = '.' THEN done "
                  "WHEN part = '..' THEN regexp_replace(done, '/[^/]*$', '') ELSE done || '/' || part END)")
        ends = f"CASE WHEN {parts}[-1] IN ('.', '..') THEN '/' ELSE '' END"
        return f"""CASE WHEN starts_with({link}, '//') THEN {scheme} || ':' || {link}
    WHEN starts_with({link}, '/') THEN {root} || {link}
    WHEN regexp_matches({link}, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN CASE WHEN contains({link}, '://') THEN {link} END
    WHEN NOT contains({base}, '://') OR starts_with({link}, '#') THEN NULL
    WHEN {bare} = '' THEN {root} || {page} || {rest}
    ELSE {root} || CASE WHEN {folded} = '' THEN '/' ELSE {folded} || {ends} END || {rest} END"""
    return f"""
WITH RECURSIVE rules(rule_host, rule_path, rule_verdict) AS (VALUES {rules}),
clean AS (
  SELECT url, regexp_replace(html, '{q(COMMENT)}', ' ', 'g') AS html FROM pages WHERE url IS NOT NULL AND html IS NOT NULL),
links AS (
  SELECT url, replace({each(BASES, HREF, HREF)}[1], '&amp;', '&') AS base,
         unnest(list_concat({each(LINKS, CANONICAL, HREF)}, {each(METAS, REFRESH, GOTO)})) AS link FROM clean),
bases AS (
  SELECT url, coalesce(CASE WHEN base <> '' THEN {target("url", "base")} END, url) AS base, replace(link, '&amp;', '&') AS l
  FROM links WHERE link <> ''),
targets AS (SELECT url AS source, {target("base", "l")} AS target FROM bases),
edges AS (SELECT {node("source")} AS a, {node("target")} AS b FROM targets WHERE target IS NOT NULL),
ways AS (SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b),
reach AS (SELECT a AS node, a AS other FROM ways UNION SELECT reach.node, ways.b FROM reach JOIN ways ON ways.a = reach.other),
best AS (
  SELECT u, arg_max(rule_host || rule_path, rank) AS rule, arg_max(rule_verdict, rank) AS verdict
  FROM (SELECT u, rule_host, rule_path, rule_verdict,
          length(rule_host || rule_path) * 2 + (rule_verdict = 'allow')::int AS rank
        FROM (SELECT url AS u FROM pages UNION SELECT other FROM reach) JOIN rules
          ON ({host("u")} = rule_host OR ends_with({host("u")}, '.' || rule_host)) AND starts_with({path("u")}, rule_path))
  GROUP BY u),
shared AS (
  SELECT node, min(other) AS component, CASE WHEN bool_or(verdict = 'allow') THEN 'allow' WHEN count(verdict) > 0 THEN 'block' END AS taken
  FROM reach LEFT JOIN best ON u = other GROUP BY node)
SELECT page_id, {host("url")} AS host, {path("url")} AS path, rule, coalesce(verdict, taken, 'allow') AS verdict,
       CASE WHEN taken IS NOT NULL THEN component END AS component
FROM pages LEFT JOIN best ON u = url LEFT JOIN shared ON node = {node("url")}"""


@_query("op3_pii_bootstrap")
def op3_pii_bootstrap(spark, sf_dir):
    """Personal data in all documents: fixed forms and bootstrapped contexts."""
    from cohortlens.llm.pii_bootstrap import personal_data
    return personal_data(table(spark, sf_dir, "documents"))


@_query("op4_url_filter", _url_sql())
def op4_url_filter(spark, sf_dir):
    """Verdicts of all pages, with decisions carried along redirects and canonical links."""
    from cohortlens.llm.url_filter import url_verdicts
    return url_verdicts(table(spark, sf_dir, "pages"))


@_query("op5_license_digest", _licence_sql())
def op5_license_digest(spark, sf_dir):
    """Whole documents that are known licence texts, by a canonical digest."""
    from cohortlens.llm.license_digest import license_matches
    return license_matches(table(spark, sf_dir, "documents"))


@_query("op6_toxicity_cnn")
def op6_toxicity_cnn(spark, sf_dir):
    """Toxicity scores of all documents by a convolutional classifier."""
    from cohortlens.llm.toxicity_cnn import toxicity_table
    return toxicity_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query("op7_decontaminate")
def op7_decontaminate(spark, sf_dir):
    """Benchmark items that occur in documents, with up to eight edits in a hundred characters."""
    from cohortlens.llm.decontaminate import contaminated
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query("op8_piece_codec")
def op8_piece_codec(spark, sf_dir):
    """SentencePiece ids of all documents, decoded again and compared."""
    from cohortlens.llm.piece_codec import piece_table
    return piece_table(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


# The given conversations hold no tool calls, so the SQL states the plain messages.
@_query("op9_tool_chat", """
SELECT conv_id, turn AS at_turn, 0 AS step, 0 AS place, turn, 'message' AS kind, NULL::varchar AS call_id,
       'plain' AS status, '' AS faults,
       to_json({'content': coalesce(text, ''), 'role': role, 'turn': turn})::varchar AS line
FROM conversations
""")
def op9_tool_chat(spark, sf_dir):
    """All conversations as ordered canonical JSON lines with linked tool calls."""
    from cohortlens.llm.tool_chat import format_chats
    return format_chats(table(spark, sf_dir, "conversations"))


@_query("op10_exact_dedup", f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM (SELECT doc_id, {LOWER_AZ} AS body FROM documents) WINDOW same AS (PARTITION BY body)
""")
def op10_exact_dedup(spark, sf_dir):
    """Exact copies by a fingerprint exchange and a byte check."""
    from cohortlens.llm.exact_dedup import exact_groups
    return exact_groups(table(spark, sf_dir, "documents"))


@_query("op11_periodic_runs")
def op11_periodic_runs(spark, sf_dir):
    """Periodic runs of words in all documents, one document in ten made periodic first."""
    from cohortlens.llm.periodic_runs import run_table
    return run_table(table(spark, sf_dir, "documents"), planted=True)


@_query("op12_hard_negatives", """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::bigint + 1) % 10 ELSE label::bigint END AS label,
         list_transform(embedding, lambda x: floor(256 * x::double)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, v.vec_id AS other, v.label,
         list_inner_product(a.q, v.q)::bigint AS score
  FROM v a JOIN v ON a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id AND len(a.q) = len(v.q)),
p AS (
  SELECT * FROM s WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
n AS (
  SELECT p.anchor_id, p.other AS positive_id, s.other AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY s.score DESC, s.other) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.own
    AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, rank::int AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
""")
def op12_hard_negatives(spark, sf_dir):
    """Hard negatives of every hundredth vector; labels of every seventh moved on by one."""
    from cohortlens.llm.hard_negatives import hard_negatives
    vectors = table(spark, sf_dir, "embeddings")
    label = F.col("label").cast("long")
    return hard_negatives(vectors.withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)))


@_query("op13_minmax_dedup", _jaccard_sql(5, 85, ", words.doc_id = component_id AS kept"))
def op13_minmax_dedup(spark, sf_dir):
    """Near copies among all documents: five-word shingles, a similarity of 0.85."""
    from cohortlens.llm.minmax_dedup import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), size=5, num=85, den=100)
