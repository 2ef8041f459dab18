"""URL filter with redirect equivalence.

Rules name a host (and its subdomains) and a path prefix; the longest fitting
rule decides.  A page that no rule fits takes the decision of its aliases:
connected components over redirect and canonical-link edges carry an explicit
allow, else a block, to every member; else the default holds.

Edges come from all ``<link>`` tags of a page with ``canonical`` among their
``rel`` words, from all its ``<meta http-equiv=refresh>`` and from a table of
redirects (source, target), if one is given.  Comments are left out; a tag ends
at its first ``>``.  Targets that are relative to the scheme, the root or the
base (the page's first ``<base href>``, else its URL) are resolved; those of
schemes without ``://`` (``mailto:``) are no edges.  A node is a URL without its
fragment.

Defined cases: a null URL, or one without ``://``, has an empty host and path,
fits no rule and has no aliases; equal URLs are one node and share a verdict;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.components import components
from cohortlens.llm.shared import cut, stash

#: (host, path, verdict); a configuration list, held in the expression.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow"))

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COMMENT = r"(?s)<!--.*?(?:-->|\z)"
LINKS, METAS, BASES = (rf"(?i)<{tag}\b[^>]*>" for tag in ("link", "meta", "base"))
CANONICAL = r"""(?i)[\s"'/]rel\s*=\s*(?:"(?:[^"]*\s)?canonical(?:\s[^"]*)?"|'(?:[^']*\s)?canonical(?:\s[^']*)?'|canonical[\s>/])"""
REFRESH = r"""(?i)[\s"'/]http-equiv\s*=\s*["']?\s*refresh["'\s>/]"""
HREF = r"""(?i)[\s"'/]href\s*=\s*["']?\s*([^"'\s>]+)"""
GOTO = r"""(?i)\burl\s*=\s*["']?([^"'\s>;]+)"""


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """struct(length, allow, rule) of the longest rule that fits; an allow wins among equally long ones."""
    found = F.array(*[F.when(
        ((host == F.lit(h)) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)),
        F.struct(F.lit(len(h + p)).alias("length"), F.lit(verdict == "allow").alias("allow"), F.lit(h + p).alias("rule")))
        for h, p, verdict in rules])
    return F.array_max(found)


def _without_dots(path: Column) -> Column:
    """A path that begins with a slash, its parts ``.`` and ``..`` folded."""
    parts = F.split(path, "/")
    kept = F.aggregate(F.slice(parts, 2, F.size(parts)), F.array().cast("array<string>"), lambda done, part: F.when(
        part == ".", done).when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(
        F.concat(done, F.array(part))))
    ends = F.element_at(parts, -1).isin(".", "..") & (F.size(kept) > 0)
    return F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(ends, "/").otherwise(""))


def _target(base: Column, link: Column) -> Column:
    link = F.regexp_replace(link, "&amp;", "&")
    scheme = F.regexp_extract(base, "^([^:]*):", 1)
    root = F.concat(scheme, F.lit("://"), host_of(base))
    page = F.when(path_of(base) == "", "/").otherwise(path_of(base))
    path, rest = F.regexp_extract(link, "^([^?#]*)", 1), F.regexp_extract(link, "^[^?#]*(.*)$", 1)
    return (F.when(F.startswith(link, F.lit("//")), F.concat(scheme, F.lit(":"), link))
            .when(F.startswith(link, F.lit("/")), F.concat(root, link))
            .when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.when(F.contains(link, F.lit("://")), link))
            .when(~F.contains(base, F.lit("://")) | F.startswith(link, F.lit("#")), F.lit(None))
            .when(path == "", F.concat(root, page, rest))
            .otherwise(F.concat(root, _without_dots(F.concat(F.regexp_replace(page, "[^/]*$", ""), path)), rest)))


def _node(url: Column) -> Column:
    bare = F.regexp_extract(url, "^([^#]*)", 1)
    return F.when(F.contains(bare, F.lit("://")), F.concat(
        F.translate(F.regexp_extract(bare, "^(.*?://[^/?#]*)", 1), UPPER, LOWER),
        F.regexp_extract(bare, "^.*?://[^/?#]*(.*)$", 1)))


def alias_edges(pages: DataFrame) -> DataFrame:
    """source, target of the canonical links and refreshes in ``pages``."""
    html = F.regexp_replace("html", COMMENT, " ")
    tags = lambda form: F.regexp_extract_all("html", F.lit(form), F.lit(0))
    each = lambda form, mark, value: F.transform(F.filter(tags(form), lambda t: t.rlike(mark)),
                                                 lambda t: F.regexp_extract(t, value, 1))
    base = F.regexp_extract(F.try_element_at(F.filter(tags(BASES), lambda t: t.rlike(HREF)), F.lit(1)), HREF, 1)
    links = (pages.where("url is not null and html is not null").select("url", html.alias("html"))
             .select("url", base.alias("base"), F.explode(F.array_distinct(F.concat(
                 each(LINKS, CANONICAL, HREF), each(METAS, REFRESH, GOTO)))).alias("link")).where("link <> ''"))
    links = links.withColumn("base", F.coalesce(F.when(F.col("base") != "", _target(F.col("url"), F.col("base"))), "url"))
    return links.select(F.col("url").alias("source"), _target(F.col("base"), F.col("link")).alias("target")).where(
        "target is not null")


def url_verdicts(pages: DataFrame, rules=RULES, redirects: DataFrame | None = None, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict, component: one row for each page."""
    edges = alias_edges(pages)
    if redirects is not None:
        edges = edges.union(redirects.select("source", "target"))
    edges = stash(edges.select(_node(F.col("source")).alias("a"), _node(F.col("target")).alias("b")).where(
        "a is not null and b is not null and a <> b").distinct(), "url-edges")
    parts = components(edges)
    ruled = parts.withColumn("found", rule_for(host_of(F.col("node")), path_of(F.col("node")), rules))
    decided = ruled.groupBy("component").agg(F.bool_or("found.allow").alias("allowed")).where("allowed is not null")
    taken = cut(parts.join(decided, "component").select(F.col("node").alias("n"), "component", "allowed"))

    url = F.col("url").cast("string")
    shown = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), _node(url).alias("node"))
    shown = shown.withColumn("found", rule_for(F.col("host"), F.col("path"), rules))
    if not taken.isEmpty():
        shown = shown.join(taken, F.col("node") == F.col("n"), "left")
    else:
        shown = shown.withColumns({"component": F.lit(None).cast("string"), "allowed": F.lit(None).cast("boolean")})
    allow = F.coalesce("found.allow", "allowed", F.lit(default == "allow"))
    return shown.select("page_id", "host", "path", F.col("found.rule").alias("rule"),
                        F.when(allow, "allow").otherwise("block").alias("verdict"), "component")
