"""URL filter: prefix rules, carried over to the other addresses of the same page.

A rule fits its host and all subdomains if the path starts with the rule's; the longest
fitting rule decides. Addresses that redirect to each other, or name one another as
canonical, are equivalent: connected components over these edges give the classes, and a
class decides for its members without a rule of their own. There an explicit allow on any
member comes before a block; a class without either allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partwise.llm.common import settle
from partwise.llm.components import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str]  # verdict ("allow" or "block"), host and path as one text: "example.com/en/"


def _part(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", group), F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(_part(url, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty without ``://``."""
    return _part(url, 2)


def _fits(host: Column, path: Column, rule: str) -> Column:
    rule_host, slash, rest = rule.partition("/")
    same = (host == rule_host) | host.endswith(f".{rule_host}")
    return same & path.startswith(slash + rest)


def ruling(host: Column, path: Column, rules: list[Rule]) -> Column:
    """(rule, verdict) of the longest rule that fits, null if none does; of equally long ones an allow."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[0] == "allow", r[1])):
        out = F.when(_fits(host, path, rule), F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def query_of(url: Column) -> Column:
    """The ``?`` and what follows it up to ``#`` or the end, else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1), F.lit(""))


def _parts(df: DataFrame, url_col: str) -> DataFrame:
    """``df`` with host, path and query, and the key that names the page: these three, null without a host."""
    url = F.col(url_col)
    split = df.withColumns({"host": host_of(url), "path": path_of(url), "query": query_of(url)})
    return split.withColumn("key", F.when(F.col("host") != "", F.concat("host", "path", "query"))).drop("query")


def resolve(target: Column, base: Column) -> Column:
    """A link target as an absolute address, seen from ``base``."""
    root = F.regexp_extract(base, r"(?s)^.*?://[^/?#]*", 0)
    folder = F.regexp_extract(path_of(base), r"(?s)^.*/", 0)
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when(target.startswith("/"), F.concat(root, target))
        .when(target.startswith("?"), F.concat(root, path_of(base), target))
        .when((target != "") & ~target.startswith("#"), F.concat(root, F.when(folder == "", "/").otherwise(folder), target))
    )


def _attribute(tag: Column, name: str) -> Column:
    quoted = F.regexp_extract(tag, rf"""(?is)\s{name}\s*=\s*(["'])(.*?)\1""", 2)
    bare = F.regexp_extract(tag, rf"""(?i)\s{name}\s*=\s*([^\s"'>]+)""", 1)
    return F.trim(F.when(quoted != "", quoted).otherwise(bare))


def alias_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(source, target) addresses of canonical links and of refresh redirects in the pages."""
    tags = F.regexp_extract_all(F.col("html"), F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))
    hinted = F.col("html").rlike("(?i)canonical|http-equiv")
    found = (
        pages.select(F.col(url_col).alias("source"), F.col(html_col).alias("html"))
        .where(hinted & F.col("source").isNotNull())
        .select("source", F.explode(tags).alias("tag"))
    )
    canonical = F.when(F.lower(_attribute(F.col("tag"), "rel")).rlike(r"\bcanonical\b"), _attribute(F.col("tag"), "href"))
    content = _attribute(F.col("tag"), "content")
    refresh = F.when(
        F.lower(_attribute(F.col("tag"), "http-equiv")) == "refresh",
        F.trim(F.regexp_extract(content, r"""(?is)^\s*[\d.]*\s*[;,]?\s*url\s*=\s*["']?([^"']*)""", 1)),
    )
    target = resolve(F.coalesce(canonical, refresh), F.col("source"))
    return found.select("source", target.alias("target"))


def judge(
    pages: DataFrame,
    rules: list[Rule],
    redirects: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """(page_id, host, path, rule, verdict, decided_by) for every row of ``pages``.

    ``redirects`` may hold more edges as (source, target) addresses. ``decided_by`` is
    ``rule``, ``alias`` (the class of the address) or ``default`` (allow).

    A null address, or one without ``://``, has an empty host and path, no rule and no
    alias: it is allowed. Null pages have no links; repeated rows and rows with a null id
    are judged by their address; only the three named columns are read. An empty table
    gives an empty result. Addresses are compared by a 64-bit hash.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    judged = _parts(rows, "url").withColumn("own", ruling(F.col("host"), F.col("path"), rules))
    judged = judged.withColumn("node", F.when(F.col("key").isNotNull(), F.xxhash64("key")))

    edges = alias_edges(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.unionByName(redirects.select("source", "target"))
    edges = settle(edges.distinct(), "links")
    sources = _parts(edges, "source").select("target", F.col("key").alias("from_key"), "host", "path")
    sources = sources.select("target", F.struct(F.col("from_key").alias("key"), "host", "path").alias("a"))
    both = _parts(sources, "target").select("a", F.struct("key", "host", "path").alias("b"))
    both = settle(both.where("a.key is not null and b.key is not null").distinct(), "aliases")
    roots = components(both.select(F.xxhash64("a.key").alias("x"), F.xxhash64("b.key").alias("y")), "x", "y")

    members = both.select(F.explode(F.array("a", "b")).alias("at")).distinct().select("at.*")
    known = members.select(F.xxhash64("key").alias("node"), ruling(F.col("host"), F.col("path"), rules)["verdict"].alias("known"))
    classes = roots.join(known, "node").groupBy("root").agg(
        F.max(F.col("known") == "allow").alias("allows"), F.max(F.col("known") == "block").alias("blocks")
    )
    decision = F.when(F.col("allows"), "allow").when(F.col("blocks"), "block")
    by_class = roots.join(classes, "root").select(F.col("node").alias("alias"), decision.alias("carried"))
    by_class = by_class.where("carried is not null")

    return judged.join(by_class, F.col("node") == F.col("alias"), "left").select(
        "page_id",
        "host",
        "path",
        F.col("own.rule").alias("rule"),
        F.coalesce("own.verdict", "carried", F.lit("allow")).alias("verdict"),
        F.when(F.col("own").isNotNull(), "rule").when(F.col("carried").isNotNull(), "alias").otherwise("default").alias("decided_by"),
    )
