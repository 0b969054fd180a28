"""URL filter: allow and block rules, carried over to the aliases of a page.  [native]

Main path: DataFrame functions only.  Rules are judged on host and path; redirects and canonical links make pages
equivalent; classes of equivalent addresses are connected components, and a class passes its decision on to those of
its addresses that no rule names.

Defined results: a null address, or one without ``://``, has an empty host and path, fits no rule, has no alias and is
allowed.  Repeated rows each get the same verdict.  A null or malformed page declares no link.  Other columns of the
input are not read, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import attach, heavy_join, materialise
from .components import connected_components


@dataclass(frozen=True)
class Rule:
    """``text`` is host, then path with its leading slash: ``example.com/en/``."""

    text: str
    allow: bool

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


RULES = (
    Rule("com/", True),
    Rule("example.com/en/", False),
    Rule("www.example.com/en/", True),
    Rule("net/es/", False),
    Rule("net/fr/", False),
)

#: More rules than this belong in a table joined by key; they are compiled into one expression here.
MAX_RULES = 500


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; else empty."""
    return _lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """From behind the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def node_of(url: Column) -> Column:
    """The address as a node: host, path and query, without scheme and fragment; null where there is no ``://``."""
    url = F.coalesce(url, F.lit(""))
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(F.contains(url, F.lit("://")), F.concat(host_of(url), F.when(rest == "", "/").otherwise(rest)))


def rule_for(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Text of the longest rule that fits host (or a parent domain) and path prefix; null if none does."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    fits = [
        F.when(
            ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
            F.lit(r.text),
        )
        for r in sorted(rules, key=lambda r: (-len(r.text), -len(r.host), r.text))
    ]
    return F.coalesce(*fits, F.lit(None).cast("string"))


def allows(rule: Column, rules: tuple[Rule, ...]) -> Column:
    """True or false by the rule, null without one."""
    named = [r.text for r in rules if r.allow]
    return F.when(rule.isNotNull(), rule.isin(named) if named else F.lit(False))


def declared_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Edges ``(u, v)`` between nodes: canonical links and refresh redirects that pages declare.

    Targets may be absolute, start with ``//`` or ``/``, or be relative to the page's folder.
    """
    tags = (
        pages.select(F.col(url).alias("at"), F.coalesce(F.col(html), F.lit("")).alias("body"))
        .where(F.contains("at", F.lit("://")) & F.col("body").rlike(r"(?i)canonical|http-equiv"))
        .select("at", F.explode(F.regexp_extract_all("body", F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))).alias("tag"))
    )
    # written down: few rows, and without it the optimiser would copy each step's expression into the next
    tags = materialise(tags, "tags")
    tag = F.col("tag")
    canonical = tag.rlike(r"""(?is)^<link.*\brel\s*=\s*["']?[^"'>]*\bcanonical\b""")
    refresh = tag.rlike(r"""(?is)\bhttp-equiv\s*=\s*["']?refresh""")
    href = F.regexp_extract(tag, r"""(?is)\bhref\s*=\s*["']?([^"'>\s]+)""", 1)
    content = F.regexp_extract(tag, r"""(?is)\bcontent\s*=\s*["']?\s*[\d.]*\s*[;,]\s*url\s*=\s*["']?([^"'>]+)""", 1)
    target = F.trim(F.replace(F.when(canonical, href).when(refresh, content), F.lit("&amp;"), F.lit("&")))
    links = materialise(tags.select("at", target.alias("to")).where("to is not null and to <> ''"), "links")
    folder = F.regexp_extract("at", r"(?s)^(.*?://[^/?#]*(?:[^?#]*/)?)", 1)
    folder = F.when(folder.endswith("/") & ~folder.endswith("://"), folder).otherwise(F.concat(folder, F.lit("/")))
    full = (
        F.when(F.contains("to", F.lit("://")), F.col("to"))
        .when(F.col("to").startswith("//"), F.concat(F.lit("http:"), F.col("to")))
        .when(F.col("to").startswith("/"), F.concat(F.lit("http://"), host_of(F.col("at")), F.col("to")))
        .when(~F.col("to").startswith("#"), F.concat(folder, F.col("to")))
    )
    return links.select(node_of(F.col("at")).alias("u"), node_of(full).alias("v")).where("u <> v").distinct()


def class_verdicts(edges: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``(node, component, class_verdict)`` for nodes that have links.

    A class with an explicitly allowed member allows its unnamed members; else one blocked member blocks them.
    """
    nodes = connected_components(edges)
    allowed = allows(rule_for(host_of(F.concat(F.lit("://"), "node")), path_of(F.concat(F.lit("://"), "node")), rules), rules)
    judged = materialise(nodes.withColumn("allowed", allowed), "judged")
    classes = judged.groupBy("component").agg(F.max("allowed").alias("any_allowed"))
    verdict = F.when(F.coalesce("any_allowed", F.lit(True)), "allow").otherwise("block")
    return attach(judged.select("node", "component"), classes, "component").select("node", "component", verdict.alias("class_verdict"))


def filter_urls(
    pages: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    id_col: str = "page_id",
    url: str = "url",
    html: str | None = "html",
    redirects: DataFrame | None = None,
) -> DataFrame:
    """Judge every row of ``pages``: ``id_col, host, path, rule, verdict, component, inherited``.

    ``redirects`` may add rows ``(source, target)`` of absolute addresses, such as a crawler's log.  ``verdict`` is
    the rule's own; without a rule it is that of the alias class, and ``allow`` without a class.  ``component`` is the
    class's smallest address, null without aliases; ``inherited`` tells that the class decided.
    """
    edges = declared_links(pages, url, html) if html else None
    if redirects is not None:
        logged = redirects.select(node_of(F.col("source")).alias("u"), node_of(F.col("target")).alias("v")).where("u <> v")
        edges = logged if edges is None else edges.unionByName(logged)
    rows = pages.select(F.col(id_col).alias("page"), F.col(url).alias("url"))
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url")), "node": node_of(F.col("url"))})
    rows = rows.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    if edges is None:
        rows = rows.withColumns({"component": F.lit(None).cast("string"), "class_verdict": F.lit(None).cast("string")})
    else:
        # an address that very many pages have is dealt in parts where it meets its class
        times = rows.groupBy("node").agg(F.count("*").alias("__pages"))
        aliases = materialise(class_verdicts(edges, rules).join(times, "node"), "aliases")
        rows = heavy_join(rows, aliases, ["node"], "__pages", "left")
    own = F.when(allows(F.col("rule"), rules), "allow").when(F.col("rule").isNotNull(), "block")
    return rows.select(
        F.col("page").alias(id_col),
        "host",
        "path",
        "rule",
        F.coalesce(own, F.col("class_verdict"), F.lit("allow")).alias("verdict"),
        "component",
        (F.col("rule").isNull() & F.col("class_verdict").isNotNull()).alias("inherited"),
    )
