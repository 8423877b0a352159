"""URL filters by redirect equivalence. Native: DataFrame functions only.

Nodes are aliases: a URL without scheme, credentials, a leading ``www.``, fragment, tracking parameters and
trailing slash. Edges are the redirect (``meta refresh``) and canonical (``link rel=canonical``, ``og:url``)
declarations of the pages. Connected components over those edges are classes of equivalent URLs.

A URL's own rule (longest fitting one) decides first. A URL without a rule takes its class's decision: an explicit
allow anywhere in the class takes precedence over a block; with neither, it is allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envflow.llm.components import connected_components
from envflow.llm.common import let, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (host and path prefix, verdict)
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
SPACE = r"[ \t\n\f\r]"


def any_case(word: str) -> str:
    """A pattern of ASCII letters in either case."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


#: A tag from its name on. Quoted values are taken whole, whatever they hold and however long they are; what they hold is no tag.
#: Nothing is tried twice from one beginning, and of beginnings that quotes leave open at the same place only one goes on: a
#: page takes time in proportion to its length (the three states of a quote are permuted by every quote, so each chain of quoted
#: values that passes over another beginning of its state ends there).
_PART = r"""(?:[^"'<>]++|"[^"]*+"|'[^']*+')*+>"""
TAGS = rf"<(?:{any_case('link')}|{any_case('meta')})[ \t\n\f\r/]{_PART}"
BASE = rf"<{any_case('base')}[ \t\n\f\r/]{_PART}"
REL = rf"(^|{SPACE}){any_case('canonical')}({SPACE}|$)"
#: What stands before the address in a refresh, and the address.
DELAY = rf"""^{SPACE}*[0-9.]*{SPACE}*[;,]?{SPACE}*({any_case('url')}{SPACE}*={SPACE}*)?["']?{SPACE}*"""
FIRST = r"""^([^"' \t\n\f\r]+)"""
MARKED = "|".join(map(any_case, ("canonical", "og:url", "http-equiv")))


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(after_scheme(url), "^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def alias_of(url: Column) -> Column:
    """The node of a URL; null where it has no host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), "^[^@]*@", ""), r"^www\.|:(80|443)$", "")
    query = F.regexp_replace(F.regexp_extract(after_scheme(url), r"^[^?#]*\?([^#]*)", 1), r"(?i)(^|&)(utm_[a-z]+|gclid|fbclid)=[^&]*", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    return F.when(host != "", F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), F.regexp_replace(query, "^&", ""))).otherwise("")))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest fitting rule, or null. The list is short and fixed, so it is one expression."""
    out = None
    for text, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        domain, _, prefix = text.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(f"/{prefix}")
        hit = F.struct(F.lit(text).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, hit) if out is None else out.when(fits, hit)
    return out


def attribute_pattern(name: str) -> str:
    """An attribute's value in group 1, 2 or 3: in either kind of quotes, or without."""
    return rf"""[ \t\n\f\r"'/]{any_case(name)}{SPACE}*=(?:{SPACE}*"([^"]*)"|{SPACE}*'([^']*)'|{SPACE}*([^ \t\n\f\r"'>]+))"""


def attribute(tag: Column, name: str) -> Column:
    """The value of a tag's attribute, quoted or not; empty where it has none."""
    pattern = attribute_pattern(name)
    return F.trim(F.concat(*(F.regexp_extract(tag, pattern, i) for i in (1, 2, 3))))


def declared(tag: Column) -> Column:
    """The address that a tag declares: canonical, og:url or refresh; empty for other tags."""
    named = F.lower(F.concat_ws(" ", attribute(tag, "property"), attribute(tag, "name")))
    content = attribute(tag, "content")
    link = F.when(attribute(tag, "rel").rlike(REL), attribute(tag, "href"))
    meta = F.when(named.rlike(rf"(^|{SPACE})og:url({SPACE}|$)"), content)
    meta = meta.when(F.lower(attribute(tag, "http-equiv")) == "refresh", F.regexp_extract(F.regexp_replace(content, DELAY, ""), FIRST, 1))
    return F.coalesce(F.when(tag.rlike(rf"^<{any_case('link')}"), link).otherwise(meta), F.lit(""))


def without_dots(path: Column) -> Column:
    """A path without the segments ``.`` and ``..``."""

    def step(kept: Column, part: Column) -> Column:
        up = F.when(F.size(kept) > 1, F.slice(kept, F.lit(1), F.size(kept) - 1)).otherwise(kept)
        return F.when(part == "..", up).when(part == ".", kept).otherwise(F.concat(kept, F.array(part)))

    def short(p: Column) -> Column:
        parts = F.aggregate(F.split(p, "/"), F.expr("CAST(array() AS array<string>)"), step)
        return F.when(p.rlike(r"(^|/)\.\.?(/|$)"), F.array_join(parts, "/")).otherwise(p)

    return let(path, short)


def resolved(to: Column, base: Column) -> Column:
    """The address that to means on a page at base; null for other schemes, fragments and pages without a host."""
    return let(to, lambda t: let(base, lambda b: _resolved(t, b)))


def _resolved(to: Column, base: Column) -> Column:
    scheme, rest = F.regexp_extract(base, "^([^:/?#]*):", 1), after_scheme(base)
    host, path = F.regexp_extract(rest, "^([^/?#]*)", 1), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    own, query = F.regexp_extract(to, "^([^?#]*)", 1), F.regexp_extract(to, r"^[^?#]*(\?.*)?$", 1)
    folder = F.concat(F.regexp_replace(path, "[^/]*$", ""), F.when(path == "", "/").otherwise(""))
    target = F.when(own == "", path).otherwise(without_dots(F.when(own.startswith("/"), own).otherwise(F.concat(folder, own))))
    inside = F.when(host != "", F.concat(scheme, F.lit("://"), host, target, query))
    return F.when(to.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), to).when(to.startswith("//"), F.concat(scheme, F.lit(":"), to)).when(to.rlike("^([A-Za-z][A-Za-z0-9+.-]*:|#|$)"), F.lit(None)).otherwise(inside)


def link_edges(pages: DataFrame) -> DataFrame:
    """(a, b): every page's alias and the alias it declares. Relative addresses are those of the page, or of its base.

    Tags and values may be of any length and number.
    """
    found = F.transform(F.regexp_extract_all("html", F.lit(TAGS), F.lit(0)), declared)
    base = attribute(F.regexp_extract("html", BASE, 0), "href")
    marked = pages.where(F.col("html").rlike(MARKED))
    marked = marked.select("url", F.coalesce(resolved(base, F.col("url")), F.col("url")).alias("base"), F.explode(F.array_distinct(found)).alias("to"))
    edge = F.struct(alias_of(F.col("url")).alias("a"), let(resolved(F.col("to"), F.col("base")), alias_of).alias("b"))
    return marked.select(F.explode(F.array(edge)).alias("edge")).select("edge.a", "edge.b").where("a <> b")


def judge(pages: DataFrame, rules=RULES, links: DataFrame | None = None) -> DataFrame:
    """One row per row of pages (page_id, url, html): page_id, host, path, rule, verdict, component.

    links: more edges (a, b) of aliases, such as a crawler's redirect log. component is the alias that stands for
    the class. A null URL, or one without ``://``, has an empty host and path, no rule and no class, and is allowed.
    Repeated rows are judged alike; other columns are ignored; an empty table gives an empty result.
    """
    edges = link_edges(pages)
    edges = edges.unionAll(links.select("a", "b")) if links is not None else edges
    classes = connected_components(edges)
    base = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), alias_of(F.col("url")).alias("alias"))
    base = base.withColumn("own", rule_of(F.col("host"), F.col("path"), rules)).select("page_id", "host", "path", "alias", "own.rule", F.col("own.verdict").alias("own"))
    base = written(base.join(classes.withColumnRenamed("node", "alias"), "alias", "left").withColumn("component", F.coalesce("component", "alias")), "urls")
    # one row per class and rule verdict; aliases that are only linked to, not crawled, count with their own rule
    linked = classes.select("component", rule_of(F.regexp_extract("node", "^([^/?#]*)", 1), F.regexp_extract("node", "^[^/?#]*([^?#]*)", 1), rules)["verdict"].alias("own"))
    decided = base.select("component", "own").unionAll(linked).where("own IS NOT NULL AND component IS NOT NULL")
    decided = decided.groupBy("component").agg(F.min("own").alias("theirs"))  # 'allow' sorts before 'block'
    open_ = base.where("own IS NULL").join(decided, "component", "left")
    out = base.where("own IS NOT NULL").withColumn("verdict", F.col("own")).unionByName(open_.withColumn("verdict", F.coalesce("theirs", F.lit("allow"))).drop("theirs"))
    return out.select("page_id", "host", "path", "rule", "verdict", "component")
