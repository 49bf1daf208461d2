"""URL filters with redirect equivalence.

A page's own rule is the longest that fits its host (or a parent of it) and begins its
path.  Pages that a redirect (``meta`` refresh) or a canonical link joins are aliases:
connected components over these edges carry a block to every alias without a rule of
its own, also from a target that is no row.  All such links of a page count.  An explicit allow of the page itself takes precedence; a page without rule and
without a blocked alias is allowed.

Definitions: null urls and urls without ``://`` have empty host and path, fit no rule and
are aliases of nothing.  A url's key is its host, its path without closing slashes, and
its query; scheme and fragment do not count, dot segments (``/./``, ``/../``) are resolved,
and equal keys are one page.  Rules are judged on the path as it stands for rows, and resolved
for link targets.  Links in HTML comments do not count; an unclosed comment reaches to the
end.  Of rules
of equal length the one with the longer host wins.  Null html has no links.  Rows are
independent otherwise; repeated rows are judged alike.  Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmarts.llm.common import lower_ascii, materialize
from clickmarts.llm.components import components

#: Fixed values of the contract: verdict, host, path.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))

_URL = r"://([^/?#]*)([^?#]*)(\?[^#]*)?"
_LINK = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
_REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\burl\s*=\s*["']?([^"'\s>]+)"""
#: Comments hold no links.
_COMMENT = r"(?s)<!--.*?(?:-->|\z)"
_DOTS = r"/\.\.?(/|\z)"


def host(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, _URL, 1)), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def resolved(path_: Column) -> Column:
    """A path without dot segments: ``.`` goes, ``..`` takes the segment before it along."""
    parts = F.split(path_, "/")
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda done, part: F.when(
        part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.least(F.size(done), F.lit(1))))).when(
        part == ".", done).otherwise(F.concat(done, F.array(part))))
    closing = F.when(F.element_at(parts, -1).isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    return F.when(path_.rlike(_DOTS), F.concat(F.array_join(kept, "/"), closing)).otherwise(path_)


def key(url: Column) -> Column:
    """The page that a url names; null without ``://``."""
    return F.when(F.instr(url, "://") > 0, F.concat(
        host(url), F.regexp_replace(resolved(path(url)), "/+$", ""), F.regexp_extract(url, _URL, 3)))


def absolute(target: Column, url: Column) -> Column:
    """A link's target, seen from a page's url."""
    scheme, folder = F.regexp_extract(url, "^([^:/?#]*)", 1), F.regexp_replace(path(url), "[^/]*$", "")
    return (F.when(target.rlike("(?i)^[a-z][a-z0-9+.-]*://"), target)
            .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
            .when(target.startswith("/"), F.concat(scheme, F.lit("://"), host(url), target))
            .when(target != "", F.concat(scheme, F.lit("://"), host(url),
                                         F.when(folder == "", "/").otherwise(folder), target)))


def own_rule(host_: Column, path_: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, else nulls."""
    ordered = sorted(rules, key=lambda r: (-len(r[1]) - len(r[2]), -len(r[1])))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in reversed(ordered):
        fits = ((host_ == h) | host_.endswith("." + h)) & path_.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def alias_edges(pages: DataFrame, rules=RULES) -> DataFrame:
    """(a, b, own): keys of pages and of all their redirect and canonical targets, and the
    verdict of the target's own rule, whether or not the target is a row."""
    html = F.when(F.col("html").contains("<!--"), F.regexp_replace("html", _COMMENT, "")).otherwise(F.col("html"))
    found = F.concat(*[F.regexp_extract_all(F.col("html"), F.lit(x), F.lit(1)) for x in (_LINK, _REFRESH)])
    links = pages.select("url", html.alias("html")).select("url", F.explode(found).alias("target")).where("target <> ''")
    ends = links.select("url", absolute(F.regexp_replace("target", "&amp;", "&"), F.col("url")).alias("end"))
    return ends.select(key(F.col("url")).alias("a"), key(F.col("end")).alias("b"),
                       own_rule(host(F.col("end")), resolved(path(F.col("end"))), rules)[1].alias("own"))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    h, p = host(F.col("url")), path(F.col("url"))
    rule, verdict = own_rule(F.col("host"), F.col("path"), rules)
    judged = (pages.select("page_id", h.alias("host"), p.alias("path"), key(F.col("url")).alias("key"))
              .select("*", rule.alias("rule"), verdict.alias("own")))
    # Written once: the components and the targets' own verdicts both read the links.
    edges = materialize(alias_edges(pages.select("url", "html"), rules).where("a is not null and b is not null").distinct(), "links")
    groups = components(edges.select("a", "b"))
    # Blocked keys of rows and of link targets, then their components, then every key of those: small
    # tables before the join with pages.
    blocked = (judged.where("own = 'block'").select(F.col("key").alias("node"))
               .union(edges.where("own = 'block'").select("b")).distinct())
    aliases = (groups.join(blocked, "node", "left_semi").select("component").distinct()
               .join(groups, "component").select("node"))
    carried = blocked.union(aliases).distinct().select(F.col("node").alias("key"), F.lit(True).alias("carried"))
    return judged.join(carried, "key", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("own", F.when(F.col("carried"), "block").otherwise("allow")).alias("verdict"))
