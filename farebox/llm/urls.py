"""URL filters with redirect equivalence (operator 9), DataFrame functions only.

A page's address, its canonical link and its refresh redirect are aliases.
Connected components over these edges carry a block decision to every alias; a
page that a rule allows explicitly stays allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import materialize
from farebox.llm.components import connected_components

# Fixed values: (verdict, host, path); the longest that fits wins.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _with_parts(df: DataFrame, url: str, name: str) -> DataFrame:
    """``df`` with ``name``_host, ``name``_path and ``name``_query (with its ``?``), all empty where there is no
    ``://``, and ``name``_node: the address without scheme and fragment, null for no host.

    The parts are cut off one column at a time, so that no expression is repeated inside another.
    """
    after, raw, rest = f"__{name}_after", f"__{name}_raw", f"__{name}_rest"
    host, path, query = f"{name}_host", f"{name}_path", f"{name}_query"
    df = df.withColumn(after, F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit("")))
    df = df.withColumn(raw, F.regexp_extract(after, r"^[^/?#]*", 0))
    df = df.withColumn(rest, F.substring(F.col(after), F.length(raw) + 1, F.length(after)))
    df = (df.withColumn(host, F.translate(raw, _UPPER, _LOWER))
          .withColumn(path, F.regexp_extract(rest, r"^[^?#]*", 0))
          .withColumn(query, F.regexp_extract(rest, r"^[^?#]*(\?[^#]*)?", 1)))
    node = F.concat(host, F.when(F.col(path) == "", F.lit("/")).otherwise(F.col(path)), query)
    return df.withColumn(f"{name}_node", F.when(F.col(host) != "", node)).drop(after, raw, rest)


def _longest_rule(host: Column, path: Column, rules: list[tuple[str, str, str]], value) -> Column:
    out = None
    for rule in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == rule[1]) | host.endswith("." + rule[1])) & path.startswith(rule[2])
        out = F.when(fits, F.lit(value(rule))) if out is None else out.when(fits, F.lit(value(rule)))
    return out if out is not None else F.lit(None).cast("string")


def _target(link: Column, host: Column, path: Column) -> Column:
    """Absolute form of a link found on a page; null where it leads nowhere else."""
    link = F.trim(F.replace(link, F.lit("&amp;"), F.lit("&")))
    here = F.concat(F.lit("http://"), host)
    return (F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
            .when((link == "") | link.startswith("#") | link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), None)
            .when(link.startswith("//"), F.concat(F.lit("http:"), link))
            .when(link.startswith("/"), F.concat(here, link))
            .when(link.startswith("?"), F.concat(here, path, link))
            .otherwise(F.concat(here, F.regexp_extract(F.concat(F.lit("/"), path), r"^/(.*/|)", 1), link)))


def _resolved(path: Column) -> Column:
    """``path`` without its ``.`` and ``..`` segments."""
    def step(acc, part):
        up = F.regexp_replace(acc, r"/[^/]*$", "")
        return F.when(part == ".", acc).when(part == "..", up).otherwise(F.concat(acc, F.lit("/"), part))

    parts = F.slice(F.split(path, "/"), F.lit(2), F.size(F.split(path, "/")))
    kept = F.aggregate(parts, F.lit(""), step)
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.when(path.rlike(r"/\.\.?$"), F.concat(kept, F.lit("/"))).otherwise(kept)).otherwise(path)


def _attribute(tag: Column, name: str, stop: str) -> Column:
    """Value of an attribute, quoted or not (then up to one of ``stop``)."""
    found = F.regexp_extract_all(tag, F.lit(rf"""(?is)\b{name}\s*=\s*("[^"]*"|'[^']*'|[^{stop}]*)"""), F.lit(1))
    return F.regexp_replace(F.coalesce(F.get(found, F.lit(0)), F.lit("")), r"""^["']|["']$""", "")


def alias_edges(pages: DataFrame) -> DataFrame:
    """(src, dst) node names from every canonical link and refresh redirect; null where a link leads nowhere."""
    html = F.col("html")
    tags = F.when(html.rlike("(?i)canonical|refresh"), F.regexp_extract_all(html, F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0)))
    tags = pages.select("url", F.explode(tags).alias("tag"))
    content = _attribute(F.col("tag"), "content", r"\s>")
    link = (F.when(_attribute(F.col("tag"), "rel", r"\s>").rlike(r"(?i)(^|\s)canonical(\s|$)"), _attribute(F.col("tag"), "href", r"\s>"))
            .when(_attribute(F.col("tag"), "http-equiv", r"\s>").rlike(r"(?i)^\s*refresh\s*$"),
                  F.regexp_extract(content, r"""(?is)\burl\s*=\s*["']?([^"'>]*)""", 1)))
    links = tags.select("url", link.alias("link")).where("link <> ''")
    links = _with_parts(links, "url", "src")
    links = links.withColumn("dst", _target(F.col("link"), F.col("src_host"), F.col("src_path")))
    ends = _with_parts(links, "dst", "dst")
    path = F.when(F.col("dst_path") == "", F.lit("/")).otherwise(_resolved(F.col("dst_path")))
    return ends.select(F.col("src_node").alias("src"), F.when(F.col("dst_host") != "", F.concat("dst_host", path, "dst_query")).alias("dst"))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule, verdict.

    A page under a rule gets the rule's verdict.  Any other is blocked if an address
    in its component is under a block rule, and allowed otherwise.  Null urls and
    urls without ``://`` have empty host and path, no rule and no aliases; a null html has no links;
    repeated rows get equal results; other columns are ignored; an empty table gives none.
    """
    judged = _with_parts(pages.select("page_id", "url"), "url", "url")
    name = _longest_rule(F.col("url_host"), F.col("url_path"), rules, lambda r: r[1] + r[2])
    own = _longest_rule(F.col("url_host"), F.col("url_path"), rules, lambda r: r[0])
    judged = judged.select("page_id", F.col("url_host").alias("host"), F.col("url_path").alias("path"),
                           F.col("url_node").alias("node"), name.alias("rule"), own.alias("own"))

    comps = connected_components(materialize(alias_edges(pages), "alias_edges"))
    at = _with_parts(comps.withColumn("address", F.concat(F.lit("http://"), F.col("node"))), "address", "at")
    rule = _longest_rule(F.col("at_host"), F.col("at_path"), rules, lambda r: r[0])
    blocked = (at.withColumn("hit", F.coalesce(rule == "block", F.lit(False)))
               .groupBy("component").agg(F.max("hit").alias("hit")).where("hit"))
    aliases = comps.join(blocked, "component").select("node", "hit")
    verdict = F.coalesce("own", F.when(F.col("hit"), F.lit("block")).otherwise(F.lit("allow")))
    return judged.join(aliases, "node", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"))
