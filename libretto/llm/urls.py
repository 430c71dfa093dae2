"""URL filters with redirect equivalence.

Rules (host, path, verdict) fit a host with all of its subdomains and every path that starts with
the rule's; the longest fitting rule wins. A url without a rule of its own takes the decision of
its aliases: urls that redirects or canonical links connect, found as distributed connected
components. A block rule on any alias blocks the urls of its component that no rule judges; an
explicit allow stands above a propagated block. Everything else is allowed.

Targets are read as browsers do: entities are decoded, relative and protocol-relative addresses are
resolved against the page's url and its <base href>, if it has one. Nodes are addresses without
#fragment and with the scheme in lower case; a relative target on a page without an absolute url
names nothing.

Nulls, urls without "://" and empty urls have an empty host and path, no rule and verdict allow;
equal urls are one node; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator, Sequence
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from libretto.llm.common import components, lean

#: (host, path, verdict)
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))

#: Tags that name a page's canonical address or send the reader on, as the SQL reads them: absolute targets, taken literally.
LINKS = (
    r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*\bhref\s*=\s*["']?([^"'\s>]+)""",
    r"""(?is)<link\b[^>]*\bhref\s*=\s*["']?([^"'\s>]+)[^>]*\brel\s*=\s*["']?canonical\b""",
    r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*\burl\s*=\s*["']?([^"'\s>;]+)""",
    r"""(?is)<meta\b[^>]*\burl\s*=\s*["']?([^"'\s>;]+)[^>]*\bhttp-equiv\s*=\s*["']?refresh\b""",
)


def host_of(url: Column) -> Column:
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def judged(df: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, url: str = "url") -> DataFrame:
    """Adds host, path, rule and _own_verdict (the verdict of the url's own rule, else null)."""
    out = df.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    rule = own = None
    for host, path, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit(path))
        rule = F.when(fits, host + path) if rule is None else rule.when(fits, host + path)
        own = F.when(fits, verdict) if own is None else own.when(fits, verdict)
    none = F.lit(None).cast("string")
    return out.withColumn("rule", none if rule is None else rule).withColumn("_own_verdict", none if own is None else own)


_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|["']?[^\s"'>]+))?""")
_REFRESH = re.compile(r"""\burl\s*=\s*(?:"([^"]*)|'([^']*)|(.*))""", re.I | re.S)
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*://"


def node_column(url: Column) -> Column:
    """The node of a page's url."""
    return F.concat(F.lower(F.regexp_extract(url, _SCHEME, 0)), F.regexp_replace(F.regexp_replace(url, _SCHEME, ""), "(?s)#.*", ""))


def node_of(address: str, base: str) -> str | None:
    """The node that `address` names at `base`; None if it is not absolute."""
    address = re.sub(r"[\t\r\n]", "", address).strip()
    if not (m := re.match(_SCHEME, address)):
        try:
            address = urljoin(base, address)
        except ValueError:  # e.g. an unclosed bracket in the host
            return None
        m = re.match(_SCHEME, address)
    return m and m[0].lower() + address[m.end() :].partition("#")[0]


def targets(tags: list[str], url: str) -> list[str]:
    """Nodes that a page's link and meta tags name as its canonical address or send the reader on to."""
    base, found = None, []
    for tag in tags:
        own: dict[str, str] = {}
        name, *attributes = _ATTRIBUTE.findall(tag[1:])
        for key, value in attributes:
            own.setdefault(key.lower(), entities.unescape(value.strip("\"'")) if value else "")
        kind = name[0].lower()
        if kind == "base" and base is None and "href" in own:
            base = node_of(own["href"], url)
        elif kind == "link" and "canonical" in own.get("rel", "").lower().split():
            found.append(own.get("href"))
        elif kind == "meta" and own.get("http-equiv", "").strip().lower() == "refresh":
            # By mistake some have the address in an attribute of its own.
            got = _REFRESH.search(own.get("content", ""))
            found.append(next(x for x in got.groups() if x is not None) if got else own.get("url"))
    return [n for x in found if x and x.strip() and (n := node_of(x, base or url))]


def edges_of(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Redirect and canonical-link edges (src, dst) between nodes that the pages themselves state."""
    lean(pages.sparkSession)

    def run(frame: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frame:
            rows = zip(*(batch.column(c).to_pylist() for c in ("src", "url", "tags")), strict=True)
            out = [(src, dst) for src, at, tags in rows for dst in targets(tags, at)]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.string()) for k in (0, 1)], names=["src", "dst"])

    rows = pages.where(F.col(url).isNotNull() & F.col(html).rlike("(?i)canonical|refresh"))
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<(?:link|meta|base)\b[^>]*"), 0)
    return rows.select(node_column(F.col(url)).alias("src"), F.col(url).alias("url"), tags.alias("tags")).mapInArrow(run, "src string, dst string").where("src <> dst")


def filtered(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, redirects: DataFrame | None = None, url: str = "url", html: str | None = "html") -> DataFrame:
    """The rows of pages with host, path, rule and verdict; redirects: further edges (src, dst), of absolute urls."""
    own = judged(pages, rules, url)
    edges = None if html is None else edges_of(pages, url, html)
    if redirects is not None:
        more = redirects.select(node_column(F.col("src")).alias("src"), node_column(F.col("dst")).alias("dst")).where("src is not null and dst is not null")
        edges = more if edges is None else edges.unionByName(more)
    if edges is None:
        return own.withColumn("verdict", F.coalesce("_own_verdict", F.lit("allow"))).drop("_own_verdict")
    part = components(edges.select(F.col("src").alias("u"), F.col("dst").alias("v")))
    # Nodes that no page has may carry the rule too, e.g. the target of a redirect.
    blocked = judged(part, rules, "node").where("_own_verdict = 'block'").select("component").distinct()
    aliases = part.join(blocked, "component", "left_semi").select(F.col("node").alias("_node"), F.lit("block").alias("_moved"))
    out = own.join(aliases, node_column(own[url]) == F.col("_node"), "left")
    return out.withColumn("verdict", F.coalesce("_own_verdict", "_moved", F.lit("allow"))).drop("_own_verdict", "_node", "_moved")
