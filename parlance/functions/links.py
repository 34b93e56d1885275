"""Links and bare hosts: what a policy shows of them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.policy import Anonymize

_HOST = re.compile(r"^(?:[a-z][a-z0-9+.-]*://)?(?:[^/?#@\s]*@)?(\[[0-9a-f:]+\]|[^/:?#\s\[\]]+)(?::\d+)?(?=[/?#]|$)", re.IGNORECASE)
#: Suffixes of bare hosts, and those that are also words and make a host in one case only.
SUFFIXES = "com net org info biz ru рф kz ua by uz kg am ge az io me co uk de fr es it in us eu app dev online site store shop pro tv cc su ai xyz top club money pay tech cloud live news agency digital finance games".split()
WORDS = frozenset("money pay store app it in me shop pro live news top club site online cloud games digital finance agency tech us".split())
BARE = re.compile(rf"(?<![\w@./-])(?:[\w](?:[\w-]{{0,61}}[\w])?\.){{1,4}}(?P<tld>{'|'.join(sorted(SUFFIXES, key=len, reverse=True))})(?![\w-])(?!\.\w)", re.IGNORECASE)
#: What every bare host ends with.
BARE_END = re.compile(rf"\.(?:{'|'.join(sorted(SUFFIXES, key=len, reverse=True))})(?![\w-])", re.IGNORECASE)
DOCUMENT = re.compile(r"\.(?:md|py|js|txt|json|xml|pdf|docx?|xlsx?|png|jpe?g)$", re.IGNORECASE)


def host_of(url: str) -> str:
    """Host of a link in lower case; empty if it has none that can be read."""
    m = _HOST.match(url)
    return m[1].lower() if m else ""


def allowed(host: str, entries: tuple[str, ...]) -> str | None:
    """How a host is shown if `entries` allow it: itself, or `<sub>.base` under a wildcard."""
    for e in entries:
        e = e.lower()
        if e.startswith("*."):
            if host == e[2:]:
                return host
            if host.endswith(e[1:]):
                return f"<sub>{e[1:]}"
        elif host == e:
            return host
    return None


def is_bare_host(m: re.Match) -> bool:
    """Whether a dotted name is a host: word suffixes only in one case throughout, no document names."""
    text, tld = m[0], m["tld"]
    if DOCUMENT.search(text):
        return False
    return tld.lower() not in WORDS or text.islower() or text.isupper()


def keeps_host(host: str, keep_terms: frozenset[str]) -> bool:
    """A host that is a keep term, or a keep term with one suffix."""
    return host in keep_terms or host.rpartition(".")[0] in keep_terms


def url_placeholder(url: str, policy: Anonymize, names: re.Pattern | None = None) -> str | None:
    """Replacement of a link, or None if the policy keeps it."""
    host = host_of(url)
    if not host:
        return "<url>"
    shown = allowed(host, policy.allow_domains)
    if shown is not None:
        return None if shown == host else url.replace(host, shown, 1)
    if policy.url_mode == "keep":
        return None
    if policy.url_mode == "domain":
        return "<url>" if names and names.search(re.sub(r"[.-]", " ", host)) else f"<url:{host}>"
    return "<url>"


def url_host(url: Column) -> Column:
    """Host of a link as a column; empty if it has none."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@ ]*@)?([^/:?# ]+)", 1))


def url_shown(url: Column, mode: str, allow: tuple[str, ...] = ()) -> Column:
    """The policy as a column expression: allow list first, then drop, domain or keep."""
    host = url_host(url)
    out = F.when(host == "", F.lit("<url>"))
    for e in allow:
        if e.startswith("*."):
            out = out.when(host == e[2:], host).when(host.endswith(e[1:]), F.lit(f"<sub>{e[1:]}"))
        else:
            out = out.when(host == e, host)
    return out.otherwise({"drop": F.lit("<url>"), "domain": F.concat(F.lit("<url:"), host, F.lit(">")), "keep": url}[mode])


def domain_counts(messages: DataFrame, top: int = 100) -> DataFrame:
    """Rows (host, n): the commonest hosts of links in texts and in entities (type, url)."""
    written = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r'(?i)[a-z][a-z0-9+.-]*://[^\s<>"]+'), 0)
    behind = F.filter(F.transform(F.coalesce("entities", F.array().cast(messages.schema["entities"].dataType)), lambda e: e["url"]), lambda u: u.isNotNull())
    hosts = messages.select(F.explode(F.concat(written, behind)).alias("link")).select(url_host(F.col("link")).alias("host")).where("host <> ''")
    return hosts.groupBy("host").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "host").limit(top)
