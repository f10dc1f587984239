"""URL and host functions over columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import values as V
from .text import let, strings, trim_blanks

PARTS = r"^([a-zA-Z][a-zA-Z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#[^\n]*)?\z"


def part(url: Column, k: int) -> Column:
    """1 scheme, 2 authority, 3 path, 4 query with its mark; '' where there is none."""
    return F.regexp_extract(url, PARTS, k)


def host(url: Column) -> Column:
    """Lower-cased host without userinfo and port."""
    return F.lower(F.regexp_replace(F.regexp_replace(part(url, 2), r"^[^\n]*@", ""), r":[0-9]*\z", ""))


def source_domain(url: Column) -> Column:
    return F.regexp_replace(host(url), r"^www\.", "")


def ip_number(h: Column) -> Column:
    """The IPv4 address as a number, null if ``h`` is none."""
    p = F.split(h, r"\.")
    value = sum((F.get(p, k).cast("long") * 256 ** (3 - k) for k in range(1, 4)), F.get(p, 0).cast("long") * 256**3)
    return F.when(h.rlike(r"^(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\.(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"), value)


def in_private_range(ip: Column) -> Column:
    hit = F.lit(False)
    for base, bits in V.PRIVATE_RANGES:
        n = sum(int(x) << (24 - 8 * i) for i, x in enumerate(base.split(".")))
        hit = hit | ip.between(n, n + 2 ** (32 - bits) - 1)
    return F.coalesce(hit, F.lit(False))


def blocked_host(h: Column) -> Column:
    """Local names, names without a dot, hexadecimal or decimal literals, IPv6 and private IPv4 addresses."""
    return let(
        h,
        lambda x: x.isin(*V.LOCAL_HOSTS) | x.endswith(".localhost") | x.endswith(".local") | x.endswith(".internal") | ~F.contains(x, F.lit(".")) | x.startswith("[")
        | x.rlike(r"^0x[0-9a-f]+$") | x.rlike(r"^[0-9]+$") | let(ip_number(x), in_private_range),
    )


def normalize_public_url(url: Column, allow_http: bool = False) -> Column:
    """The URL without its fragment, '' unless it is public: https (or http), no userinfo, default port, no blocked host."""
    u = trim_blanks(url)
    scheme, authority = F.lower(part(u, 1)), part(u, 2)
    port = F.regexp_extract(authority, r":([0-9]*)\z", 1)
    good = scheme.isin("https", "http") if allow_http else (scheme == "https")
    good = good & ~F.contains(authority, F.lit("@")) & ((port == "") | ((port == "443") & (scheme == "https")) | ((port == "80") & (scheme == "http"))) & ~blocked_host(host(u)) & ~u.rlike(r"[\s|]")
    path = F.when(part(u, 3) == "", F.lit("/")).otherwise(part(u, 3))
    return F.when(F.coalesce(good, F.lit(False)), F.concat(scheme, F.lit("://"), host(u), path, part(u, 4))).otherwise(F.lit(""))


def checked_fetch_url(url: Column, hosts: Column | None = None) -> Column:
    """The normalised URL; an unsafe one, or one whose host isn't among ``hosts`` (an array, if given), fails the job."""
    safe = normalize_public_url(url)
    good = (safe != "") if hosts is None else (safe != "") & F.array_contains(hosts, host(safe))
    return F.when(F.coalesce(good, F.lit(False)), safe).otherwise(F.raise_error(F.concat(F.lit("unsafe URL: "), F.coalesce(F.substring(url, 1, 160), F.lit("")))).cast("string"))


def path_key(url: Column) -> Column:
    """Host and path without one trailing slash; an unparsable URL: its first 200 characters, lower-cased."""
    return F.when(part(url, 2) != "", F.concat(host(url), F.regexp_replace(F.when(part(url, 3) == "", F.lit("/")).otherwise(part(url, 3)), "/$", ""))).otherwise(F.substring(F.lower(url), 1, 200))


def owner_domain(domain: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(F.trim(F.lower(domain)), "^.*@", ""), ":[^:]*$", ""), r"^www\.", "")


def _last_labels(h: Column, suffixes) -> Column:
    p = F.split(h, r"\.")
    two = F.array_join(F.slice(p, -2, 2), ".")
    return F.when(F.size(p) <= 2, h).when(two.isin(*suffixes), F.array_join(F.slice(p, -3, 3), ".")).otherwise(two)


def registrable_domain(h: Column) -> Column:
    """Owner by the coverage count's suffixes."""
    return _last_labels(h, V.COVERAGE_SUFFIXES)


def etld1(h: Column) -> Column:
    """Owner by the corroboration count's suffixes."""
    return _last_labels(F.regexp_replace(F.lower(h), r"^www\.", ""), V.CORROBORATION_SUFFIXES)


def domain_class(domain: Column) -> tuple[Column, Column]:
    """(tier, credibility) of a discovered domain; exact matches alone."""
    tier = credibility = None
    for name, value, domains in V.KNOWN_DOMAINS:
        hit = domain.isin(*domains)
        tier = F.when(hit, name) if tier is None else tier.when(hit, name)
        credibility = F.when(hit, F.lit(value)) if credibility is None else credibility.when(hit, F.lit(value))
    return tier.otherwise("news"), credibility.otherwise(F.lit(0.6))


def host_allowed(h: Column, domain: Column, extra=()) -> Column:
    return (h == domain) | (h == F.concat(F.lit("www."), domain)) | (F.array_contains(strings(extra), h) if extra else F.lit(False))
