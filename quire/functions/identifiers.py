"""Identifier and URL expressions: Column in, Column out, NULL for what does not normalise."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ALPHABET = "abcdefghijklmnopqrstuvwxyz234567"


def strip_prefix(x: Column, prefix: str) -> Column:
    """One mention of x, so that several of these in a row stay one short expression."""
    return F.regexp_replace(x, "^" + re.escape(prefix), "")


def clean_doi(raw: Column) -> Column:
    """Strict DOI: lower case ASCII without blanks, resolver prefixes removed one after another, one doubled slash repaired."""
    x = F.lower(F.trim(raw))
    bad = x.rlike(r"[ \x{2013}\x{00ac}]")
    for p in ("doi:", "http://", "https://", "doi.org/", "dx.doi.org/"):
        x = strip_prefix(x, p)
    x = F.regexp_replace(x, "^10\\.1037//", "10.1037/")
    return F.when(~bad & x.rlike(r"^10\.\d{4,}/[\x00-\x08\x0e-\x1f\x21-\x7f]+$"), x)


def lenient_doi(raw: Column) -> Column:
    """First token, lower case, five resolver prefixes in order, must start with 10."""
    x = F.lower(F.split(F.trim(raw), " ")[0])
    for p in ("doi:", "https://doi.org/", "http://doi.org/", "https://dx.doi.org/", "http://dx.doi.org/"):
        x = strip_prefix(x, p)
    return F.when(F.startswith(x, F.lit("10.")), x)


def orcid(raw: Column) -> Column:
    x = F.trim(strip_prefix(strip_prefix(raw, "https://orcid.org/"), "http://orcid.org/"))
    dashed = F.concat_ws("-", *(F.substring(x, i, 4) for i in (1, 5, 9, 13)))
    return F.when(~F.contains(x, F.lit("-")) & (F.length(x) == 16), dashed).otherwise(x)


def arxiv_versioned(raw: Column) -> Column:
    return F.when(raw.rlike(r".v[0-9]+$"), raw).otherwise(F.concat(raw, F.lit("v1")))


def source_id(source: str, key: Column) -> Column:
    """Deterministic id: the source and the SHA-1 of the key."""
    return F.concat(F.lit(source + "-"), F.sha1(key.cast("binary")))


def _bits(hex_digits: Column, digits: int) -> Column:
    parts = [F.lpad(F.conv(F.substring(hex_digits, i, 8), 16, 2), 32 if digits - i >= 7 else 4 * (digits - i + 1), "0") for i in range(1, digits + 1, 8)]
    return F.concat(*parts)


def hex_to_base32(hex_digits: Column, digits: int) -> Column:
    """Lower-case base32 without padding of `digits` hex digits."""
    n = -(-digits * 4 // 5)
    bits = F.rpad(_bits(hex_digits, digits), n * 5, "0")
    groups = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.substr(F.lit(ALPHABET), F.conv(F.substr(bits, i * 5 + 1, F.lit(5)), 2, 10).cast("int") + 1, F.lit(1)))
    return F.array_join(groups, "")


def base32_to_hex(text: Column, digits: int) -> Column:
    """`digits` hex digits of unpadded base32; surplus bits are dropped."""
    n = -(-digits * 4 // 5)
    low = F.lower(text)
    place = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.position(F.substr(low, i, F.lit(1)), F.lit(ALPHABET)) - 1)
    bits = F.array_join(F.transform(place, lambda v: F.lpad(F.conv(v.cast("string"), 10, 2), 5, "0")), "")
    return F.lower(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(digits - 1)), lambda i: F.conv(F.substr(bits, i * 4 + 1, F.lit(4)), 2, 16)), ""))


def uuid_to_short(uuid: Column) -> Column:
    """A UUID's 128 bits as 26 base32 characters."""
    return hex_to_base32(F.regexp_replace(F.lower(uuid), "-", ""), 32)


def short_to_uuid(text: Column) -> Column:
    h = base32_to_hex(text, 32)
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.when(text.rlike("^[a-zA-Z2-7]{26}$"), F.concat_ws("-", *(F.substring(h, *k) for k in cuts)))


def issn(x: Column) -> Column:
    return F.when(x.rlike(r"^\d{4}-\d{3}[0-9Xx]$"), F.upper(x))


def is_sha1(x: Column) -> Column:
    return x.rlike(r"^[0-9a-f]{40}$")


def blob_path(digest: Column) -> Column:
    """Content-addressed path: two levels of two characters, then the digest."""
    return F.concat_ws("/", F.substring(digest, 1, 2), F.substring(digest, 3, 2), digest)


def url_host(url: Column) -> Column:
    """Host with port, without user info, lower case."""
    return F.lower(F.regexp_replace(F.try_parse_url(url, F.lit("AUTHORITY")), r"^.*@", ""))


def registered_domain(host: Column) -> Column:
    """Last two labels, three below second-level public suffixes."""
    bare = F.regexp_replace(host, r":\d+$", "")
    return F.regexp_extract(bare, r"([^.]+\.(?:(?:ac|co|gov|org|net|com|edu)\.[a-z]{2}|[^.]+))$", 1)


def wayback_url(ts: Column, url: Column) -> Column:
    return F.concat(F.lit("https://web.archive.org/web/"), ts, F.lit("id_/"), url)


def access_url(url: Column, work: Column) -> Column:
    """Links to archived copies of a work become links that pass by its own pages; others, and those of no work, stay."""
    wayback = r"^https?://web\.archive\.org/web/\d{14}/(.*)"
    item = r"^https?://archive\.org/download/([^/]+)/(.*)"
    page = F.concat(F.lit("/work/"), work, F.lit("/access/"))
    return (
        F.when(F.coalesce(work, F.lit("")) == "", url)
        .when(url.rlike(wayback), F.concat(page, F.lit("wayback/"), F.regexp_extract(url, wayback, 1)))
        .when(url.rlike(item), F.concat(page, F.lit("ia_file/"), F.regexp_extract(url, item, 1), F.lit("/"), F.regexp_extract(url, item, 2)))
        .otherwise(url)
    )


def referrer_bucket(referrer: Column, buckets: tuple[tuple[str, str], ...]) -> Column:
    """Where a visit came from, by (name, part of the host) pairs, the first match winning: no referrer is `direct`, an unknown or unreadable one `other`."""
    host = F.lower(F.try_parse_url(referrer, F.lit("HOST")))
    out = F.when(F.coalesce(referrer, F.lit("")) == "", "direct")
    for name, part in buckets:
        out = out.when(F.contains(host, F.lit(part)), name)
    return out.otherwise("other")


#: Shapes of bare identifiers and the field that each is looked up in (fixed values).
IDENTIFIERS = (
    (r"^10\.\d{4,}/\S+$", "doi"),
    (r"(?i)^PMC\d+$", "pmcid"),
    (r"^\d{4}\.\d{4,5}(?:v\d+)?$", "arxiv_id"),
    (r"^[a-z-]+(?:\.[A-Z]{2})?/\d{7}$", "arxiv_id"),
)


def identifier_query(q: Column) -> Column:
    """A query that is a bare identifier, or a DOI's address, becomes a fielded one; the text is kept as it is."""
    x = F.regexp_replace(q, r"(?i)^https?://(?:dx\.)?doi\.org/", "")
    out = x
    for pattern, field in reversed(IDENTIFIERS):
        out = F.when(x.rlike(pattern), F.concat(F.lit(f'{field}:"'), x, F.lit('"'))).otherwise(out)
    return out


#: Where full texts are expected, by identifier, the likeliest first (fixed values).
FULL_TEXTS = (
    ("arxiv", "https://arxiv.org/pdf/{}.pdf"),
    ("pmcid", "http://europepmc.org/backend/ptpmcrender.fcgi?accid={}&blobtype=pdf"),
    ("doaj", "https://doaj.org/article/{}"),
    ("doi", "https://doi.org/{}"),
)


def full_text_urls(extids: Column, doaj_url: Column) -> Column:
    """Addresses of a release's full text in order of preference; the one that DOAJ itself names stands before DOAJ's page."""
    of = lambda k: F.nullif(F.try_element_at(extids, F.lit(k)), F.lit(""))
    out = []
    for k, form in FULL_TEXTS:
        head, tail = form.split("{}")
        if k == "doaj":
            out.append(F.when(of(k).isNotNull(), doaj_url))
        out.append(F.concat(F.lit(head), of(k), F.lit(tail)))
    return F.array_compact(F.array(*out))
