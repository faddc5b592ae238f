"""URL algebra and allow-list predicates."""

from __future__ import annotations

import re
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Schemes that are never followed, before ":" or "(".
REJECTED = ("javascript", "vbscript", "data", "mailto", "tel")


_SCHEMES = rf"^({'|'.join(REJECTED)})\s*[:(]"


def resolve(base: str | None, href: str | None) -> str | None:
    """An absolute http(s) URL without fragment, or None."""
    text = (href or "").strip()
    if not text or re.match(_SCHEMES, text, re.IGNORECASE):
        return None
    try:
        url = urlsplit(urljoin(base or "", text))
        if url.scheme in ("http", "https") and url.hostname:
            return url._replace(netloc=url.netloc.lower(), path=url.path or "/", fragment="").geturl()
    except ValueError:
        return None
    return None


@F.pandas_udf(StringType())
def _resolved(base: pd.Series, href: pd.Series) -> pd.Series:
    return pd.Series([resolve(b, h) for b, h in zip(base, href, strict=True)], dtype=object)


#: Absolute URLs of plain characters, on which no library disagrees: scheme, host and port, path, query, fragment.
_ABSOLUTE = r"^(?i:(https?))://([A-Za-z0-9._-]+(?::[0-9]+)?)(/[!$&-;=@-Z_a-z~%]*)?(\?[!$&-;=?@-Z_a-z~%/]*)?(#[!-~]*)?$"


def normalize_absolute(c: Column) -> Column:
    """A URL that has a scheme and host in normal form, as a native expression; null for any other."""
    part = lambda k: F.regexp_extract(c, _ABSOLUTE, k)
    path = F.when(part(3) == "", "/").otherwise(part(3))
    return F.when(c.rlike(_ABSOLUTE) & ~c.rlike(r"/\.{1,2}(/|$|\?|#)"), F.concat(F.lower(part(1)), F.lit("://"), F.lower(part(2)), path, F.when(part(4) == "?", "").otherwise(part(4))))


def normalize_url(base, href) -> Column:
    """href against base in normal form, or null. Plain absolute links are native; only others reach Python."""
    base, href = (F.col(x) if isinstance(x, str) else x for x in (base, href))
    native = normalize_absolute(href)
    return F.coalesce(native, _resolved(F.when(native.isNull(), base), F.when(native.isNull(), href)))


def host_of(c: Column) -> Column:
    """The lower-case host, without user and port; null without one."""
    return F.nullif(F.lower(F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def is_https(c: Column) -> Column:
    return F.lower(F.substring(c, 1, 8)) == "https://"


def robots_url(c: Column) -> Column:
    return F.nullif(F.concat(F.regexp_extract(c, r"^([a-z]+://[^/?#]+)", 1), F.lit("/robots.txt")), F.lit("/robots.txt"))


def is_allowed_candidate(url: Column, enabled: Column, official: Column, domains: Column, prefixes: Column) -> Column:
    """https, an enabled official source, a listed host and a listed prefix of the string."""
    listed = F.array_contains(F.transform(domains, F.lower), host_of(url)) & F.exists(prefixes, lambda p: F.startswith(url, p))
    return F.coalesce(is_https(url) & enabled & official & listed, F.lit(False))


def is_allowed_fetch(url: Column, entrypoints: Column, *policy: Column) -> Column:
    """A configured entrypoint, or an allowed candidate."""
    return F.coalesce(F.array_contains(F.transform(entrypoints, normalize_absolute), url), F.lit(False)) | is_allowed_candidate(url, *policy)
