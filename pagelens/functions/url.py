"""URL functions: host, path, slug, hash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelens.functions.common import col

# Host of an absolute (scheme://) or protocol-relative (//host) URL.
HOST_RE = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"
# Path: after an optional scheme and authority, up to '?' or '#'.
PATH_RE = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)"


def url_host(c) -> Column:
    """Host of a link as written (case kept); '' when it has none (relative, mailto:)."""
    return F.regexp_extract(col(c), HOST_RE, 1)


def url_path(c) -> Column:
    """Path of a URL, '/' when it has none."""
    p = F.regexp_extract(col(c), PATH_RE, 1)
    return F.when(p == "", F.lit("/")).otherwise(p)


def url_slug(path) -> Column:
    """``__root__`` for the site root, else the path without leading slashes."""
    p = col(path)
    return F.when(p.isin("/", ""), F.lit("__root__")).otherwise(F.ltrim(p, F.lit("/")))


def url_hash(c) -> Column:
    return F.md5(col(c))
