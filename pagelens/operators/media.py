"""Media planning: upload acceptance, file names, base64 images, dedup by URL
hash, batch upload outcomes and orphan cleanup. No network or file I/O: the
image bytes/metadata arrive as columns; the jobs decide what to store/delete.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelens.functions.common import col, falsy

# Accepted MIME types -> file extension; size limit (10 MB).
MIME_EXT = (("image/jpeg", "jpg"), ("image/png", "png"), ("image/gif", "gif"), ("image/webp", "webp"))
MAX_FILE_SIZE = 10485760
FALLBACK_NAME_PREFIX = "echo5-image-"
URL_RE = r"^[A-Za-z][A-Za-z0-9+.-]*://[^\s/?#]+[^\s]*$"


def is_valid_url(c) -> Column:
    """scheme://host... with no whitespace (FILTER_VALIDATE_URL shape)."""
    return F.coalesce(col(c).rlike(URL_RE), F.lit(False))


def mime_extension(mime) -> Column:
    """Extension for a MIME type; 'jpg' when unknown."""
    m = col(mime)
    out = F.lit("jpg")
    for t, e in reversed(MIME_EXT):
        out = F.when(m == t, F.lit(e)).otherwise(out)
    return out


def sniffed_type(head_hex) -> Column:
    """MIME type told from an image's first bytes (hex text); NULL when they are none of the accepted types'."""
    h = F.upper(col(head_hex))
    return (F.when(h.startswith("FFD8FF"), "image/jpeg").when(h.startswith("89504E470D0A1A0A"), "image/png")
            .when(h.startswith("474946383761") | h.startswith("474946383961"), "image/gif")
            .when(h.startswith("52494646") & (F.substring(h, 17, 8) == "57454250"), "image/webp"))


def image_accept(images: DataFrame, url_col: str = "source_url", mime_col: str = "mime_type",
                 size_col: str = "n_bytes", head_col: str | None = "head_hex") -> DataFrame:
    """Upload checks: valid url, supported type, size <= 10 MB; reason of the first failure.

    A type that is not supported as declared is told from the first bytes (``head_col``, hex), if there are any.
    """
    types = [t for t, _ in MIME_EXT]
    declared = F.col(mime_col)
    if head_col in images.columns:
        images = images.withColumn(mime_col, F.when(declared.isin(*types), declared).otherwise(F.coalesce(sniffed_type(head_col), declared)))
    ok_type = F.coalesce(F.col(mime_col).isin(*types), F.lit(False))
    reason = (F.when(~is_valid_url(F.col(url_col)), F.lit("invalid_url"))
              .when(~ok_type, F.lit("invalid_type"))
              .when(F.col(size_col) > MAX_FILE_SIZE, F.lit("file_too_large")))
    return images.select("*", reason.isNull().alias("accepted"), reason.alias("reason"),
                         mime_extension(F.col(mime_col)).alias("extension"))


def _byte_prefix(s: Column, n: int) -> Column:
    """First ``n`` bytes of a UTF-8 string (a cut character becomes U+FFFD)."""
    return F.decode(F.substring(F.encode(s, "UTF-8"), 1, n), "UTF-8")


def image_filename(url, alt, extension, epoch_seconds) -> Column:
    """SEO file name: alt-based (50 bytes, [a-z0-9-]) or url base name, + 6-char unique suffix.

    The suffix is md5(url || time) as in the reference; time is an argument.
    """
    u, a = col(url), col(alt)
    from_alt = F.lower(_byte_prefix(a, 50))
    from_alt = F.regexp_replace(F.regexp_replace(from_alt, "[^a-z0-9-]", "-"), "-+", "-")
    from_alt = F.btrim(from_alt, F.lit("-"))
    path = F.regexp_extract(u, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    base = F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"\.[^.]*$", "")
    base = F.when(falsy(base) | (F.octet_length(base) < 3),
                  F.concat(F.lit(FALLBACK_NAME_PREFIX), F.substring(F.md5(u), 1, 8))).otherwise(base)
    stem = F.when(~falsy(a), from_alt).otherwise(base)
    unique = F.substring(F.md5(F.concat(u, col(epoch_seconds).cast("string"))), 1, 6)
    return F.concat(stem, F.lit("-"), unique, F.lit("."), col(extension))


def sanitize_title(c) -> Column:
    """Slug form: lower case, runs of non [a-z0-9] -> '-', trimmed dashes."""
    s = F.regexp_replace(F.lower(col(c)), "[^a-z0-9]+", "-")
    return F.btrim(s, F.lit("-"))


def base64_image(data, alt, date) -> Column:
    """Decode a (data-URI or raw) base64 image: struct(ok, mime, n_bytes, filename).

    Strict decode as in PHP: whitespace is skipped, any other character
    outside the alphabet fails, at most two '=' at the end, a lone trailing
    sextet fails, padding (when present) completes a 4-char group. Fewer than
    100 bytes is rejected. Name = date-<alt slug, 40 chars or 'blog-image'>-
    <md5(bytes)[0:6]>.<ext>.
    """
    d = col(data)
    prefix = F.regexp_extract(d, r"^data:(image/\w+);base64,", 0)
    mime = F.when(prefix != "", F.regexp_extract(d, r"^data:(image/\w+);base64,", 1)).otherwise(F.lit("image/jpeg"))
    payload = F.when(prefix != "", F.substring(d, F.length(prefix) + 1, 1 << 30)).otherwise(d)
    p = F.regexp_replace(payload, r"\s", "")
    core = F.regexp_replace(p, "=+$", "")
    pad = F.length(p) - F.length(core)
    valid = (core.rlike("^[A-Za-z0-9+/]*$") & (pad <= 2) & (F.length(core) % 4 != 1)
             & ((pad == 0) | ((F.length(core) + pad) % 4 == 0)))
    raw = F.when(valid, F.try_to_binary(core, F.lit("base64")))
    ok = raw.isNotNull() & (F.octet_length(raw) >= 100)
    ext = mime_extension(mime)
    stem = F.when(~falsy(col(alt)), F.substring(sanitize_title(col(alt)), 1, 40)).otherwise(F.lit("blog-image"))
    name = F.concat(F.date_format(col(date), "yyyy-MM-dd"), F.lit("-"), stem, F.lit("-"),
                    F.substring(F.md5(raw), 1, 6), F.lit("."), ext)
    return F.struct(ok.alias("ok"), mime.alias("mime"), F.octet_length(raw).cast("bigint").alias("n_bytes"),
                    F.when(ok, name).alias("filename"))


def media_dedup(requests: DataFrame, attachments: DataFrame, url_col: str = "url") -> DataFrame:
    """Mark requested image urls already in the library (md5(url) = stored hash)."""
    lib = attachments.select(F.col("url_hash").alias("_h"), F.col("id").alias("existing_id")) \
        .groupBy("_h").agg(F.min("existing_id").alias("existing_id"))
    r = requests.withColumn("_h", F.md5(F.col(url_col)))
    return (r.join(lib, "_h", "left").withColumn("duplicate", F.col("existing_id").isNotNull()).drop("_h"))


def media_upload_summary(requests: DataFrame, attachments: DataFrame, batch_col: str = "batch_id",
                         url_col: str = "url") -> DataFrame:
    """Per upload batch: success / duplicate / failed counts.

    The per-image outcomes stay rows (``upload_outcomes``); only counts are
    aggregated, so a huge batch is never gathered into one row.
    """
    d = upload_outcomes(requests, attachments, url_col)
    return (d.groupBy(batch_col, "outcome").agg(F.count(F.lit(1)).cast("bigint").alias("n")))


def upload_outcomes(requests: DataFrame, attachments: DataFrame, url_col: str = "url") -> DataFrame:
    """Per requested image: failed (invalid url), duplicate (already stored) or success."""
    d = media_dedup(requests, attachments, url_col)
    outcome = (F.when(~is_valid_url(F.col(url_col)), F.lit("failed"))
               .when(F.col("duplicate"), F.lit("duplicate")).otherwise(F.lit("success")))
    return d.withColumn("outcome", outcome)


def orphan_media(attachments: DataFrame, postmeta: DataFrame, as_of: str, older_than_days: int = 30,
                 batch: int | None = None) -> DataFrame:
    """Uploads to delete: parent 0, ours, older than N days, not used as any post's featured
    image; the newest ``batch`` of these if given."""
    cutoff = F.to_timestamp(F.lit(as_of)) - F.expr(f"INTERVAL {int(older_than_days)} DAYS")
    cand = (attachments.filter((F.col("post_parent") == 0) & F.col("uploaded_by_us")
                               & (F.col("post_date").cast("timestamp") < cutoff)))
    used = postmeta.filter(F.col("meta_key") == "_thumbnail_id").select(
        F.col("meta_value").try_cast("bigint").alias("id")).distinct()
    orphans = cand.join(used, "id", "left_anti").select("id", "source_url", "post_date")
    return orphans if batch is None else orphans.orderBy(F.col("post_date").desc(), F.col("id").desc()).limit(batch)
