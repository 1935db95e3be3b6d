"""URL and path text taken apart with built-in string functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_URL = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)"

# Schemes whose last path segment may carry ";parameters".
PARAMETER_SCHEMES = [
    "ftp", "hdl", "prospero", "http", "imap", "https", "shttp", "rtsp", "rtsps", "rtspu", "sip", "sips", "mms", "sftp", "tel",
]


def split_url(url: Column) -> Column:
    """STRUCT(scheme, authority, path): query and fragment are cut off, nothing is decoded."""
    scheme = F.lower(F.regexp_extract(url, _URL, 1))
    path = F.regexp_extract(url, _URL, 3)
    return F.struct(
        scheme.alias("scheme"),
        F.regexp_extract(url, _URL, 2).alias("authority"),
        F.when(scheme.isin(PARAMETER_SCHEMES), F.regexp_replace(path, r";[^/]*$", ""))
        .otherwise(path)
        .alias("path"),
    )


def absolute_path(path: Column, base_dir: str) -> Column:
    """Path joined to base_dir with "." and ".." segments folded away."""
    full = F.when(path.startswith("/"), path).otherwise(
        F.concat(F.lit(base_dir.rstrip("/") + "/"), path)
    )
    kept = F.filter(F.split(full, "/"), lambda s: (s != "") & (s != "."))
    folded = F.aggregate(
        kept,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(
            s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))
        ).otherwise(F.concat(acc, F.array(s))),
    )
    # POSIX: exactly two leading slashes are kept, any other number counts as one.
    root = F.when(full.rlike("^//(?!/)"), F.lit("//")).otherwise(F.lit("/"))
    return F.concat(root, F.array_join(folded, "/"))


def is_path(text: Column) -> Column:
    """Neither "." nor "/" starts a URL, and a URL has a colon."""
    return text.startswith("/") | text.startswith(".") | ~text.contains(":")


def to_url(text: Column, base_dir: str) -> Column:
    return F.when(is_path(text), F.concat(F.lit("file://"), absolute_path(text, base_dir))).otherwise(text)


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)
