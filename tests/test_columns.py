"""Sizes, locations, regions and errors, against plain Python where there is a counterpart."""

import os
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from partwise.functions.errors import EXIT_CODES, error_table
from partwise.functions.sizes import bytes_to_text
from partwise.operators.locations import FILE, SOURCE, STORE, classify_locations, derive_destination, resolve_region
from partwise.operators.rejects import reject_split
from partwise.operators.sizes import normalise_sizes, size_report

M = 1024**2


@pytest.mark.parametrize(
    "text, size",
    [
        ("0 ", 0), ("1 K", 1024), ("1 M", M), ("1 Gi", 1024**3), ("1 tera", 1024**4), ("0.5kilo", 512),
        ("0.1  byte", 0), ("1 k", 1024), ("7.", 7), (".5K", 512), ("12 foo", None), ("256MB", None), ("1.5.2", None),
        ("", None), (".", None), ("-1", None), ("1 kk", None), ("8E", None), ("99Y", None), ("7E", 7 * 1024**6), (None, None),
    ],
)
def test_size_text(spark, text, size):
    df = spark.createDataFrame([(text,)], "t string")
    row = normalise_sizes(df, "t", lo=0, hi=None).first()
    assert row["bytes"] == size
    assert (row["reject_reason"] is None) == (size is not None)


def test_size_bounds(spark):
    df = spark.createDataFrame([(t,) for t in ("5M", "5119K", "5G", "5121M", "1", "0")], "t string")
    upload = {r["t"]: r["reject_reason"] for r in normalise_sizes(df, "t").collect()}
    assert upload == {"5M": None, "5119K": "UserError", "5G": None, "5121M": "UserError", "1": "UserError", "0": "UserError"}
    download = {r["t"]: r["reject_reason"] for r in normalise_sizes(df, "t", lo=1, hi=None).collect()}
    assert [t for t, why in download.items() if why] == ["0"]


@pytest.mark.parametrize(
    "size, kwargs, text",
    [
        (0, {}, "0.0 "), (1, {}, "1.0 "), (1023, {}, "1023.0 "), (1024, {}, "1.0 K"), (M, {}, "1.0 M"), (9856, {}, "9.6 K"),
        (9856, {"symbols": "customary_ext"}, "9.6 kilo"), (9856, {"symbols": "iec"}, "9.6 Ki"),
        (9856, {"symbols": "iec_ext"}, "9.6 kibi"), (10000, {"suffix": "/sec"}, "9.8 K/sec"),
        (10000, {"decimals": 5}, "9.76562 K"), (1280, {}, "1.2 K"), (1792, {}, "1.8 K"), (2**62, {}, "4.0 E"), (-1, {}, None),
    ],
)
def test_size_shown(spark, size, kwargs, text):
    df = spark.createDataFrame([(size,)], "n bigint")
    assert df.select(bytes_to_text(F.col("n"), **kwargs)).first()[0] == text


def test_size_report(spark):
    parts = spark.createDataFrame([("a", 1024), ("a", 512), ("b", 0)], "k string, size bigint")
    rows = {r["k"]: (r["n_parts"], r["bytes"], r["human"]) for r in size_report(parts, ["k"]).collect()}
    assert rows == {"a": (2, 1536, "1.5 K"), "b": (1, 0, "0.0 ")}


URLS = [
    "s3://b/k", "s3://b/", "s3://b", "s3://", "s3:///k", "s3://b/k?v=1#f", "s3://b_1/a b", "http://h:80/a/b;p=1?q#f",
    "HTTP://H/x", "ftp://u@h/x;type=a", "file:/tmp/p", "file:///tmp/p", "file://localhost/p", "file://tmp/p",
    "mailto:x", "s3://b/ü/%20", "http://h", "x-y+z.1://a/b",
]


def test_urls_as_urlparse(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "u string")
    for row in classify_locations(df, "u", SOURCE).collect():
        parsed = urlparse(row["u"])
        assert (row["scheme"], row["authority"], row["path"]) == (parsed.scheme, parsed.netloc, parsed.path), row
        assert row["has_query"] == any(c in row["u"] for c in "?#")


PATHS = [
    "a", "./a", "../a", "../../../a", "/a", "/a/", "//a", "///a", "/a//b/../c/.", ".", "/", "/..", "./a:b", "x/./y/../z",
]


def test_paths_as_abspath(spark):
    df = spark.createDataFrame([(p,) for p in PATHS], "u string")
    for row in classify_locations(df, "u", SOURCE, "/base/dir").collect():
        wanted = urlparse("file://" + os.path.normpath(os.path.join("/base/dir", row["u"])))
        assert (row["scheme"], row["path"], row["authority"]) == ("file", wanted.path, wanted.netloc), row
        assert row["reject_reason"] is None


@pytest.mark.parametrize(
    "role, text, reason",
    [
        (SOURCE, "file://tmp/p", "InvalidSourceURL"), (SOURCE, "", "InvalidSourceURL"), (SOURCE, None, "InvalidSourceURL"),
        (SOURCE, "s3://b", "InvalidS3URL"), (SOURCE, "http://h/x", None), (SOURCE, "a b", None),
        (STORE, "s3://b/k", None), (STORE, "s3://b", "InvalidS3URL"), (STORE, "/a", "InvalidS3URL"), (STORE, "", "InvalidS3URL"),
        (STORE, "http://b/k", "InvalidS3URL"), (FILE, "/a/b", None), (FILE, "file:/a", None), (FILE, "s3://b/k", "InvalidDestinationURL"),
        (FILE, "/a/x.partial", "InvalidDestinationURL"), (FILE, "x.progress", "InvalidDestinationURL"), (FILE, "file://h/a", "InvalidSourceURL"),
    ],
)
def test_location_roles(spark, role, text, reason):
    df = spark.createDataFrame([(text,)], "u string")
    assert classify_locations(df, "u", role).first()["reject_reason"] == reason


def test_destinations(spark):
    df = spark.createDataFrame([("", "/a/b"), ("d/", "/a/b"), ("k", "/a/b"), ("d/", "/a/")], "key string, path string")
    assert [r["dst_key"] for r in derive_destination(df).collect()] == ["b", "d/b", "k", "d/"]


def test_regions(spark):
    df = spark.createDataFrame([("",), ("us-west-1",), (None,)], "location string")
    assert [tuple(r) for r in resolve_region(df).collect()] == [
        ("", "us-east-1", "https://s3.amazonaws.com", None),
        ("us-west-1", "us-west-1", "https://s3-us-west-1.amazonaws.com", None),
        (None, None, None, "PermissionDenied"),
    ]


def test_errors(spark):
    assert {r[0]: r[1] for r in error_table(spark).collect()} == EXIT_CODES
    df = spark.createDataFrame([(1, None), (2, "FileExists"), (3, "Odd")], "i int, why string")
    good, bad = reject_split(df, "why")
    assert [tuple(r) for r in good.collect()] == [(1,)]
    assert {tuple(r) for r in bad.collect()} == {(2, "FileExists", 11), (3, "Odd", 1)}
