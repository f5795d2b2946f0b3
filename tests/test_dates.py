"""The date grammar against the plain parser of the standard library."""

import random
from datetime import datetime, timezone

from pyspark.sql import functions as F

from gripelode.functions import keys


def plain(value):
    txt = value.strip().replace("Z", "+00:00")
    for read in (datetime.fromisoformat, *(lambda t, f=f: datetime.strptime(t, f) for f in ("%Y-%m-%d %H:%M:%S", "%Y-%m-%d", "%a, %d %b %Y %H:%M:%S %z"))):
        try:
            found = read(txt)
        except ValueError:
            continue
        return (found if found.tzinfo else found.replace(tzinfo=timezone.utc)).astimezone(timezone.utc).replace(tzinfo=None)
    return None


def parsed(spark, values):
    frame = spark.createDataFrame(list(enumerate(values)), "i int, v string").select("i", keys.parse_time(F.col("v")).alias("t"))
    return [r["t"] for r in sorted(frame.collect(), key=lambda r: r["i"])]


DATES = ["2024-02-29", "20240229", "2024-W09-4", "2024W094", "2024-W09", "2024W09", "2020-W53-7", "2021-W53-1", "2024-W00-1", "2024-W10-8", "2024-W10-0", "2023-02-29", "2024-13-01", "2024-00-10", "0001-01-02", "9999-12-30", "2009-W01-1", "2008-W01-1", "2010-W53"]
CLOCKS = ["", "T10", " 10", "T10:20", "T1020", " 10:20:30", "T102030", "x10:20:30", "T10:20:30.1", "T10:20:30,123456", "T10:20:30.123456789", "T102030.5", "T23:59:59.999999", "T25:00", "T10:60", "T10:20:60", "T", "T1", "T10:2", "T10:20:3", "T10:2030", "T1020:30"]
OFFSETS = ["", "Z", "+05", "-05:30", "+0530", "+05:30:15", "+053015", "-05:30:15.25", "+24:00", "-23:59", "+05:60", "+5", "+05:3", "z"]
OTHERS = [
    "2024-1-5", "2024-1-5 3:4:5", "2024-01-05  03:04:05", "2024-01-05\t03:04:05", "2024-1-5 3:4", "2024-1-5T3:4:5", "2024- 1-5", "2024-01- 5", "2024-1-32", "24-01-05", " 2024-01-05 ",
    "Fri, 05 Jan 2024 03:04:05 +0000", "fri, 5 JAN 2024 3:4:5 -0530", "Mon, 05 Jan 2024 03:04:05 +00:00", "Fri,  05  Jan 2024 03:04:05  +053015", "Fri, 05 Jan 2024 03:04:05 +05:30:15.5", "Fri, 05 Jan 2024 03:04:05 Z",
    "Fri, 05 Jan 2024 03:04:05", "05 Jan 2024 03:04:05 +0000", "Fri, 05 Jan 2024 03:04 +0000", "Fri, 05 Foo 2024 03:04:05 +0000", "Xyz, 05 Jan 2024 03:04:05 +0000", "Fri, 31 Feb 2024 03:04:05 +0000",
    "Fri, 05 Jan 2024 03:04:05 +2500", "Fri, 05 Jan 2024 03:04:05 +0060", "Fri, 05 Jan 2024 03:04:60 +0000", "Fri, 05 Jan 2024 03:04:05 +05:3015", "", "  ", "yesterday", "2024", "2024-01", "2024-100", "1704423845", "2024-01-05T03:04:05+00:00Z", "2024/01/05",
]


def test_forms_equal_the_plain_parser(spark):
    rng = random.Random(5)
    values = [d + c + o for d in DATES for c in CLOCKS for o in OFFSETS if c or o in ("", "Z") or rng.random() < 0.2] + OTHERS
    differ = [(v, got, plain(v)) for v, got in zip(values, parsed(spark, values)) if got != plain(v)]
    assert differ == []
    assert len(values) > 1000 and sum(plain(v) is not None for v in values) > 500


def test_null_has_no_time(spark):
    assert spark.range(1).select(keys.parse_time(F.lit(None).cast("string")).alias("t")).first()["t"] is None
