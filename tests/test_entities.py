import html
import random
from html.entities import html5

from pyspark.sql import functions as F

from gripelode.functions import text
from gripelode.functions.entities import unescape


def decoded(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", unescape(F.col("t")).alias("t")).collect()
    return [r["t"] for r in sorted(rows, key=lambda r: r["i"])]


def test_every_name_with_and_without_what_follows(spark):
    names = list(html5)
    for make in (lambda n: f"x&{n}y", lambda n: f"&{n}", lambda n: f"&{n.rstrip(';')}é;z", lambda n: f"a &amp;{n} &{n}&{n}"):
        texts = [make(n) for n in names]
        got = decoded(spark, texts)
        assert [t for t, g in zip(texts, got) if g != html.unescape(t)] == []


def test_numbers(spark):
    numbers = [*range(0, 300), 0x7FF, 0x800, 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDCF, 0xFDD0, 0xFDEF, 0xFDF0, 0xFFFD, 0xFFFE, 0xFFFF, 0x10000, 0x1FFFE, 0x1F600, 0x10FFFD, 0x10FFFF, 0x110000, 10**7, 10**30]
    texts = [f(n) for n in numbers for f in (lambda n: f"&#{n};", lambda n: f"&#{n}x", lambda n: f"&#x{n:x};", lambda n: f"&#X000{n:X} ", lambda n: f"&#000000000{n};")]
    texts += ["&#;", "&#x;", "&#xg;", "&#", "&#x", "&#12&#13;", "&#" + "9" * 4000 + ";"]
    got = decoded(spark, texts)
    assert [t for t, g in zip(texts, got) if g != html.unescape(t)] == []


def test_random_texts(spark):
    rng = random.Random(3)
    parts = ["&", "&", ";", "#", "x", "amp", "lt", "notin", "not", "it", "copy", "ampersand", "CounterClockwiseContourIntegral", " ", "\t", "\r", "<", "é", "😀", "1", "41", "a" * 40, "\x00"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(1500)] + ["", "&" * 3000, "&amp;lt;" * 500]
    got = decoded(spark, texts)
    assert [t for t, g in zip(texts, got) if g != html.unescape(t)] == []


def test_nulls_and_plan(spark):
    frame = spark.createDataFrame([(None,), ("<b>a &amp; b</b>",)], "t string").select(text.strip_html(F.col("t")).alias("t"))
    assert [r["t"] for r in frame.collect()] == ["", "a & b"]
    assert "Python" not in frame._jdf.queryExecution().executedPlan().toString()
