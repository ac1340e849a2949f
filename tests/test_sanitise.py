"""HTML sanitising: only bare allowed tags survive, every other mark is escaped, text is kept."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kiln.functions.validators import ALLOWED_TAGS, has_xss, sanitise_html

CASES = {
    "1 < 2 and 3 > 2": "1 &lt; 2 and 3 &gt; 2",
    "a <b and more": "a &lt;b and more",
    "fish & chips &amp; &#39; &#x2F; &nope": "fish &amp; chips &amp; &#39; &#x2F; &amp;nope",
    "<P CLASS='x'>Hi</P><br/>": "<P>Hi</P><br>",
    "<scr<b>ipt>x</scr</b>ipt>": "x",
    "<<i>script>x": "&lt;<i>script&gt;x",
    "<<x>script>alert(1)<</x>/script>": "&lt;script&gt;alert(1)&lt;/script&gt;",
    "<script>alert(1)</script>": "alert(1)",
    "<img src=x onerror=alert(1)>t": "t",
    "<a href='javascript:x()'>t</a>": "t",
    "<iframe src=//e></iframe>": "",
    "<!-- a > b --><!DOCTYPE html><?php x ?>t": "t",
    "<!-- open": "&lt;!-- open",
    "\x01script\x02\x03lt;": "scriptlt;",
    "<blink>b</blink><bold>": "b",
    "": "",
}


PIECES = [*"<>/!-?&;#x1ab pi\n\"'=", "script", "<b", "</p>", "<!--", "-->", "&lt;", "\x01"]
PAGES = st.lists(st.sampled_from(PIECES), max_size=14).map("".join)


def cleaned(spark, texts, times=1):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, h string")
    for _ in range(times):
        df = df.withColumn("h", sanitise_html(F.col("h")))
    return [r.h for r in df.orderBy("i").collect()]


def test_stray_marks_are_escaped_and_text_is_kept(spark):
    assert cleaned(spark, CASES) == list(CASES.values())
    assert cleaned(spark, [None]) == [None]


def test_hostile_samples_lose_their_scripts(spark):
    hostile = ["<script>x()</script>", "<img onload=x()>", "<IMG SRC=x OnError = x()>", "<iframe>", "<object data=x>", "<embed src=x>"]
    df = spark.createDataFrame([(h,) for h in hostile], "h string").withColumn("clean", sanitise_html(F.col("h")))
    assert df.where(has_xss(F.col("clean")) | F.col("clean").rlike("[<>]")).count() == 0


@settings(max_examples=5, deadline=None)
@given(st.lists(PAGES, min_size=40, max_size=40))
def test_idempotent_with_no_mark_left(spark, texts):
    once = cleaned(spark, texts)
    assert cleaned(spark, texts, 2) == once
    bare = re.compile(rf"</?({'|'.join(ALLOWED_TAGS)})>", re.I)
    for h in once:
        rest = bare.sub("", h)
        assert "<" not in rest and ">" not in rest
        assert not re.search(r"&(?![A-Za-z][A-Za-z0-9]*;|#[0-9]+;|#[xX][0-9A-Fa-f]+;)", rest)


def test_long_pages(spark):
    page = "<div class='x'>a < b</div>" * 40_000 + "<" * 100_000
    assert cleaned(spark, [page])[0] == "a &lt; b" * 40_000 + "&lt;" * 100_000
