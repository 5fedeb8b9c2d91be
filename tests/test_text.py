from itertools import product

import pytest
from pyspark.sql import functions as F

from topictally.functions import is_article, lines, lower_words, millis, split_words


def words_by_rule(text):
    """Split on one space, then drop trailing empty words; empty text keeps its one empty word."""
    if text is None:
        return None
    if text == "":
        return [""]
    words = text.split(" ")
    while words and words[-1] == "":
        words.pop()
    return words


def test_split_rule_on_all_short_texts(spark):
    alphabet = [" ", "a", "\t", "\n", "É"]
    texts = ["".join(t) for n in range(5) for t in product(alphabet, repeat=n)] + [None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r.text: r.words for r in df.select("text", split_words("text").alias("words")).collect()}
    assert got == {t: words_by_rule(t) for t in texts}


def test_lower_words(spark):
    cases = {
        "a b ": ["a", "b"],
        " a  b": ["", "a", "", "b"],
        "": [""],
        "   ": [],
        "A\tb c\nd": ["a\tb", "c\nd"],
        "ÉTÉ Straße": ["été", "straße"],
    }
    df = spark.createDataFrame([(t,) for t in cases], "text string")
    got = {r.text: r.words for r in df.select("text", lower_words("text").alias("words")).collect()}
    assert got == cases


def test_exploding_null_text_gives_no_rows(spark):
    df = spark.createDataFrame([(None,), ("x y",)], "text string")
    assert df.select(F.explode(lower_words("text"))).count() == 2


def test_lines(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],), (["a", None],)], "items array<string>")
    got = [r[0] for r in df.select(lines("items")).collect()]
    assert got == ["a\nb\n", "", "a\nnull\n"]


def test_is_article(spark):
    df = spark.createDataFrame([("ART",), ("X-ART-Y",), ("AD",), ("art",), (None,)], "flags string")
    assert [r.flags for r in df.filter(is_article()).collect()] == ["ART", "X-ART-Y"]


def test_durations():
    assert millis("1 minute") == millis("60 seconds") == millis(60_000) == 60_000
    assert millis("2 hours") == 7_200_000
    for bad in ("minute", "1 fortnight", -1):
        with pytest.raises(ValueError):
            millis(bad)
