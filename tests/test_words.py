"""Word breaks and highlight fragments, on cases made by hand."""

import pytest
from pyspark.sql import functions as F

from quire.functions import text
from quire.functions.text import passages, terms
from quire.operators import search

WORDS = {
    "Can't stop; the dog's bone": ["can't", "stop", "the", "dog's", "bone"],
    "'quoted' words' ends": ["quoted", "words", "ends"],
    "Mr. Smith, e.g. a.b.c. (example.com)": ["mr", "smith", "e.g", "a.b.c", "example.com"],
    "3.14 1,000,000.5 2,b 7. 5;6 1:2": ["3.14", "1,000,000.5", "2", "b", "7", "5;6", "1", "2"],
    "a1.b c.2d x1y2.3z": ["a1", "b", "c", "2d", "x1y2.3z"],
    "snake_case _x_ ___ 4_5": ["snake_case", "_x_", "4_5"],
    "日本語のテスト、カタカナ・ひらABC漢字": ["日", "本", "語", "の", "テスト", "カタカナ", "ひ", "ら", "abc", "漢", "字"],
    "한국어 단어 привет-мир": ["한국어", "단어", "привет", "мир"],
    "café na‍ive ½ ² 😀": ["café", "na‍ive"],
    "ภาษาไทย x": ["ภาษาไทย", "x"],
    "": [],
    " .,;: ": [],
}


def test_words(spark):
    rows = spark.createDataFrame([(x,) for x in [*WORDS, None]], "t string").select("t", terms("t").alias("w")).collect()
    assert {r["t"]: r["w"] for r in rows} == WORDS | {None: None}
    assert [search.terms_of(x) for x in WORDS] == list(WORDS.values())


@pytest.mark.parametrize("text, n", [("a" * 1_000_000, 1), ("a." * 300_000, 1), ("a1" * 300_000, 1), ("_" * 500_000, 0), ("語" * 200_000, 200_000), ("e" + "́" * 300_000, 1)])
def test_very_long_words(spark, text, n):
    rows = spark.createDataFrame([(text,)], "t string")
    assert rows.select(F.size(terms("t"))).first()[0] == n
    assert rows.select((search.highlighted("t", "zz") == F.col("t")).alias("same")).first()[0]


def test_passages(spark):
    text = "One. Two!  Three? 3.5 four\nfive\n\n " + "word " * 30 + "\n" + "x" * 250 + " end"
    got = spark.createDataFrame([(text,), ("",), ("  \n ",), (None,)], "t string").select(passages(F.col("t"), 100)).collect()
    first = got[0][0]
    assert first[:5] == ["One.", "Two!", "Three?", "3.5 four", "five"]
    assert first[5:] == [("word " * 20).strip(), ("word " * 10).strip(), "x" * 100, "x" * 100, "x" * 50 + " end"]
    assert [r[0] for r in got[1:]] == [[], [], None]


def marked(spark, text, query, **bounds):
    rows = spark.createDataFrame([(text,)], "content string")
    return rows.select(search.highlighted("content", query), search.highlight_fragments("content", query, **bounds)).first()


def test_highlights(spark):
    text = "The cat's here. A CAT sat. Nothing. Cat, cat and dog! A dog."
    whole, best = marked(spark, text, "cat dog", number=2)
    assert whole == "The cat's here. A <em>CAT</em> sat. Nothing. <em>Cat</em>, <em>cat</em> and <em>dog</em>! A <em>dog</em>."
    assert best == ["A <em>CAT</em> sat.", "<em>Cat</em>, <em>cat</em> and <em>dog</em>!"]  # the best, then the earliest of equals, in the text's order
    assert marked(spark, "a+b (c) $1 \\ a.b", "a.b $1") == ("a+b (c) $<em>1</em> \\ <em>a.b</em>", ["a+b (c) $<em>1</em> \\ <em>a.b</em>"])
    assert marked(spark, "日本、日の出", "日") == ("<em>日</em>本、<em>日</em>の出", ["<em>日</em>本、<em>日</em>の出"])
    assert marked(spark, "some text", "none") == ("some text", []) == marked(spark, "some text", " ?")
    assert marked(spark, None, "none") == (None, None)


def test_fragments_are_of_bounded_length(spark):
    text = " ".join(f"w{i} of" for i in range(5000))
    _, best = marked(spark, text, "of w77", size=40, number=3)
    assert len(best) == 3 and all(len(x.replace("<em>", "").replace("</em>", "")) <= 40 for x in best)
    assert any("<em>w77</em>" in x for x in best)


def test_plain_words_match_as_by_the_whole_rule(spark):
    general = text._WORD.removeprefix(f"{text._PLAIN}|")
    assert general != text._WORD
    rows = spark.createDataFrame([(f"a{chr(i)}b {chr(i)} 1{chr(i)}2 {chr(i)}a_{chr(i)}.x ab,{chr(i)} a. {chr(i)}ab-{chr(i)} _ab c",) for i in range(1, 0x3100)], "t string")
    assert rows.filter(F.regexp_extract_all("t", F.lit(general), F.lit(0)) != F.regexp_extract_all("t", F.lit(text._WORD), F.lit(0))).count() == 0
