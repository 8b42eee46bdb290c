import pytest
from pyspark.sql import functions as F

from passagerank.functions.porter import porter
from passagerank.functions.text import STOPWORDS, strip_punctuation, tokens, with_term_groups
from passagerank.operators.index import stem_vocabulary, tokenize_flat

# fixed value: the sentence of the install check
SENTENCE = "This is a test query in which things are tested. Found using www.google.com of course!"


def one(spark, text, **options):
    df = spark.createDataFrame([(text,)], "s STRING")
    return df.select(tokens("s", **options).alias("t")).first()["t"]


def test_nine_tokens(spark):
    assert one(spark, SENTENCE, stemmer=None) == [
        "test", "query", "which", "things", "tested", "found", "using", "www.google.com", "course",
    ]
    assert one(spark, SENTENCE) == ["test", "queri", "which", "thing", "test", "found", "us", "www.google.com", "cours"]


@pytest.mark.parametrize(
    ("word", "stem"),
    [
        ("percenter", "percent"), ("lps", "lp"), ("suicide", "suicid"), ("caresses", "caress"), ("ponies", "poni"),
        ("ties", "ti"), ("cats", "cat"), ("feed", "feed"), ("agreed", "agre"), ("plastered", "plaster"),
        ("motoring", "motor"), ("sing", "sing"), ("conflated", "conflat"), ("hopping", "hop"), ("falling", "fall"),
        ("failing", "fail"), ("filing", "file"), ("happy", "happi"), ("sky", "sky"), ("relational", "relat"),
        ("conditional", "condit"), ("vietnamization", "vietnam"), ("triplicate", "triplic"), ("hopefulness", "hope"),
        ("revival", "reviv"), ("adjustment", "adjust"), ("adoption", "adopt"), ("probate", "probat"), ("cease", "ceas"),
        ("controlling", "control"), ("roll", "roll"), ("a", "a"), ("is", "is"), ("école", "école"), ("2019", "2019"),
    ],
)
def test_porter(word, stem):
    assert porter(word) == stem


def test_empty_null_and_stopwords(spark):
    assert one(spark, "", stemmer=None) == []
    assert one(spark, None) == []
    assert one(spark, " ".join(STOPWORDS), stemmer=None) == []
    assert len(STOPWORDS) == 33


def test_possessive_and_joined_words(spark):
    assert one(spark, "The cat's cat’s O'Neil a.b 3.5 x-y foo.", stemmer=None) == [
        "cat", "cat", "o'neil", "a.b", "3.5", "x", "y", "foo",
    ]


def test_long_dotted_text_does_not_overflow(spark):
    text = ".".join(["a1"] * 200_000)
    assert one(spark, text, stemmer=None) == [text]


def test_strip_punctuation_deletes(spark):
    df = spark.createDataFrame([("a-b, c's (d)!",)], "s STRING")
    assert df.select(strip_punctuation("s")).first()[0] == "ab cs d"


def test_positions_and_groups(spark):
    df = spark.createDataFrame([(1, "b a b c a b"), (2, "")], "id INT, text STRING")
    flat = tokenize_flat(df, "text", stemmer=None, stopwords=())
    assert [(r.position, r.term) for r in flat.orderBy("position").collect()] == list(enumerate("b a b c a b".split()))
    with_tokens = df.withColumn("t", tokens("text", None, ()))
    rows = {r.id: r.g for r in with_term_groups(with_tokens, "t", "g").collect()}
    assert [(g.term, g.tf, g.positions) for g in rows[1]] == [
        ("a", 2, [1, 4]), ("b", 3, [0, 2, 5]), ("c", 1, [3]),
    ]
    assert rows[2] == []


def test_stem_vocabulary(spark):
    words = spark.createDataFrame([("cats",), ("running",)], "term STRING")
    assert {r.term: r.stem for r in stem_vocabulary(words).collect()} == {"cats": "cat", "running": "run"}


def test_analysis_uses_no_python_without_stemmer(spark, corpus):
    plan = corpus.select(tokens("text", None))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert F is not None
