import pytest
from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from heatline.constants import CLEAN_PATTERN, ENGLISH_STOP_WORDS, PUNCTUATION
from heatline.functions import text as X
from heatline.functions.stemming import stem, stems, stems_of

EDGES = ["Héllo, wörld_x don't a , b", " \n tab\tX ", "", "!!!", "foo-bar baz ÉÇ", None, "  ", "a  b",
         " lead", "trail \t\n", "\n", "__a__", "x y"]


def frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, text string")


def column(df, expression):
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_clean_text_edges(spark):
    got = column(frame(spark, EDGES), X.clean_text(F.col("text")))
    assert got[0] == "hllo wrldx dont a  b"
    assert got[1] == "\n tab\tx"
    assert got[2:6] == ["", "", "foobar baz", None]
    assert got[11] == "a"


def test_clean_text_equals_the_plain_pattern(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("text").unionAll(
        frame(spark, EDGES).select("text"))
    plain = F.trim(F.lower(F.regexp_replace("text", CLEAN_PATTERN, "")))
    assert docs.where(~X.clean_text(F.col("text")).eqNullSafe(plain)).count() == 0


def test_clean_text_is_idempotent_and_has_a_unicode_mode(spark):
    df = frame(spark, EDGES)
    once = X.clean_text(F.col("text"))
    assert column(df, X.clean_text(once)) == column(df, once)
    assert column(df, X.clean_text(F.col("text"), unicode_words=True))[0] == "héllo wörldx dont a  b"


def test_normalise_strips_punctuation_and_keeps_words_apart(spark):
    df = frame(spark, ["a\nb\tc", "A,  B!", " x  y ", PUNCTUATION, None])
    assert column(df, X.normalise_text(F.col("text"))) == ["a b c", "a b", "x y", "", None]


def test_tokens_equal_the_ml_tokenizer(spark):
    df = frame(spark, EDGES).where("text is not null")
    ml = Tokenizer(inputCol="text", outputCol="words").transform(df)
    assert ml.where(~ml["words"].eqNullSafe(X.tokens(F.col("text")))).count() == 0
    assert column(frame(spark, ["a  b", "", None]), X.tokens(F.col("text"))) == [
        ["a", "", "b"], [""], None]


def test_stop_words(spark):
    assert list(ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")
    df = frame(spark, ["The cat and I don't", "dont worry"])
    words = X.tokens(F.col("text"))
    ml = StopWordsRemover(inputCol="w", outputCol="f").transform(df.withColumn("w", words))
    assert ml.where(ml["f"] != X.without_stop_words(words)).count() == 0
    assert column(df, X.without_stop_words(words)) == [["cat"], ["dont", "worry"]]
    bare = X.without_stop_words(words, X.stop_words(bare_apostrophes=True))
    assert column(df, bare) == [["cat"], ["worry"]]


PAIRS = """caresses caress ponies poni ties tie cats cat feed feed agreed agre plastered plaster
bled bled motoring motor sing sing conflated conflat troubled troubl sized size hopping hop
tanned tan falling fall hissing hiss fizzed fizz failing fail filing file happy happi sky sky
relational relat conditional condit rational ration digitizer digit operator oper feudalism feudal
decisiveness decis hopefulness hope callousness callous formality formal sensitivity sensit
triplicate triplic formative form formalize formal electricity electr electrical electr
goodness good revival reviv allowance allow inference infer airliner airlin adjustable adjust
defensible defens irritant irrit replacement replac adjustment adjust dependent depend
adoption adopt communism commun activate activ homologous homolog effective effect probate probat
rate rate cease ceas controll control roll roll generalizations gener oscillators oscil
died die spied spi dying die radically radic is is""".split()


@pytest.mark.parametrize("word,expected", list(zip(PAIRS[::2], PAIRS[1::2])))
def test_stem(word, expected):
    assert stem(word) == expected


def test_stems_as_columns(spark):
    df = frame(spark, ["running", None]).withColumn("words", F.array("text", F.lit("cats")))
    assert column(df, stems(F.col("text"))) == ["run", None]
    assert column(df.where("i = 0"), stems_of(F.col("words"))) == [["run", "cat"]]


def test_stems_of_arrays_hold_each_word_once(spark):
    """Null arrays, empty ones and null words; a batch of ten thousand long texts."""
    df = spark.createDataFrame([(1, ["running", "cats", None]), (2, None), (3, []), (4, ["cats"])], "i int, words array<string>")
    got = {r.i: r.s for r in df.select("i", stems_of(F.col("words")).alias("s")).collect()}
    assert got == {1: ["run", "cat", None], 2: None, 3: [], 4: ["cat"]}

    long = spark.range(0, 10_000, 1, 1).select(F.array_repeat(F.lit("hopefulness"), 1500).alias("words"))
    assert "ArrowEvalPython" in long.select(stems_of(F.col("words")))._jdf.queryExecution().executedPlan().toString()
    assert long.select(F.sum(F.size(stems_of(F.col("words"))))).first()[0] == 15_000_000
