"""Style and rule features on hand-made rows with expected values worked out from the definitions."""
import pytest
from pyspark.sql import functions as F

from tellmark import lexicon as L
from tellmark.functions import text as X
from tellmark.operators.rules import rule_features
from tellmark.operators.style import style_features

ROWS = [
    (1, "5/5 stars! As a busy parent, I was blown away by it. It is GREAT.", 5.0),
    (2, "## Title\n- a b\n- c d", 3.0),
    (3, "- a **x** b **y**", 3.0),
    (4, "★★ nice 😀 ⭐", 4.0),
    (5, "Bad, broken. Great!", 5.0),
    (6, "great x x x x amazing x x x x x perfect", 1.0),
    (7, "", None),
    (8, "No words? 123 !!", 2.0),
    (9, "a b c\nd e f", 3.0),
    (10, "5/5 fine", 5.0),
    (11, None, float("nan")),
]
# words, sentence lengths, ttr, punctuation, caps, markdown, opener, emoji, superlatives, paragraphs, mismatch
EXPECTED = {
    1: (14, [1, 10, 3], 0.928571, 0.061538, 0.066667, 0, 1, 0, 0, 0, 0),
    2: (5, [5], 1, 0.1, 0, 1, 0, 0, 0, 0.849779, 0),
    3: (4, [4], 1, 0.058824, 0, 3, 0, 0, 0, 0, 0),
    4: (1, [1], 1, 0, 0, 0, 1, 3, 0, 0, 0),
    5: (3, [2, 1], 1, 0.157895, 0, 0, 0, 0, 0, 0, 1),
    6: (12, [12], 0.333333, 0, 0, 0, 0, 0, 0.083333, 0, 1),
    7: (1, [1], 0, 0, 0, 0, 0, 0, 0, 0, 0),
    8: (2, [2, 0], 1, 0.1875, 0, 0, 0, 0, 0, 0, 0),
    9: (6, [6], 1, 0, 0, 0, 0, 0, 0, 1, 0),
    10: (1, [1], 1, 0, 0, 0, 0, 0, 0, 0, 0),
    11: (1, [1], 0, 0, 0, 0, 0, 0, 0, 0, 0),
}


@pytest.fixture(scope="module")
def wide(spark):
    df = spark.createDataFrame(ROWS, "review_id long, text string, rating double")
    return {r["review_id"]: r for r in rule_features(style_features(df)).collect()}


@pytest.mark.parametrize("key", EXPECTED)
def test_hand_made_rows(wide, key):
    n, lens, ttr, punct, caps, md, opener, emoji, sup, para, mis = EXPECTED[key]
    r = wide[key]
    mean = sum(lens) / len(lens)
    assert r["word_count"] == n
    assert r["mean_sentence_length"] == pytest.approx(mean)
    assert r["std_sentence_length"] == pytest.approx((sum((x - mean) ** 2 for x in lens) / len(lens)) ** 0.5)
    assert r["type_token_ratio"] == pytest.approx(ttr, abs=1e-6)
    assert r["punctuation_density"] == pytest.approx(punct, abs=1e-6)
    assert r["caps_ratio"] == pytest.approx(caps, abs=1e-6)
    assert r["rule_markdown_artifacts"] == md
    assert r["rule_starts_with_rating"] == opener
    assert r["rule_emoji_count"] == emoji
    assert r["rule_superlative_density"] == pytest.approx(sup, abs=1e-6)
    assert r["rule_avg_paragraph_perfection"] == pytest.approx(para, abs=1e-6)
    assert r["rule_sentiment_rating_mismatch"] == mis


def test_rule_phrases_found(wide):
    assert wide[1]["rule_template_hits"] == 1
    assert wide[1]["rule_buyer_persona_phrases"] == 1


@pytest.mark.parametrize("phrase, hits", [
    ("I can't recommend it enough", 1), ("i cannot recommend\nit enough", 0), ("not only\rbut also", 1),
    ("Overall, it is the perfect gift", 2), ("user friendly top-notch must have", 3), ("worth every pennyx", 0),
    ("é must-have", 1), ("émust-have", 0),
])
def test_template_phrases(spark, phrase, hits):
    df = spark.createDataFrame([(1, phrase, 3.0)], "review_id long, text string, rating double")
    assert rule_features(df).first()["rule_template_hits"] == hits


def test_every_pattern_has_a_fixed_part_that_any_match_contains(spark):
    import re

    samples = {"(i|this|it)": "it", "(addition|solution|gift|choice)": "gift", "('?t| not)": "'t", "(conclusion|summary)": "summary",
               "(and|design|aesthetic)": "and", "(design|interface|features)": "design"}
    for p in L.TEMPLATE_PHRASES + L.PERSONA_PHRASES:
        text = p.replace(r"\b", "").replace(".*", " x ").replace(",?", "").replace("[- ]", "-")
        for group, one in samples.items():
            text = text.replace(group, one)
        text = re.sub(r"\([^)]*\)\?", "", text)
        assert spark.range(1).select(X.matches(F.lit(text), p)).first()[0], (p, text)


def test_tokens_follow_unicode_blanks(spark):
    cases = {"x y": 2, "a b　c": 3, "  ": 0, "": 0, "é\x1cf": 2, "naïve café": 2, "a​b": 1, "ab日本 c": 2}
    df = spark.createDataFrame(list(cases.items()), "t string, n int")
    rows = df.select("t", "n", X.token_count(F.col("t")).alias("got"), F.size(X.tokens(F.col("t"))).alias("size")).collect()
    for r in rows:
        assert (r["got"], r["size"]) == (len(r["t"].split()), len(r["t"].split())), repr(r["t"])


def test_strip_caps_and_digits_agree_with_python(spark):
    texts = ["  x \n", "\tAB c ", "ÀÉ Éa A 42 A1 ★★ STRASSE", "x² ٣ ①", "\n\n", "OK! no YES"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    t = F.col("t")
    for r in df.select("t", X.strip(t).alias("s"), X.shouted_tokens(t).alias("caps"), X.digits(t, X.beyond_ascii(t)).alias("d")).collect():
        assert r["s"] == r["t"].strip()
        assert r["caps"] == sum(len(w) > 1 and w.isupper() for w in r["t"].split())
        assert r["d"] == sum(c.isdigit() for c in r["t"])


def test_features_do_not_depend_on_partitioning(spark, sf):
    from tellmark.plans.detect import text_features
    from tellmark.sources.tables import driver_reviews

    rows = driver_reviews(spark, sf)
    results = [sorted(map(tuple, text_features(rows.repartition(p)).drop("text").collect()), key=lambda r: r[0]) for p in (1, 4, 17)]
    assert results[0] == results[1] == results[2]


def test_words_and_tokens_are_found_once_for_both_kinds_of_features(spark):
    """Words were found twice, tokens once in the whole text and once line by line."""
    from tellmark.plans import detect

    texts = ["", " ", "a", "  Great, great\x1f\n\n perfect!\r\nSTOP it　now ", "\n", "naïve lines\n\x00 x", None, "A B\tC\n\nlovely amazing 42!"]
    df = spark.createDataFrame([(i, t, float(i % 5 + 1)) for i, t in enumerate(texts)], "review_id long, text string, rating double")
    both = detect.text_features(df)
    assert both.columns == [*df.columns, *L.TEXT_STYLE_FEATURES, *L.TEXT_RULE_FEATURES]
    assert both._jdf.queryExecution().optimizedPlan().toString().count(f", {L.LOWER_WORD}, 0)") == 1
    apart = rule_features(style_features(df))
    assert sorted(map(str, both.collect())) == sorted(map(str, apart.collect()))
    sums = df.select((X.sum_of(X.line_tokens(X.present(F.col("text")))) == X.token_count(X.present(F.col("text")))).alias("same"))
    assert all(r["same"] for r in sums.collect())
