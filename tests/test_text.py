from pyspark.sql import functions as F

from textlens.functions import text as tx


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "t string").select(expression(F.col("t"))).first()[0]


def test_normalizer_unifies_letters_digits_and_spaces(spark):
    assert one(spark, "كتاب علي ٢٣", tx.normalize_text) == "کتاب علی ۲۳"
    assert one(spark, "مُحَمَّد", tx.normalize_text) == "محمد"
    assert one(spark, "می ‌‌ رود", tx.normalize_text) == "می‌رود"
    assert one(spark, "  a   b ,c ", tx.normalize_text) == "a b,c"


def test_normalizer_takes_lexicon_rules(spark):
    assert one(spark, "می رود", lambda c: tx.normalize_text(c, [("^می ", "می‌")])) == "می‌رود"


def test_index_tokens_need_two_characters_and_split_at_half_space(spark):
    assert one(spark, "A bc می‌رود d_1!", tx.index_tokens) == ["bc", "می", "رود", "d_1"]


def test_fulltext_tokens_keep_half_space_and_single_letters(spark):
    assert one(spark, "A می‌رود!", tx.fulltext_tokens) == ["a", "می‌رود"]


def test_split_tokens_keep_punctuation_and_case(spark):
    assert one(spark, "Ab, c-d", tx.split_tokens) == ["Ab", ",", "c", "-", "d"]


def test_whitespace_tokens(spark):
    assert one(spark, "  a\tb c\n", tx.whitespace_tokens) == ["a", "b", "c"]
    assert one(spark, "", tx.whitespace_tokens) == []


def test_ngrams_over_filtered_tokens(spark):
    tokens = F.array(*[F.lit(t) for t in ("a", "the", "b", "c")])
    kept = tx.drop_stop_words(tokens, ["the"])
    assert one(spark, "", lambda _: tx.word_ngrams(kept)) == ["a", "b", "c", "a b", "b c"]
    assert one(spark, "", lambda _: tx.word_ngrams(kept, 3, 3)) == ["a b c"]
    single = F.array(F.lit("a"))
    assert one(spark, "", lambda _: tx.word_ngrams(single)) == ["a"]
    empty = F.array().cast("array<string>")
    assert one(spark, "", lambda _: tx.word_ngrams(empty)) == []


def test_halves_keep_hyphens_inside(spark):
    assert one(spark, "a-b c - d-e ", lambda c: tx.split_halves(c, 1)) == "a-b c"
    assert one(spark, "a-b c - d-e ", lambda c: tx.split_halves(c, 2)) == "d-e"
