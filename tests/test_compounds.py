import pytest
from pyspark.sql import functions as F

from reviewloom.operators.compounds import fold_reviews
from reviewloom.operators.tokens import keep_content, tag_polarity, tag_synonym

COLUMNS = "row_id string, place int, surface string, pos string, sub_pos string, inflection string, lemma string"


def fold(spark, text, *morphemes):
    rows = [("r", i, *m.split("/")) for i, m in enumerate(morphemes)]
    reviews = spark.createDataFrame([("run", "r", "id", text)], "run_id string, row_id string, review_id string, review_text string")
    out = fold_reviews(spark.createDataFrame(rows, COLUMNS), reviews).orderBy("place").collect()
    return [(w.surface, w.pos, w.lemma, w.inflection, w.start_offset, w.end_offset, w.sentence) for w in out]


CASES = {
    "offsets": ("鳥は鳴く", ["鳥/名詞/一般/*/鳥", "は/助詞/係助詞/*/は", "鳴く/動詞/自立/基本形/鳴く"], [
        ("鳥", "名詞", "鳥", "*", 0, 0, 1), ("は", "助詞", "は", "*", 1, 1, 1), ("鳴く", "動詞", "鳴く", "基本形", 2, 3, 1)]),
    "light_verb": ("配達する", ["配達/名詞/サ変接続/*/配達", "する/動詞/自立/基本形/する"], [
        ("配達する", "動詞", "配達する", "基本形", 0, 3, 1)]),
    "light_verb_over_particle": ("配達をする", ["配達/名詞/サ変接続/*/配達", "を/助詞/格助詞/*/を", "する/動詞/自立/基本形/する"], [
        ("配達する", "動詞", "配達する", "基本形", 0, 4, 1)]),
    "desire": ("泳ぎたい", ["泳ぎ/動詞/自立/連用形/泳ぐ", "たい/助動詞/*/基本形/たい"], [
        ("泳ぎたい", "動詞", "泳ぎたい", "希望形", 0, 3, 1)]),
    "negation": ("書かない", ["書か/動詞/自立/未然形/書く", "ない/助動詞/*/基本形/ない"], [
        ("書かない", "動詞", "書かない", "否定形", 0, 3, 1)]),
    # a desire does not take a negation
    "desire_then_negation": ("泳ぎたくない", ["泳ぎ/動詞/自立/連用形/泳ぐ", "たく/助動詞/*/連用テ接続/たい", "ない/助動詞/*/基本形/ない"], [
        ("泳ぎたく", "動詞", "泳ぎたい", "希望形", 0, 3, 1), ("ない", "助動詞", "ない", "基本形", 4, 5, 1)]),
    "voice_then_negation": ("呼ばれない", ["呼ば/動詞/自立/未然形/呼ぶ", "れ/動詞/接尾/未然形/れる", "ない/助動詞/*/基本形/ない"], [
        ("呼ばれない", "動詞", "呼ばれない", "否定形", 0, 4, 1)]),
    "progressive": ("見ている", ["見/動詞/自立/連用形/見る", "て/助詞/接続助詞/*/て", "いる/動詞/非自立/基本形/いる"], [
        ("見ている", "動詞", "見る", "基本形", 0, 3, 1)]),
    "verbal_noun_negated": ("予約しない", ["予約/名詞/サ変接続/*/予約", "し/動詞/自立/未然形/する", "ない/助動詞/*/基本形/ない"], [
        ("予約しない", "動詞", "予約しない", "否定形", 0, 4, 1)]),
    "delimiter_separates": ("泳ぎ。たい", ["泳ぎ/動詞/自立/連用形/泳ぐ", "|/記号/一般/*/|", "たい/助動詞/*/基本形/たい"], [
        ("泳ぎ", "動詞", "泳ぐ", "連用形", 0, 1, 1), ("たい", "助動詞", "たい", "基本形", 3, 4, 2)]),
    # the second occurrence is searched behind the first; a word the text does not hold follows on
    "search_moves_on": ("ABCab", ["ab/名詞/一般/*/ab", "ab/名詞/一般/*/ab", "zz/名詞/一般/*/zz"], [
        ("ab", "名詞", "ab", "*", 0, 1, 1), ("ab", "名詞", "ab", "*", 3, 4, 1), ("zz", "名詞", "zz", "*", 5, 6, 1)]),
}


@pytest.mark.parametrize("name", list(CASES))
def test_compounds(spark, name):
    text, morphemes, expected = CASES[name]
    assert fold(spark, text, *morphemes) == expected


def test_keep_content_drops_other_classes_and_renumbers(spark):
    rows = [("r", 1, 0, "副詞"), ("r", 1, 1, "名詞"), ("r", 3, 2, "動詞"), ("r", 3, 3, "感動詞"), ("r", 3, 4, "助詞")]
    kept = keep_content(spark.createDataFrame(rows, "row_id string, sentence int, place int, pos string"))
    assert [(r.pos, r["index"], r.index_in_sentence) for r in kept.orderBy("index").collect()] == [
        ("名詞", 0, 0), ("動詞", 1, 0), ("助詞", 2, 1)]


LEXICON = [("つまずく", ["negative"]), ("嘆く", ["negative"]), ("笑う", ["positive"]), ("眩しい", ["positive"])]


@pytest.mark.parametrize("wanted, lemmas, expected", [
    ("negative", ["嘆く", "笑う", "歩く"], [["negative"], None, None]),
    ("positive", ["嘆く", "眩しい"], [None, ["positive"]]),
    ("negative", [], []),
])
def test_polarity(spark, wanted, lemmas, expected):
    tokens = spark.createDataFrame([("r", i, x) for i, x in enumerate(lemmas)], "row_id string, place int, lemma string")
    lexicon = spark.createDataFrame(LEXICON, "term string, polarities array<string>")
    tagged = tag_polarity(tokens, lexicon, F.array(F.lit(wanted)))
    assert [r.polarities for r in tagged.orderBy("place").collect()] == expected


def test_synonyms_match_lemma_and_class(spark):
    tokens = spark.createDataFrame([("r", 0, "僕", "名詞"), ("r", 1, "僕", "動詞")], "row_id string, place int, lemma string, pos string")
    synonyms = spark.createDataFrame([("僕", "名詞", "自分")], "lemma string, pos string, synonym string")
    assert [r.synonym for r in tag_synonym(tokens, synonyms).orderBy("place").collect()] == ["自分", None]
