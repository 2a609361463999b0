"""Sinks, views, and a whole run on a small Japanese CSV with an analyser's output given by hand."""

from datetime import datetime

import pytest

from reviewloom import schemas as S
from reviewloom.plans import batch, views
from reviewloom.sources import sinks

CSV = """source,source_id,review_text,posted_at,user_name
a.com,1,部屋が汚い。料理は美味しい,2026/02/01 8:12,u1
a.com,2,対応が最悪です,2026/02/01 9:45,u2
a.com,3,掃除していないので臭い,2026/02/02 9:45,u3
a.com,3,掃除していないので臭い,2026/02/02 9:45,u3
a.com,4,abc,2026/02/02 9:45,u4
"""
MORPHEMES = {
    "部屋が汚い。料理は美味しい": [
        "部屋/名詞/一般/*/部屋", "が/助詞/格助詞/*/が", "汚い/形容詞/自立/基本形/汚い", "|/記号/一般/*/|",
        "料理/名詞/一般/*/料理", "は/助詞/係助詞/*/は", "美味しい/形容詞/自立/基本形/美味しい"],
    "対応が最悪です": ["対応/名詞/一般/*/対応", "が/助詞/格助詞/*/が", "最悪/名詞/一般/*/最悪", "です/助動詞/*/基本形/です"],
    "掃除していないので臭い": [
        "掃除/名詞/サ変接続/*/掃除", "し/動詞/自立/連用形/する", "て/助詞/接続助詞/*/て", "い/動詞/非自立/未然形/いる",
        "ない/助動詞/*/基本形/ない", "ので/助詞/接続助詞/*/ので", "臭い/形容詞/自立/基本形/臭い"],
}


@pytest.fixture(scope="module")
def lexicons(spark):
    return {
        "sentiment": spark.createDataFrame(
            [("汚い", ["negative"]), ("最悪", ["negative"]), ("臭い", ["negative"]), ("美味しい", ["positive"])],
            "term string, polarities array<string>"),
        "entity": spark.createDataFrame([("部屋", "Room"), ("対応", "Staff"), ("料理", "Food")], "term string, entity string"),
        "issue": spark.createDataFrame([("汚い", "Cleanliness"), ("臭い", "Odour")], "term string, issue_category string"),
    }


@pytest.fixture(scope="module")
def landed(spark, lexicons, tmp_path_factory):
    out = tmp_path_factory.mktemp("landed")
    (out / "hotel.csv").write_text(CSV, encoding="utf-8")
    analysed = spark.createDataFrame(
        [(t, i, *m.split("/")) for t, ms in MORPHEMES.items() for i, m in enumerate(ms)],
        "review_text string, place int, surface string, pos string, sub_pos string, inflection string, lemma string")

    def analyse(valid):
        return batch.tokens_from_morphemes(valid, valid.select("row_id", "review_text").join(analysed, "review_text"))

    for run in ("run_1", "run_2"):
        batch.run(spark, str(out / "hotel.csv"), str(out), lexicons, analyse, run_id=run)
    return {n: spark.read.parquet(str(out / n)) for n in ("review_raw", "review_validated", "review_reasons")}


def test_a_run_lands_three_tables(landed):
    assert landed["review_raw"].where("run_id = 'run_1'").count() == 5
    assert set(S.RAW_COLUMNS) == set(landed["review_raw"].columns)
    validated = landed["review_validated"].where("run_id = 'run_1'").orderBy("row_number").collect()
    assert [r.is_valid for r in validated] == [True, True, True, False, False]
    assert {str(r.posted_date) for r in validated} == {"2026-02-01", "2026-02-02"}
    reasons = landed["review_reasons"].where("run_id = 'run_1'")
    assert reasons.columns == S.REASON_COLUMNS
    assert sorted((r.subject, r.predicate, r.entity, r.issue_category, r.confidence) for r in reasons.collect()) == [
        ([], "掃除していない", None, None, 0.3),
        ([], "臭い", None, "Odour", 0.5),
        (["対応"], "最悪", "Staff", None, 0.77),
        (["部屋"], "汚い", "Room", "Cleanliness", 0.97),
    ]


def test_append_keeps_runs_and_views_show_the_latest(spark, landed):
    assert {r.run_id for r in landed["review_raw"].select("run_id").distinct().collect()} == {"run_1", "run_2"}
    views.register_views(spark, landed["review_validated"].drop("posted_date"), landed["review_reasons"])
    coverage = spark.sql("SELECT * FROM v_kpi_extraction_coverage_by_run").collect()
    rows = {(r.run_id): (r.valid_review_count, r.reviews_with_any_reason, r.extraction_coverage_negative) for r in coverage}
    assert rows["run_2"][1] == rows["run_2"][0] >= 2
    dq = {r.run_id: r for r in spark.sql("SELECT * FROM v_dq_metrics_by_run").collect()}
    assert (dq["run_1"].total_rows, dq["run_1"].rows_valid, dq["run_1"].duplicate_rows, dq["run_1"].too_short_rows) == (5, 3, 1, 1)
    assert dq["run_1"].valid_rate == pytest.approx(0.6)
    reasons = [tuple(r) for r in spark.sql("SELECT run_id, invalid_reason, rows_count FROM v_dq_invalid_reasons_by_run").collect()]
    assert ("run_1", S.DUPLICATE, 1) in reasons
    for view in ("v_reasons_enriched", "v_reasons_top1_per_review", "v_kpi_reason_categories_daily", "v_kpi_entity_counts",
                 "v_kpi_issue_category_counts", "v_kpi_top_subject_predicate", "v_kpi_entity_issue_coverage"):
        assert spark.table(view).count() > 0


def test_coverage_of_nothing_is_null(spark):
    top1 = spark.createDataFrame([], "entity string, issue_category string")
    row = views.kpi_entity_issue_coverage(top1).collect()[0]
    assert (row.total_records, row.entity_coverage_rate, row.issue_category_coverage_rate) == (0, None, None)


def raw_row(**changes):
    row = dict(source="a.com", source_id="1", review_text=' a "b"\n c ', posted_at="", user_name=None, source_file="f",
               source_path="d/f", row_number=1, row_id="r", ingested_at=datetime(2026, 3, 1), run_id="run") | changes
    return tuple(row[c] for c in S.RAW_COLUMNS)


RAW = "source string, source_id string, review_text string, posted_at string, user_name string, source_file string, source_path string, row_number long, row_id string, ingested_at timestamp, run_id string"


def test_write_modes_and_csv(spark, tmp_path):
    raw = spark.createDataFrame([raw_row()], RAW)
    path = str(tmp_path / "t")
    for mode, rows in (("append", 1), ("append", 2), ("truncate", 1)):
        sinks.write_raw(raw, path, mode)
        assert spark.read.parquet(path).count() == rows
    sinks.write_raw(raw, str(tmp_path / "c"), fmt="csv")
    back = spark.read.csv(str(tmp_path / "c"), header=True, multiLine=True, escape='"').collect()
    assert back[0].review_text == ' a "b"\n c '


@pytest.mark.parametrize("column", S.RAW_REQUIRED)
def test_required_columns_are_enforced(spark, tmp_path, column):
    bad = spark.createDataFrame([raw_row(**{column: None})], RAW)
    with pytest.raises(Exception, match=f"required column {column} is NULL"):
        sinks.write_raw(bad, str(tmp_path / "t"))


def test_reasons_as_bucketed_table(spark, landed):
    sinks.save_reasons_table(landed["review_reasons"], "reasons_by_review", 4)
    assert spark.table("reasons_by_review").count() == landed["review_reasons"].count()
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED reasons_by_review").collect()}
    assert described["Num Buckets"] == "4" and "review_id" in described["Bucket Columns"]


def test_heatmap_and_tops(spark):
    rows = [("Room", "Noise", ["a"], "x")] * 3 + [("Room", "Odour", ["a", "b"], "y")] * 2 + [(None, "Noise", [], None)]
    top1 = spark.createDataFrame(rows, "entity string, issue_category string, subject_array array<string>, predicate string")
    heat = {r.entity: (r.Noise, r.Odour, r.Safety) for r in views.entity_issue_heatmap(top1, ["Noise", "Odour", "Safety"]).collect()}
    assert heat == {"Room": (3, 2, 0), None: (1, 0, 0)}
    assert [tuple(r) for r in views.top_issue_categories(top1, 1).collect()] == [("Noise", 4)]
    assert [tuple(r) for r in views.top_subject_predicates(top1, 2).collect()] == [("a", "x", 3), ("a", "y", 2)]
    best = views.top_issues_per_entity(top1, 1).select("entity", "issue_category", "reason_count").collect()
    assert [tuple(r) for r in best] == [("Room", "Noise", 3)]


def test_run_drilldown(spark, landed):
    rows = views.run_drilldown(landed["review_validated"], landed["review_reasons"], "run_2").collect()
    assert {r.run_id for r in rows} == {"run_2"}
    assert len({r.row_id for r in rows}) == 5
    assert all(r.reason_id is None for r in rows if not r.is_valid) and any(r.reason_id for r in rows)
