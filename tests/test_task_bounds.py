"""What queries move and hold, by the stages that ran: figures that must not grow with the tables."""

import pytest

from sedimenta import session
from sedimenta.operators import classify, ground_truth, refs
from sedimenta.plans import catalogue


@pytest.fixture
def measured(spark):
    """Runs a function and gives its result with the stages that it took."""

    def stages():
        store = spark.sparkContext._jsc.sc().statusStore()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        found = store.stageList(None, False, False, getattr(store, "stageList$default$4")(), None)
        return {found.apply(i).stageId(): found.apply(i) for i in range(found.size())}

    def run(f):
        before = set(stages())
        out = f()
        return out, [s for k, s in stages().items() if k not in before]

    return run


def test_runs_that_the_benchmark_lacks_stay_where_they_are(spark, measured, tmp_path):
    words = lambda k, n: " ".join(f"w{k}x{i}" for i in range(n))
    docs = [(k, words(k, 100)) for k in range(200)] + [(None, f"{words(1000, 9)} end {words(1000, 9)}"), (900, words(1000, 12))]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, words(1000, 10)), (2, words(1000, 7)), (3, None), (4, words(1000, 8))], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got, ran = measured(lambda: sorted(map(tuple, catalogue.QUERIES["contamination_overlap"](spark, str(tmp_path)).collect()), key=str))
    assert got == [(900, 1, 3), (900, 4, 1), (None, 1, 2), (None, 4, 1)]
    assert sum(s.shuffleWriteRecords() for s in ran) < 93 * 200 / 2


def test_a_coordinate_is_read_once(spark):
    rows = spark.createDataFrame([("35", " 36.5 "), ("200", "1"), ("x", "1"), (None, "1"), ("1", "1"), ("1e999", "1"), ("nan", "1")], "lat string, lon string")
    kinds = rows.select("lat", classify.coordinate_class("lat", "lon").alias("kind"))
    assert [r.kind for r in kinds.collect()] == ["drawable", "malformed", "malformed", "missing", "outside_accepted_range", "malformed", "malformed"]
    drawn = kinds.where("kind = 'drawable'")
    assert [r.lat for r in drawn.collect()] == ["35"]
    assert drawn._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(") == 2 * 2  # in the filter and in the column


def test_gates_count_nulls_repeats_and_strangers(spark):
    frame = spark.createDataFrame
    t = {
        "records": frame([(1, "p1", 35.0, 36.0, False), (1, "p2", None, None, False), (None, None, 35.0, 36.0, True), (3, "p3", 200.0, 36.0, None)], "record_id int, page_id string, latitude double, longitude double, direct_ok boolean"),
        "references": frame([("f1", 1, 7, "u", "n"), ("f1", 9, 8, "v", ""), ("f2", None, None, "v", None)], "source_reference_id string, record_id int, external_source_id int, raw_url string, normalized_url string"),
        "sources": frame([(7, "FULL_TEXT_DIRECT", " ", False, "h"), (7, "METADATA_ONLY", "x", True, "h"), (None, "no such", "x", None, "h")], "source_id int, content_status string, text string, full_text_passed boolean, content_hash string"),
        "pages": frame([("record", "p1"), ("record", None), ("record", "p9"), ("reference", "f1"), ("source", "7"), ("source", "6"), ("other", "p2")], "kind string, id string"),
        "links": frame([(3, 1, 2)], "checked int, broken int, escaped int"),
        "index": frame([("record", 1), ("source", 7), ("source", 99)], "kind string, id int"),
        "points": frame([(1,), (None,), (5,)], "record_id int"),
        "exports": frame([("raw", "u"), ("raw", "w"), ("normalized", "n"), ("raw", None)], "kind string, url string"),
        "manifest": frame([("source_entities", 3)], "name string, n bigint"),
        "report": frame([("incident_records_total", 4), ("local_source_entity_pages_generated", 1)], "name string, n bigint"),
        "layout": frame([("data",), ("data",)], "name string"),
        "assets": frame([], "name string"),
        "search_fields": frame([("date",)], "name string"),
        "search_filters": frame([("date",), ("coordinates",), ("source_status",), ("search_text",)], "name string"),
    }
    t["records"] = t["records"].selectExpr("*", "array(403) as direct_statuses", "array('') as direct_errors", "'direct' as origin_status", "'' as description")
    t["references"] = t["references"].selectExpr("*", "'ok' as url_status")
    gates = ground_truth.release_gates(t, 5)
    found = {r.gate: r.found for r in gates.collect() if r.found}
    assert found == {
        "missing_release_artifacts": 4,
        "incident_missing_separate_origin_fields": 1,
        "incident_file_count_mismatch": 1,
        "incident_ids_not_unique": 2,
        "incident_page_set_mismatch": 5,
        "source_reference_count_mismatch": 4,
        "source_reference_ids_not_unique": 1,
        "source_reference_page_set_mismatch": 1,
        "source_ids_not_unique": 2,
        "source_page_set_mismatch": 2,
        "reference_to_missing_incident": 2,
        "reference_to_missing_source_entity": 1,
        "raw_url_export_mismatch": 3,
        "direct_fetch_success_not_zero": 1,
        "http_403_reconciliation_failed": 1,
        "empty_source_counted_full": 1,
        "unvalidated_source_counted_full": 1,
        "metadata_source_counted_full": 1,
        "source_status_reconciliation_failed": 1,
        "utf8_or_json_errors": 1,
        "search_document_count_mismatch": 3,
        "search_fields_missing": 11,
        "map_point_count_mismatch": 3,
        "map_assets_missing": 2,
        "long_url_layout_protection_missing": 1,
        "internal_links_broken": 3,
        "ground_truth_release_mismatch": 5,
    }
    assert gates.where("ok").count() == 34 - len(found)
    passed = {r.criterion for r in ground_truth.acceptance_matrix(gates).where("passed").collect()}
    assert passed == {"every_normalized_reference_url_exported", "map_exclusions_explicit"}
    assert not ground_truth.acceptance_matrix(gates.where("gate != 'coordinate_reconciliation_failed'")).where("criterion = 'map_exclusions_explicit' and passed").count()


def test_staged_references_sort_a_bounded_number_of_rows(spark, measured, monkeypatch):
    monkeypatch.setattr(session, "ROWS_A_TASK", 100)
    rows = spark.range(4000).selectExpr("id % 1000 as record_id", "concat('u', id % 700) as raw_url", "id as ord")
    got, ran = measured(lambda: refs.collect_references(rows, rows, rows).collect())
    assert len(got) == 4000 and {r.origin for r in got} == {"historical"}
    assert max(s.numTasks() for s in ran) == 3 * 4000 // 100


def test_later_stages_add_the_first_place_of_new_pairs(spark):
    kind = "record_id int, raw_url string, ord int"
    one = spark.createDataFrame([(1, "a", 5), (1, "a", 2), (1, None, 9), (None, "n", 1)], kind)
    two = spark.createDataFrame([(1, "a", 1), (1, "b", 7), (1, "b", 3), (1, "d", None), (1, "d", 4), (2, "", 1), (None, "n", 1)], kind)
    three = spark.createDataFrame([(1, "b", 0), (1, "c", 2), (2, "c", 2), (2, "c", 1)], kind)
    got = refs.collect_references(one, two, three).select("record_id", "origin", "occurrence", "raw_url", "is_repeat").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(1, "historical", 1, "a", False), (1, "historical", 2, "a", True), (1, "historical", 3, None, False), (None, "historical", 1, "n", False)]
        + [(1, "provenance", 1, "d", False), (1, "provenance", 2, "b", False), (1, "embedded", 1, "c", False), (2, "embedded", 1, "c", False)],
        key=str,
    )
