from __future__ import annotations

import re

import pytest

from layerloom import sources
from layerloom.plans import export_by_key, store_responses, stored_elements, stored_rejects
from workload.sources import envelope_rejects

GOOD = [
    (1, '{"results": 2, "response": [{"league": {"id": 140}, "n": 1}, {"league": {"id": 39}, "n": 2}]}'),
    (2, '{"results": 1, "response": [{"league": {"id": 140}, "n": 3}]}'),
    (2, '{"results": 1, "response": [{"league": {"id": 140}, "n": 3}]}'),
]
NO_ROWS = [
    (3, '{"results": 0, "response": []}'),
    (4, '{"results": 0, "response": [{"league": {"id": 1}}]}'),
    (5, '{"response": [{"league": {"id": 1}}]}'),
    (6, '{"results": null, "response": [{"league": {"id": 1}}]}'),
    (7, '{"results": 3}'),
    (8, '{"results": 3, "response": null}'),
    (9, '{"errors": {"token": "bad"}}'),
    (9, '{"results": 2.0, "response": []}'),
]
BAD = [
    (10, "<html>502</html>"),
    (11, None),
    (12, ""),
    (13, " \n"),
    (14, "[1, 2]"),
    (15, '{"results": 1, "response": [{"league"'),
    (16, '{"results": 1, "response": {"a": 1}}'),
    (17, '{"results": 1, "response": [{}]} trailing'),
    (18, '{"results": 1, "response": [{}]}{"results": 1, "response": [{}]}'),
    (19, '{"results": 1, "response": [{}]}\n{"results": 1, "response": [{}]}'),
    (20, '{"results": 1, "response": [{}]},{"results": 1, "response": [{}]}'),
    (21, '{"results": 1, "response": [{}]}}'),
    (22, '{"results": 1, "response": [{}]}]'),
    (23, '{"results": 1, "response": [{}]}]}'),
    (24, "{'results': 1, 'response': [{}]}"),
    (25, "null"),
    (26, "[]"),
    (27, '[{"results": 1, "response": [{}]}]'),
    (28, "7"),
    (29, '"text"'),
    (30, "true"),
    (31, '{"results": "1", "response": [{}]}'),
    (32, '{"results":1,"response":["a"]}], "x": [1'),
    (33, '{"results":1,"response":["a"]}], "body": [{"results":1,"response":["b"]}'),
    (34, '{"results":1,"response":["a"]}], "end": true}, {"y": [1'),
    (35, '{"results": "NaN", "response": [{}]}'),
]
ELEMENT = "league struct<id: bigint>, n bigint"


@pytest.fixture
def landed(spark):
    return spark.createDataFrame(GOOD + NO_ROWS + BAD, "request int, body string")


def test_accepted_typed(landed):
    rows = sources.accepted(landed, element=ELEMENT).select("request", "element.league.id", "element.n")
    assert sorted(map(tuple, rows.collect())) == [(1, 39, 2), (1, 140, 1), (2, 140, 3), (2, 140, 3)]


def test_accepted_untyped_keeps_the_json_text(landed):
    rows = sources.accepted(landed).select("request", "element").collect()
    assert sorted((r.request, r.element) for r in rows) == [
        (1, '{"league":{"id":140},"n":1}'),
        (1, '{"league":{"id":39},"n":2}'),
        (2, '{"league":{"id":140},"n":3}'),
        (2, '{"league":{"id":140},"n":3}'),
    ]


@pytest.mark.parametrize("element", [None, ELEMENT])
def test_rejected_keeps_every_unreadable_body(landed, element):
    rows = sources.rejected(landed, element=element).collect()
    assert sorted((r.request, r.rejected_body) for r in rows) == BAD


@pytest.mark.parametrize("element", [None, ELEMENT])
def test_opened_is_both_sides(landed, element):
    rows = sources.opened(landed, element=element)
    good = rows.filter("outcome = 'accepted'").select("request", "element")
    bad = rows.filter("outcome = 'rejected'").select("request", "rejected_body")
    assert sorted(map(repr, good.collect())) == sorted(
        map(repr, sources.accepted(landed, element=element).collect())
    )
    assert sorted(map(tuple, bad.collect())) == BAD
    empty = rows.filter("outcome = 'empty'")
    assert sorted(r.request for r in empty.collect()) == [request for request, _ in NO_ROWS]
    assert empty.filter("element is not null or rejected_body is not null").count() == 0


def test_results_may_be_any_number(spark):
    landed = spark.createDataFrame([(1, '{"results": 1.0, "response": [{"n": 1}]}')], "r int, body string")
    assert sources.accepted(landed).count() == 1


@pytest.mark.parametrize("name", ["outcome", "element", "rejected_body", "_body", "_envelope"])
def test_parameters_that_would_clash_are_refused(spark, name):
    landed = spark.createDataFrame([(1, "{}")], f"{name} int, body string")
    for read in (sources.accepted, sources.rejected, sources.opened):
        with pytest.raises(ValueError, match=name):
            read(landed)


def test_null_element_is_kept(spark):
    landed = spark.createDataFrame([(1, '{"results": 2, "response": [null, {"n": 1}]}')], "r int, body string")
    assert sources.accepted(landed).count() == 2
    assert sources.opened(landed).filter("outcome = 'accepted'").count() == 2


def test_only_empty_responses_still_write_a_table(spark, config):
    landed = spark.createDataFrame(NO_ROWS, "request int, body string")
    schema = store_responses(landed, config, "teams")
    assert stored_elements(spark, config, "teams", schema).count() == 0
    assert stored_rejects(spark, config, "teams", schema).count() == 0


def test_store_and_export(spark, landed, config):
    schema = store_responses(landed, config, "fixtures", element=ELEMENT)
    elements = stored_elements(spark, config, "fixtures", schema)
    assert elements.columns == ["request", "element"]
    assert elements.count() == 4
    rejects = stored_rejects(spark, config, "fixtures", schema)
    assert sorted(map(tuple, rejects.collect())) == BAD
    path = export_by_key(elements, config, "by_league", "league.id", "league_id", keys=[140])
    back = sources.read_by_key(spark, path, f"{ELEMENT}, league_id bigint")
    assert sorted((r.league.id, r.n, r.league_id) for r in back.collect()) == [
        (140, 1, 140),
        (140, 3, 140),
        (140, 3, 140),
    ]


def test_landed_files_to_exports(spark, config, tmp_path):
    bodies = {
        (140, 2023): '{"results": 2,\n "response": [{"league": {"id": 140}, "n": 1}, {"league": {"id": 140}, "n": 2}]}',
        (39, 2023): '{"results": 1, "response": [{"league": {"id": 39}, "n": 3}]}\n',
        (45, 2023): '{"results": 0, "response": []}',
        (2, 2023): "<html>429</html>",
    }
    for (league, season), body in bodies.items():
        folder = tmp_path / f"league={league}" / f"season={season}"
        folder.mkdir(parents=True)
        (folder / "response.json").write_text(body)
    landed = sources.read_landed(spark, str(tmp_path))
    schema = store_responses(landed, config, "games", element=ELEMENT)
    assert [(r.league, r.season, r.rejected_body) for r in stored_rejects(spark, config, "games", schema).collect()] == [(2, 2023, "<html>429</html>")]
    elements = stored_elements(spark, config, "games", schema)
    path = export_by_key(elements, config, "games_by_league", "league.id", "league_id")
    back = sources.read_by_key(spark, path, f"{ELEMENT}, league_id bigint").collect()
    assert sorted((r.league_id, r.n) for r in back) == [(39, 3), (140, 1), (140, 2)]


def test_rejects_are_counted_without_whole_bodies(spark, tmp_path):
    text = "long " * 50_000
    docs = [(1, "en", text), (2, "en", text + "x"), (3, None, ""), (4, "de", "a\nb")]
    tables = {
        "documents": (docs, "doc_id bigint, lang string, text string"),
        "pages": ([("<p>" + text,), ("<p>" + text,), (None,), ("",)], "html string"),
        "events": ([('{"k": 1}',)], "props string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    found = envelope_rejects(spark, str(tmp_path))
    assert sorted(map(tuple, found.collect())) == [("broken", 16, 16), ("html", 4, 2)]
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "HashAggregate(keys=[lang" in plan and not re.search(r"keys=\[lang#\d+, rejected_body#", plan)
