import json
import os

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.storage import load_artifact, save_artifact
from corpusloom.sources import articles as art
from corpusloom.sources import labels as lab
from corpusloom.sources import sinks


def paper(paper_id, abstract=None, body=(), authors=(("Ada", "Byron"), ("Alan", "Turing"))):
    doc = {
        "paper_id": paper_id,
        "metadata": {"title": f"title {paper_id}", "authors": [{"first": f, "last": n, "middle": []} for f, n in authors]},
        "body_text": [{"text": t, "section": s, "cite_spans": []} for t, s in body],
        "back_matter": [],
    }
    if abstract is not None:
        doc["abstract"] = [{"text": t} for t in abstract]
    return doc


def write(folder, docs):
    for i, doc in enumerate(docs):
        sub = folder / f"part{i % 2}"
        sub.mkdir(exist_ok=True)
        (sub / f"{doc['paper_id']}.json").write_text(json.dumps(doc, indent=1))
    (folder / "notes.txt").write_text("not an article")
    (folder / "part0" / "copy.json.bak").write_text("{}")


def test_scan_and_flatten(spark, tmp_path):
    write(tmp_path, [
        paper("b", ["One.", "Two."], [("p1", "Intro"), ("p2", "End")]),
        paper("a", None, [("only", "Intro")]),
        paper("c", [], [("x", "Intro")], authors=[]),
        paper("d", None, []),
    ])
    rows = {r.paper_id: r for r in art.flatten_articles(art.scan_articles(spark, str(tmp_path))).collect()}
    assert sorted(rows) == ["a", "b", "c", "d"]
    assert rows["b"].abstract == "One. Two." and rows["b"].body == "p1 p2 One. Two."
    assert rows["b"].authors == "Ada Byron, Alan Turing"
    assert rows["a"].abstract == "" and rows["a"].body == "only "
    assert rows["c"].abstract == "" and rows["c"].authors == "" and rows["c"].body == "x "
    assert rows["d"].authors == "" and rows["d"].body == " "  # no body, so no authors


def test_keywords_accumulate(spark, tmp_path):
    write(tmp_path, [
        paper("a", None, [("k1", "Keywords"), ("text", "Intro"), ("k2", "Keywords")]),
        paper("b", None, [("text", "keywords")]),
    ])
    nested = art.scan_articles(spark, str(tmp_path))
    rows = sorted((r.paper_id, r.seq, r.keywords) for r in art.article_keywords(nested).collect())
    assert rows == [("a", 0, "k1"), ("a", 1, "k1k2")]
    flat = spark.createDataFrame([("a", 0, "k1"), ("a", 2, "k2")], "paper_id string, pos int, text string")
    assert sorted((r.paper_id, r.seq, r.keywords) for r in art.running_keywords(flat).collect()) == rows
    counts = art.corpus_counts(art.flatten_articles(nested), art.article_keywords(nested)).first()
    assert (counts.documents, counts.abstracts, counts.keyword_entries) == (2, 0, 2)


def test_numbering_lookup_and_related(spark, tmp_path):
    write(tmp_path, [
        paper("c", ["short"], [("about Surveillance", "I")]),
        paper("a", ["abs"], [("clinical work", "I")]),
        paper("b", None, [("screening", "I")]),
    ])
    nested = art.scan_articles(spark, str(tmp_path))
    flat = art.flatten_articles(nested)
    meta = {r.paper_id: (r.paper_number, r.label) for r in art.article_metadata(flat).collect()}
    assert meta == {"a": (0, 1), "b": (1, 1), "c": (2, 1)}
    assert art.article_lookup(nested, 0).first().text == "abs"
    assert art.article_lookup(nested, 1).first().text == "screening "
    found = art.related_abstracts(flat, ["clinical", "screening", "surveillance"])
    assert [r.paper_id for r in found.collect()] == ["a"]  # case matters, and b has no abstract
    assert {r.paper_id: r.paper_number for r in art.number_articles(flat).collect()} == {"a": 0, "b": 1, "c": 2}


def test_label_sheet_round_trip(spark, tmp_path):
    rows = [("p1", 'say "hi", twice', " lead", 7, 1), ("p2", "line\nbreak ", "", 3, 0)]
    sheet = spark.createDataFrame(rows, lab.SHEET_SCHEMA)
    back = sinks.write_csv(sheet, str(tmp_path / "sheet"))
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    assert sorted(map(tuple, lab.read_labels(spark, str(tmp_path / "sheet")).collect())) == [(3, 0), (7, 1)]


def test_rows_at_positions(spark):
    labels = spark.createDataFrame([(10, 1), (30, 0), (20, 1)], "paper_number bigint, label int")
    positions = spark.createDataFrame([(1,), (3,)], "row_no bigint")
    got = sorted((r.row_no, r.paper_number) for r in lab.label_rows_at(labels, positions).collect())
    assert got == [(1, 10), (3, 30)]


def test_predictions_review_and_reports(spark, tmp_path):
    meta = spark.createDataFrame([(str(i), "t", "", i, 1) for i in range(5)], lab.SHEET_SCHEMA)
    predictions = spark.createDataFrame([(i, i % 2) for i in range(5)], "paper_number bigint, prediction int")
    written = sinks.write_predictions(meta, predictions, str(tmp_path / "p"))
    assert {r.paper_number: r.label for r in written.collect()} == {i: i % 2 for i in range(5)}
    picked = spark.createDataFrame([(1,), (1,), (4,)], "paper_number bigint")
    again = sinks.write_review_batch(meta, picked, str(tmp_path / "r"))
    assert sorted((r.paper_number, r.label) for r in again.collect()) == [(1, 1), (1, 1), (4, 1)]
    report = sinks.write_topic_reports(meta, picked, predictions, str(tmp_path / "t"))
    assert {r.report: r.rows for r in report.collect()} == {"doc_topics": 5, "topic_distribution": 3, "topic_keywords": 5}
    assert os.path.isdir(tmp_path / "t" / "topic_keywords")


def test_artifacts(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, [])], "id int, tokens array<string>")
    save_artifact(df, str(tmp_path / "tokens"))
    assert sorted(map(tuple, load_artifact(spark, str(tmp_path / "tokens")).collect())) == [(1, ["a", "b"]), (2, [])]
    assert df.agg(F.count("*")).first()[0] == 2


def test_broken_file_is_an_error(spark, tmp_path):
    write(tmp_path, [paper("a", None, [("x", "I")])])
    (tmp_path / "part0" / "z.json").write_text('{"paper_id": "z", ')
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILFAST"):
        art.flatten_articles(art.scan_articles(spark, str(tmp_path))).collect()
