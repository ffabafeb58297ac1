"""Every operator on odd rows and on an empty table: defined results, one row per input row."""

import importlib.util
import sys
from pathlib import Path

import pytest

from vela.llm import (language_id, mixing, near_dedup, packing, quality_classifier, quality_rules, secrets, toxicity,
                      url_reputation, vp_search)

LABELS = "doc_id bigint, quality int, toxic int"


def test_quality_rules_edges(odd_docs, no_docs):
    rows = quality_rules.report(odd_docs).collect()
    assert len(rows) == 9
    assert all(r.base_failed and not r.kept for r in rows if r.n_words < 50)
    assert {r.doc_id: r.n_words for r in rows}[1] == 0
    assert quality_rules.report(no_docs).count() == 0
    assert quality_rules.filter_docs(odd_docs).columns == odd_docs.columns


def test_near_dedup_edges(odd_docs, no_docs):
    rows = near_dedup.groups(odd_docs).collect()
    assert len(rows) == 9
    by = {r.doc_id: r for r in rows}
    assert by[1].n_shingles == by[2].n_shingles == by[3].n_shingles == 0
    assert by[4].n_shingles == 1 and by[None].component_id is None
    assert all(r.kept for r in rows)
    assert near_dedup.groups(no_docs).count() == 0
    assert near_dedup.filter_docs(odd_docs).columns == odd_docs.columns


def test_secret_edges(odd_docs, no_docs):
    rows = secrets.report(odd_docs).collect()
    assert len(rows) == 9 and all(r.spans == "" for r in rows)
    assert secrets.report(no_docs).count() == 0
    assert sorted(secrets.redact(odd_docs).collect(), key=str) == sorted(odd_docs.collect(), key=str)


def test_mixing_edges(odd_docs, no_docs):
    rows = mixing.report(odd_docs).collect()
    assert len(rows) == 9
    assert all(0 <= r.taken <= 2 * r["size"] for r in rows)
    assert mixing.report(no_docs).count() == 0
    assert mixing.mix(no_docs).count() == 0
    mixed = mixing.mix(odd_docs)
    assert mixed.columns == odd_docs.columns


def test_packing_edges(odd_docs, no_docs):
    rows = packing.pack(odd_docs).collect()
    total = {}
    for r in rows:
        total.setdefault(r.doc_id, []).append(r)
    assert sum(r.length for r in total[1]) == total[1][0].doc_tokens == 1
    assert sum(r.length for r in total[5]) == total[5][0].doc_tokens > 1024
    assert sum(r.length for r in total[6]) == 2 * total[6][0].doc_tokens
    assert packing.pack(no_docs).count() == 0


def test_classifier_edges(frame, odd_docs, no_docs):
    labels = frame([(2, 1, 0), (4, None, None), (5, 0, 1), (6, 1, 0), (99, 1, 1)], LABELS)
    none = frame([], LABELS)
    for table in (labels, none):
        for report in (quality_classifier.report, toxicity.report):
            rows = report(odd_docs, table).collect()
            assert len(rows) == 9 and all(0 <= r.score <= 1 for r in rows)
            assert report(no_docs, table).count() == 0


def test_language_edges(odd_docs, no_docs):
    rows = {r.doc_id: r for r in language_id.report(odd_docs).collect()}
    assert rows[1].lang_pred == rows[2].lang_pred == rows[7].lang_pred == "und"
    assert all(0 <= r.score <= 1 for r in rows.values())
    assert language_id.report(no_docs).count() == 0


def test_url_edges(frame):
    schema = "page_id bigint, url string, html string, verdict string, host string"
    pages = frame([(1, None, None, "x", "y"), (2, "no scheme", None, "x", "y"), (3, "http://A.Example.ORG/es/1?q#f", None, "x", "y"),
                   (3, "http://A.Example.ORG/es/1?q#f", None, "x", "y"), (4, "https://org", None, "x", "y"), (None, "a://b.com/de/://x", "", "x", "y")], schema)
    rows = url_reputation.judge(pages).collect()
    assert len(rows) == 6
    by = {r.page_id: r for r in rows}
    assert (by[1].host, by[1].path, by[1].rule) == ("", "", None) == (by[2].host, by[2].path, by[2].rule)
    assert (by[3].host, by[3].path, by[3].rule, by[3].verdict) == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert (by[4].path, by[4].rule) == ("", None)
    assert (by[None].host, by[None].path, by[None].rule) == ("b.com", "/de/://x", "com/de/")
    assert url_reputation.judge(frame([], schema)).count() == 0


def test_vector_edges(frame):
    schema = "vec_id bigint, embedding array<float>, label int"
    nan = float("nan")
    rows = [(0, [1.0, 0.0], 1), (100, [1.0, 0.0], 1), (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [nan, 1.0], 1), (5, [1.0, None], 1),
            (6, [1.0, 1.0, 1.0], 1), (7, [1.0, 0.0], 1), (7, [1.0, 0.0], 1), (8, [float("inf"), 0.0], 1), (None, [1.0, 0.0], 1), (9, [2.0, 0.0], 1)]
    found = vp_search.report(frame(rows, schema)).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == [
        (0, 1, 7, 0.0), (0, 2, 100, 0.0), (0, 3, 9, 1.0), (100, 1, 0, 0.0), (100, 2, 7, 0.0), (100, 3, 9, 1.0)]
    assert vp_search.report(frame([], schema)).count() == 0


@pytest.fixture()
def pipeline():
    root = Path(__file__).resolve().parents[2]
    spec = importlib.util.spec_from_file_location("corpus_pipeline", root / "corpus_pipeline.py")
    module = importlib.util.module_from_spec(spec)
    sys.modules.setdefault("corpus_pipeline", module)
    spec.loader.exec_module(module)
    return module


def test_pipeline_stages_keep_columns(spark, pipeline, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in pipeline.STAGES[:-1]:
            out = stage(spark, docs, "")
            assert out.columns == docs.columns
            out.count()


CLASHING = ("_id", "_s", "_n", "_nth", "_kept", "_base", "_copies", "_copy", "_gone", "cut", "lang_", "source_", "stats", "cut_lang", "mix_id", "mix_nth",
            "mix_of", "mix_times", "mix_copy", "gone", "x", "doc", "size", "start", "length", "ids", "form", "n")


def test_stages_return_columns_of_clashing_names_unchanged(spark, frame, pipeline):
    words = " ".join(f"good{k} words{k % 7}" for k in range(60))
    rows = [(k, f"{words} {k % 4} {'odd ' * (k % 3)}", ("en", "de", None)[k % 3], ("a", "b", None)[k % 3], 100, *[f"{c}{k}" for c in CLASHING]) for k in range(30)]
    rows += [(1, None, None, None, None, *[None] * len(CLASHING)), (2, "", "en", "a", 0, *["z"] * len(CLASHING))]
    docs = frame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in CLASHING))
    given = {tuple(r) for r in rows}
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        kept = [tuple(r) for r in out.collect()]
        assert kept and set(kept) <= given, name
    assert pipeline.STAGES[-1][1](spark, docs, "").count() >= len(rows)


def test_pipeline_runs(spark, sf, pipeline):
    pieces = pipeline.run(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    rows = pieces.collect()
    assert rows and {r.doc_id for r in rows} <= ids
    kept = {r.doc_id for r in near_dedup.groups(quality_rules.filter_docs(docs)).filter("kept").collect()}
    assert {r.doc_id for r in rows} <= kept
