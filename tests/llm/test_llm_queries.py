"""The registered queries against DuckDB, and the pipeline against its stages' plain versions."""

import sys

import brute
import numpy as np
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from conftest import DATA
from oracle_compare import connect, differences
from starhouse.llm import queries

FOLDER = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_oracle(spark, con, name):
    df = entry_points.queries()[name](spark, FOLDER)
    assert differences(df, con, queries.ORACLES[name]) == []


def _documents():
    table = pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()
    return [(r["doc_id"], r["text"]) for r in table]


def test_every_operator_has_one_query():
    names = [n.split("_")[0] for n in queries.QUERIES]
    assert sorted(names) == sorted(f"op{n}" for n in range(1, 11))
    assert set(queries.ORACLES) < set(queries.QUERIES) < set(entry_points.queries())


def test_op8_equals_brute_force(spark):
    found = brute.by_id(queries.op8_suffix_array_dedup(spark, FOLDER))
    rows = _documents()
    assert len(found) == len(rows)
    for (i, _), (removed, spans, kept) in zip(rows, brute.kept_bytes(rows), strict=True):
        r = found[i]
        assert (r["n_removed"], r["n_spans"], r["kept_sha256"]) == (
            removed, spans, brute.sha256(kept))


def test_op5_round_trip(spark):
    found = brute.by_id(queries.op5_byte_bpe(spark, FOLDER))
    assert all(found[i]["decoded_sha256"] == brute.sha256(t or "") for i, t in _documents())


def test_op9_counts_what_op5_encodes(spark):
    found = brute.by_id(queries.op9_token_counts(spark, FOLDER))
    assert len(found) == len(_documents())
    assert all(sum(r["section_tokens"]) == sum(r["field_tokens"]) == r["n_tokens"]
               for r in found.values())


def test_op4_reads_every_page(spark):
    pages = pq.read_table(f"{FOLDER}/pages.parquet").to_pylist()
    found = {r["page_id"]: r for r in queries.op4_warc(spark, FOLDER).collect()}
    assert {p: r["payload_bytes"] for p, r in found.items()} == {
        r["page_id"]: len((r["html"] or "").encode()) for r in pages}


def test_op2_score_and_split(spark):
    found = queries.op2_language_id(spark, FOLDER).collect()
    langs = dict(pq.read_table(f"{FOLDER}/documents.parquet").select(
        ["doc_id", "lang"]).to_pandas().values.tolist())
    assert 0 < sum(r["held_out"] for r in found) < len(found) == len(langs)
    right = [r["lang_pred"] == langs[r["doc_id"]] for r in found if r["held_out"]]
    assert np.mean(right) > 0.95


def test_pipeline_equals_its_stages(spark, monkeypatch):
    rows = [dict(r, text=r["text"]) for r in pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()]
    verdicts = brute.by_id(queries.op10_quality_rules(spark, FOLDER))
    rows = [r for r in rows if verdicts[r["doc_id"]]["kept"]]
    lines = brute.kept_lines([(r["doc_id"], r["text"]) for r in rows])
    rows = [(r["doc_id"], line[2]) for r, line in zip(rows, lines, strict=True)]
    heads = brute.components([t for _, t in rows])
    first = {h: min(rows[i][0] for i, x in enumerate(heads) if x == h) for h in set(heads)}
    rows = [r for r, h in zip(rows, heads, strict=True) if first[h] == r[0]]
    items = [(r["item_id"], r["text"])
             for r in pq.read_table(f"{FOLDER}/benchmark.parquet").to_pylist()]
    rows = [r for r in rows if not brute.phrase_hits(r[1], items)[1]]
    found = brute.by_id(corpus_pipeline.run(spark, FOLDER))
    assert sorted(found) == sorted(i for i, _ in rows)
    for i, text in rows:
        assert found[i]["decoded_sha256"] == brute.sha256(text)
        assert found[i]["n_tokens"] == len(found[i]["ids"])


def test_stages_keep_the_columns_and_bear_odd_rows(spark):
    text = " ".join(f"word{i}" for i in range(80))
    rows = [(1, text, "en", "s"), (1, text, "en", "s"), (None, text, None, None),
            (2, None, None, "s"), (3, "", "en", None), (4, text + " end", "en", "s"),
            (5, text.upper(), "en", "s")]
    docs = spark.createDataFrame(
        [(*r, len(r[1] or "")) for r in rows],
        "doc_id long, text string, lang string, source string, n_chars long")
    left = docs
    sizes = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, FOLDER)
        assert left.columns == docs.columns and left.dtypes == docs.dtypes
        sizes.append(left.count())
    # the repeated line stays in 5 only; 4 and 5 are similar; the emptied rows link with nothing
    assert sizes == [5, 5, 4, 4]
    assert {r["doc_id"] for r in left.collect()} == {None, 1, 4}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), FOLDER).count() == 0, name


@pytest.mark.parametrize("most", [0, corpus_pipeline.BROADCAST_ROWS])
def test_quality_stage_takes_common_lines_out(spark, monkeypatch, most):
    monkeypatch.setattr(corpus_pipeline, "BROADCAST_ROWS", most)
    body = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(14)]
    rows = [(i, f" Home About \n{b}\n\nhome about", "en", "h") for i, b in enumerate(body[:12])]
    rows += [rows[0], (20, f"home about\n{body[12]}", "en", None), (21, "home about", "en", "h")]
    docs = spark.createDataFrame(
        [(*r, len(r[1])) for r in rows],
        "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.quality_rules(spark, docs, FOLDER)
    assert left.dtypes == docs.dtypes
    want = [(i, f"{b}\n") for i, b in enumerate(body[:12])] + [(0, f"{body[0]}\n"), rows[13][:2]]
    found = [(r["doc_id"], r["text"]) for r in left.collect()]
    assert sorted(found) == sorted(want)
    assert all(r["n_chars"] == len(r["text"]) for r in left.collect())


def test_a_null_elsewhere_makes_another_row(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(1, good, None), (1, None, good)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr(
        "doc_id", "text", "'en' AS lang", "source", "60L AS n_chars")
    left = corpus_pipeline.quality_rules(spark, docs, FOLDER).collect()
    assert [(r["text"], r["source"]) for r in left] == [(good, None)]


@pytest.mark.parametrize("most", [0, corpus_pipeline.BROADCAST_ROWS])
def test_near_duplicates_keep_one_row_of_a_group(spark, monkeypatch, most):
    monkeypatch.setattr(corpus_pipeline, "BROADCAST_ROWS", most)
    text = [" ".join(f"w{i}x{j}" for j in range(80)) for i in range(4)]
    rows = [(1, text[0], "en", "s"), (1, text[0], "en", "r"), (1, text[0], "en", "r"),
            (1, text[0] + " end", "en", "a"), (2, text[0], "en", "a"), (None, text[0], "en", "a"),
            (None, text[1], "en", "s"), (None, text[1], "en", "s"), (None, text[1] + " end", None, "s"),
            (3, text[2], "en", "s"), (3, text[3], "en", "s"), (None, "", "en", "s"),
            (None, "", "en", "s"), (None, None, "en", "s")]
    docs = spark.createDataFrame(
        [(*r, len(r[1] or "")) for r in rows],
        "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.near_duplicates(spark, docs, FOLDER)
    assert left.dtypes == docs.dtypes
    found = [tuple(r)[:4] for r in left.collect()]
    of = {i: [r for r in found if (r[1] or "").startswith(f"w{i}x")] for i in range(4)}
    assert len(found) == 7 and [len(of[i]) for i in range(4)] == [1, 1, 1, 1]
    assert of[0][0] in ((1, text[0], "en", "r"), (1, text[0] + " end", "en", "a"))
    assert of[1][0][0] is None and of[2] == [rows[9]] and of[3] == [rows[10]]


def test_the_package_works_without_the_subpackage(monkeypatch):
    import importlib

    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    found = importlib.reload(entry_points)
    assert "pipeline" not in found.queries() and "dim_date" in found.queries()
    monkeypatch.undo()
    assert "pipeline" in importlib.reload(entry_points).queries()
