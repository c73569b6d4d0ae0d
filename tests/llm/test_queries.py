"""The corpus queries against their SQL twins, and the pipeline stage by stage."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from tallyforge.llm.queries import ORACLES, QUERIES  # noqa: E402
from tests.llm.brute import jaccard_components, repeated_runs  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402

DATA = os.environ.get("TALLYFORGE_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    _, problems = compare(QUERIES[name](spark, DATA), duck, ORACLES[name])
    assert not problems


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    made = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, made[-1], DATA).write.parquet(str(tmp_path / str(i)))
        made.append(spark.read.parquet(str(tmp_path / str(i))))
    rows = [[r.asDict() for r in m.collect()] for m in made]
    assert all(m.columns == docs.columns for m in made[:5])
    # quality: a subset of whole rows, in which labelled good documents are kept
    good = {r.doc_id for r in spark.read.parquet(f"{DATA}/labels.parquet").where("quality = 1").collect()} & {r["doc_id"] for r in rows[0]}
    kept = {r["doc_id"]: r for r in rows[1]}
    assert all(kept[r["doc_id"]] == r for r in rows[0] if r["doc_id"] in kept)
    assert len(good & set(kept)) >= 0.95 * len(good)
    # lines
    want = repeated_runs([(r["doc_id"], r["text"]) for r in rows[1]], 50)
    assert {r["doc_id"]: r["text"] for r in rows[2]} == {d: t for d, (t, gone) in want.items() if not gone or t.split()}
    assert all(r["n_chars"] == len(r["text"]) or not want[r["doc_id"]][1] for r in rows[2])
    # one document of each group
    groups = jaccard_components([(r["doc_id"], r["text"]) for r in rows[2]])
    assert sorted(r["doc_id"] for r in rows[3]) == sorted(d for d, (_, c) in groups.items() if d == c)
    # mixing repeats whole rows
    by_id = {r["doc_id"]: r for r in rows[3]}
    assert rows[4] and all(by_id[r["doc_id"]] == r for r in rows[4])
    assert sorted(r["doc_id"] for r in rows[5]) == sorted(r["doc_id"] for r in rows[4])
    assert corpus_pipeline.run(spark, DATA).count() == len(rows[5])


def test_pipeline_stages_on_odd_rows(spark, tmp_path):
    """Null ids and texts, empty, white and long texts, repeated rows, names that the operators use, and no rows at all."""
    long = "\n".join(f"line {i} of a very long text with more words" for i in range(3000))
    rows = [(1, None, "en", "a", None), (2, "", None, None, 0), (3, " \t\n", "en", "b", 3), (4, long, "en", "b", len(long)), (4, long, "en", "b", len(long)),
            (None, "one text", "de", None, 8), (None, None, None, None, None), (5, long + "\nmore", "en", "c", len(long) + 5), (6, "one text", "de", "a", 8)]
    names = "doc_id long, text string, lang string, source string, n_chars long, copy int, shuffle_key string, row string, key long, h int, score string, label int, mask int"
    docs = spark.createDataFrame([(*r, 7, "s", "r", 8, 9, "x", 1, 2) for r in rows], names)
    docs.select("doc_id").where("doc_id < 4").distinct().selectExpr("doc_id", "CAST(doc_id % 2 AS INT) AS quality", "0 AS toxic").write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        for given in (docs, docs.limit(0)):
            out = stage(spark, given, str(tmp_path))
            got = out.collect()
            assert name.startswith("Sentence") or out.columns == docs.columns, name
            assert got or given is not docs or name.startswith("mixing"), name
            if name not in ("SentencePiece encoding and decoding",):
                assert all(r.copy == 7 and r.shuffle_key == "s" and r.row == "r" and r.key == 8 and r.h == 9 and r.score == "x" for r in got)
            if given is not docs:
                assert got == []
    deduped = corpus_pipeline.STAGES[1][1](spark, docs, str(tmp_path)).collect()
    assert sorted((r.doc_id, len(r.text or "")) for r in deduped if r.doc_id in (4, 5)) == [(4, len(long)), (4, len(long)), (5, 4)]
    assert [r.n_chars for r in deduped if r.doc_id == 5] == [4]
    groups = corpus_pipeline.STAGES[2][1](spark, docs, str(tmp_path)).collect()
    assert sum(r.doc_id == 4 for r in groups) == 1 and not any(r.doc_id == 5 for r in groups)
