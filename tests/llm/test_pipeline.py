from __future__ import annotations

import corpus_pipeline
import pytest
from salesmart.llm import common
from salesmart.llm.common import noted, stored
from tests.llm.helpers import SF_DIR, docs

LABELLED = "/root/testdata/sf0.01"  # the smallest tables with enough toxic labels


def test_stages_take_effect(spark):
    first = spark.read.parquet(f"{LABELLED}/documents.parquet")
    toxic = {r.doc_id for r in spark.read.parquet(f"{LABELLED}/labels.parquet").where("toxic = 1").collect()}
    frame, columns, rows = first, first.columns, {}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mix", "encode"]
    for name, stage in corpus_pipeline.STAGES:
        frame = stored(stage(spark, frame, LABELLED), name)
        rows[name] = frame.collect()
        if name != "encode":
            assert frame.dtypes == first.dtypes and frame.columns == columns
    ids = {name: [r.doc_id for r in found] for name, found in rows.items()}
    assert len(set(ids["toxicity"]) & toxic) < 0.4 * len(toxic)
    assert sorted(ids["line_dedup"]) == sorted(ids["toxicity"])
    assert sum(len(r.text) for r in rows["line_dedup"]) < sum(len(r.text) for r in rows["toxicity"])
    assert all(r.n_chars == len(r.text) for r in rows["line_dedup"])
    assert len(ids["near_dedup"]) == len(set(ids["near_dedup"])) < len(ids["line_dedup"])
    assert set(ids["mix"]) <= set(ids["near_dedup"]) and len(ids["mix"]) > len(set(ids["mix"]))
    assert sorted(ids["encode"]) == sorted(ids["mix"])
    assert all(r.n_tokens == len(r.token_ids) for r in rows["encode"])


def test_run_is_the_stages(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    again = corpus_pipeline.run(spark, SF_DIR).collect()
    assert rows and sorted(map(str, rows)) == sorted(map(str, again))


def test_run_leaves_one_stored_table(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(common, "shared_folder", lambda _: str(tmp_path))
    rows = corpus_pipeline.run(spark, SF_DIR)
    kept = {p.name: spark.read.parquet(str(p)).count() for p in tmp_path.iterdir()}
    assert len(kept) > 4 and [name.rsplit("-", 1)[0] for name, n in kept.items() if n] == ["stage-mix"]
    assert rows.count() == sum(kept.values())


def test_a_stage_that_fails_leaves_what_it_read(spark, monkeypatch, tmp_path):
    def fails(spark, docs, sf_dir):
        return docs.selectExpr("raise_error('no') as doc_id")

    first = ("first", lambda spark, docs, sf_dir: docs)
    monkeypatch.setattr(common, "shared_folder", lambda _: str(tmp_path))
    monkeypatch.setattr(corpus_pipeline, "STAGES", [first, ("second", fails), first])
    with pytest.raises(Exception, match="no"):
        corpus_pipeline.run(spark, SF_DIR)
    (path,) = tmp_path.glob("stage-first-*")
    assert spark.read.parquet(str(path)).count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()


def test_noted_blocks_are_apart(spark):
    with noted() as outer:
        stored(spark.range(1), "one")
        with noted() as inner:
            stored(spark.range(1), "two")
    stored(spark.range(1), "three")
    assert ["/one-" in p for p in outer] == [True] and ["/two-" in p for p in inner] == [True]


def test_odd_tables(spark):
    odd = docs(spark, [None, "", " \n\t", "x", "x", "one two three"] + ["word " * 30000]).union(docs(spark, ["again"]))
    frames = [docs(spark, ["a"]).where("false"), odd]
    for frame in frames:
        for name, stage in corpus_pipeline.STAGES:
            frame = stored(stage(spark, frame, SF_DIR), name)
        assert frame.count() >= 0


def test_clashing_columns_stay(spark):
    clash = docs(spark, ["a b c d e f", "a b c d e f"])
    names = ["rate", "copy", "copies", "mix_key", "n_lines", "n_dropped", "fp", "component_id", "score", "predicted"]
    for name in names:
        clash = clash.selectExpr("*", f"'mine' as {name}")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        clash = stage(spark, clash, SF_DIR)
        assert all(r[name] == "mine" for r in clash.collect() for name in names)
