"""Registered queries against their SQL, and the pipeline stage by stage."""
import sys
from collections import Counter

import duckdb
import pytest

sys.path.insert(0, ".")
import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from portalforge.llm import decontam, neardup, pii, quality, registry  # noqa: E402
from portalforge.llm.common import stored, table  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = registry.QUERIES[name](spark, SF)
    want = con.execute(registry.ORACLE[name]).fetchall()
    columns = [c[0] for c in con.description]
    assert sorted(columns) == sorted(df.columns)
    assert Counter(map(tuple, df.select(*columns).collect())) == Counter(want)


def test_every_operator_is_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert any(x.startswith(f"op{n}_") for x in names)
    assert "pipeline" in names


def test_contract_columns(spark):
    expect = {"op11_lm_scores": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint",
                                 "train_tokens": "bigint", "base_score": "double", "score": "double", "bits_per_byte": "double"},
              "op12_conversation_repair": {"conv_id": "bigint", "gaps": "bigint", "blank": "bigint", "duplicate": "bigint",
                                           "truncated": "bigint", "illegal": "bigint", "cost": "bigint", "audit": "string",
                                           "repaired_sha256": "string"},
              "op13_merkle_manifest": {"doc_id": "bigint", "leaf": "string", "subroot": "string", "root": "string",
                                       "proof_sha256": "string", "folded_root": "string", "verified": "boolean"},
              "op1_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
              "op2_probminhash_neardup": {"doc_id": "bigint", "class_id": "bigint"},
              "op3_substring_dedup": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
              "op5_exact_topk": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
              "op6_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
              "op7_language": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}}
    for name, columns in expect.items():
        df = registry.QUERIES[name](spark, SF)
        assert dict(df.dtypes) == columns, name


def test_pipeline_stages(spark):
    docs = stored(table(spark, SF, "documents"), "in")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_dedup", "decontaminate", "pseudonymise", "mix"]

    good = stored(stages["quality"](spark, docs, SF), "q")
    network = quality.fit(docs, table(spark, SF, "labels"))
    want = {r.doc_id for r in quality.score(docs, network).collect() if r.score >= quality.THRESHOLD}
    assert {r.doc_id for r in good.select("doc_id").collect()} == want

    unique = stored(stages["near_dedup"](spark, good, SF), "u")
    assert sorted(r.doc_id for r in unique.select("doc_id").collect()) == sorted({r.class_id for r in neardup.classes(good).collect()})

    bench = table(spark, SF, "benchmark")
    clean = stored(stages["decontaminate"](spark, unique, SF), "c")
    gone = {r.doc_id for r in decontam.contamination(unique, bench).filter("contaminated").collect()}
    before = {r.doc_id for r in unique.select("doc_id").collect()}
    assert {r.doc_id for r in clean.select("doc_id").collect()} == before - gone

    private = stored(stages["pseudonymise"](spark, clean, SF), "p")
    f = pii.Feistel(pii.DEMO_KEY)
    assert {r.doc_id: r.text for r in private.collect()} == {r.doc_id: pii.pseudonymise(r.text, f)[0] for r in clean.collect()}
    for part in (good, unique, clean, private):
        assert part.columns == docs.columns

    mixed = stages["mix"](spark, private, SF)
    assert {(r.doc_id, r.text) for r in mixed.collect()} <= {(r.doc_id, r.text) for r in private.collect()}
    rows = lambda df: sorted((r.doc_id, r.epoch, r.text) for r in df.collect())
    assert rows(corpus_pipeline.run(spark, SF)) == rows(mixed)
