"""The pipeline stage by stage against plain versions."""

import corpus_pipeline as P
from tessera.llm import simhash
from tessera.llm.common import read_table
from test_against_brute_force import brute_repeats

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = read_table(spark, SF, "documents")
    cols = docs.columns
    good = P.quality_stage(spark, docs, SF)
    good_rows = {r.doc_id: r for r in good.collect()}
    assert 0.7 * docs.count() < len(good_rows) < docs.count()
    fps = {i: simhash.fingerprint((r.text or "").encode()) for i, r in good_rows.items()}
    kept = P.near_duplicate_stage(spark, good, SF)
    kept_ids = {r.doc_id for r in kept.collect()}
    for i in fps:  # every dropped one has a smaller near copy, every kept one has none among the kept
        near = [j for j in fps if j != i and (fps[i] ^ fps[j]).bit_count() <= 3]
        assert (i in kept_ids) or any(near)
        assert not (i in kept_ids and any(j in kept_ids for j in near))
    cut = P.repeated_passage_stage(spark, kept, SF)
    want = brute_repeats({i: good_rows[i].text or "" for i in kept_ids})
    rows = cut.collect()
    assert cut.columns == cols and {r.doc_id for r in rows} == kept_ids
    for r in rows:
        assert len(r.text.encode()) <= want[r.doc_id][0] - want[r.doc_id][1] and r.n_chars == len(r.text)
        assert want[r.doc_id][1] or r.text == good_rows[r.doc_id].text
    mixed = P.mixing_stage(spark, cut, SF)
    assert mixed.columns == cols and {r.doc_id for r in mixed.collect()} <= kept_ids


def test_run(spark):
    out = P.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 0
