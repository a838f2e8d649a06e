"""The pipeline's stages take effect, each on what the one before it kept."""

from __future__ import annotations

import corpus_pipeline
from gridloom.llm import decontaminate, minhash
from gridloom.llm.common import cut

from .test_operators import corpus


def test_stages(spark, tmp_path):
    rows = corpus(80, 3)
    docs = spark.createDataFrame([(i, t, lang, src, len(t or "")) for i, t, lang, src in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items = [(0, " ".join(rows[9][1].split()[:1500])), *((i, rows[i][1]) for i in (20, 22, 23, 25))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept, now = {}, spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        now = cut(stage(spark, now, str(tmp_path)))
        kept[name] = now.collect()
        if name != "sharding":
            assert now.columns == docs.columns
    ids = lambda n: {r.doc_id for r in kept[n]}
    text = {i: t for i, t, *_ in rows}
    comps = minhash.brute([(i, text[i]) for i in ids("quality")], 5, 0.8)
    assert ids("near_dedup") == {i for i, (_, c) in comps.items() if c == i}
    dirty = {r[0] for r in decontaminate.brute([(i, text[i]) for i in ids("near_dedup")], items) if r[-1]}
    assert dirty and ids("decontamination") == ids("near_dedup") - dirty
    assert ids("mixing") <= ids("decontamination") and len(kept["sharding"]) == len(kept["mixing"])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "mixing", "sharding"]
