import zlib

import numpy as np

import corpus_pipeline as cp
from pressroom.llm import decontaminate, jaccard_join, mixing, quality
from pressroom.llm.common import materialize, read
from pressroom.llm.token_files import Pieces, default_tokenizer


def test_stages_take_effect(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    names = [n for n, _ in cp.STAGES]
    assert names == ["quality", "near_duplicates", "decontaminate", "mix", "tokens"]
    columns, kept = docs.columns, [docs]
    for name, stage in cp.STAGES[:-1]:
        out = materialize(stage(spark, kept[-1], sf_dir), name)
        assert out.columns == columns
        kept.append(out)
    ids = [{r.doc_id for r in k.select("doc_id").collect()} for k in kept]
    assert all(b <= a for a, b in zip(ids, ids[1:]))
    scored = {r.doc_id: r.predicted for r in quality.classify_quality(docs, read(spark, sf_dir, "labels")).collect()}
    assert ids[1] == {i for i, p in scored.items() if p}
    groups = jaccard_join.jaccard_groups(kept[1]).collect()
    assert ids[2] == {r.class_id for r in groups}
    hit = decontaminate.contamination(kept[2], read(spark, sf_dir, "benchmark")).collect()
    assert ids[3] == {r.doc_id for r in hit if not r.contaminated} and len(ids[3]) < len(ids[2])
    mixed = sorted(r.doc_id for r in kept[4].select("doc_id").collect())
    assert mixed == sorted(r.doc_id for r in mixing.mix_sources(kept[3]).select("doc_id").collect())
    tokens = cp.tokens(spark, kept[4], sf_dir).orderBy("start").collect()
    assert [r.doc_id for r in tokens] == mixed
    pieces, text = Pieces(default_tokenizer()), {r.doc_id: r.text for r in kept[3].collect()}
    for r in tokens[:50]:
        raw = pieces.encode([text[r.doc_id]])[0] + np.array([2], "<u4").tobytes()
        assert (r.n_tokens, r.ids_crc32) == (len(raw) // 4, zlib.crc32(raw))
