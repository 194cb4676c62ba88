"""The pipeline's last three stages, chained as it chains them, against brute force on the tables' documents.

The two stages before drop what learned scores reject; these scores are held against naive ones in ``test_texts.py``.
"""

import zlib

import numpy as np
import public_tokenizers
from test_shingle_join import brute
from tokenizers import Tokenizer

import corpus_pipeline
from tidemart.llm.common import written

LIMIT = 2048


def test_copies_mixture_and_packing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(200)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    docs = docs.where(docs.doc_id.isin([d for d, _ in rows]))
    texts = dict(rows)
    stages = dict(corpus_pipeline.STAGES)
    kept = written(stages["near_copies"](spark, docs, sf_dir), "kept")
    left = sorted({least for _, least, _ in brute(rows)})
    assert sorted(r.doc_id for r in kept.collect()) == left and len(left) < len(rows)
    mixed = written(stages["mixture"](spark, kept, sf_dir), "mixed")
    assert sorted((r.doc_id, r.text) for r in mixed.collect()) == [(d, texts[d]) for d in left]

    model = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    out = stages["packing"](spark, mixed, sf_dir).collect()
    pieces, sequences = {}, {}
    for r in out:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert sorted(pieces) == left
    for d, of in pieces.items():
        ids = model.encode(texts[d] or "", add_special_tokens=False).ids + [0]
        of.sort(key=lambda r: r.piece)
        assert [r.piece for r in of] == list(range(len(of))) and len(of) == -(-len(ids) // LIMIT)
        at = 0
        for k, r in enumerate(of):
            assert r.start == at and (len(of) == 1 or k == 0 or r.length == LIMIT)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for of in sequences.values():
        of.sort(key=lambda r: r.offset)
        assert [r.offset for r in of] == [sum(x.length for x in of[:k]) for k in range(len(of))]
        assert sum(r.length for r in of) <= LIMIT
    # no two sequences that are at most half full
    assert sum(sum(r.length for r in of) <= LIMIT // 2 for of in sequences.values()) <= 1
