"""Shingle counts that cover all documents."""

import numpy as np

from gripelens.llm.near_dedup import BUCKETS, NearDedup
from gripelens.llm.shingles import shingle_sets, shingles


def test_shingle_counts_cover_all_documents(spark):
    texts = [f"a{i} b{i} c{i} d{i} a{i} b{i} c{i}" for i in range(64)] + ["", "short", "one two"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    levels = NearDedup(3, 85).shingle_levels(df)
    flat = shingles(texts, 3)
    full, _ = shingle_sets([t for t in texts if len(t) > 7], 3)
    assert len(flat) == 64 * 5 and set(flat.tolist()) == set(full.tolist())
    want = np.zeros(BUCKETS, np.int64)
    counts = np.bincount((flat & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
    want[counts > 0] = np.minimum(1 + 4 * np.log2(counts[counts > 0]), 127)
    assert (levels == want).all()
