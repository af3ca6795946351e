"""Operators for training-data pipelines over web-scale tables.

One module per operator, each with its general interface, its registered
query and (where SQL can express it) the DuckDB SQL of the same result:

    ann_mih      approximate nearest neighbours by multi-index hashing
    wrappers     main text of HTML pages by union-free wrapper inference
    line_dedup   content-defined line chunks, repeated chunks removed
    packing      token sequences packed by length patterns (non-negative least squares)
    quality      quality score from random-indexing word vectors
    secrets      secrets, and weak ones linked to complementary parts
    fingerprint  order-min-hash fingerprints
    near_dup     order-min-hash near duplicates with banded alignment
    lm_score     masked pseudo-likelihood under a bidirectional window network
    mixing       sources mixed to target weights by Sainte-Lague apportionment
    fim          fill-in-middle transformation by repeated-capture matching
    spelling     spelling variants by sorted permuterm rotations
    lexicon      BPE encoding by a minimal acyclic transducer, and decoding
"""

