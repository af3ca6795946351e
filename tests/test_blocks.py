"""Blocks of bounded work: the same rows, in slices that don't grow with the batch."""

import numpy as np
import pyarrow as pa

from quillspark.operators import blocks as bl
from quillspark.operators import gradient as gr
from quillspark.operators import text as tx


def test_slices_keep_every_row_in_order_and_are_bounded():
    texts = ["ab" * k for k in range(40)] + [None, "", "x" * 500, "é" * 10, None]
    batches = [pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], ["id", "text"]).slice(3), pa.record_batch([pa.array([], pa.int64()), pa.array([], pa.string())], ["id", "text"])]
    out = list(bl.blocks(iter(batches), 1, 100))
    assert [i for b in out for i in b.column(0).to_pylist()] == list(range(3, len(texts)))
    assert [t for b in out for t in b.column(1).to_pylist()] == texts[3:]
    size = [sum(len((t or "").encode()) for t in b.column(1).to_pylist()) for b in out]
    assert all(s <= 100 or b.num_rows == 1 for s, b in zip(size, out)) and len(out) > 10


def test_slices_of_lists_count_entries():
    lists = [[1] * k for k in (0, 5, 3, 9, 1, 0, 2)] + [None]
    out = list(bl.blocks(iter([pa.record_batch([pa.array(lists, pa.list_(pa.int32()))], ["i"])]), "i", 6))
    assert [v for b in out for v in b.column(0).to_pylist()] == lists
    assert [b.num_rows for b in out] == [2, 1, 1, 4]


def test_passes_over_slices_give_the_rows_of_one_pass(spark, monkeypatch):
    """Small blocks, in tasks of several, give what one block for all gives."""
    docs = spark.createDataFrame([(k, " ".join(f"w{(k * j) % 17}" for j in range(k % 23)) if k % 9 else None, float(k % 2)) for k in range(120)], "doc_id long, text string, label double").coalesce(1)

    def results():
        tokens = tx.tokenised(docs, keep=["label"])
        vocab = tx.fit_vocabulary(tokens, 12)
        feats = tx.features(tokens, vocab, keep=["label"])
        words = sorted((r.doc_id, r.label, r.n_tok, sorted(zip(r.words, r.counts))) for r in tokens.collect())
        rows = words, sorted(map(tuple, feats.collect()))
        g, loss, n = gr.gradient_and_loss(feats, np.full(13, 0.1), "logistic")
        return rows, g, loss, n

    one = results()
    for module in (tx, gr):
        monkeypatch.setattr(module, "ENTRIES", 7)
    monkeypatch.setattr(tx, "TEXT_BYTES", 40)
    rows, g, loss, n = results()
    assert rows == one[0] and n == one[3]
    assert np.allclose(g, one[1], rtol=1e-12, atol=1e-14) and abs(loss - one[2]) < 1e-9


def test_batches_are_bounded_by_bytes(spark):
    """A batch of long texts has few rows (10,000 rows of any length before)."""
    before = spark.conf.get(bl.BATCH_BYTES)
    try:
        spark.conf.set(bl.BATCH_BYTES, "64m")
        docs = spark.range(40).selectExpr("id AS doc_id", "repeat('some words ', 100000) AS text").coalesce(1)
        tx.tokenised(docs)
        assert int(spark.conf.get(bl.BATCH_BYTES)) == bl.BATCH_MB << 20

        def size(batches):
            for b in batches:
                yield pa.record_batch([pa.array([b.nbytes])], ["n"])

        assert max(r.n for r in docs.select("text").mapInArrow(size, "n long").collect()) <= 2 * bl.BATCH_MB << 20
        spark.conf.set(bl.BATCH_BYTES, "1m")
        bl.bound_batches(spark)
        assert spark.conf.get(bl.BATCH_BYTES) == "1m"
    finally:
        spark.conf.set(bl.BATCH_BYTES, before)
