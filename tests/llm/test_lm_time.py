"""The passes of op9 do less work for the same numbers."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from quillspark.llm import lm_score, tokens
from tests.llm.conftest import sentence


def peak_mb(run):
    tracemalloc.start()
    run()
    most = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return most


def plain_hash(word: bytes, powers):
    total = sum((c + 1) * int(powers[k & 0xFFFF]) for k, c in enumerate(word))
    if len(word) > 0xFFFF:
        total += sum(int(tokens.mix(np.array([k >> 16], np.uint64))[0]) for k in range(0x10000, len(word)))
    with np.errstate(over="ignore"):
        return int(tokens.mix(np.array([(total + len(word)) % 2**64], np.uint64))[0])


def test_hashes_of_words_of_all_lengths():
    rng = random.Random(1)
    words = ["x" * n for n in (1, 31, 32, 33, 64, 65_535, 65_536, 70_000)] + ["é" * n for n in range(1, 40)]
    words += ["".join(rng.choice("abcxyz") for _ in range(rng.randint(1, 50))) for _ in range(300)]
    rng.shuffle(words)
    split = tokens.Splitter(words_only=True)
    got = [h for w in split.words(pa.array([" ".join(words[:200]), None, "", " ".join(words[200:])])) for h in w.hash.tolist()]
    assert got == [plain_hash(w.encode(), split.powers) for w in words]
    data = np.frombuffer(b"abcd", np.uint8)
    empty = tokens.segment_hashes(data, np.array([0, 2, 2]), np.array([2, 2, 4]), split.powers)
    assert empty.tolist() == [plain_hash(x, split.powers) for x in (b"ab", b"", b"cd")]


def test_words_are_not_spread_out_byte_by_byte():
    """A block took 43 times its bytes, now under 30 times."""
    rng = random.Random(2)
    column = pa.array([sentence(rng, 400) for _ in range(200)])
    split = tokens.Splitter()
    assert peak_mb(lambda: [len(w.hash) for w in split.words(column)]) < 30 * column.nbytes / 1e6


def test_sums_of_columns_have_the_bits_of_numpys():
    rng = np.random.default_rng(4)
    for n in (8, 32, 64, 3, 12):
        values = rng.normal(size=(777, n)).astype(np.float32)
        assert np.array_equal(lm_score.column_sums(np.ascontiguousarray(values.T)), values.sum(1))


def test_scoring_makes_no_probabilities(monkeypatch):
    """They were made and dropped; log-probabilities are the same without."""
    rng = np.random.default_rng(5)
    net = lm_score.Network(rng.normal(0, 0.3, lm_score.Network().flat.shape))
    beside = rng.integers(0, lm_score.CODES + 1, (9000, 4))
    target = rng.integers(0, lm_score.CODES, 9000)
    p = {k: v.astype(float) for k, v in net.p.items()}
    h = np.tanh(p["embed"][beside].reshape(9000, -1) @ p["w1"] + p["b1"])
    group, member = target // lm_score.MEMBERS, target % lm_score.MEMBERS
    want = 0
    for logits, hit in ((h @ p["wg"] + p["bg"], group), (h @ p["wm"] + p["bm"][group], member)):
        want = want + logits[np.arange(9000), hit] - np.log(np.exp(logits).sum(1))
    assert np.allclose(net.log_probabilities(beside, target), want, atol=1e-4)
    assert np.allclose(net.forward(beside, target)[-1], want, atol=1e-4)
    assert peak_mb(lambda: net.log_probabilities(beside, target)) < 4
