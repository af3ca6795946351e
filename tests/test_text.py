import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.functions.columns import tokens
from quillspark.operators import text as tx
from quillspark.sources.text import line_counts, load_corpus, parse_id_text, parse_labelled, read_lines


def docs_frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_tokens_keep_empty_and_case(spark):
    df = spark.createDataFrame([("a  b ",), ("",), ("A\tb,c\nd",)], "t string")
    got = [r[0] for r in df.select(tokens("t")).collect()]
    assert got == [["a", "", "b", ""], [""], ["A\tb,c\nd"]]


def test_parse_patterns(spark, tmpdir_path):
    lines = [
        '<doc id="7" title="x">one</doc> tail</doc>',      # shortest vs greedy body
        '<doc id="AU9" title="y">say "hi"> there</doc>',   # ">' inside the text
        '<doc id="3" title="z"></doc>',                     # empty body
        'no marker here',
    ]
    path = os.path.join(tmpdir_path, "docs.txt")
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    raw = read_lines(spark, path)
    short = {r.id: r.text for r in parse_id_text(raw).collect()}
    assert short == {"7": "one", "AU9": 'say "hi"> there', "3": ""}
    lab = parse_labelled(raw).orderBy("doc_id").collect()
    assert [(r.doc_id, r.text, r.label) for r in lab] == [
        ("3", "", 0.0), ("7", "one</doc> tail", 0.0), ("AU9", 'say "hi"> there', 1.0)]
    assert tuple(line_counts(raw).first()) == (4, 3, 1)
    train, test = load_corpus(spark, path, path)
    assert train.count() == 3 and test.count() == 3


def test_doc_freq_and_vocab_rules(spark):
    texts = ["a b c x", "a b c", "a b d", "a c e", "a b"]
    docs = docs_frame(spark, texts)
    dfreq = {r.word: r.df for r in tx.doc_freq(docs).collect()}
    assert dfreq == {"a": 5, "b": 4, "c": 3, "x": 1, "d": 1, "e": 1}
    v = tx.fit_vocabulary(docs, 3).words().orderBy("idx").collect()
    assert [(r.idx, r.word, r.df) for r in v] == [(0, "b", 4), (1, "c", 3), (2, "d", 1)]
    forced = tx.fit_vocabulary(docs, 3, rule=tx.RULE_FORCED, forced_words=["a"]).words()
    assert [r.word for r in forced.orderBy("idx").collect()] == ["a", "b", "c"]
    maxdf = tx.fit_vocabulary(docs, 10, rule=tx.RULE_MAX_DF, max_df=0.6).words()
    assert [r.word for r in maxdf.orderBy("idx").collect()] == ["c", "d", "e", "x"]
    # a word in exactly 80 % of the documents passes df / n <= 0.8
    at80 = tx.fit_vocabulary(docs, 10, rule=tx.RULE_MAX_DF, max_df=0.8).words()
    assert [r.word for r in at80.orderBy("idx").collect()] == ["b", "c", "d", "e", "x"]


def test_vocab_independent_of_partitioning(spark):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choice(words, 12)) for _ in range(60)]
    docs = docs_frame(spark, texts)
    a = tx.fit_vocabulary(docs, 10).words().orderBy("idx").collect()
    b = tx.fit_vocabulary(docs.repartition(7), 10).words().orderBy("idx").collect()
    assert a == b


def test_tfidf_by_hand_and_empty_vector(spark):
    texts = ["a b b", "a c", "zz"]
    docs = docs_frame(spark, texts)
    vocab = tx.fit_vocabulary(docs, 10)       # n = 3; no word in every document
    idf = {r.word: r.idf for r in vocab.table.collect()}
    assert idf["b"] == pytest.approx(math.log(4 / 2))
    feats = {r.doc_id: (r.i, r.v) for r in tx.features(docs, vocab).collect()}
    widx = {r.word: r.idx for r in vocab.table.collect()}
    i0, v0 = feats[0]
    got = dict(zip(i0, v0))
    assert got[widx["b"]] == pytest.approx(2 / 3 * math.log(4 / 2))
    assert got[widx["a"]] == pytest.approx(1 / 3 * math.log(4 / 3))
    assert i0 == sorted(i0)
    long = {(r.doc_id, r.idx): r.x for r in tx.tfidf_long(docs, vocab).collect()}
    assert long[(0, widx["b"])] == pytest.approx(got[widx["b"]])
    # a document with no vocabulary word keeps its (empty) row in features
    small = tx.fit_vocabulary(docs, 1)        # only the top word
    f2 = {r.doc_id: r.i for r in tx.features(docs, small).collect()}
    assert f2[2] == []


def test_require_column(spark):
    docs = docs_frame(spark, ["a"])
    with pytest.raises(ValueError):
        tx.doc_freq(docs, "body")


def test_topk_ties_and_zero_fill(spark):
    texts = ["x y", "x y", "q r", "s t", "x"]
    docs = docs_frame(spark, texts)
    vocab = tx.fit_vocabulary(docs, 10)
    feats = tx.features(docs, vocab)
    qvec = tx.dense_query(tx.vectorize_text(spark, "x y", vocab), 10)
    for hits in (tx.top_k_similar(feats, qvec, 4, docs=docs).collect(),
                 tx.top_k_similar_text(docs.repartition(3), vocab, "x y", 4).collect()):
        assert [(r["rank"], r.doc_id) for r in hits] == [(1, 0), (2, 1), (3, 4), (4, 2)]    # ties by id, zero fill by id
        assert hits[-1].score == 0.0 and hits[0].snippet == "x y"


def test_features_on_a_stream(spark, tmpdir_path):
    """The fitted featuriser gives the same rows on a streaming frame."""
    docs = docs_frame(spark, ["a b b", "a c", "b c d"])
    vocab = tx.fit_vocabulary(docs, 10)
    src = os.path.join(tmpdir_path, "stream_in")
    docs.write.parquet(src)
    stream = spark.readStream.schema(docs.schema).parquet(src)
    q = (tx.features(stream, vocab).writeStream.format("memory").queryName("qs_stream_tf").outputMode("append")
         .option("checkpointLocation", os.path.join(tmpdir_path, "stream_ckpt")).start())
    try:
        q.processAllAvailable()
        rows = spark.sql("SELECT * FROM qs_stream_tf").collect()
    finally:
        q.stop()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, tx.features(docs, vocab).collect()))


def random_docs(spark, seed=7):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(25)] + ["", "W1", "w1,", "é"]
    texts = [" ".join(rng.choice(words, int(rng.integers(1, 30)))) for _ in range(120)]
    texts += ["", "zz", "a  b ", texts[3]]
    return texts, spark.createDataFrame([(i, t, float(i % 2)) for i, t in enumerate(texts)],
                                        "doc_id long, text string, label double").repartition(3)


def test_topk_from_text_equals_feature_path(spark):
    _, docs = random_docs(spark, 5)
    vocab = tx.fit_vocabulary(docs, 12)
    query = "w1 w2 w2 w3 w17 nope"
    a = tx.top_k_similar_text(docs, vocab, query, 30).collect()
    qvec = tx.dense_query(tx.vectorize_text(spark, query, vocab), 12)
    b = tx.top_k_similar(tx.features(docs, vocab), qvec, 30, docs=docs).collect()
    assert a == b and [r["rank"] for r in a] == list(range(1, 31))


def test_features_by_counting(spark):
    """Tokens, TF and TF-IDF of every document against plain counting, from
    texts and from kept tokens."""
    from collections import Counter

    texts, docs = random_docs(spark)
    counts = [Counter(t.split(" ")) for t in texts]
    df = Counter(w for c in counts for w in c)
    kept = tx.tokenised(docs, keep=["label"]).cache()
    for source in (docs, kept):
        vocab = tx.fit_vocabulary(source, 15)
        words = [r.word for r in vocab.words().orderBy("idx").collect()]
        assert words == sorted((w for w in df if df[w] != len(texts)), key=lambda w: (-df[w], w.encode()))[:15]
        for value in ("tfidf", "tf"):
            for r in tx.features(source, vocab, keep=["label"], value=value).collect():
                c, n = counts[r.doc_id], len(texts[r.doc_id].split(" "))
                want = [(i, c[w] / n * (math.log((len(texts) + 1) / (df[w] + 1)) if value == "tfidf" else 1.0)) for i, w in enumerate(words) if c[w]]
                assert r.label == r.doc_id % 2 and r.i == [i for i, _ in want] and r.v == pytest.approx([x for _, x in want])
        got = {(r.doc_id, r.idx): r.cnt for r in tx.term_counts(source, vocab).collect()}
        assert got == {(d, i): c[w] for d, c in enumerate(counts) for i, w in enumerate(words) if c[w]}
    kept.unpersist()


def test_rows_without_a_text_are_no_documents(spark):
    """One rule everywhere: neither counted nor scored."""
    rows = [(0, "a b"), (1, None), (2, "a c"), (3, "a d")]
    docs, plain = (spark.createDataFrame(r, "doc_id long, text string") for r in (rows, [r for r in rows if r[1] is not None]))
    a, b = (tx.fit_vocabulary(d, 10) for d in (docs, plain))
    assert a.table.collect() == b.table.collect() and {r.n_docs for r in a.table.collect()} == {3}
    assert "a" not in [r.word for r in a.words().collect()]            # in every document
    assert sorted(r.doc_id for r in tx.features(docs, a).collect()) == [0, 2, 3]
    assert [r.doc_id for r in tx.top_k_similar_text(docs, a, "b", 10).collect()] == [0, 2, 3]
    assert tx.doc_freq(docs).where("word = 'a'").first().df == 3


def test_vocabulary_is_kept_and_loaded(spark, tmpdir_path):
    _, docs = random_docs(spark)
    vocab = tx.fit_vocabulary(docs, 10)
    path = os.path.join(tmpdir_path, "vocab")
    vocab.save(path)
    again = tx.Vocabulary.load(spark, path, 10)
    assert sorted(again.table.collect()) == sorted(vocab.table.collect())
    assert sorted(map(str, tx.features(docs, again).collect())) == sorted(map(str, tx.features(docs, vocab).collect()))


def test_one_path_split_does_not_depend_on_file_splits(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "docs.txt")
    with open(path, "w") as f:
        f.writelines(f'<doc id="{"AU" if i % 3 else ""}{i}" title="t">text {i} {"x" * 40}</doc>\n' for i in range(3000))
    tests = []
    for size in ("128m", "20k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            train, test = load_corpus(spark, path)
            tests.append((sorted(r.doc_id for r in test.collect()), train.count()))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert tests[0] == tests[1] and 200 < len(tests[0][0]) < 400 and len(tests[0][0]) + tests[0][1] == 3000
