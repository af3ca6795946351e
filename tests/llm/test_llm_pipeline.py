import random
import re
from collections import Counter

import corpus_pipeline as cp
import __spark_entry__ as entry
from quillspark.llm import mixing, near_dup

from .conftest import sentence
from .test_llm_free import classes_by_brute_force, quality_rows


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{k}" for k in range(1, 11)}


def test_stages(spark, odd_docs, odd_rows, tmp_path, no_docs, clashing):
    docs, labels = quality_rows()
    known = spark.createDataFrame([(10_000 + i, q, 0) for i, q in labels], "doc_id long, quality int, toxic int")
    table = odd_docs.union(spark.createDataFrame([(10_000 + i, t, "en", "s1", len(t)) for i, t, _ in docs], odd_docs.schema))
    known.write.parquet(f"{tmp_path}/labels.parquet")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    stage = dict(cp.STAGES)
    assert list(stage) == ["quality classifier", "line dedup", "near dedup", "mixing", "packing"]

    kept = cp.cut(stage["quality classifier"](spark, table, str(tmp_path)))
    assert kept.columns == table.columns
    ids = Counter(r.doc_id for r in kept.select("doc_id").collect())
    assert all(ids[10_000 + i] == q for i, q in labels)

    lines = cp.cut(stage["line dedup"](spark, kept, str(tmp_path)))
    assert lines.columns == table.columns and lines.count() == kept.count()
    assert lines.where("n_chars != length(text)").count() == 0

    single = cp.cut(stage["near dedup"](spark, lines, str(tmp_path)))
    rows = [(r.doc_id, r.text) for r in lines.collect()]
    want = classes_by_brute_force(rows)
    assert sorted(r.doc_id for r in single.collect()) == sorted({c for c in want.values()})

    mixed = cp.cut(stage["mixing"](spark, single, str(tmp_path)))
    assert mixed.columns == table.columns
    times = Counter(r.doc_id for r in mixed.collect())
    assert max(times.values()) <= 3
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in single.collect()}
    total = sum(size.values())
    assert abs(sum(size[d] * n for d, n in times.items()) - total) < 0.25 * total

    packed = stage["packing"](spark, mixed, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == times
    assert cp.run(spark, str(tmp_path)).count() == len(packed)
    # empty tables, and more columns of names that the operators use
    for name in stage:
        assert stage[name](spark, no_docs, str(tmp_path)).collect() == []
    more = clashing
    for name in list(stage)[:-1]:
        more = cp.cut(stage[name](spark, more, str(tmp_path)))
        assert more.columns == clashing.columns and more.count() > 0 and more.where("score != 1 OR kept_lines != 1").count() == 0
    assert near_dup.SIMILARITY == 0.8


def test_mixing_stage_meets_the_targets(spark, tmp_path):
    """Also for a source that holds a third of the rows, in long documents of
    which the mix takes less than half."""
    rng = random.Random(8)
    rows = [(i, "w " * max(1, int(rng.lognormvariate(5.5, 0.8))), "en", "s0" if i % 3 == 0 else f"s{1 + i % 7}", 0) for i in range(1500)]
    docs = cp.cut(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3))
    want, taken = {}, Counter()
    for r in mixing.mix(docs).collect():
        want[r.source] = (r.target, r.target / r.source_size)
    got = cp.cut(cp.mix_to_weights(spark, docs, str(tmp_path)))
    size = {r[0]: len(r[1].split()) for r in rows}
    times = Counter(r.doc_id for r in got.select("doc_id").collect())
    for i, _, _, source, _ in rows:
        taken[source] += size[i] * times[i]
    assert any(q < 0.5 for _, q in want.values()) and any(q % 1 > 0.3 and q > 1 for _, q in want.values())
    for s, (target, _) in want.items():
        assert abs(taken[s] - target) < 0.05 * target, (s, taken[s], target)
    assert max(times.values()) <= 3
    again = Counter(r.doc_id for r in cp.mix_to_weights(spark, docs.repartition(5), str(tmp_path)).select("doc_id").collect())
    assert again == times


def test_stages_keep_rows_without_an_id_or_with_a_shared_one(spark, tmp_path):
    rng = random.Random(12)
    text = [sentence(rng, 60) for _ in range(6)]
    near = text[0].split()
    near[30] = "changed"
    rows = [(None, text[0]), (None, " ".join(near)), (None, text[1]), (7, text[2]), (7, text[3]), (7, text[3]), (3, text[4]), (None, text[4]), (9, text[5])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    single = cp.cut(cp.drop_near_duplicates(spark, docs, str(tmp_path)))
    got = [(r.doc_id, r.text) for r in single.collect()]
    first, *rest = sorted(got, key=lambda r: r[1] not in (text[0], " ".join(near)))
    assert first[0] is None and first[1] in (text[0], " ".join(near))
    assert Counter(rest) == Counter([(None, text[1]), (7, text[2]), (7, text[3]), (3, text[4]), (9, text[5])])
    # one source is taken once as a whole
    assert Counter((r.doc_id, r.text) for r in cp.mix_to_weights(spark, single, str(tmp_path)).collect()) == Counter(got)


def test_rows_without_an_id(spark, odd_rows):
    """They are rows like others; as a class has its least id for a name, near
    copies of them alone have none."""
    from quillspark.llm import fingerprint, line_dedup, lm_score, mixing, packing, quality, secrets

    rows = [(None, r[1], r[3]) if k % 5 == 0 else (r[0], r[1], r[3]) for k, r in enumerate(odd_rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    n = len(rows)
    assert mixing.mix(docs).count() == n
    assert secrets.find_secrets(docs).count() == n
    assert fingerprint.edited_pairs(docs).count() == n
    assert line_dedup.drop_repeated(docs).count() == n
    assert near_dup.near_duplicates(docs).count() == n
    assert packing.pack_documents(docs, packing.default_tokenizer()).where("piece = 0").count() == n
    vectors, network = quality.train(docs, spark.createDataFrame([(1, 1), (None, 0)], "doc_id long, quality int"))
    assert quality.score(docs, vectors, network).count() == n
    assert lm_score.score(docs, lm_score.train(docs, epochs=1)).count() == n
