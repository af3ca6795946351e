import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from quillspark.llm import ann_mih, line_dedup, lm_score, near_dup, packing, quality, wrappers
from quillspark.llm.tokens import Splitter

from .conftest import sentence


# ---------------------------------------------------------------- words

def test_words_are_split_and_hashed():
    texts = ["Hello wörld 12 hello\nHello!! a", "", None, "y" * 70_000 + " z " + "y" * 70_000, "  ", "wörld!!"]
    for words_only in (False, True):
        seen = {}
        for w in Splitter(words_only).words(pa.array(texts)):
            for row, a, b, h in zip(w.row, w.start, w.end, w.hash):
                word = bytes(w.data[a:b])
                assert seen.setdefault(word, h) == h
        assert len(set(seen.values())) == len(seen)
        want = {x.encode() for t in texts for x in (t or "").split()}
        assert not words_only or set(seen) == want
    assert {b"Hello", b"!!", b"12"} <= set(Counter(bytes(w.data[a:b]) for w in Splitter().words(pa.array(texts)) for a, b in zip(w.start, w.end)))


# ---------------------------------------------------------------- packing

def test_tokens_equal_the_tokenizer():
    words = packing.WordTokenizer(packing.default_tokenizer())
    rng = random.Random(3)
    texts = ["Don't I'll we've 12³ ½ x²y ªb ºc µ ß ŉ ĳ ſ … “q” ‘s’'S 'T — a\xa0b\x85c\x1cd", "<|endoftext|> hi", "", "\n", "日本 ΣΑΣ İ", "àb é"]
    texts += ["".join(rng.choice("ab'sT ,.9é\n-ß!") for _ in range(200)) for _ in range(50)]
    for t in texts * 2:
        assert words.ids(t).tolist() == words.tokenizer.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_up_the_histogram(seed):
    rng = np.random.default_rng(seed)
    size = 64
    histogram = np.zeros(size + 1, np.int64)
    histogram[1:] = rng.poisson(rng.choice([0, 1, 40], size))
    used, n = np.zeros(size + 1, np.int64), 0
    for content, times in packing.plan(histogram, size):
        assert sum(content) <= size and times > 0
        n += times
        for length in content:
            used[length] += times
    assert (used == histogram).all()
    bound = -(-int((histogram * np.arange(size + 1)).sum()) // size)
    plain = sum(times for _, times in packing.best_fit(histogram.copy(), size))
    assert bound <= n <= max(plain, bound) * 1.02 + 1


def test_pack(odd_docs, odd_rows, clashing, no_docs):
    path = packing.default_tokenizer()
    rows = packing.pack_documents(odd_docs, path).collect()
    words = packing.WordTokenizer(path)
    ids = {r[0]: words.tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0] for r in odd_rows}
    copies = Counter(r[0] for r in odd_rows)
    got, sequences = Counter(), defaultdict(list)
    for r in rows:
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert r.start == 2048 * r.piece and r.length == len(part) and r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        got[r.doc_id, r.piece] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    assert got == Counter({(d, k): n for d, n in copies.items() for k in range(-(-len(ids[d]) // 2048))})
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(len(ids[d]) * n for d, n in copies.items())
    assert len(sequences) <= -(-total // 2048) * 1.1 + 1
    # many buckets and groups of buckets give every piece a place of its own too
    many = packing.pack(packing.cut(packing.pieces(odd_docs, path)), bucket_rows=1, group_buckets=3).collect()
    assert Counter((r.sequence_id, r.offset, r.length) for r in many) == Counter((r.sequence_id, r.offset, r.length) for r in rows)
    assert Counter((r.doc_id, r.piece) for r in many) == got
    assert packing.pack_documents(clashing, path).count() == len(rows)
    assert packing.pack_documents(no_docs, path).collect() == []


# ---------------------------------------------------------------- line dedup

def test_line_dedup(odd_docs, odd_rows, clashing, no_docs):
    rows = line_dedup.drop_repeated(odd_docs).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r[0] for r in odd_rows)
    text = {r[0]: r[1] for r in odd_rows}
    out = {r.doc_id: r for r in rows}
    assert out[0].text is None and out[1].text == ""
    lines = Counter(x for t in text.values() for x in set((t or "").split("\n")))
    for r in rows:
        before, after = (text[r.doc_id] or "").split("\n"), (r.text or "").split("\n")
        gone = Counter(before) - Counter(after)
        assert all(lines[x] > 1 for x in gone if x)
        assert text[r.doc_id] is None or r.kept_lines + r.removed_lines == len(before)
    # the passage stays in its first document; later ones lose it but for its ends
    first, *later = range(11, 15)
    assert out[first].text == text[first]
    for d in later:
        assert out[d].removed_lines >= 4 and {text[d].split("\n")[0], text[d].split("\n")[-1]} <= set(out[d].text.split("\n"))
    # a copy that is one long line
    assert out[4].removed_lines == 0 and out[5].text == "" and out[6].text == text[6]
    got = line_dedup.drop_repeated(clashing)
    assert sorted((r.doc_id, r.text or "", r.removed_lines) for r in got.collect()) == sorted((r.doc_id, r.text or "", r.removed_lines) for r in rows)
    assert line_dedup.drop_repeated(no_docs).collect() == []


def test_planted_passages_are_found(spark):
    """Passages of 2, 3 and 4 lines, 50 words and up, wherever they stand; the
    first occurrence stays, also in a text that repeats one line."""
    rng = random.Random(31)
    new = lambda n: [sentence(rng, rng.randint(5, 12)) for _ in range(n)]
    rows, planted = [], {}
    for k in range(60):
        lines = 2 + k % 3
        passage = [sentence(rng, rng.randint(*{2: (26, 49), 3: (17, 30), 4: (13, 20)}[lines])) for _ in range(lines)]
        for d in (k, 1000 + k):
            rows.append((d, "\n".join(new(3 + d % 4) + passage + new(3 + d % 3))))
        planted[1000 + k] = passage
    again = sentence(rng, 9)
    rows.append((5000, "\n".join([again] * 40)))
    out = {r.doc_id: r.text for r in line_dedup.drop_repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for d, text in rows[:-1]:
        want = [x for x in text.split("\n") if x not in planted.get(d, ())]
        assert out[d].split("\n") == want
    assert set(out[5000].split("\n")) == {again} and out[5000].count(again) >= 2
    rng = np.random.default_rng(3)
    words, row = rng.integers(0, 30, 300), np.sort(rng.integers(0, 12, 300))
    hashes = rng.integers(0, 2**63, 300).astype(np.uint64)
    first, end, h = line_dedup.windows(row, hashes, words)
    got = set(zip(first.tolist(), end.tolist()))
    full = lambda i, j: words[i:j].sum() >= line_dedup.MIN_WORDS and (words[i:j] > 0).sum() >= 2
    want = {(i, j) for i in range(300) for j in range(i + 2, 301) if row[i] == row[j - 1] and words[i] and words[j - 1] and full(i, j)
            and not (full(i, j - 1) and full(i + 1, j))}
    assert got == want
    copy = line_dedup.windows(row[50:], hashes[50:], words[50:])
    assert set(copy[2].tolist()) <= set(h.tolist()) and len(set(h.tolist())) == len(h)


@pytest.mark.parametrize("lines", [2, 3, 5])
def test_short_passages_are_found(spark, lines):
    """Passages of a few lines of 4 to 9 words, with and without empty lines
    between them, go whole, wherever they stand; single lines and pairs of fewer
    words than a passage has stay."""
    rng = random.Random(lines)
    new = lambda n: [sentence(rng, rng.randint(5, 12)) for _ in range(n)]
    rows, planted = [], {}
    alone, brief = sentence(rng, 30), [sentence(rng, 2), sentence(rng, 2)]
    for k in range(40):
        passage = [sentence(rng, rng.randint(4, 9)) for _ in range(lines)]
        for d in (k, 1000 + k):
            joined = (["\n\n", "\n"][k % 2]).join(passage).split("\n")
            rows.append((d, "\n".join(new(d % 4) + joined + new(2) + [alone] + new(1) + brief + new(1 + d % 3))))
        planted[1000 + k] = {*passage, *([""] if k % 2 == 0 else [])}
    out = {r.doc_id: r.text for r in line_dedup.drop_repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for d, text in rows:
        assert out[d].split("\n") == [x for x in text.split("\n") if x not in planted.get(d, ())]


def test_equal_hashes_of_unlike_chunks_stay(spark, monkeypatch):
    """With a hash that makes all chunks collide only equal bytes are removed."""
    rng = random.Random(2)
    body = ["\n".join(sentence(rng, 60) for _ in range(3)) for _ in range(3)]
    rows = [(0, body[0]), (1, body[1]), (2, body[0]), (3, body[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = line_dedup.chunk_table

    def colliding(df):
        from pyspark.sql import functions as F

        return whole(df).withColumn("hash", F.lit(7).cast("long"))

    monkeypatch.setattr(line_dedup, "chunk_table", colliding)
    out = {r.doc_id: r.text for r in line_dedup.drop_repeated(docs).collect()}
    assert out[1] == body[1] and out[3] == body[2] and out[0] == body[0]


# ---------------------------------------------------------------- near duplicates

def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance():
    rng = np.random.default_rng(1)
    for t in range(300):
        a = rng.integers(0, rng.integers(2, 8), rng.integers(0, 30))
        b = a.copy() if t % 2 else rng.integers(0, 4, rng.integers(0, 30))
        for _ in range(rng.integers(0, 6)):
            k = int(rng.integers(0, len(b) + 1))
            b = np.concatenate([b[:k], rng.integers(0, 8, rng.integers(0, 2)), b[k + int(rng.integers(0, 2)):]])
        want = plain_distance(a.tolist(), b.tolist())
        for most in (0, 1, 3, 10, 60):
            assert near_dup.edit_distance(a, b, most) == min(want, most + 1)
            if len(a) and len(b) and abs(len(a) - len(b)) <= most:
                assert near_dup.banded(*((a, b) if len(a) >= len(b) else (b, a)), most) == min(want, most + 1)


def classes_by_brute_force(rows):
    """Connected components of all pairs of similarity 0.8 or more."""
    texts = {d: (t or "").split() for d, t in rows}
    label = {d: d for d in texts}

    def root(d):
        while label[d] != d:
            d = label[d]
        return d

    ids = sorted(texts)
    for i in ids:
        for j in ids:
            if i < j:
                a, b = texts[i], texts[j]
                if a == b or (a and b and min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and len(a) < 500 and plain_distance(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9):
                    x, y = sorted((root(i), root(j)))
                    label[y] = x
    return {d: root(d) for d in ids}


def test_near_duplicates(spark, odd_docs, odd_rows, clashing, no_docs):
    got = near_dup.near_duplicates(odd_docs).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in odd_rows)
    want = classes_by_brute_force([(r[0], r[1]) for r in odd_rows])
    assert {r.doc_id: r.class_id for r in got} == want
    assert want[0] == want[1] == want[2] == 0 and want[4] == want[5] == want[6] == 4
    assert sorted(map(tuple, near_dup.near_duplicates(clashing).collect())) == sorted(map(tuple, got))
    assert near_dup.near_duplicates(no_docs).collect() == []


def test_chains_and_shared_passages(spark):
    """A chain of edits whose ends differ is one class; many unlike texts that
    share a passage aren't."""
    rng = random.Random(9)
    chain = [sentence(rng, 100).split()]
    for k in range(12):
        chain.append([*chain[-1][:8 * k], *sentence(rng, 6).split(), *chain[-1][8 * k + 6:]])
    passage = sentence(rng, 40)
    texts = [" ".join(c) for c in chain] + [f"{sentence(rng, 60)} {passage} {sentence(rng, 60)}" for _ in range(60)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {got[d] for d in range(13)} == {0}
    assert all(got[d] == d for d in range(13, len(texts)))


# ---------------------------------------------------------------- nearest neighbours

def test_codes_within_a_radius_are_all_found():
    rng = np.random.default_rng(4)
    hasher = ann_mih.Hasher(rng.normal(size=(400, 24)), 10.0)
    codes = hasher.codes(rng.normal(size=(400, 24)))
    index = ann_mih.Index(codes)
    for code in hasher.codes(rng.normal(size=(20, 24)), query=True):
        distance = ann_mih.BITS[codes ^ code].sum(1, dtype=int)
        for radius in (0, 5, 15, 25, hasher.bits):
            assert index.within(code, radius).tolist() == np.flatnonzero(distance <= radius).tolist()


def test_search(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(600, 16)).astype(np.float32)
    x[100:160] = x[100]                                # a vector that many rows share
    x[200] *= 5
    rows = [(i, [float(v) for v in r], 1) for i, r in enumerate(x)]
    rows += [(1000, None, 1), (1020, [0.0] * 16, 1), (1040, [float("nan")] * 16, 1), (1060, [1.0] * 3, 1), (1080, [None] + [1.0] * 15, 1), (1100, [float("inf")] * 16, 1), (None, [1.0] * 16, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    from pyspark.sql import functions as F

    got = defaultdict(list)
    for r in ann_mih.search(df, F.col("vec_id") % 20 == 0, 10).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert set(got) == set(range(0, 600, 20))
    d = x.astype(np.float64)
    hits = 0
    for q, rows in got.items():
        rows.sort()
        assert [r for r, _, _ in rows] == list(range(1, 11))
        assert all(abs(s - d[q] @ d[v]) < 1e-9 for _, v, s in rows) and q not in [v for _, v, _ in rows]
        assert [(-round(s, 9), v) for _, v, s in rows] == sorted((-round(s, 9), v) for _, v, s in rows)
        best = sorted((-round(float(d[q] @ d[v]), 9), v) for v in range(600) if v != q)[:10]
        hits += len({v for _, v in best} & {v for _, v, _ in rows})
    assert hits >= 0.9 * 10 * len(got)
    assert [v for _, v, _ in got[140]] == list(range(100, 110))
    few = ann_mih.search(df.where("vec_id < 3"), F.col("vec_id") == 0, 10).collect()
    assert [r.rank for r in few] == [1, 2]
    assert ann_mih.search(df.where("vec_id > 5000"), F.col("vec_id") == 0).collect() == []


def test_isolated_and_repeated_queries_get_all_rows(spark):
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(20, 32)) * 10
    x = np.concatenate([centres[rng.integers(0, 20, 3000)] + rng.normal(size=(3000, 32)) * 0.1, rng.normal(size=(5, 32)) * 4])
    ids = [i if i < 3000 else 10 * (100 * i) for i in range(len(x))]  # the isolated ones are queries
    rows = [(i, [float(v) for v in r], 0.0, "s") for i, r in zip(ids, x)]
    rows += [rows[40], rows[40], rows[41]]                            # ids that repeat
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score double, q string")
    from pyspark.sql import functions as F

    got = defaultdict(list)
    for r in ann_mih.search(df, F.col("vec_id") % 200 == 0).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert {i for i in ids if i % 200 == 0} <= set(got)
    hits = 0
    for q, found in got.items():
        mine = x[ids.index(q)]
        assert sorted(r for r, _, _ in found) == list(range(1, 21))
        best = sorted((-float(mine @ np.array(r[1])), r[0]) for r in rows if r[0] != q)[:20]
        hits += len({v for _, v in best} & {v for _, v, _ in found}) / len({v for _, v in best})
    assert hits >= 0.9 * len(got)


# ---------------------------------------------------------------- wrappers

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a="</p>";</script></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href="/a">A</a></li><li><a href="/b">B</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
{main}<div id="comments"><p>first!</p></div><aside>more</aside><form><input> go</form><footer>&copy; us</footer>"""


def test_main_text():
    main = "<article><h1>T &amp; U</h1><p><b>one\n two<br><p>three&nbsp;&lt;4&gt;</p><div class='ad'>buy</div><section class=comments><p>no</p></section></article>"
    assert wrappers.page_text(PAGE.format(main=main), None) == "T & U\none two\nthree <4>"
    plain = "<div class='content'><h2>A</h2><p>long text of the page</p><h2>B</h2><p>more text of it</p></div><div class='box'><p>x</p></div>"
    assert wrappers.page_text(PAGE.format(main=plain), None) == "A\nlong text of the page\nB\nmore text of it"
    for page, text in ((None, ""), ("", ""), ("plain", "plain"), ("a < b", "a < b"), ("<div>" * 3000 + "x", "x"), ("<nav>n</nav>", ""), ("<p>x" * 50, "\n".join("x" * 50))):
        assert wrappers.page_text(page, None) == text


def test_wrapper_has_slots_options_and_repeats():
    pages = ["<h1>a</h1><ul><li>1<li>2</ul><p>same</p>", "<h1>b</h1><img><ul><li>1</ul><blockquote>q</blockquote><p>same</p>", "<h1>a</h1><ul><li>9<li>2<li>3</ul><p>same</p>"]
    for order in (pages, pages[::-1]):
        held = None
        for p in order:
            new = wrappers.wrapper_of(wrappers.parse(p))
            held = new if held is None else wrappers.joined(held, new)
        assert wrappers.expression(held) == '<h1>{#} <ul>{<li>{#}+} <blockquote>{"q"}? <p>{"same"}'
        assert wrappers.expression(wrappers.load(wrappers.dump(held))) == wrappers.expression(held)
    blocks = wrappers.wrapper_of(wrappers.parse("<h2>a</h2><p>b</p><h2>c</h2><p>d</p><p>e</p>"))
    assert wrappers.expression(blocks) == "(<h2>{#} <p>{#}+)+"


def test_extract(spark):
    # the host's other pages tell which part is the main one of a page with little text
    full = "<div class='top'><p>{a}</p></div><div class='story'><p>{b}</p></div>"
    long, short = "word " * 50, "tiny"
    rows = [(k, "http://h.example/x", full.format(a=short, b=long), 1) for k in range(5)]
    rows += [(7, "http://h.example/y", full.format(a="a bit longer", b=short), 1), (8, None, "<p>x</p>", 1), (9, "http://o.example", None, 1), (7, "http://h.example/y", full.format(a="a bit longer", b=short), 1),
             (10, "http://h.example/z", "<section><p>another</p></section>", 1)]
    got = sorted(map(tuple, wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string, host int")).collect()), key=str)
    text = {r[0]: r[2] for r in got}
    assert len(got) == len(rows) and text[0] == long.strip() and text[7] == short and text[8] == "x" and text[9] == "" and text[10] == "another"
    assert wrappers.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_constants_of_a_host_are_no_article(spark):
    top, foot = "Welcome to the <b>Daily</b> Page", "All rights are with<br>the paper and nobody else. " * 3
    page = "<html><body><div>{top}</div><p>{text}</p><div>{foot}</div></body></html>"
    reports = [f"Report {k}: {'rain ' * (k % 3 + 1)}in town {k * 7}." for k in range(20)]
    rows = [(k, f"https://paper.example/{k}", page.format(top=top, text=t, foot=foot)) for k, t in enumerate(reports)]
    rows += [(100 + k, f"https://few.example/{k}", page.format(top=top, text=t, foot=foot)) for k, t in enumerate(reports[:5])]
    # a host whose pages are copies of one, and one with a single page, keep all
    rows += [(200 + k, "https://copies.example/", page.format(top=top, text=reports[0] * 3, foot="end")) for k in range(3)]
    rows += [(300, "https://one.example/", page.format(top=top, text=reports[0] * 3, foot="end"))]
    for n in (1, 6):
        df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(n)
        text = {r.page_id: r.text for r in wrappers.extract(df).collect()}
        assert [text[k] for k in range(20)] == reports
        assert [text[100 + k] for k in range(5)] == reports[:5]
        assert all(text[k] == f"Welcome to the Daily Page\n{reports[0] * 3}\nend" for k in (200, 201, 202, 300))


# ---------------------------------------------------------------- models

def quality_rows(n=240):
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        text = sentence(rng, rng.randint(5, 80)).capitalize() + "." if good else " ".join(w.upper() + "!!" for w in sentence(rng, rng.randint(5, 80)).split())
        docs.append((i, text, 1.0))
        labels.append((i, int(good)))
    return docs, labels


def test_quality(spark, odd_docs, odd_rows, no_docs):
    docs, labels = quality_rows()
    df = spark.createDataFrame(docs, "doc_id long, text string, score double")
    known = spark.createDataFrame(labels + [(1, None), (None, 1), (1, 1)], "doc_id long, quality int")
    vectors, network = quality.train(df, known)
    assert vectors.shape == (quality.WORDS, quality.DIMS) and 0.2 <= network.temperature <= 4.1
    got = {r.doc_id: r.score for r in quality.score(df, vectors, network).collect()}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 20 and np.mean([(got[i] >= 0.5) == dict(labels)[i] for i in held]) > 0.95
    odd = quality.score(odd_docs, vectors, network).collect()
    assert len(odd) == len(odd_rows) and all(0 <= r.score <= 1 and not math.isnan(r.score) for r in odd)
    assert quality.score(no_docs, vectors, network).collect() == []
    flags = {r.doc_id: r.h for r in df.select("doc_id", quality.held_out("doc_id").alias("h")).collect()}
    assert flags == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i, _ in labels}


def test_quality_without_two_kinds_of_labels(spark, no_docs):
    docs, _ = quality_rows(20)
    df = spark.createDataFrame(docs, "doc_id long, text string, score double")
    for labels, base in (([], 0.5), ([(i, 1) for i in range(20)], 1.0)):
        vectors, network = quality.train(df, spark.createDataFrame(labels, "doc_id long, quality int"))
        assert {r.score for r in quality.score(df, vectors, network).collect()} == {base}
    vectors, network = quality.train(no_docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert network.base == 0.5


def test_labels_of_held_out_rows_are_not_read(spark):
    docs, labels = quality_rows(120)
    df = spark.createDataFrame(docs, "doc_id long, text string, score double")
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in labels]
    scores = []
    for rows in (labels, turned):
        vectors, network = quality.train(df, spark.createDataFrame(rows, "doc_id long, quality int"))
        scores.append([r.score for r in quality.score(df, vectors, network).orderBy("doc_id").collect()])
    assert np.allclose(scores[0], scores[1])


def test_random_indexing_is_a_sum_of_index_vectors():
    split = Splitter()
    (w,) = split.words(pa.array(["aa bb cc bb", "cc dd"]))
    index, sums = quality.index_vectors(quality.WORDS, 1), np.zeros((quality.WORDS, quality.DIMS))
    quality.context_sums(w, index, sums)
    at = (w.hash & np.uint64(quality.WORDS - 1)).astype(int)
    want = np.zeros_like(sums)
    for i in range(len(at)):
        for j in range(max(0, i - 2), min(len(at), i + 3)):
            if i != j and w.row[i] == w.row[j]:
                want[at[i]] += index[at[j]]
    assert np.allclose(sums, want)


def test_word_vectors_do_not_depend_on_tasks(spark):
    """Merged in two levels beyond 32 tasks, with tasks that have no rows."""
    rng = random.Random(4)
    docs = spark.createDataFrame([(sentence(rng, 30),) for _ in range(60)], "text string")
    one, many = quality.word_vectors(docs.coalesce(1)), quality.word_vectors(docs.repartition(70))
    assert np.array_equal(one, many) and abs(one).sum() > 0


def test_network_gradients():
    rng = np.random.default_rng(3)
    net = lm_score.Network(seed=2)
    net = lm_score.Network(net.flat)
    beside = rng.integers(0, lm_score.CODES + 1, (40, 4))
    target = rng.integers(0, lm_score.CODES, 40)
    before = net.log_probabilities(beside, target).mean()
    squares = {k: np.zeros(s, np.float32) for k, s in lm_score.SHAPES.items()}
    for _ in range(60):
        net.step(beside, target, squares)
    assert net.log_probabilities(beside, target).mean() > before + 2
    # gradients against numeric derivatives of the mean loss, in doubles
    net = lm_score.Network(seed=2)
    net.flat = net.flat.astype(np.float64)
    at = 0
    for k, shape in lm_score.SHAPES.items():
        net.p[k] = net.flat[at:at + int(np.prod(shape))].reshape(shape)
        at += int(np.prod(shape))
    loss = lambda: -net.log_probabilities(beside, target).mean()
    for k, g in net.gradients(beside, target).items():
        for place in map(tuple, np.argwhere(np.abs(g) >= np.sort(np.abs(g), None)[-3])[:3]):
            was, out = net.p[k][place], []
            for step in (1e-5, -1e-5):
                net.p[k][place] = was + step
                out.append(loss())
            net.p[k][place] = was
            assert (out[0] - out[1]) / 2e-5 == pytest.approx(g[place], rel=1e-4, abs=1e-7)
    net = lm_score.Network(seed=2)
    # probabilities of all codes sum to one
    one = np.repeat(beside[:1], lm_score.CODES, 0)
    assert abs(np.exp(net.log_probabilities(one, np.arange(lm_score.CODES)).astype(float)).sum() - 1) < 1e-3


def test_language_model(spark, odd_docs, odd_rows, no_docs):
    rng = random.Random(4)
    # every word determines its neighbours
    texts = [" ".join(f"w{(s + k) % 12}" for k in range(60)) for s in range(60)]
    mixed = [" ".join(rng.sample(t.split(), 60)) for t in texts[:10]]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(2)
    model = lm_score.train(docs, epochs=6)
    test = spark.createDataFrame([(i, t) for i, t in enumerate(texts[:10] + mixed)], "doc_id long, text string")
    got = {r.doc_id: r for r in lm_score.score(test, model).collect()}
    assert np.mean([got[i].log_prob_per_word for i in range(10)]) > np.mean([got[i].log_prob_per_word for i in range(10, 20)]) + 0.3
    odd = lm_score.score(odd_docs, model).collect()
    assert len(odd) == len(odd_rows)
    by_id = {r.doc_id: r for r in odd}
    assert by_id[0].n_words == 0 and by_id[0].log_prob == 0.0 and by_id[0].log_prob_per_word is None
    assert by_id[4].log_prob == pytest.approx(by_id[5].log_prob) and all(r.log_prob <= 0 for r in odd)
    from pyspark.sql import functions as F

    clashing = odd_docs.select("*", *[F.lit("x").alias(c) for c in ("words", "word", "row", "_row", "n", "n_words", "log_prob", "_log", "_logs", "mass", "seen")])
    again = lm_score.score(clashing, model).collect()
    assert sorted((r.doc_id, r.n_words, round(r.log_prob, 3)) for r in again) == sorted((r.doc_id, r.n_words, round(r.log_prob, 3)) for r in odd)
    lm_score.train(clashing, epochs=1)
    assert lm_score.score(no_docs, model).collect() == []
    lm_score.train(no_docs, epochs=1)


def test_pseudo_likelihood_by_brute_force(spark, monkeypatch):
    # four words have a code of their own, the others share eight
    monkeypatch.setattr(lm_score, "CODES", 12)
    monkeypatch.setattr(lm_score, "RARE", 8)
    monkeypatch.setitem(lm_score.SHAPES, "embed", (13, lm_score.EMBED))
    rng = random.Random(7)
    texts = [" ".join(rng.choice(("red", "ox", "1905", "plum", "fig,")) if rng.random() < 0.6 else f"rare{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(n)) for n in (1, 2, 5, 40, 300)]
    texts += [texts[3], "unseen" * 3, "", None]
    docs = spark.createDataFrame([(i, t, i, 0, 0) for i, t in enumerate(texts)], "doc_id long, text string, row long, word int, n int")
    known = docs.where("doc_id <> 6")
    model = lm_score.train(known)
    split = lambda t: re.findall("[A-Za-z]+|[0-9]+|[^A-Za-z0-9 ]+", t or "")
    hashed = {}
    for t in texts:
        for w in Splitter().words(pa.array([t], pa.string())):
            hashed |= dict(zip(split(t), w.hash.tolist()))
    n = Counter(w for i, t in enumerate(texts) if i != 6 for w in split(t))
    frequent = model.frequent.tolist()
    assert [n[w] for f in frequent for w, h in hashed.items() if h == f] == sorted(n.values(), reverse=True)[:len(frequent)]
    own = {w: frequent.index(h) for w, h in hashed.items() if h in frequent}
    code = {w: own[w] if w in own else lm_score.CODES - lm_score.RARE + (h & (lm_score.RARE - 1)) for w, h in hashed.items()}
    net = lm_score.Network(model.flat)
    got = {r.doc_id: r for r in lm_score.score(docs, model).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        words, total = split(t), 0.0
        for k, w in enumerate(words):
            beside = [code[words[k + s]] if 0 <= k + s < len(words) else lm_score.CODES for s in lm_score.BESIDE]
            total += float(net.log_probabilities(np.array([beside]), np.array([code[w]]))[0])
            if w not in own:
                others = [v for v in n if v not in own and code[v] == code[w]]
                total += np.log((n[w] + 1) / (sum(n[v] for v in others) + len(others) + 1))
        assert got[i].n_words == len(words) and got[i].log_prob == pytest.approx(total, rel=1e-4, abs=1e-6)
    assert got[3].log_prob == pytest.approx(got[5].log_prob, rel=1e-6)
