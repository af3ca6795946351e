import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quillspark.llm import fim, lexicon, spelling
from quillspark.llm.packing import default_tokenizer

from .conftest import SCHEMA, sentence


# ------------------------------------------------------------ fill in middle

def arranged(doc_id, text):
    """The contract, by slices."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k:k + 8], 16) for k in (0, 8, 16, 24)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return doc_id, n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def test_fill_in_middle(spark, odd_docs, odd_rows, clashing, no_docs):
    from pyspark.sql import functions as F

    rows = [(r[0], r[1]) for r in odd_rows] + [(500 + k, f"ein <{m}> Text\n") for k, m in enumerate("PSMX")] + [(None, "ohne Nummer"), (900, "𝒳<<S<é")]
    rows += [(1000 + k, "<M" * (k % 3) + "naïve 日本" * 3) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for window in (fim.WINDOW, 7):
        made = fim.fill_in_middle(docs, window=window)
        got = [tuple(r) for r in made.select(*fim.COLUMNS.replace(" long", "").replace(" string", "").split(", ")).collect()]
        assert Counter(got) == Counter(arranged(*r) for r in rows)
        assert {r[2] for r in got} == {"plain", "psm", "spm"}
    back = made.select("doc_id", fim.restore(F.col("output"), F.col("form")).alias("text")).collect()
    assert Counter(map(tuple, back)) == Counter((i, t or "") for i, t in rows)
    assert fim.fill_in_middle(no_docs).collect() == []
    assert fim.fill_in_middle(clashing).count() == len(odd_rows)


def test_units_of_any_pattern():
    units = fim.Units(r"\s*\S+\s*", window=2)
    n, offsets = units.cuts("ein  zwei drei vier fünf", lambda n: [0, 1, 3, n])
    assert n == 5 and offsets == [0, 5, 15, 24]
    assert fim.Units(r"\X").cuts("éx", lambda n: [1]) == (2, [2])
    with pytest.raises(ValueError):
        fim.Units("a").cuts("aab", lambda n: [])
    with pytest.raises(ValueError):
        fim.Units("a*").cuts("b", lambda n: [])


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="a<PSM>\né𝒳", max_size=40), st.integers(0, 10**6), st.integers(1, 9))
def test_rearranged(text, doc_id, window):
    assert (doc_id, *fim.rearranged(doc_id, text, fim.Units(window=window))) == arranged(doc_id, text)


# ------------------------------------------------------------------ spelling

def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:k] + long[k + 1:] == short for k in range(len(long)))


def grouped(counts, times=10):
    forms, rows = {}, {}
    for w, n in counts.items():
        beside = sorted((-m, v) for v, m in counts.items() if near(w, v))
        forms[w] = beside[0][1] if beside and -beside[0][0] >= times * n else None
        rows[w] = (n, len(beside))
    out = set()
    for w, (n, beside) in rows.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.add((w, forms[w], root, n, beside, counts[forms[w]] if forms[w] else None))
    return out


def counted(rows):
    counts = Counter()
    for i, t in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                counts[run] += 1
    return Counter({w: n for w, n in counts.items() if n >= 2})


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def test_spelling_groups_by_brute_force(spark):
    rng = random.Random(3)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 7))): rng.choice([1, 2, 3, 20, 40, 400, 4000]) for _ in range(250)}
    words |= {"straße": 5, "strasse": 70, "strase": 700, "ÉCOLE": 3, "École": 30, "é": 9, "𝒳a": 8}
    table = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    got = [tuple(r[c] for c in COLUMNS) for r in spelling.spelling_groups(table).collect()]
    assert len(got) == len(words) and set(got) == grouped(words)
    assert any(r[1] and r[2] != r[1] for r in got)


def test_spelling_query(spark, tmp_path, no_docs, odd_rows):
    rng = random.Random(4)
    base = [sentence(rng, 1) + sentence(rng, 1) for _ in range(12)]
    rows = [(None if k % 9 == 0 else k, " ".join(rng.choice(base).title() if rng.random() < 0.1 else rng.choice(base) for _ in range(60)) + " Größenwahn×x 12") for k in range(60)]
    rows += [(77, None), (78, ""), rows[1], rows[1], *[(r[0], r[1]) for r in odd_rows]]
    spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    out = spelling.op12_permuterm(spark, str(tmp_path))
    assert dict(out.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    got = [tuple(r[c] for c in COLUMNS) for r in out.collect()]
    want = grouped(counted(rows))
    assert len(got) == len(want) and set(got) == want and any(r[1] for r in got)
    assert spelling.spelling_groups(spelling.occurrences(no_docs).groupBy("word").count().withColumnRenamed("count", "n")).collect() == []


# ------------------------------------------------------------------- lexicon

def test_transducer_holds_its_words_and_shares_suffixes():
    rng = random.Random(6)
    entries = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 7))).encode(): tuple(rng.randint(0, 5) for _ in range(rng.randint(0, 4))) for _ in range(600)}
    t = lexicon.Transducer(lexicon.compile_lexicon(entries.items()))
    asked = [*entries, b"", b"abcd", b"x", b"aaaaaaaaa", b"c" * 100]
    data = np.frombuffer(b"".join(asked), np.uint8)
    length = np.array([len(w) for w in asked])
    held, n, ids = t.look_up(data, np.cumsum(length) - length, length)
    assert [w for w, h in zip(asked, held) if h] == [w for w in asked if w in entries]
    assert np.split(ids, np.cumsum(n)[:-1])[0].tolist() == list(entries[asked[0]])
    at = 0
    for w, k in zip([w for w in asked if w in entries], n):
        assert tuple(ids[at:at + k].tolist()) == entries[w]
        at += k
    none = lexicon.Transducer(lexicon.compile_lexicon([]))
    assert not none.look_up(data, np.cumsum(length) - length, length)[0].any()
    # words with one ending and one kind of ids: a state for each letter, not for each word
    one = lexicon.Transducer(lexicon.compile_lexicon((f"{c}-ending".encode(), (k,)) for k, c in enumerate("abcdefgh")))
    assert len(one.tail) == len("-ending") + 2 and len(one.key) == len("-ending") + 8


@pytest.fixture(scope="module")
def bpe():
    return lexicon.WordBpe(default_tokenizer()), Tokenizer.from_file(default_tokenizer())


@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=60) | st.text(alphabet="aeinrstß'01 \n<|>éÉ", max_size=80))
def test_merges_are_the_tokenizers(bpe, text):
    own, theirs = bpe
    assert [i for w in own.words(text) for i in own.merged(w)] == theirs.encode(text, add_special_tokens=False).ids


def test_encode_and_decode(spark, odd_docs, odd_rows, clashing, no_docs, bpe):
    _, theirs = bpe
    rows = [(r[0], r[1]) for r in odd_rows] + [(None, "It's 12½ x<|endoftext|>ab  <|EndOfText|> İ ΑΣ ﬁ é ​ 🎉"), (501, "<|startoftext|>"), (502, "\x00 a\x85b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    path = default_tokenizer()
    want = Counter()
    for i, t in rows:
        ids = theirs.encode(t or "", add_special_tokens=False).ids
        want[i, np.array(ids, "<u4").tobytes(), theirs.decode(ids, skip_special_tokens=False)] += 1
    for words in (lexicon.LEXICON, 5):  # the lexicon's size changes nothing
        name = lexicon.build_lexicon(docs, path, words)
        got = lexicon.decode(lexicon.encode(docs, path, name), path).collect()
        assert Counter((r.doc_id, bytes(r.ids), r.text) for r in got) == want
    assert lexicon.encode(no_docs, path, lexicon.build_lexicon(no_docs, path)).collect() == []
    assert lexicon.encode(clashing, path, name).count() == len(odd_rows)


def test_word_counts(spark, odd_docs, odd_rows, bpe):
    own, _ = bpe
    got = {r.word: r.n for r in lexicon.word_counts(odd_docs, default_tokenizer()).collect()}
    want = Counter(w for r in odd_rows for w in own.words(r[1] or "") if len(w.encode()) <= lexicon.LONGEST)
    assert got == want


def test_unknown_ids_are_refused(spark):
    ids = spark.createDataFrame([(1, bytearray(np.array([49408], "<u4").tobytes()))], "doc_id long, ids binary")
    with pytest.raises(Exception, match="doesn't have|index|bounds"):
        lexicon.decode(ids, default_tokenizer()).collect()


def test_regex_library_keeps_every_repetition():
    assert regex.fullmatch("(?s:(.))*", "ab\n").ends(1) == [1, 2, 3]


# ------------------------------------------------------------- near duplicates

def test_near_copies_of_any_length_are_found(spark):
    """300 pairs of 9 to 300 words, a similarity of 0.80 to 0.95, changes scattered."""
    from quillspark.llm import near_dup

    rng = random.Random(21)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(4000)]
    rows, pairs = [], 0
    for k in range(300):
        n = rng.choice([9, 10, 12, 15, 20, 30, 45, 50, 60, 100, 200, 300])
        a = [rng.choice(vocabulary) for _ in range(n)]
        b = a[:]
        for at in rng.sample(range(n), max(1, int(rng.uniform(0.05, 0.2) * n))):
            b[at] = f"changed{rng.random()}"
        rows += [(2 * k, " ".join(a)), (2 * k + 1, " ".join(b))]
        pairs += near_dup.near(*[np.array([zlib.crc32(w.encode()) for w in t]) for t in (a, b)])
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = sum(got[2 * k] == got[2 * k + 1] for k in range(300))
    assert pairs == 300 and found >= 0.95 * pairs, found
    assert all(got[2 * k] == 2 * k for k in range(300))                   # and nothing else


def test_passages_that_many_texts_share(spark):
    """Thousands of unlike texts in the same buckets; the near copies among them are found."""
    from quillspark.llm import near_dup

    rng = random.Random(22)
    passage = sentence(rng, 40)
    own = [" ".join(f"u{rng.randrange(10**6)}" for _ in range(35)) for _ in range(1200)]
    rows = [(k, f"{t[:len(t) // 2]} {passage} {t[len(t) // 2:]}") for k, t in enumerate(own)]
    rows += [(5000 + k, rows[k][1].replace(" u", " v", 2)) for k in range(0, 1200, 12)]
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    copies = [k for k in range(0, 1200, 12) if got[5000 + k] == got[k]]
    assert len(copies) >= 0.95 * 100, len(copies)
    assert sum(c == d for d, c in got.items()) >= len(rows) - 100
