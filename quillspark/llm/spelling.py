"""Spelling variants by sorted permuterm rotations.

A word marked with a terminator has a rotation for each of its places. Two words
differ by one replaced code point if two of their rotations agree but for the
last one, and by one inserted code point if a rotation of the longer agrees, but
for its last one, with a whole rotation of the shorter. So with all rotations
sorted, a word's near words stand beside it: they share the prefix that skips
the edited code point. Each prefix is a group; it holds at most one whole
rotation and one word for each code point of the alphabet.

Groups are scanned by window functions over the sorted rotations. A group isn't
expanded into pairs: each member gets the number of its neighbours there and the
best of them (the group's first, or its second for the first one itself). Two
words that differ by a replacement share exactly one group. Those that differ by
an inserted code point share one group for each place of a run of equal code
points (``ab`` and ``aab``); only the run's first place counts, so the sums over
a word's groups are exact. All that is sorted, shuffled and written is linear in
the words' lengths.

Defined results. Null text has no words; a null id counts as an empty one in the
hash that picks occurrences to shorten. Repeated rows each count. Ties between
forms go to the smaller word in code-point order. An empty table gives no rows;
extra columns are ignored. Words must not hold the terminator, which no run of
letters does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.llm.common import cut, documents

#: Fixed values of the query's words: runs, their upper-case letters, and how occurrences are shortened.
LETTERS = r"A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHORTENED = 31
MIN_LENGTH, MIN_COUNT, TIMES = 7, 2, 10
END = "$"


def occurrences(docs: DataFrame, least: int = MIN_LENGTH, shortened: int = SHORTENED) -> DataFrame:
    """``(word)``: a row for each occurrence of a word of at least ``least``
    code points in ``docs(doc_id, text)``: the runs of letters, lower-cased;
    where ``shortened`` divides an occurrence's hash it lacks one letter. Runs
    of fewer letters can't give such words and aren't listed."""
    run = F.explode(F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0)))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), run.alias("run"))
    runs = runs.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "utf-8"))
    hashed = runs.select("run", h.alias("h"))
    size = F.length("run")
    at = F.pmod(F.col("h"), size).cast("int")
    short = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    words = hashed.select(F.when(F.pmod(F.col("h"), F.lit(shortened)) == 0, short).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= least)


def rotations(words: DataFrame, end: str = END) -> DataFrame:
    """``(prefix, last, first, n)`` for the words of ``words(word, n)``: each
    rotation once whole (``last`` is null) and once without its last code
    point, unless that is the terminator. ``first``: the skipped code point
    begins a run of equal ones."""
    marked = F.concat("word", F.lit(end))
    places = F.transform(F.sequence(F.lit(0), F.length("word")), lambda p: F.struct(
        p.alias("p"), F.concat(F.substr(marked, p + 1), F.substr("word", F.lit(1), p)).alias("rotation")))
    each = words.select("word", "n", F.explode(places).alias("r")).select("word", "n", "r.p", "r.rotation")
    letter = lambda p: F.substr("word", p, F.lit(1))
    p = F.col("p")
    whole = F.struct(F.col("rotation").alias("prefix"), F.lit(None).cast("string").alias("last"), F.lit(False).alias("first"))
    skipped = F.struct(F.substr("rotation", F.lit(1), F.length("word")).alias("prefix"), letter(p).alias("last"),
                       ((p == 1) | (letter(p) != letter(p - 1))).alias("first"))
    both = each.select("n", F.explode(F.when(p > 0, F.array(whole, skipped)).otherwise(F.array(whole))).alias("k"))
    return both.select("k.prefix", "k.last", "k.first", "n")


def unrotated(prefix: Column, last: Column, end: str = END) -> Column:
    """The word of a rotation: what follows the terminator, then what precedes it."""
    whole = F.concat(prefix, F.coalesce(last, F.lit("")))
    return F.concat(F.split_part(whole, F.lit(end), F.lit(2)), F.split_part(whole, F.lit(end), F.lit(1)))


def scanned(rotated: DataFrame, end: str = END) -> DataFrame:
    """``(word, near, best_n, best)`` of each member of a prefix group that has
    neighbours there: how many, and the one of largest n (ties: smallest)."""
    group = Window.partitionBy("prefix")
    ranked = group.orderBy(F.col("last").isNull(), F.col("n").desc(), "last")
    all_ranked = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    skips = F.col("last").isNotNull()
    item = F.struct(F.col("n").alias("n"), F.col("last").alias("last"))
    # the first of those a whole word can be shortened to: largest n, then smallest code point
    shortened = F.min(F.when(skips & F.col("first"), F.struct((-F.col("n")).alias("n"), F.col("last").alias("last"))))
    seen = rotated.select(
        "*", F.row_number().over(ranked).alias("rank"), F.count(F.lit(1)).over(group).alias("members"),
        F.count("last").over(group).alias("skips"), F.max(F.when(~skips, F.col("n"))).over(group).alias("whole_n"),
        F.count_if(skips & F.col("first")).over(group).alias("firsts"), shortened.over(group).alias("shortened"),
        F.nth_value(item, 1).over(all_ranked).alias("one"), F.nth_value(item, 2).over(all_ranked).alias("two"))
    seen = seen.where("members > 1")
    word_of = lambda last: unrotated(F.col("prefix"), last, end)
    other = F.when(F.col("rank") == 1, F.col("two")).otherwise(F.col("one"))
    has_whole = F.col("first") & F.col("whole_n").isNotNull()
    replaced = F.when(skips & (F.col("skips") > 1), F.struct(other["n"].alias("n"), word_of(other["last"]).alias("word")))
    deleted = F.when(skips & has_whole, F.struct(F.col("whole_n").alias("n"), word_of(F.lit(None).cast("string")).alias("word")))
    inserted = F.when(~skips & (F.col("firsts") > 0), F.struct((-F.col("shortened.n")).alias("n"), word_of(F.col("shortened.last")).alias("word")))
    near = F.when(skips, F.col("skips") - 1 + has_whole.cast("long")).otherwise(F.col("firsts"))
    best = F.array_compact(F.array(replaced, deleted, inserted))
    key = F.transform(best, lambda b: F.struct((-b["n"]).alias("n"), b["word"].alias("word")))
    out = seen.where(near > 0).select(word_of(F.col("last")).alias("word"), near.alias("near"), F.array_min(key).alias("best"))
    return out.select("word", "near", "best")


def neighbours(words: DataFrame, end: str = END) -> DataFrame:
    """``(word, n_near, best)`` for those of ``words(word, n)`` that have near
    words; ``best`` is a struct of the minus n and the word of the best one."""
    seen = scanned(rotations(words, end), end)
    return seen.groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for ``forms(word, form)`` without circles: each word's
    last form, by pointer jumping on written tables. A word that has no row is
    a root."""
    at = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        step = at.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        jumped = cut(at.join(step.hint("merge"), F.col("root") == F.col("_word"), "left").select(
            "word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("_moved")))
        at = jumped.select("word", "root")
        if not jumped.where("_moved").limit(1).count():
            return at


def spelling_groups(words: DataFrame, times: float = TIMES, end: str = END) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for each row of ``words(word,
    n)``: the near word of largest n as its form, if that has ``times`` its n."""
    words = cut(words.select("word", "n"))
    near = neighbours(words, end).withColumnRenamed("word", "_near_word")
    known = words.join(near.hint("merge"), F.col("word") == F.col("_near_word"), "left")
    takes = -F.col("best.n") >= F.lit(times) * F.col("n")
    known = cut(known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                             F.when(takes, F.col("best.word")).alias("form"), F.when(takes, -F.col("best.n")).alias("form_n")))
    last = roots(known.where("form is not null")).select(F.col("word").alias("_word"), "root")
    return known.join(last.hint("merge"), F.col("word") == F.col("_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", F.col("form_n").cast("long").alias("form_n"))


def op12_permuterm(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = occurrences(documents(spark, sf_dir)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return spelling_groups(counted.where(F.col("n") >= MIN_COUNT))


OP12_SQL = """
WITH RECURSIVE polynomial(k, b, c) AS (
    -- the table of the checksum's bytes: eight shifts of each number up to 255
    SELECT 0, i::BIGINT, i::BIGINT FROM range(256) r(i)
    UNION ALL
    SELECT k + 1, b, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM polynomial WHERE k < 8
), crc AS (
    SELECT list(c ORDER BY b) AS t FROM polynomial WHERE k = 8
), runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{00C0}-\\x{00FF}]+')),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents
), counted AS (
    SELECT id, w, count(*) AS c, hex(encode(id || ':' || w)) AS x FROM runs WHERE length(w) >= 7 GROUP BY id, w
), summed AS (
    SELECT w, c, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(x), 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT)),
           lambda a, b: xor(a // 256, t[xor(a, b) % 256 + 1])), 4294967295) AS h
    FROM counted, crc
), words AS (
    SELECT v AS word, sum(c)::BIGINT AS n FROM (
        SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS v, c FROM summed)
    WHERE length(v) >= 7 GROUP BY v HAVING sum(c) >= 2
), shorter AS (
    SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS less, substr(word, p, 1) AS ch
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM words)
), pairs AS (
    SELECT a.word AS word, b.word AS near FROM shorter a JOIN shorter b ON a.less = b.less AND a.p = b.p AND a.ch <> b.ch
    UNION SELECT a.less, a.word FROM shorter a JOIN words b ON a.less = b.word
    UNION SELECT a.word, a.less FROM shorter a JOIN words b ON a.less = b.word
), ranked AS (
    SELECT p.word, p.near, w.n, row_number() OVER (PARTITION BY p.word ORDER BY w.n DESC, p.near) AS k, count(*) OVER (PARTITION BY p.word) AS n_near
    FROM pairs p JOIN words w ON w.word = p.near
), formed AS (
    SELECT w.word, w.n, coalesce(r.n_near, 0)::BIGINT AS n_near, CASE WHEN r.n >= 10 * w.n THEN r.near END AS form, CASE WHEN r.n >= 10 * w.n THEN r.n END AS form_n
    FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.k = 1
), followed(word, root) AS (
    SELECT word, word FROM formed
    UNION ALL
    SELECT f.word, g.form FROM followed f JOIN formed g ON g.word = f.root WHERE g.form IS NOT NULL
), deepest AS (
    SELECT f.word, f.root FROM followed f JOIN formed g ON g.word = f.root WHERE g.form IS NULL
)
SELECT formed.word, form, root, n, n_near, form_n FROM formed JOIN deepest ON deepest.word = formed.word
"""
