"""Line dedup by content-defined chunks of lines.

A text's lines are hashed. A gap between lines is a boundary where a rolling
hash over the two lines after it, or over the two before it, hits one value in
a divisor; both depend on content alone, so a passage that shifts or changes
neighbours keeps the boundaries inside it and, where its own lines decide,
around it. Each of ``DIVISORS`` gives a chunking of its own, finer and coarser
ones, so that some chunk of one of them lies inside the passage. A line of ``LONG_WORDS`` words or more is
always a chunk of its own. A short passage can have no boundary of any chunking
at both its ends, so the least windows are chunks as well: from each line on and
up to each line, the shortest run of two or more lines with words that reaches
``MIN_WORDS`` words. Every line of a passage of several lines and that many
words lies in a window inside the passage, wherever it stands, so an equal
passage is followed line by line as far as it goes.

Chunks of several lines and ``MIN_WORDS`` words, long lines and windows are
looked up over the whole corpus by hash; where a hash occurs again, 256-bit
digests of the bytes are compared with that of its first occurrence (least
doc_id, text hash, line). A later, equal one is removed, but for lines of that
first occurrence itself (a text that repeats a line over and over). Lines of
fewer than ``MIN_WORDS`` words together, such as brackets or bare headings, are
no passage.

Only hashes and places are shuffled for the lookup. Counts and first places
are combined before the shuffle; the join that finds the later ones is on
written tables, so that Spark splits a chunk that a third of the rows share.

Defined results. Null text stays null, empty text empty. Repeated rows (equal
id and text) are treated alike and keep the same lines. Every input row gives
one result row with all its columns; a text whose lines all go becomes empty;
an empty table gives none. Single short lines are never removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.common import SEED, bounded_batches, cut, documents
from quillspark.llm.tokens import MIX_A, SPACE, Splitter, buffers, blocks, mix, segment_hashes

DIVISORS = (2, 3, 3, 4, 4)
LONG_WORDS = 50
MIN_WORDS = 8
WINDOW_SEED = SEED + len(DIVISORS)
CHUNK = "hash long, doc_id long, th long, first int, lines int"


def line_table(data: np.ndarray, edges: np.ndarray, splitter: Splitter):
    """Row, byte range, hash and number of words of each line of some rows."""
    breaks = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([edges[:-1], breaks + 1]))
    row = np.searchsorted(edges[:-1], np.sort(np.concatenate([edges[:-1], breaks])), "right") - 1
    # an empty row has one empty line, which begins where the next row's first does
    row = np.repeat(np.arange(len(edges) - 1), np.bincount(np.searchsorted(edges[1:], breaks, "right"), minlength=len(edges) - 1) + 1)
    last = np.append(row[1:] != row[:-1], True)
    end = np.append(start[1:], edges[-1]) - ~last
    space = splitter.table[data] == SPACE if len(data) else np.zeros(0, bool)
    begins = np.concatenate([[0], np.cumsum(~space & np.append(True, space[:-1]))]) if len(data) else np.zeros(1, np.int64)
    # a row's first word may follow another row's last without white space
    words = begins[end] - begins[start]
    glued = (start > 0) & (end > start)
    glued[glued] = ~space[start[glued]] & ~space[start[glued] - 1]
    return row, start, end, segment_hashes(data, start, end, splitter.powers), words + glued


def chunks(row: np.ndarray, hashes: np.ndarray, words: np.ndarray, seed: int, divisor: int):
    """First line, one past the last and hash of each chunk of one chunking."""
    n = len(row)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    same = np.append(False, row[1:] == row[:-1])           # line i has the row of line i - 1
    ahead = np.where(np.append(same[1:], False), np.append(hashes[1:], np.uint64(0)), np.uint64(0))
    pair = mix(hashes * np.uint64(MIX_A) + ahead + np.uint64(seed))       # lines i, i + 1
    hit = (pair % np.uint64(divisor)) == 0
    hit2 = (mix(pair + np.uint64(1)) % np.uint64(divisor)) == 0
    behind = np.zeros(n, bool)
    behind[2:] = hit2[:-2] & same[2:] & same[1:-1]
    long = words >= LONG_WORDS
    gap = ~same | hit | behind | long | np.append(False, long[:-1])
    first = np.flatnonzero(gap)
    end = np.append(first[1:], n)
    place = np.arange(n) - np.repeat(first, end - first)
    whole = np.add.reduceat(mix(hashes + place.astype(np.uint64) * np.uint64(MIX_A)), first)
    return first, end, mix(whole + (end - first).astype(np.uint64))


def windows(row: np.ndarray, hashes: np.ndarray, words: np.ndarray, least: int = MIN_WORDS):
    """First line, one past the last and hash of each window of two or more
    lines with words that begins and ends with one, reaches ``least`` words and
    no longer does all that without its last such line, or without its first.
    Lines without words go with the window they are inside of."""
    line = np.flatnonzero(words > 0)
    n = len(line)
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    through = np.concatenate([[0], np.cumsum(words[line])])
    at = np.arange(n)
    end = np.maximum(at + 2, np.searchsorted(through, through[:-1] + least, "left"))             # from each line on
    first = np.minimum(at - 1, np.searchsorted(through, through[1:] - least, "right") - 1)       # up to each line
    first, end = np.concatenate([at, first]), np.concatenate([end, at + 1])
    inside = (first >= 0) & (end <= n)
    first, last = line[first[inside]], line[end[inside] - 1]
    inside = row[first] == row[last]
    first, end = np.unique(np.stack([first[inside], last[inside] + 1]), axis=1)
    # sums of the lines' hashes times powers of an odd number, which has an inverse
    powers, back = (np.multiply.accumulate(np.full(len(row), m % 2**64, np.uint64)) for m in (MIX_A, pow(MIX_A, -1, 2**64)))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers)])
    h = (sums[end] - sums[first]) * back[first]
    return first, end, mix(h + (end - first).astype(np.uint64) + np.uint64(WINDOW_SEED))


def chunk_table(docs: DataFrame) -> DataFrame:
    """Rows ``(hash, doc_id, th, first, lines)`` of ``docs(doc_id, th, text)``."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(words_only=True)
        for batch in batches:
            data, offsets = buffers(batch.column(2))
            for lo, hi in blocks(offsets):
                part, edges = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
                row, _, _, hashes, words = line_table(part, edges, splitter)
                line = np.arange(len(row)) - np.searchsorted(row, row)
                through = np.concatenate([[0], np.cumsum(words)])
                found = []
                for k, divisor in enumerate(DIVISORS):
                    first, end, h = chunks(row, hashes, words, SEED + k, divisor)
                    n_words = through[end] - through[first]
                    keep = ((end - first > 1) & (n_words >= MIN_WORDS)) | (n_words >= LONG_WORDS)
                    found.append(np.stack([first[keep], end[keep], h[keep].view(np.int64)]))
                first, end, h = windows(row, hashes, words)
                found.append(np.stack([first, end, h.view(np.int64)]))
                first, end, h = np.unique(np.concatenate(found, 1), axis=1)
                at = pa.array(lo + row[first])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h), batch.column(0).take(at), batch.column(1).take(at), pa.array(line[first].astype(np.int32)), pa.array((end - first).astype(np.int32))],
                    ["hash", "doc_id", "th", "first", "lines"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "th", "text").mapInArrow(run, CHUNK)


def digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode(), digest_size=32).digest()


def _text_hash(text: str = "text") -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")), F.lit(SEED))


def repeated(docs: DataFrame) -> DataFrame:
    """``(doc_id, th, spans)``: for each text that loses lines, the chunks (first
    line, number of lines) that are byte for byte those of an earlier place."""
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_hash().alias("th"), "text")
    table = cut(chunk_table(named))
    place = F.struct("doc_id", "th", "first")
    # counted before the shuffle too: a chunk in a third of all rows is one row a task
    firsts = cut(table.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("at"), F.min("lines").alias("n_lines")).where("n > 1")
                 .select(F.col("hash").alias("_hash"), "at"))
    again = cut(table.join(firsts, F.col("hash") == F.col("_hash")).select(
        "hash", "doc_id", "th", "first", "lines", (place == F.col("at")).alias("is_first"),
        F.when(F.col("at.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("at.th") == F.col("th")), F.col("at.first") + F.col("lines")).alias("clear")))
    wanted = again.groupBy(F.col("doc_id").alias("_id"), F.col("th").alias("_th")).agg(
        F.collect_set(F.struct("hash", "first", "lines", "is_first", "clear")).alias("wanted")).hint("merge")  # grows with the corpus
    texts = named.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th"))).select("doc_id", "th", "text", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, th, text, want in zip(*(c if k == 2 else c.to_pylist() for k, c in enumerate(batch.columns))):
                lines = (text.as_py() or "").split("\n")
                rows = []
                for w in want:
                    body = digest("\n".join(lines[w["first"]:w["first"] + w["lines"]]))
                    rows.append((w["hash"], doc_id, th, w["first"], w["lines"], w["is_first"], w["clear"], body))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                    ["hash", "doc_id", "th", "first", "lines", "is_first", "clear", "body"])

    bodies = cut(texts.mapInArrow(run, CHUNK + ", is_first boolean, clear int, body binary"))
    origin = cut(bodies.where("is_first").groupBy(F.col("hash").alias("_hash")).agg(F.first("body").alias("_body")))
    equal = bodies.where("not is_first").join(origin, (F.col("hash") == F.col("_hash")) & (F.col("body") == F.col("_body")))
    # lines of the first place stay, where a text repeats itself at once
    begin = F.greatest(F.col("first"), F.coalesce("clear", F.lit(0)))
    stop = F.col("first") + F.col("lines")
    span = F.struct(begin.alias("first"), (stop - begin).alias("lines"))
    equal = equal.where(stop > begin)
    return cut(equal.groupBy("doc_id", "th").agg(F.collect_set(span).alias("spans")))


def drop_repeated(docs: DataFrame, counts: bool = True) -> DataFrame:
    """``docs`` with its ``text`` without repeated chunks and, with ``counts``,
    how many lines are ``kept_lines`` and ``removed_lines`` (columns of these
    names are replaced)."""
    spans = repeated(docs).select(F.col("doc_id").alias("_of_id"), F.col("th").alias("_of_th"), F.col("spans").alias("_of_spans")).hint("merge")
    added = ["kept_lines", "removed_lines"] if counts else []
    names, kinds = [c for c in docs.columns if c not in added], dict(docs.dtypes)
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_of_id")) & (_text_hash() == F.col("_of_th"))
    both = docs.join(spans, same, "left").select(*[F.col(f"`{c}`") for c in names], "_of_spans")
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, kept, removed = [], [], []
            for text, spans in zip(batch.column(at), batch.column(len(names))):
                text, spans = text.as_py(), spans.as_py()
                lines = [] if text is None else text.split("\n")
                gone = np.zeros(len(lines), bool)
                for s in spans or ():
                    gone[s["first"]:s["first"] + s["lines"]] = True
                texts.append("\n".join(line for line, g in zip(lines, gone) if not g) if spans else text)
                kept.append(int((~gone).sum()))
                removed.append(int(gone.sum()))
            columns = list(batch.columns[:len(names)])
            columns[at] = pa.array(texts, pa.string())
            extra = [pa.array(kept, pa.int64()), pa.array(removed, pa.int64())][:len(added)]
            yield pa.RecordBatch.from_arrays([*columns, *extra], [*names, *added])

    return both.mapInArrow(run, ", ".join([f"`{c}` {kinds[c]}" for c in names] + [f"{c} long" for c in added]))


def op3_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated(documents(spark, sf_dir))
