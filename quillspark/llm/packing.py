"""Best-fit packing: length patterns by non-negative least squares.

Every document becomes token ids and an end id; longer ones are cut into pieces
of ``SEQUENCE`` tokens. Only the histogram of piece lengths (``SEQUENCE``
numbers, however many documents) reaches the driver. There patterns of two or
three lengths that fill a sequence are enumerated, repeat counts are fitted to
the histogram by non-negative least squares and rounded down to what the
histogram has; the pieces left over are packed by best fit, on the histogram
too. The outcome is a list of patterns with counts, of bounded size. Each piece
then finds its sequence from its length and its rank among pieces of equal
length.

Defined results. Null text counts as empty: one piece, the end id alone. Every
input row gives its pieces, repeated rows too. An empty table gives no rows.
Pieces of equal length rank by (bucket, doc_id, piece). Extra columns are
ignored.
"""

from __future__ import annotations

import sys
import types
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.llm.common import SEED, bounded_batches, cut, documents, seeded

SEQUENCE = 2048
END_ID = 0
PATTERN_ANCHORS = 24      # middle lengths that three-piece patterns are made with
FIT_STEPS = 400
RANK_BUCKETS = 512        # rows of a rank bucket, over all lengths
GROUP_BUCKETS = 1024     # buckets whose counts one window adds up
WORDS_KEPT = 700_000      # tokenized words of each of a Python worker's two generations
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# ------------------------------------------------------------------ tokens

def _plain_ranges() -> tuple[str, str, str]:
    """Characters whose lower case, composition and class are the same for every
    library: Latin letters up to U+017F, digits, and everything a text has
    beside them in that range. Made from Unicode's categories by rule."""
    plain = [chr(c) for c in [*range(9, 14), *range(32, 0x85), *range(0x86, 0x180), *range(0x2010, 0x2028)] if c != 0x130]
    letters = "".join(c for c in plain if unicodedata.category(c)[0] == "L")
    numbers = "".join(c for c in plain if unicodedata.category(c)[0] == "N")
    return "".join(plain), letters, numbers


class WordTokenizer:
    """A tokenizer's ids for whole texts, where a word's ids depend on the word
    alone: words already seen are looked up, new ones go to the tokenizer all
    together. Texts with any other character than the plain ones, or with the
    start of a special token, go to the tokenizer whole."""

    def __init__(self, path: str):
        import re

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        for word, at in vocab.items():
            self.ends[at] = word.endswith("</w>")
        plain, letters, numbers = _plain_ranges()
        esc = lambda s: "".join(f"\\u{ord(c):04x}" for c in s)
        self.odd = re.compile(f"[^{esc(plain)}]|<\\|")
        # the tokenizer's own rule of words, for lower-case plain text
        self.split = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{esc(letters)}]+|[{esc(numbers)}]|[^\\s{esc(letters + numbers)}]+").findall
        # Two generations: a full one becomes the old one, and words still in
        # use come over from there.
        self.words: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def learn(self, wanted: list[str]) -> None:
        if len(self.words) + len(wanted) > WORDS_KEPT:
            self.words, self.old = {}, self.words
        new = []
        for w in wanted:
            ids = self.old.get(w)
            if ids is None:
                new.append(w)
            else:
                self.words[w] = ids
        if not new:
            return
        ids = np.array(self.tokenizer.encode(" ".join(new), add_special_tokens=False).ids, np.uint16)
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(new):  # a word that the tokenizer splits again: one by one
            for w in new:
                self.words[w] = np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, np.uint16).tobytes()
            return
        raw, at = ids.tobytes(), 0
        for w, end in zip(new, (2 * ends).tolist()):
            self.words[w] = raw[at:end]
            at = end

    def ids(self, text: str) -> np.ndarray:
        if self.odd.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        words = self.split(text.lower())
        known = self.words
        try:
            return np.frombuffer(b"".join([known[w] for w in words]), np.uint16).astype(np.uint32)
        except KeyError:
            self.learn([w for w in dict.fromkeys(words) if w not in known])
            known = self.words
            if any(w not in known for w in words):  # forgotten to make room
                self.learn([w for w in dict.fromkeys(words) if w not in known])
            return np.frombuffer(b"".join([known[w] for w in words]), np.uint16).astype(np.uint32)


def worker_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of this Python worker, kept from one task to the next."""
    kept = sys.modules.setdefault("_quillspark_kept", types.ModuleType("_quillspark_kept"))
    if getattr(kept, "path", None) != path:
        kept.path, kept.words = path, WordTokenizer(path)
    return kept.words


def pieces(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Rows ``(doc_id, piece, start, length, ids_crc32)`` of ``docs(doc_id, text)``."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        words = worker_tokenizer(tokenizer_path)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(words.ids(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                for k, at in enumerate(range(0, len(ids), sequence)):
                    part = ids[at:at + sequence]
                    out.append((doc_id, k, at, len(part), zlib.crc32(part.tobytes())))
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


# ---------------------------------------------------------------- patterns

def patterns(histogram: np.ndarray, size: int, anchors: int = PATTERN_ANCHORS) -> np.ndarray:
    """Rows of three lengths (0: none) that sum to ``size``, of lengths that the
    histogram has: all pairs, and triples whose middle one is an anchor, a
    length where an equal share of all pieces ends."""
    have = histogram > 0
    half = np.arange(1, size // 2 + 1)
    pairs = np.stack([size - half, half, 0 * half], 1)
    below = np.cumsum(histogram * (np.arange(size + 1) <= size // 2))
    spots = np.unique(np.searchsorted(below, np.linspace(0, below[-1], anchors + 2)[1:-1])) if below[-1] else np.array([], int)
    rows = [pairs]
    for a in spots[spots > 0]:
        rest = size - a
        b = np.arange(1, rest // 2 + 1)
        rows.append(np.stack([rest - b, b, 0 * b + a], 1))
    every = np.sort(np.concatenate(rows), 1)[:, ::-1]
    every = np.unique(every, axis=0)
    have[0] = True
    return every[have[every].all(1)]


def fit_counts(shapes: np.ndarray, histogram: np.ndarray, steps: int = FIT_STEPS) -> np.ndarray:
    """Non-negative least squares of ``A x = histogram``, A being the patterns'
    length counts, by accelerated projected gradient on the sparse A. An error
    weighs as the square of its length: what is left of long pieces is harder
    to pack."""
    n = len(histogram)
    used = shapes > 0
    error_weight = (np.arange(n) / (n - 1)) ** 2
    # |W A|^2 <= largest column sum times largest row sum
    rows = np.bincount(shapes[used], minlength=n) * error_weight
    step = 1.0 / max(1e-9, float(rows.max() * 3)) if len(shapes) else 1.0
    wanted = histogram.astype(float)
    x = np.zeros(len(shapes))
    y, t = x, 1.0
    for _ in range(steps if len(shapes) else 0):
        made = np.zeros(n)
        for c in range(3):
            made += np.bincount(shapes[:, c], weights=y, minlength=n)
        residual = (made - wanted) * error_weight
        gradient = residual[shapes].sum(1)
        new = np.maximum(0, y - step * gradient)
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / t2 * (new - x), new, t2
    return x


def plan(histogram: np.ndarray, size: int = SEQUENCE) -> list[tuple[tuple[int, ...], int]]:
    """Patterns with whole counts that use up the histogram exactly."""
    left = histogram.astype(np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []
    if left[size]:
        out.append(((size,), int(left[size])))
        left[size] = 0
    shapes = patterns(left, size)
    counts = fit_counts(shapes, left)
    some = np.flatnonzero(counts >= 0.5)
    # patterns of the longest pieces first: only the fitting complement serves them
    for at in some[np.lexsort((-counts[some], -shapes[some, 0]))] if len(some) else ():
        # The fit can ask for more than there is: what is left bounds it.
        lengths, times = np.unique(shapes[at][shapes[at] > 0], return_counts=True)
        n = int(min(np.floor(counts[at] + 0.5), (left[lengths] // times).min()))
        if n > 0:
            out.append((tuple(int(v) for v in shapes[at] if v), n))
            left[lengths] -= n * times
    return out + best_fit(left, size)


def best_fit(left: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Longest first into the fullest sequence with room, on counts: open
    sequences of equal content are one entry. A step uses up a length or an
    entry, so the list grows with the lengths, not with the pieces."""
    import bisect

    opened: dict[int, list[list]] = {}
    rooms: list[int] = []
    done: list[tuple[tuple[int, ...], int]] = []

    def put(content: tuple[int, ...], n: int) -> None:
        room = size - sum(content)
        if room == 0:
            done.append((content, n))
            return
        if room not in opened:
            bisect.insort(rooms, room)
            opened[room] = []
        opened[room].append([content, n])

    for length in range(size, 0, -1):
        n = int(left[length])
        while n:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                each = max(1, size // length)
                if n >= each:
                    put((length,) * each, n // each)
                    n -= n // each * each
                else:
                    put((length,) * n, 1)
                    n = 0
                continue
            room = rooms[at]
            entry = opened[room][-1]
            fits = max(1, room // length)
            if n >= entry[1] * fits:
                opened[room].pop()
                if not opened[room]:
                    del opened[room]
                    rooms.pop(at)
                put(entry[0] + (length,) * fits, entry[1])
                n -= entry[1] * fits
            elif n >= fits:
                entry[1] -= n // fits
                put(entry[0] + (length,) * fits, n // fits)
                n -= n // fits * fits
            else:
                entry[1] -= 1
                if not entry[1]:
                    opened[room].pop()
                    if not opened[room]:
                        del opened[room]
                        rooms.pop(at)
                put(entry[0] + (length,) * n, 1)
                n = 0
    for entries in opened.values():
        done += [(content, n) for content, n in entries if n]
    return done


def slots(packed: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """Per length, ranges of ranks: ``(length, first rank, one past the last,
    sequence of the first, offset)``."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for content, n in packed:
        offset = 0
        for length in content:
            first = used.get(length, 0)
            out.append((length, first, first + n, sequence, offset))
            used[length] = first + n
            offset += length
        sequence += n
    return out


def pack(cut_pieces: DataFrame, size: int = SEQUENCE, bucket_rows: int = RANK_BUCKETS, group_buckets: int = GROUP_BUCKETS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces that are already written
    (:func:`pieces`, then ``cut``). Ranks within a length come from three
    levels: inside a bucket of (length, hash of the id), the counts of the
    buckets before it in its group of ``GROUP_BUCKETS``, and those of the groups
    before that, so a length that a third of the pieces share is ranked by many
    tasks and no window has more than a group's buckets or a length's groups."""
    spark = cut_pieces.sparkSession
    counts = cut_pieces.groupBy("length").count().collect()  # at most `size` rows
    histogram = np.zeros(size + 1, np.int64)
    for length, n in counts:
        histogram[length] = n
    buckets = max(1, int(histogram.sum()) // bucket_rows)
    bucketed = cut_pieces.withColumn("_bucket", F.pmod(seeded(SEED, "doc_id", "piece"), F.lit(buckets)))
    sizes = bucketed.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    sizes = cut(sizes.withColumn("_group", F.floor(F.col("_bucket") / group_buckets)))
    through = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    groups = sizes.groupBy("length", "_group").agg(F.sum("_n").alias("_n"))
    groups = groups.select(F.col("length").alias("_l"), F.col("_group").alias("_g"), through(Window.partitionBy("length").orderBy("_group")).alias("_groups_before"))
    sizes = sizes.withColumn("_inside_before", through(Window.partitionBy("length", "_group").orderBy("_bucket")))
    sizes = sizes.join(cut(groups), (F.col("length") == F.col("_l")) & (F.col("_group") == F.col("_g")))
    sizes = cut(sizes.select(F.col("length").alias("_length"), F.col("_bucket").alias("_b"), (F.col("_groups_before") + F.col("_inside_before")).alias("_before")))
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece")
    ranked = bucketed.withColumn("_rank", F.row_number().over(inside) - 1)
    ranked = ranked.join(sizes, (F.col("length") == F.col("_length")) & (F.col("_bucket") == F.col("_b")))
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_before"))
    table = np.array(slots(plan(histogram, size)) or np.zeros((0, 5)), np.int64).reshape(-1, 5)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    # One number orders (length, rank): ranks are below 2**50.
    starts = (table[:, 0] << 50) + table[:, 1]
    given = spark.sparkContext.broadcast((starts, table))  # a few rows for each of `size` lengths
    names = cut_pieces.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, table = given.value
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            row = table[np.searchsorted(starts, (length << 50) + rank, side="right") - 1] if len(rank) else np.zeros((0, 5), np.int64)
            sequence = row[:, 3] + rank - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in names), pa.array(sequence), pa.array(row[:, 4])],
                [*names, "sequence_id", "offset"])

    schema = ", ".join([f"{c} {t}" for c, t in cut_pieces.dtypes] + ["sequence_id long", "offset long"])
    return ranked.select(*names, "_rank").mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    return pack(cut(pieces(docs, tokenizer_path)))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_pack_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), default_tokenizer())
