"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

Encoding: texts are split into the tokenizer's words; the words' counts over the
whole corpus name up to ``LEXICON`` most frequent ones (a histogram of the counts
gives the least count taken); their token ids are found by exact merging and compiled into a minimal acyclic transducer, an automaton
whose arcs carry ids and whose equal suffixes are shared. It is one flat file of
32-bit numbers, which Spark ships to the executors and their Python workers map
into memory, so all workers of a machine share its pages. A task takes the
distinct words of a few megabytes of text at once and walks all of them through
the automaton, a byte at a time, in numpy; words that it doesn't hold are merged
exactly. The size of the lexicon is a matter of speed alone.

Decoding looks each id's token up and joins them as the tokenizer's own decoder
does where its file names none: by single spaces.

Defined results. Null text counts as empty: no ids, and an empty text back.
Every input row gives one result row, repeated rows too; an empty table gives
none; extra columns are ignored. Words of over ``LONGEST`` bytes aren't in the
lexicon. A tokenizer file of another kind than byte-level BPE with word ends
raises an error; so do ids that the tokenizer doesn't have.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import sys
import tempfile
import types
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.common import bounded_batches, cut, documents
from quillspark.llm.packing import _plain_ranges, default_tokenizer
from quillspark.llm.tokens import blocks, buffers

LEXICON = 1 << 17         # words of the transducer, at most
GRADES = 8                # of word counts, from one power of two to the next
LONGEST = 64              # bytes of a word of the transducer
BLOCK = 2 << 20           # bytes of text whose distinct words are walked together
MERGED_KEPT = 200_000     # merged words that a Python worker remembers, of up to LONGEST bytes each
SHORT = 256               # bytes of a word whose pairs are searched through for each merge


# ----------------------------------------------------------------- tokenizer

def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones stand for
    themselves, the others for the code points from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class WordBpe:
    """A byte-level BPE file with word ends: splitting, exact merging, decoding."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            kind = json.load(f)
        model = kind["model"]
        self.end = model.get("end_of_word_suffix")
        if model["type"] != "BPE" or not self.end or model.get("byte_fallback") or model.get("dropout") or kind.get("decoder"):
            raise ValueError(f"{path} isn't a byte-level BPE with word ends")
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in kind["added_tokens"]}
        letters = byte_letters()
        self.byte_of = {c: b for b, c in enumerate(letters)}
        self.inner = [vocab[c] for c in letters]
        self.last = [vocab[c + self.end] for c in letters]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = {(vocab[a], vocab[b]): k for k, (a, b) in enumerate(pairs)}
        self.made = [vocab[a + b] for a, b in pairs]
        self.whole = Tokenizer.from_file(path)
        plain, letter, number = _plain_ranges()
        esc = lambda s: "".join(f"\\u{ord(c):04x}" for c in s)
        marks = "|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))
        self.odd = re.compile(f"[^{esc(plain)}]" + (f"|{marks}" if marks else ""))
        self.marks = re.compile(f"({marks})") if marks else None
        # the file's rule of words, for lower-case plain text
        self.plain_words = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{esc(letter)}]+|[{esc(number)}]|[^\\s{esc(letter + number)}]+").findall

    def words(self, text: str) -> list[str]:
        """The text's words in order; special tokens stand as themselves. Texts
        with characters whose lower case, composition or class could differ
        between libraries are normalised and split by the tokenizer's own parts."""
        if not self.odd.search(text):
            return self.plain_words(text.lower())
        out = []
        for k, part in enumerate(self.marks.split(text) if self.marks else [text]):
            if k % 2:
                out.append(part)
            elif part:
                split = self.whole.pre_tokenizer.pre_tokenize_str(self.whole.normalizer.normalize_str(part))
                out += [bytes([self.byte_of[c] for c in w]).decode("utf-8") for w, _ in split]
        return out

    def merged(self, word: str) -> list[int]:
        """The ids of a word: of all neighbouring pairs the one of least rank,
        the leftmost of these, is merged until none is left."""
        if word in self.special:
            return [self.special[word]]
        raw = word.encode("utf-8")
        ids = [*[self.inner[b] for b in raw[:-1]], self.last[raw[-1]]]
        if len(ids) > SHORT:
            return self.merged_long(ids)
        get, none = self.rank.get, len(self.made)
        ranks = [get(p, none) for p in zip(ids, ids[1:])]
        while ranks and (least := min(ranks)) < none:
            k = ranks.index(least)
            ids[k:k + 2] = [self.made[least]]
            del ranks[k]
            if k:
                ranks[k - 1] = get((ids[k - 1], ids[k]), none)
            if k < len(ranks):
                ranks[k] = get((ids[k], ids[k + 1]), none)
        return ids

    def merged_long(self, ids: list[int]) -> list[int]:
        """The same for long words in n log n steps: pairs wait in a heap,
        neighbours are linked."""
        n, rank = len(ids), self.rank
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank[a, b], k, a, b) for k, (a, b) in enumerate(zip(ids, ids[1:])) if (a, b) in rank]
        heapq.heapify(heap)
        while heap:
            least, k, a, b = heapq.heappop(heap)
            right = after[k]
            if ids[k] != a or right >= n or ids[right] != b:  # one of the pair is merged already
                continue
            ids[k], ids[right], after[k] = self.made[least], -1, after[right]
            if after[k] < n:
                before[after[k]] = k
            for left in (before[k], k):
                if left >= 0 and after[left] < n and (pair := (ids[left], ids[after[left]])) in rank:
                    heapq.heappush(heap, (rank[pair], left, *pair))
        return [i for i in ids if i >= 0]


def token_table(path: str) -> pa.Array:
    """The tokens by id, null where the file has none."""
    with open(path, encoding="utf-8") as f:
        kind = json.load(f)
    tokens = {i: t for t, i in [*kind["model"]["vocab"].items(), *((t["content"], t["id"]) for t in kind["added_tokens"])]}
    return pa.array([tokens.get(i) for i in range(max(tokens) + 1)], pa.string())


# ---------------------------------------------------------------- transducer

class _State:
    __slots__ = ("arcs", "final", "tail")

    def __init__(self):
        self.arcs, self.final, self.tail = {}, False, ()


def compile_lexicon(entries: Iterable[tuple[bytes, tuple[int, ...]]]) -> np.ndarray:
    """The minimal acyclic transducer of distinct non-empty words with their
    ids, as one array of 32-bit numbers. Words come in byte order; ids move to
    the earliest arc that all words through it share; a state whose words are
    all in is replaced by an equal one, if there is."""
    known: dict[tuple, int] = {}
    path, previous = [_State()], b""

    def settle(state: _State) -> int:
        key = (state.final, state.tail, tuple((c, *arc) for c, arc in sorted(state.arcs.items())))
        return known.setdefault(key, len(known))

    def settle_beyond(depth: int) -> None:
        while len(path) > depth + 1:
            done = settle(path.pop())
            arc = path[-1].arcs[previous[len(path) - 1]]
            path[-1].arcs[previous[len(path) - 1]] = (arc[0], done)

    for word, ids in sorted(entries):
        depth = next((k for k, (a, b) in enumerate(zip(word, previous)) if a != b), min(len(word), len(previous)))
        settle_beyond(depth)
        for k in range(depth):
            out, to = path[k].arcs[word[k]]
            same = next((j for j, (a, b) in enumerate(zip(out, ids)) if a != b), min(len(out), len(ids)))
            path[k].arcs[word[k]] = (out[:same], to)
            ids, rest = ids[same:], out[same:]
            if rest:  # what not all words share moves one arc on
                deeper = path[k + 1]
                deeper.arcs = {c: (rest + o, t) for c, (o, t) in deeper.arcs.items()}
                deeper.tail = rest + deeper.tail if deeper.final else ()
        for k in range(depth, len(word)):
            path[k].arcs[word[k]] = (ids, None)
            ids = ()
            path.append(_State())
        path[-1].final, path[-1].tail = True, ids
        previous = word
    settle_beyond(0)
    root = settle(path[0])

    pool: list[int] = []
    places: dict[tuple, int] = {}

    def place(ids: tuple[int, ...]) -> int:
        if ids not in places:
            places[ids] = len(pool)
            pool.extend(ids)
        return places[ids]

    arcs = [(state * 256 + c, to, place(out), len(out)) for (_, _, kept), state in known.items() for c, out, to in kept]
    ends = [(place(tail), len(tail)) if final else (-1, 0) for final, tail, _ in known]
    columns = [*map(list, zip(*sorted(arcs)))] or [[], [], [], []]
    return np.array([root, len(arcs), len(ends), *sum(columns, []), *[p for p, _ in ends], *[n for _, n in ends], *pool], np.int32)


class Transducer:
    """A compiled lexicon, in memory or mapped from its file."""

    def __init__(self, flat: np.ndarray):
        self.root, arcs, states = map(int, flat[:3])
        at = 3
        parts = []
        for n in (arcs,) * 4 + (states,) * 2:
            parts.append(flat[at:at + n])
            at += n
        self.key, self.to, self.out, self.out_n, self.tail, self.tail_n = parts
        self.pool = flat[at:]

    def look_up(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the words (byte ranges of ``data``) it holds, the number of
        ids of each of those, and all their ids in order."""
        state = np.full(len(start), self.root, np.int64)
        live = np.flatnonzero((length > 0) & (length <= LONGEST)) if len(self.key) else np.zeros(0, np.int64)
        steps = int(length[live].max(initial=0))
        taken = np.full((len(start), steps), -1, np.int32)
        held = np.zeros(len(start), bool)
        for k in range(steps):
            key = state[live] * 256 + data[start[live] + k]
            arc = np.searchsorted(self.key, key)
            arc[arc == len(self.key)] = 0
            on = self.key[arc] == key
            live, arc = live[on], arc[on]
            taken[live, k] = arc
            state[live] = self.to[arc]
            ended = length[live] == k + 1
            held[live[ended]] = self.tail[state[live[ended]]] >= 0
            live = live[~ended]
        rows = taken[held]
        last = state[held]
        on_arc = rows >= 0
        place = np.column_stack([np.where(on_arc, self.out[rows], 0), self.tail[last]]).ravel()
        n = np.column_stack([np.where(on_arc, self.out_n[rows], 0), self.tail_n[last]])
        per_word, n = n.sum(axis=1), n.ravel()
        ids = self.pool[np.repeat(place - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        return held, per_word, ids


# ------------------------------------------------------------------- encoder

class Encoder:
    """Encodes blocks of texts in a Python worker."""

    def __init__(self, path: str, flat: np.ndarray):
        self.bpe, self.lexicon = WordBpe(path), Transducer(flat)
        self.remembered: dict[str, np.ndarray] = {}

    def merged(self, word: str) -> np.ndarray:
        ids = self.remembered.get(word)
        if ids is None:
            ids = np.array(self.bpe.merged(word), np.int32)
            if len(word) <= LONGEST:
                if len(self.remembered) >= MERGED_KEPT:
                    self.remembered.clear()
                self.remembered[word] = ids
        return ids

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each word and all ids in order."""
        coded = pa.array(words, pa.large_string()).dictionary_encode()
        data, offsets = buffers(coded.dictionary)
        held, per_held, held_ids = self.lexicon.look_up(data, offsets[:-1], np.diff(offsets))
        rest = np.flatnonzero(~held)
        merged = [self.merged(w) for w in coded.dictionary.take(pa.array(rest)).to_pylist()]
        n = np.zeros(len(held), np.int64)
        n[held], n[rest] = per_held, [len(x) for x in merged]
        begin = np.zeros(len(held), np.int64)
        begin[held] = np.cumsum(per_held) - per_held
        begin[rest] = len(held_ids) + np.cumsum(n[rest]) - n[rest]
        pool = np.concatenate([held_ids, *merged]) if merged else held_ids
        code = coded.indices.to_numpy(zero_copy_only=False)
        n, begin = n[code], begin[code]
        return n, pool[np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]


def _kept(name: str, make):
    """Kept in this Python worker from one task to the next, one of each kind."""
    kept = sys.modules.setdefault("_quillspark_lexicon", types.ModuleType("_quillspark_lexicon"))
    kind = name.split(":", 1)[0]
    if getattr(kept, kind, (None,))[0] != name:
        setattr(kept, kind, (name, make()))
    return getattr(kept, kind)[1]


def _text_blocks(column: pa.Array) -> Iterator[pa.Array]:
    """Slices of a text column of about ``BLOCK`` bytes."""
    for lo, hi in blocks(buffers(column)[1], BLOCK):
        yield column.slice(lo, hi - lo)


def word_counts(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``(word, n)`` over all texts of ``docs(text)``, for words of up to
    ``LONGEST`` bytes. Counted in the task first: a word in every document
    costs one row per block."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _kept(f"bpe:{tokenizer_path}", lambda: WordBpe(tokenizer_path))
        for batch in batches:
            for texts in _text_blocks(batch.column(0)):
                words: list[str] = []
                for t in texts.to_pylist():
                    words += bpe.words(t or "")
                counted = pc.value_counts(pa.array(words, pa.string()))
                yield pa.RecordBatch.from_arrays([counted.field("values"), counted.field("counts")], ["word", "n"])

    each = docs.select("text").mapInArrow(run, "word string, n long")
    return each.where(F.octet_length("word") <= LONGEST).groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(docs: DataFrame, tokenizer_path: str, words: int = LEXICON) -> list[str]:
    """Up to ``words`` most frequent words. Counts are graded by their size;
    the grades' histogram, some hundred rows, says how far down the list fits:
    no task and not the driver gets more than that."""
    grade = F.floor(F.log2("n") * GRADES)
    counts = cut(word_counts(docs, tokenizer_path).withColumn("grade", grade))
    least = None
    for row in sorted(counts.groupBy("grade").count().collect(), reverse=True):
        words -= row["count"]
        if words < 0:
            break
        least = row["grade"]
    return [] if least is None else [r["word"] for r in counts.where(F.col("grade") >= least).select("word").collect()]


def build_lexicon(docs: DataFrame, tokenizer_path: str, words: int = LEXICON) -> str:
    """Compiles the most frequent words and ships the file to all executors;
    returns its name there."""
    bpe = WordBpe(tokenizer_path)
    flat = compile_lexicon((w.encode("utf-8"), tuple(bpe.merged(w))) for w in frequent_words(docs, tokenizer_path, words))
    name = f"lexicon-{uuid.uuid4().hex}"
    file = os.path.join(tempfile.mkdtemp(prefix="lexicon-"), name)
    flat.tofile(file)
    docs.sparkSession.sparkContext.addFile(file)  # executors fetch it, also those that start later
    return name


def encode(docs: DataFrame, tokenizer_path: str, lexicon: str) -> DataFrame:
    """``(doc_id, ids)`` for each row of ``docs(doc_id, text)``: the ids as
    little-endian unsigned 32-bit numbers."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _kept(f"encoder:{tokenizer_path}:{lexicon}", lambda: Encoder(
            tokenizer_path, np.memmap(SparkFiles.get(lexicon), np.int32, "r")))
        for batch in batches:
            at = 0
            for texts in _text_blocks(batch.column(1)):
                words: list[str] = []
                through = [0]
                for t in texts.to_pylist():
                    words += encoder.bpe.words(t or "")
                    through.append(len(words))
                n, ids = encoder.ids(words)
                ends = np.concatenate([[0], np.cumsum(n)])[through] * 4
                raw = pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(ids.astype("<u4"))])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), raw.cast(pa.binary())], ["doc_id", "ids"])
                at += len(texts)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """``(doc_id, ids, text)`` for each row of ``encoded(doc_id, ids)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _kept(f"tokens:{tokenizer_path}", lambda: token_table(tokenizer_path))
        for batch in batches:
            for lo, hi in blocks(buffers(batch.column(1))[1], BLOCK):
                part = batch.slice(lo, hi - lo)
                data, offsets = buffers(part.column(1))
                tokens = table.take(pa.array(np.ascontiguousarray(data).view("<u4")))
                if tokens.null_count:
                    raise ValueError("an id that the tokenizer doesn't have")
                rows = pa.LargeListArray.from_arrays(pa.array(offsets // 4), tokens)
                yield pa.RecordBatch.from_arrays([*part.columns, pc.binary_join(rows, " ").cast(pa.string())], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")


def op13_lexicon_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = documents(spark, sf_dir), default_tokenizer()
    both = decode(encode(docs, path, build_lexicon(docs, path)), path)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("text", 256).alias("decoded_sha256"))
