"""Fill-in-middle transformation by repeated-capture matching.

A text is a row of units, matched from left to right: code points, or any
pattern of the regex library. One match of ``(unit)*`` over the whole text keeps
every repetition of its group: ``match.ends(1)`` lists where each unit ends, so
its length is the number of units ``n`` and a cut after ``u`` units is its entry
``u - 1``. Nothing is iterated per unit. As the list takes some 50 bytes a unit,
a text of over ``WINDOW`` units is matched in windows of that many; the window
that holds a cut is matched once more, so memory doesn't grow with the text.

Cuts, form and order of the parts come from the sha256 of the row's id alone:
reruns and retries give the same rows. Outputs carry the markers ``<P>``,
``<S>`` and ``<M>``; a text that holds one of them stays plain, so that
:func:`restore` rebuilds every text from its output and form.

Defined results. Null text counts as empty; an empty text is plain, with 0
units. A null id is hashed as an empty one. Every input row gives one result
row, repeated rows too; an empty table gives none; extra columns are ignored.
A text that the unit's pattern doesn't cover from end to end raises an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.common import bounded_batches, documents

CODE_POINT = r"(?s:.)"
WINDOW = 1 << 17
MARKERS = ("<P>", "<S>", "<M>")
#: Percent of the rows that stay plain, and of the others that put the suffix first.
PLAIN_PERCENT, SUFFIX_FIRST_PERCENT = 10, 20
COLUMNS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class Units:
    """Units of texts by the captures of one repeated group."""

    def __init__(self, unit: str = CODE_POINT, window: int = WINDOW):
        import regex

        self.repeated = regex.compile(f"({unit}){{0,{window}}}+")

    def windows(self, text: str) -> Iterator[tuple[int, list[int]]]:
        """Where each window begins and its units end; a single one for all but
        the longest texts."""
        at = 0
        while at < len(text):
            ends = self.repeated.match(text, at).ends(1)
            if not ends or ends[-1] <= at:
                raise ValueError(f"no unit matches at code point {at}")
            yield at, ends
            at = ends[-1]

    def cuts(self, text: str, pick) -> tuple[int, list[int]]:
        """``n`` and the offsets after as many units as ``pick(n)`` lists."""
        n, begins, last = 0, [], []
        for at, last in self.windows(text):
            begins.append((n, at))
            n += len(last)
        offsets = []
        for units in pick(n):
            if units == 0:
                offsets.append(0)
                continue
            before, at = next(b for b in reversed(begins) if b[0] < units)
            ends = last if (before, at) == begins[-1] else self.repeated.match(text, at).ends(1)
            offsets.append(ends[units - 1 - before])
        return n, offsets


def draws(doc_id: int | None) -> list[int]:
    """Four numbers from the sha256 of the id."""
    import hashlib

    digest = hashlib.sha256(b"1:" + (b"" if doc_id is None else b"%d" % doc_id)).digest()
    return [int.from_bytes(digest[k:k + 4], "big") for k in (0, 4, 8, 12)]


def rearranged(doc_id: int | None, text: str, units: Units) -> tuple:
    """``(n, form, prefix_chars, middle_chars, output)`` of one text."""
    h1, h2, h3, h4 = draws(doc_id)
    n, (first, second) = units.cuts(text, lambda n: sorted((h1 % (n + 1), h2 % (n + 1))))
    if not text or h3 % 100 >= 100 - PLAIN_PERCENT or any(m in text for m in MARKERS):
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    p, s, m = MARKERS
    if h4 % 100 < SUFFIX_FIRST_PERCENT:
        return n, "spm", first, second - first, f"{s}{suffix}{p}{prefix}{m}{middle}"
    return n, "psm", first, second - first, f"{p}{prefix}{s}{suffix}{m}{middle}"


def fill_in_middle(docs: DataFrame, unit: str = CODE_POINT, window: int = WINDOW) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)`` for each row of
    ``docs(doc_id, text)``; the chars are code points, whatever the unit."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units(unit, window)
        for batch in batches:
            rows = [rearranged(i, t.as_py() or "", units) for i, t in zip(batch.column(0).to_pylist(), batch.column(1))]
            n, form, prefix, middle, output = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(output, pa.string())],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, COLUMNS)


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made from. No part holds a marker, so each
    marker stands once in an output that isn't plain."""
    p, s, m = MARKERS
    part = lambda mark, k: F.split_part(output, F.lit(mark), F.lit(k))
    middle = part(m, 2)
    psm = F.concat(F.split_part(part(s, 1), F.lit(p), F.lit(2)), middle, F.split_part(part(s, 2), F.lit(m), F.lit(1)))
    spm = F.concat(F.split_part(part(p, 2), F.lit(m), F.lit(1)), middle, F.split_part(part(p, 1), F.lit(s), F.lit(2)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(documents(spark, sf_dir))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


OP11_SQL = """
WITH hashed AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), drawn AS (
    SELECT doc_id, t, length(t)::BIGINT AS n,
           ('0x' || substr(h, 1, 8))::BIGINT % (length(t) + 1) AS u1, ('0x' || substr(h, 9, 8))::BIGINT % (length(t) + 1) AS u2,
           ('0x' || substr(h, 17, 8))::BIGINT % 100 AS h3, ('0x' || substr(h, 25, 8))::BIGINT % 100 AS h4
    FROM hashed
), formed AS (
    SELECT doc_id, t, n, least(u1, u2) AS a, greatest(u1, u2) AS b,
           CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain'
                WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), cut AS (
    SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM formed
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM cut
"""
