"""Main text of HTML pages by wrappers inferred from pages of the same host.

A page is a stream of tags and texts, read into a tree that forgives missing
end tags. A wrapper is a union-free regular expression over such streams: a
tree whose parts are required, optional (?) or repeated (+), and whose texts
are constant or slots. It starts as the first page's stream and is aligned
with one page after the other:

* parts in a row with one symbol, and blocks of up to ``PERIOD`` parts that
  recur in a row, become a repeated part, their insides aligned with each other;
* a part that only one side has becomes optional;
* texts that differ become a slot.

Alignment is symmetric, so every task builds a wrapper of each host's pages it
has, and these are aligned with each other in two levels: a host with a third
of all pages is dealt over many tasks and no page is gathered. The wrapper then
names the host's main parts: its article or main elements, or else the part
whose own slots and paragraphs hold the most text that isn't links; texts that
the host's pages share weigh nothing beside slots. Each page's text is read from
its parts at these places, without menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles and reader comments in them, and outside article
and main elements without the constants that all pages of the host have there.

Defined results. Null and empty html give an empty text. Pages with no url
count as one host. Where no text differs between a host's pages (one page, or
copies of one), all texts weigh and none is dropped. A page that has none of its host's main parts is read by
the wrapper of its own stream. Elements nested deeper than ``DEEPEST`` count
as text of the one that holds them. Every input row gives one result row;
extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.common import bounded_batches, cut
from quillspark.sources.tables import read_table

DEEPEST = 100
PERIOD = 4
CONSTANT = 80           # a longer constant stands in its wrapper as a digest
SALTS = 64

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)>""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# Elements by kind, as HTML has them.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
# An element of these ends an open one of the same set.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
NOT_IN_P = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul figure".split())
MAIN = {"article", "main"}
# What isn't the main text: by element, role, and words of class or id.
ASIDE = {"nav", "footer", "aside", "form", "head", "button", "select", "dialog", "menu", "svg", "object", "canvas", "audio", "video", "fieldset"}
ASIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog", "form", "menu", "menubar"}
ASIDE_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent notice alert popup modal overlay "
    "newsletter subscribe subscription signup sidebar nav navbar navigation menu breadcrumb breadcrumbs masthead footer comment comments "
    "disqus respond share sharing social related recommended widget login search toolbar pagination pager".split())


class Part:
    """An element or text of a page, or a part of a wrapper."""

    __slots__ = ("symbol", "tag", "aside", "inside", "text", "linked", "optional", "repeated", "chars", "pages")

    def __init__(self, symbol, tag, aside=False, text=None, linked=False):
        self.symbol, self.tag, self.aside, self.text, self.linked = symbol, tag, aside, text, linked
        self.inside: list[Part] = []
        self.optional = self.repeated = False
        self.chars, self.pages = 0, 1


def is_aside(tag: str, attributes: dict[str, str]) -> bool:
    if tag in ASIDE or attributes.get("role", "").lower() in ASIDE_ROLES:
        return True
    named = f"{attributes.get('class', '')} {attributes.get('id', '')}"
    return bool(named.strip()) and not ASIDE_WORDS.isdisjoint(w.lower() for w in WORDS.findall(named))


def parse(page: str) -> Part:
    """The tree of a page. Its ``html`` and ``body`` are left out, so that pages
    with and without them agree."""
    root = Part("", "")
    stack, links, at = [root], 0, 0
    while at < len(page):
        token = TOKEN.search(page, at)
        text = page[at:token.start()] if token else page[at:]
        if text:
            if text.strip() or stack[-1].inside:
                stack[-1].inside.append(Part("#", "#", text=entities.unescape(text), linked=links > 0))
        if not token:
            break
        at = token.end()
        closing, tag, rest = token.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if tag in ("html", "body"):
            continue
        if closing:
            if tag == "a":
                links = max(0, links - 1)
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if tag in INLINE and stack[k].tag not in INLINE:
                    break
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        attributes = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(rest)} if "=" in rest else {}
        if tag in VOID:
            if tag in ("br", "hr"):
                stack[-1].inside.append(Part("br", "br"))
            continue
        aside = is_aside(tag, attributes)
        if tag in INLINE and not aside:
            links += tag == "a"
            continue
        if tag in NOT_IN_P or tag in CLOSES:
            ends = CLOSES.get(tag, {"p"})
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ends:
                    del stack[k:]
                    break
                if stack[k].tag not in INLINE and not (ends == CLOSES["tr"] and stack[k].tag in ("td", "th")):
                    break
        if len(stack) > DEEPEST:
            stack[-1].inside.append(Part("br", "br"))
            continue
        named = " ".join(sorted(f"{attributes.get('class', '')} {attributes.get('id', '')}".split()))
        if tag == "header" and not aside:  # a page's, not an article's
            aside = not any(p.tag in MAIN for p in stack)
        part = Part(f"{tag}.{re.sub('[0-9]+', '', named)}" if named else tag, tag, aside)
        stack[-1].inside.append(part)
        if not rest.rstrip().endswith("/"):
            stack.append(part)
            if tag not in INLINE:
                links = 0
    return root


# ------------------------------------------------------------------ wrappers

def constant(block: str) -> str:
    """A block of text as a wrapper holds it, of bounded length."""
    return block if len(block) <= CONSTANT else "sha256:" + hashlib.sha256(block.encode("utf-8", "surrogatepass")).hexdigest()


def wrapper_of(part: Part) -> Part:
    """The wrapper of one stream: repeats folded, texts in a row as one constant
    with a line for each block."""
    out = Part(part.symbol, part.tag, part.aside)
    inside: list[Part] = []
    for is_text, run in groupby(part.inside, key=lambda p: p.tag in ("#", "br")):
        if not is_text:
            inside.extend(map(wrapper_of, run))
            continue
        text = Part("#", "#")
        lines = [""]
        for p in run:
            if p.tag == "br":
                lines.append("")
            else:
                lines[-1] += p.text
                text.chars += 0 if p.linked else len(p.text.strip())
        text.text = "\n".join(constant(b) for b in (" ".join(x.split()) for x in lines) if b)
        if text.text:
            inside.append(text)
    out.inside = fold(inside)
    return out


def joined(a: Part, b: Part) -> Part:
    """Two parts of one symbol aligned, as one."""
    if a.tag == "#":
        a.text = a.text if a.text == b.text else None
    else:
        a.inside = align(a.inside, b.inside)
    a.optional |= b.optional
    a.repeated |= b.repeated
    a.chars += b.chars
    a.pages += b.pages
    return a


def fold(parts: list[Part]) -> list[Part]:
    """Repeats in a row as one repeated part, single parts first, then blocks."""
    out: list[Part] = []
    for p in parts:
        if out and out[-1].symbol == p.symbol:
            out[-1] = joined(out[-1], p)
            out[-1].repeated = True
        else:
            out.append(p)
    for period in range(2, PERIOD + 1):
        at = 0
        while at + 2 * period <= len(out):
            block = [p.symbol for p in out[at:at + period]]
            if block == [p.symbol for p in out[at + period:at + 2 * period]]:
                group = _group(out[at:at + period])
                to = at + period
                while [p.symbol for p in out[to:to + period]] == block:
                    group = joined(group, _group(out[to:to + period]))
                    to += period
                group.repeated = True
                out[at:to] = [group]
            at += 1
    return out


def _group(parts: list[Part]) -> Part:
    group = Part("(" + " ".join(p.symbol for p in parts) + ")", "()")
    group.inside = list(parts)
    return group


def _grouped(parts: list[Part], groups: list[Part]) -> list[Part]:
    """Blocks that the other side has as groups, as groups here too."""
    for g in groups:
        if any(p.symbol == g.symbol for p in parts):
            continue
        block, at = [p.symbol for p in g.inside], 0
        while at + len(block) <= len(parts):
            if [p.symbol for p in parts[at:at + len(block)]] == block:
                parts = [*parts[:at], _group(parts[at:at + len(block)]), *parts[at + len(block):]]
            at += 1
    return parts


def align(a: list[Part], b: list[Part]) -> list[Part]:
    """Two streams as one: the longest common sequence of symbols matches, the
    rest becomes optional."""
    if [p.symbol for p in a] == [p.symbol for p in b]:
        return [joined(x, y) for x, y in zip(a, b)]
    a, b = _grouped(a, [p for p in b if p.tag == "()"]), _grouped(b, [p for p in a if p.tag == "()"])
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i].symbol == b[j].symbol else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and a[i].symbol == b[j].symbol:
            out.append(joined(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            a[i].optional = True
            out.append(a[i])
            i += 1
        else:
            b[j].optional = True
            out.append(b[j])
            j += 1
    return fold(out)


def dump(p: Part) -> list:
    return [p.symbol, p.tag, int(p.aside) + 2 * p.optional + 4 * p.repeated, p.text, p.chars, p.pages, [dump(x) for x in p.inside]]


def load(x: list) -> Part:
    p = Part(x[0], x[1], bool(x[2] & 1), x[3])
    p.optional, p.repeated, p.chars, p.pages = bool(x[2] & 2), bool(x[2] & 4), x[4], x[5]
    p.inside = [load(y) for y in x[6]]
    return p


def expression(p: Part) -> str:
    """A wrapper as text: constants quoted, slots as #."""
    marks = "+" * p.repeated + "?" * p.optional
    if p.tag == "#":
        return (f'"{p.text}"' if p.text is not None else "#") + marks
    inside = " ".join(expression(x) for x in p.inside)
    return (f"({inside})" if p.tag == "()" else f"<{p.symbol}>{{{inside}}}" if p.symbol else inside) + marks


def main_places(wrapper: Part) -> tuple[list[str], list[str]]:
    """Places (symbols from the top) of a wrapper's main parts, and the
    constants, with their places, that are no text of a page's own there."""
    marked: list[str] = []
    constants: set[str] = set()
    weight: dict[str, tuple[int, int]] = {}
    one_page = wrapper.pages == 1

    def walk(p: Part, place: str, under: str | None, required: bool) -> tuple[int, int]:
        """Characters that count for the part itself: of slots, of all texts."""
        if p.aside:
            return 0, 0
        slots = texts = 0
        for x in p.inside:
            always = required and not x.optional
            if x.tag == "#":
                texts += x.chars
                if x.text is None or one_page or x.pages == 1:
                    slots += x.chars
                elif always:
                    constants.update(f"{place}\t{block}" for block in x.text.split("\n"))
                continue
            if x.tag == "()":
                inner = walk(x, place, under, always)
                slots, texts = slots + inner[0], texts + inner[1]
                continue
            where = f"{place}/{x.symbol}"
            if x.tag in MAIN and not x.aside and under is None:
                marked.append(where)
            inner = walk(x, where, under if under is not None or x.tag not in MAIN else where, always)
            if x.tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "pre", "blockquote", "table", "tbody", "tr", "td", "th", "dl", "dt", "dd"):
                slots, texts = slots + inner[0], texts + inner[1]
        if p.tag != "()":
            before = weight.get(place, (0, 0))
            weight[place] = before[0] + slots, before[1] + texts
        return slots, texts

    walk(wrapper, "", None, True)
    if marked:
        return sorted(set(marked)), []
    best = max(weight, key=lambda k: (weight[k], -k.count("/"), k), default="")
    if not any(weight.get(best, (0, 0))):
        return [], []
    return [best], sorted(constants) if weight[best][0] else []


def read(root: Part, places: set[str], constants: set[str] = frozenset()) -> str | None:
    """The text of a page's parts at the places but for the constants; None if
    it has none of them."""
    blocks: list[str] = []
    line: list[str] = []
    found, at = "" in places, ""

    def end() -> None:
        text = " ".join("".join(line).split())
        if text and f"{at}\t{constant(text)}" not in constants:
            blocks.append(text)
        line.clear()

    def walk(p: Part, place: str, inside: bool) -> None:
        nonlocal found, at
        for x in p.inside:
            if x.tag == "#":
                if inside:
                    at = place
                    line.append(x.text)
            elif x.tag == "br":
                end()
            elif not x.aside:
                where = f"{place}/{x.symbol}"
                here = inside or where in places
                found |= here
                if x.tag not in INLINE:
                    end()
                walk(x, where, here)
                if x.tag not in INLINE:
                    end()

    walk(root, "", found)
    end()
    return "\n".join(blocks) if found else None


def page_text(page: str | None, places: set[str] | None, constants: set[str] = frozenset()) -> str:
    root = parse(page or "")
    text = read(root, places, constants) if places else None
    return read(root, set(main_places(wrapper_of(root))[0])) or "" if text is None else text


# --------------------------------------------------------------------- Spark

def host(url: str = "url") -> F.Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def wrappers(pages: DataFrame) -> DataFrame:
    """``(host, wrapper)``, JSON, of ``pages(host, html)``."""
    bounded_batches(pages.sparkSession)
    kind = "host string, salt int, wrapper string"

    def infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Part] = {}
        for batch in batches:
            for name, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                new = wrapper_of(parse(page.as_py() or ""))
                found[name] = joined(found[name], new) if name in found else new
            if len(found) > 10_000:  # hand on what there is; it is aligned with the rest later
                yield rows(found)
                found = {}
        yield rows(found)

    def rows(found: dict[str, Part]) -> pa.RecordBatch:
        text = [json.dumps(dump(p), ensure_ascii=False) for p in found.values()]
        salt = [sum(map(ord, t)) % SALTS for t in text]
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(salt, pa.int32()), pa.array(text, pa.string())], ["host", "salt", "wrapper"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in order of their key: those of one key are next to each other."""
        key, held = None, None
        for batch in batches:
            done: list[tuple[str, str]] = []
            for name, salt, text in zip(*(c.to_pylist() for c in batch.columns)):
                if key == (name, salt):
                    held = joined(held, load(json.loads(text)))
                    continue
                if key is not None:
                    done.append((key[0], json.dumps(dump(held), ensure_ascii=False)))
                key, held = (name, salt), load(json.loads(text))
            yield of(done)
        if key is not None:
            yield of([(key[0], json.dumps(dump(held), ensure_ascii=False))])

    def of(done: list[tuple[str, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([0] * len(done), pa.int32()), pa.array([d[1] for d in done], pa.string())], ["host", "salt", "wrapper"])

    out = pages.select("host", "html").mapInArrow(infer, kind)
    for _ in range(2):
        out = out.repartition("host", "salt").sortWithinPartitions("host", "salt", "wrapper").mapInArrow(merge, kind)
    return out.select("host", "wrapper")


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text)`` of ``pages(page_id, url, html)``."""
    hosted = pages.select("page_id", "url", "html", host().alias("host"))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_places(load(json.loads(t))) for t in batch.column(1).to_pylist()]
            lists = [pa.array([f[k] for f in found], pa.list_(pa.string())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], ["_host", "places", "constants"])

    places = cut(wrappers(hosted).mapInArrow(name, "_host string, places array<string>, constants array<string>"))
    both = hosted.join(places, F.col("host") == F.col("_host"), "left").select("page_id", "url", "html", "places", "constants")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [page_text(page.as_py(), set(p.as_py() or ()), set(c.as_py() or ())) for page, p, c in zip(batch.column(2), batch.column(3), batch.column(4))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string())], ["page_id", "url", "text"])

    kind = dict(pages.dtypes)["page_id"]
    return both.mapInArrow(run, f"page_id {kind}, url string, text string")


def op2_wrapper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = extract(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return text.withColumn("n_chars", F.length("text").cast("long"))


#: The same rows in SQL, for tables whose pages have one article of headings,
#: paragraphs and bold parts, as the given ones have.
OP2_SQL = r"""
WITH a AS (
  SELECT page_id, url, string_split_regex(regexp_replace(
    regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1), '</?b>', '', 'g'), '</?(?:h1|p|br)>') AS blocks
  FROM pages),
t AS (
  SELECT page_id, url, array_to_string(list_filter(list_transform(blocks, lambda x: trim(regexp_replace(
    replace(replace(replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '&amp', '&'),
    '\s+', ' ', 'g'))), lambda x: x <> ''), chr(10)) AS text
  FROM a)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM t"""
