"""HTML extraction (5): nearest-URL page differencing.

Pages of a host are put in the order of their URL paths; each is compared with its
nearest neighbours in that order (NEAR on either side). A page is a sequence of
text lines in blocks; a block's key is its place, the elements around it down to
the last that only groups others, and the kinds of text elements inside it. The
keys of two pages are aligned by their longest common subsequence. What the pages
of a site repeat is its template, and it is deleted: the words of menus, adverts
and footers differ from page to page, but their places and sizes do not, while
the place of the article holds a few words on one page and thousands on the next.
So a block is template if most neighbours have its place and its size there
varies little beside the place that varies most (SHARE of it); where no size
varies, the words decide that no neighbour has. In blocks that are left, lines
that most neighbours have too (longest common subsequence of lines) go as well.

Tags check the result. They veto a block that the neighbours would keep if it is
furniture by its element, role or name, or if the page marks its article and the
block is outside; and one they would delete if it is in the marked article, unless
most neighbours repeat its words, or a name calls it furniture. ``n_vetoed`` counts
the lines where they did. A page alone on its host has tags only.

At scale: one shuffle of the pages by ranges of (host, path) of about equal bytes,
which split a host with any share of all pages over many tasks, then a stream
through each task that holds 2 x NEAR + 1 pages.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from datescore.llm.common import arrow_schema, column, parallelism, slices, texts_of, to_python

_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot"
    " th thead title tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SILENT = frozenset("head title script style noscript template svg math iframe object select textarea button audio video canvas".split())
_FURNITURE = frozenset("nav footer aside form menu dialog".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar".split())
_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|sponsor(?:ed)?|promo|banner|sidebar|side-bar|menu|nav|navbar|navigation|breadcrumbs?"
    r"|header|masthead|footer|cookies?|consent|gdpr|notice|popup|modal|overlay|newsletter|subscribe|signup|login|share|sharing"
    r"|social|related|recommended|comments?|disqus|replies)(?:$|[\s_-])",
    re.I,
)
_ARTICLE = frozenset(("article", "main"))
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_SPACE = re.compile(r"\s+")
# A start tag closes these open elements, up to the nearest block that may hold them.
_CLOSES = {
    "p": ("p",),
    "li": ("li", "p"),
    "dt": ("dt", "dd", "p"),
    "dd": ("dt", "dd", "p"),
    "tr": ("tr", "td", "th", "p"),
    "td": ("td", "th", "p"),
    "th": ("td", "th", "p"),
    "option": ("option",),
}
_CONTAINERS = frozenset("article aside body div dl fieldset footer form header main nav ol section table tbody tfoot thead ul td th li dd blockquote".split())


# Elements that are text or hold pieces of one text; all other blocks group.
_TEXT = frozenset(
    "p h1 h2 h3 h4 h5 h6 hgroup ul ol li dl dt dd blockquote pre table thead tbody tfoot tr td th caption figure figcaption address center".split()
)
NEAR = 4  # neighbours on either side
SHARE = 0.3  # of the largest variation: what varies less is template


class Line(NamedTuple):
    text: str
    block: int  # the grouping element around it, by number
    place: str  # the elements down to that one
    kind: str  # the text elements inside it
    furniture: bool
    article: bool
    named: bool  # inside the article, in a block that only a class or id calls furniture


class _Lines(HTMLParser):
    """The text lines of a page in order; unclosed and stray tags are tolerated."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        # tag, place, silent, furniture, article, named; the numbers of the open elements beside them
        self.open: list[tuple[str, str, bool, bool, bool, bool]] = []
        self.number: list[int] = []
        self.elements = 0
        self.text: list[str] = []

    def _state(self) -> tuple[bool, bool, bool, bool]:
        return self.open[-1][2:] if self.open else (False, False, False, False)

    def flush(self) -> None:
        if self.text:
            text = _SPACE.sub(" ", "".join(self.text)).strip()
            self.text = []
            if text:
                _, furniture, article, named = self._state()
                group = max((k for k, (tag, place, *_) in enumerate(self.open) if place and tag not in _TEXT), default=-1)
                place = "/".join(p for _, p, *_ in self.open[: group + 1] if p)
                kind = "/".join(tag for tag, p, *_ in self.open[group + 1 :] if p)
                self.lines.append(Line(text, self.number[group] if group >= 0 else 0, place, kind, furniture, article, named))

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _BLOCKS:
            self.flush()
        if tag == "br":
            self.text.append(" ")
        if tag in _CLOSES:
            self._close_implied(_CLOSES[tag])
        elif tag in _BLOCKS and tag != "html":
            self._close_implied(("p",))
        if tag in _VOID:
            return
        silent, furniture, article, named = self._state()
        if tag in _ARTICLE and not furniture:
            article = True
        names = {k: (v or "") for k, v in attrs}
        if tag in _SILENT or "hidden" in names or names.get("aria-hidden") == "true" or "display:none" in names.get("style", "").replace(" ", ""):
            silent = True
        marked = _NAMES.search(names.get("class", "")) or _NAMES.search(names.get("id", ""))
        marked = marked and tag not in ("html", "body", "article", "main")
        if marked and article:
            # A name alone is not sure there: its place must be the neighbour's too. A heading's id names its section.
            named = named or tag not in _HEADINGS
            marked = False
        if tag in _FURNITURE or (tag == "header" and not article) or marked or names.get("role", "").lower() in _ROLES:
            furniture = True
        place = tag + "." + names.get("class", "") if tag in _BLOCKS else ""
        self.open.append((tag, place, silent, furniture, article, named))
        self.elements += 1
        self.number[len(self.open) - 1 :] = [self.elements]

    def _close_implied(self, tags: tuple[str, ...]) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            tag = self.open[k][0]
            if tag in tags:
                self.flush()
                del self.open[k:]
                return
            if tag in _CONTAINERS:
                return

    def handle_endtag(self, tag: str) -> None:
        if tag in _BLOCKS:
            self.flush()
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                return
            # An inline end tag does not close blocks around it; a block's may.
            if tag not in _BLOCKS and self.open[k][0] in _BLOCKS:
                return

    def handle_data(self, data: str) -> None:
        if not self._state()[0]:
            self.text.append(data)


def page_lines(html: str) -> list[Line]:
    """Non-empty text lines of a page, white space collapsed, character references decoded."""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser.lines


# --- differencing -------------------------------------------------------------------------


def common(a: list[str], b: list[str]) -> dict[int, int]:
    """Positions of ``a`` on a longest common subsequence with ``b``, and theirs in ``b``.

    Bit-parallel: a row of the table is one integer with a bit for each line
    of ``a``, so long pages cost lines x lines / 64.
    """
    at: dict[str, int] = {}
    for k, key in enumerate(a):
        at[key] = at.get(key, 0) | 1 << k
    full = (1 << len(a)) - 1
    row, rows = full, []
    for key in b:
        hits = row & at.get(key, 0)
        row = ((row + hits) | (row - hits)) & full
        rows.append(row)
    out, i, j = {}, len(a), len(b)
    while i and j:
        if rows[j - 1] >> (i - 1) & 1:
            i -= 1
        else:
            j -= 1
            if not j or rows[j - 1] >> (i - 1) & 1:
                i -= 1
                out[i] = j
    return out


class Block(NamedTuple):
    """Lines that follow each other in one grouping element."""

    key: str
    lines: list[Line]
    words: list[str]


def page_blocks(lines: list[Line]) -> list[Block]:
    out = []
    for _, group in itertools.groupby(lines, key=lambda line: line.block):
        own = list(group)
        kinds = ",".join(dict.fromkeys(line.kind for line in own))
        out.append(Block(f"{own[0].place}[{kinds}]", own, [w for line in own for w in line.text.split()]))
    return out


class Verdict(NamedTuple):
    """What the neighbours say of a block."""

    template: bool
    placed: bool  # most neighbours have its place
    repeated: bool  # most neighbours have its words there
    lines: frozenset[int]  # of its lines, those that most neighbours have


def compare(page: list[Block], near: list[list[Block]]) -> list[Verdict]:
    """The verdict on every block of a page with at least one neighbour."""
    most = len(near) / 2
    keys = [b.key for b in page]
    theirs: list[list[Block]] = [[] for _ in page]
    for other in near:
        for i, j in common(keys, [b.key for b in other]).items():
            theirs[i].append(other[j])
    placed = [len(t) >= most for t in theirs]

    def spread(block: Block, others: list[Block], known: bool) -> int:
        if not known:
            return len(block.words)
        sizes = [len(block.words), *(len(o.words) for o in others)]
        return max(sizes) - min(sizes)

    def news(block: Block, others: list[Block], known: bool) -> int:
        """Words of the block that its nearest counterpart lacks."""
        counts = [sum((Counter(block.words) - Counter(o.words)).values()) for o in others]
        return min(counts) if known and counts else len(block.words)

    varies = [spread(b, t, k) for b, t, k in zip(page, theirs, placed)]
    if not any(varies):
        varies = [news(b, t, k) for b, t, k in zip(page, theirs, placed)]
    top = max(varies, default=0)
    out = []
    for block, others, known, v in zip(page, theirs, placed, varies):
        template = known and v <= SHARE * top
        times: Counter = Counter()
        texts = [line.text for line in block.lines]
        for o in others if not template else ():
            if not {line.text for line in o.lines}.isdisjoint(texts):
                times.update(common(texts, [line.text for line in o.lines]).keys())
        repeated = known and sum(o.words == block.words for o in others) >= most
        out.append(Verdict(template, known, repeated, frozenset(k for k, n in times.items() if n >= most)))
    return out


class Text(NamedTuple):
    text: str
    deleted: int  # lines that the neighbours call template
    vetoed: int  # lines on which the tags' check decided otherwise


def extract(blocks: list[Block], near: list[list[Block]]) -> Text:
    """Main text of a page: its lines without the template, joined by one space."""
    own = [line.article and not line.furniture for b in blocks for line in b.lines]
    marked = any(own)
    largest = max((len(b.words) for b in blocks if any(x.article and not x.furniture for x in b.lines)), default=0)
    verdicts = compare(blocks, near) if near else [Verdict(False, False, False, frozenset())] * len(blocks)

    def kept(differ: bool) -> tuple[list[str], int, int]:
        out, deleted, vetoed = [], 0, 0
        for block, v in zip(blocks, verdicts):
            for k, line in enumerate(block.lines):
                theirs = differ and (v.template or k in v.lines)
                inside = line.article and not line.furniture
                if line.furniture or marked and not inside:
                    keep = False
                elif inside and line.named:
                    keep = not (differ and v.placed)
                elif inside:
                    # A neighbour's copy of the article does not make it template; a repeated notice in it is.
                    keep = not (differ and v.repeated and len(near) >= 3 and len(block.words) < largest)
                else:
                    keep = not theirs
                deleted += theirs
                vetoed += differ and keep == theirs
                if keep:
                    out.append(line.text)
        return out, deleted, vetoed

    lines, deleted, vetoed = kept(bool(near))
    if not lines:  # every line is a neighbour's: a copy, not template
        lines = kept(False)[0]
    return Text(" ".join(lines), deleted, vetoed)


def main_text(lines: list[Line], *neighbours: list[Line] | None) -> str:
    return extract(page_blocks(lines), [page_blocks(n) for n in neighbours if n]).text


RESULT = "page_id bigint, url string, text string, n_chars bigint, n_template bigint, n_vetoed bigint"


class _Page(NamedTuple):
    page_id: int | None
    url: str | None
    host: str
    guest: bool
    blocks: list[Block]


def _difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages of one range in URL order; each result waits for NEAR pages after it."""
    schema = arrow_schema(RESULT)
    held: deque[_Page] = deque()
    done = 0  # pages of ``held`` that have their result

    def result(k: int) -> tuple | None:
        page = held[k]
        if page.guest:
            return None
        near = [held[j].blocks for j in range(max(0, k - NEAR), min(len(held), k + NEAR + 1)) if j != k and held[j].host == page.host]
        found = extract(page.blocks, near)
        return page.page_id, page.url, found.text, len(found.text), found.deleted, found.vetoed

    def out(rows: list) -> Iterator[pa.RecordBatch]:
        rows = [r for r in rows if r is not None]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), schema)], schema=schema)

    for batch in slices(batches, "html"):
        rows = []
        values = [column(batch, c).to_pylist() for c in ("page_id", "url", "host", "guest")]
        for page_id, url, host, guest, html in zip(*values, texts_of(batch, "html")):
            held.append(_Page(page_id, url, host, guest, page_blocks(page_lines(html))))
            if len(held) - done > NEAR:
                rows.append(result(done))
                done += 1
            if done > NEAR:
                held.popleft()
                done -= 1
        yield from out(rows)
    yield from out([result(k) for k in range(done, len(held))])


CUT_SAMPLE = 64  # pages looked at for each range


def range_of(cuts: list[str]) -> Column:
    """Range number of the sort key ``k``: how many split points are at or before it."""
    if not cuts:
        return F.lit(0)
    # Two levels, so that a key is compared with about twice the root of their number.
    step = math.isqrt(len(cuts)) + 1
    groups = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    heads = F.array(*[F.lit(g[0]) for g in groups])
    table = F.array(*[F.array(*[F.lit(c) for c in g]) for g in groups])
    group = F.size(F.filter(heads, lambda c: c <= F.col("k")))
    inside = F.size(F.filter(F.get(table, group - 1), lambda c: c <= F.col("k")))
    return F.when(group == 0, F.lit(0)).otherwise((group - 1) * step + inside)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task's keys, the NEAR least and greatest of each range."""
    least: dict[int, list[str]] = {}
    greatest: dict[int, list[str]] = {}
    for batch in batches:
        keys: dict[int, set[str]] = {}
        for part, k in zip(column(batch, "part").to_pylist(), column(batch, "k").to_pylist()):
            keys.setdefault(part, set()).add(k)
        for part, some in keys.items():
            least[part] = sorted(some.union(least.get(part, ())))[:NEAR]
            greatest[part] = sorted(some.union(greatest.get(part, ())))[-NEAR:]
    rows = [(part, k) for part in least for k in sorted({*least[part], *greatest[part]})]
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string())], names=["part", "k"])


def split_points(rows: DataFrame, ranges: int) -> list[str]:
    """Keys that cut ``rows`` into ranges of about equal bytes, from the pages with the least hashes of their keys."""
    some = rows.select("k", "bytes").orderBy(F.xxhash64("k"), "k").limit(CUT_SAMPLE * ranges).collect()
    some = sorted((r.k, r.bytes) for r in some)
    total = sum(b for _, b in some)
    cuts, held = [], 0
    for k, size in some:
        if held * ranges >= (len(cuts) + 1) * total:
            cuts.append(k)
        held += size
    return sorted(set(cuts))


def _in_url_order(rows: DataFrame) -> DataFrame:
    """``rows`` (with the sort key ``k`` and ``bytes``) dealt by ranges of ``k``, a partition each, with ``guest``.

    The NEAR pages before and after a range also come to it, as guests, so every
    page meets all its neighbours and the result does not depend on the ranges.
    Only split points and the ends of the ranges reach the driver.
    """
    spark = rows.sparkSession
    cuts = split_points(rows, parallelism(spark))
    keyed = rows.select("k").withColumn("part", range_of(cuts))
    # Of all tasks' ends, the outermost.
    all_ends = F.array_sort(F.collect_set("k"))
    ends = keyed.mapInArrow(_ends, "part int, k string").groupBy("part").agg(all_ends.alias("ks"))
    ends = sorted(ends.select("part", F.slice("ks", 1, NEAR), F.reverse(F.slice(F.reverse("ks"), 1, NEAR))).collect())
    guests: list[tuple[str, int]] = []
    for n, (part, _, _) in enumerate(ends):  # a range with few pages looks further than the next
        before = [k for _, _, last in ends[max(0, n - NEAR) : n] for k in last][-NEAR:]
        after = [k for _, first, _ in ends[n + 1 : n + 1 + NEAR] for k in first][:NEAR]
        guests += [(k, part) for k in (*before, *after)]
    # At most 2 x NEAR rows a range: a bounded broadcast.
    table = spark.createDataFrame(guests, "end string, to int").groupBy("end").agg(F.collect_list("to").alias("to"))
    sent = rows.withColumn("own", range_of(cuts)).join(F.broadcast(table), F.col("k") == F.col("end"), "left")
    here = F.struct(F.col("own").alias("part"), F.lit(False).alias("guest"))
    there = F.transform(F.coalesce("to", F.array().cast("array<int>")), lambda t: F.struct(t.alias("part"), F.lit(True).alias("guest")))
    dealt = sent.select(*rows.columns, F.inline(F.concat(F.array(here), there)))
    return dealt.repartitionById(max(1, len(cuts) + 1), "part").sortWithinPartitions("k", "guest")


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``, from the whole html; then ``n_template`` (lines that the
    neighbours call template) and ``n_vetoed`` (lines on which the tags' check decided otherwise).

    Null and empty html give an empty text. A null url, or one without a host, is of the host
    '' and compared with others of that kind. Repeated rows are pages like any other; a
    page alone on its host has no neighbour and keeps all that is not furniture.
    An empty table gives an empty result; other columns are not read.
    """
    url = F.coalesce("url", F.lit(""))
    rows = pages.select(
        "page_id",
        "url",
        F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1)).alias("host"),
        F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1).alias("path"),
        "html",
    )
    number = F.lpad(F.coalesce(F.col("page_id").cast("string"), F.lit("")), 20, "0")
    # Different pages have different keys, also without a URL and an id.
    content = F.hex(F.xxhash64(F.coalesce("html", F.lit(""))))
    rows = rows.withColumn("k", F.concat_ws("\x01", "host", "path", number, content)).withColumn("bytes", F.octet_length(F.coalesce("html", F.lit(""))))
    return to_python(_in_url_order(rows).drop("k", "bytes", "part")).mapInArrow(_difference, RESULT)
