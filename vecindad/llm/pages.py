"""Main text of web pages by differencing with the page of the nearest URL.

1. Pages of a host with the same lines are one, known by the least path.  They are put
   in the order of their paths by a distributed sort; each is paired with the neighbour
   whose path has the longer common beginning, so never with a copy of itself.  The
   sort sees hosts, paths and keys alone and splits a hot host by path and key;
   pairs over a partition's end are made from the first and last row of each.
2. Each page is cut into blocks of text.  Menus, headers, footers, sidebars, notices,
   adverts, forms, scripts, styles and reader comments are left out where the markup
   names them (element, class, id or role); inside an article or main element a name
   for a header, banner or search leaves nothing out, as it may be the title's.  End tags
   may be left out as in HTML: an open p, li, dt, dd, option or part of a table ends where
   the next one begins.
   Where article and main elements hold at least half of a page's text, the blocks inside
   are its lines; else (a teaser beside the story) all blocks are.
3. The lines of paired pages are aligned by a longest common subsequence, and shared
   lines are deleted.  A line inside an article or main element is shared only if the
   neighbour has it inside one too, and needs a second witness: it is deleted if a second
   page of the host, chosen by the hash of its lines, shares it too.  So are the others if
   they are more than half of the page's text: it may be an article of which there is
   another version, or a frame longer than the article.  A host of two different pages has
   no second witness; they keep the text.

Defined results: a null html is an empty page with an empty text; a null url or one
without a host is not paired; repeated rows give the same text each (a page is never
paired with itself); a null page_id stays null; an empty table gives no row; other
columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecindad.llm.tables import read, stored

# Elements without content, that never close.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that do not end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meta "
    "nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr link".split()
)
# Elements that are never part of the main text.
DROPPED = frozenset(
    "aside button canvas datalist dialog fieldset footer form head iframe input menu nav noscript "
    "object script select style svg template textarea title".split()
)
MAIN = frozenset(("article", "main"))
FRAME = frozenset(("html", "body", "article", "main"))
# Elements that a start tag ends if they are open, and those that it does not look beyond.
_CELLS = ("td", "th")
_TABLE = ("table", "template")
_LISTS = ("ul", "ol", "menu", "table", "td", "th", "template")
_ENDED = {
    "li": (("li",), _LISTS),
    "dt": (("dt", "dd"), ("dl", *_LISTS)),
    "dd": (("dt", "dd"), ("dl", *_LISTS)),
    "option": (("option",), ("select", "datalist")),
    "optgroup": (("option", "optgroup"), ("select", "datalist")),
    "td": (_CELLS, ("tr", *_TABLE)),
    "th": (_CELLS, ("tr", *_TABLE)),
    "tr": (("tr", *_CELLS), _TABLE),
    **{t: (("thead", "tbody", "tfoot", "tr", *_CELLS, "caption"), _TABLE) for t in ("thead", "tbody", "tfoot")},
}
# Start tags that end an open p, unless one of the others is open inside it.
_ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul".split()
)
_AROUND_P = ("button", "caption", "object", "table", "td", "th", "template")
# End tags of other elements do not reach over these.
_AROUND = ("caption", "object", "table", "td", "th", "template")
_OF_TABLE = frozenset(("html", "body", "thead", "tbody", "tfoot", "tr", *_AROUND))
#: Share of a page's text that its article and main elements must hold.
SHARE = 0.5
#: The least page of each of so many parts of a host is looked at for the second page.
PARTS = 1024
# Names of such parts in a class, id or role, as a word of their own.
_EVERYWHERE = (
    r"ads?|advert\w*|breadcrumbs?|comments?|commentlist|complementary|contentinfo|consent|"
    r"cookies?|disclaimer|disqus|footer|gdpr|login|menu|modal|nav|navbar|navigation|newsletter|"
    r"notice|notification|pagination|popup|promo\w*|related|replies|reply|share|sharing|sidebar|signup|"
    r"social|sponsor\w*|subscribe|toolbar|widgets?"
)
_NAMED_INSIDE = re.compile(rf"(?:^|[\s_-])(?:{_EVERYWHERE})(?:$|[\s_-])", re.IGNORECASE)
_NAMED = re.compile(
    rf"(?:^|[\s_-])(?:{_EVERYWHERE}|banner|header|masthead)(?:$|[\s_-])|"
    r"(?:^|\s)(?:site[_-]?)?search(?:[_-]?(?:bar|box|field|form))?(?:$|\s)",
    re.IGNORECASE,
)
_TAG = re.compile(r"<[/!?a-zA-Z]")
_SPACE = re.compile(r"\s+")


class _Blocks(HTMLParser):
    """Blocks of text in page order, and whether each lies inside a main element."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, bool]] = []
        self._open: list[str] = []
        #: Depths of the open elements of each name, and of those that end a block; the last is the innermost.
        self._at: dict[str, list[int]] = {}
        self._block: list[int] = []
        self._main = 0
        #: Depth of the outermost open element that is left out; 0 if none is.
        self._out = 0
        self._text: list[str] = []

    def flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self._text)).strip()
        self._text.clear()
        if text:
            self.blocks.append((text, self._main > 0))

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self._text.append(" ")
        elif tag not in INLINE:
            self.flush()
        if tag in _ENDS_P:
            self._end(("p",), _AROUND_P)
        if tag in _ENDED:
            self._end(*_ENDED[tag])
        if tag in VOID:
            return
        self._open.append(tag)
        self._at.setdefault(tag, []).append(len(self._open))
        if tag not in INLINE:
            self._block.append(len(self._open))
        if not self._out and self._left_out(tag, attrs):
            self._out = len(self._open)
        if tag in MAIN:
            self._main += 1

    def _left_out(self, tag: str, attrs) -> bool:
        if tag in DROPPED or (tag == "header" and not self._main):
            return True
        if tag in FRAME and tag != "article":
            return False
        named = _NAMED_INSIDE if self._main else _NAMED
        for name, value in attrs:
            if name == "hidden" or (name in ("class", "id", "role") and value and named.search(value)):
                return True
        return False

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.flush()
        at = self._depth(tag)
        if not at:
            return
        if tag in INLINE:  # does not end a block that is open inside it
            if not self._block or self._block[-1] < at:
                self._close(at)
        elif tag in _OF_TABLE or at > max(map(self._depth, _AROUND)):
            self._close(at)

    def _depth(self, tag: str) -> int:
        """Of the innermost open element of this name; 0 if none is."""
        found = self._at.get(tag)
        return found[-1] if found else 0

    def _end(self, tags: tuple[str, ...], beyond: tuple[str, ...]) -> None:
        """Closes the outermost of the open ``tags`` that lies inside each of ``beyond``."""
        edge = max(map(self._depth, beyond))
        inside = [at for tag in tags for at in self._at.get(tag, ())[-1:] if at > edge]
        if inside:
            self.flush()
            self._close(min(inside))

    def _close(self, at: int) -> None:
        """Closes open elements up to the one of this depth; each is closed once, so parsing is linear."""
        while len(self._open) >= at:
            last = self._open.pop()
            self._at[last].pop()
            if last not in INLINE:
                self._block.pop()
            if last in MAIN:
                self._main -= 1
            if self._out > len(self._open):
                self._out = 0

    def handle_data(self, data):
        if not self._out:
            self._text.append(data)


def blocks(html: str) -> list[tuple[str, bool]]:
    parser = _Blocks()
    # What a cut page ends with may be half a tag, which is no text.
    half = _TAG.search(html, html.rfind(">") + 1)
    parser.feed(html[: half.start()] if half else html)
    parser.close()
    parser.flush()
    inside = [b for b in parser.blocks if b[1]]
    enough = sum(len(t) for t, _ in inside) >= SHARE * sum(len(t) for t, _ in parser.blocks)
    return inside if inside and enough else parser.blocks


def shared_lines(one: list[int], two: list[int]) -> list[int]:
    """Places in ``one`` of a longest common subsequence, with one bit per line of ``two``."""
    head = 0
    while head < min(len(one), len(two)) and one[head] == two[head]:
        head += 1
    tail = 0
    while tail < min(len(one), len(two)) - head and one[-1 - tail] == two[-1 - tail]:
        tail += 1
    found = list(range(head)) + list(range(len(one) - tail, len(one)))
    middle, other = one[head : len(one) - tail], two[head : len(two) - tail]
    at: dict[int, int] = {}
    for j, line in enumerate(other):
        at[line] = at.get(line, 0) | 1 << j
    rows = []
    full = (1 << len(other)) - 1
    row = full
    for line in middle:
        hit = row & at.get(line, 0)
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    i, j = len(middle), len(other)
    while i and j:
        if middle[i - 1] == other[j - 1]:
            found.append(head + i - 1)
            i, j = i - 1, j - 1
        elif rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
    return found


def main_text(
    texts: list[str], inside: list[bool], lines: list[int], other: list[int] | None, second: list[int] | None
) -> str:
    """The page's text without the lines of the frame that it shares with its neighbour (and a second page)."""
    if other:
        gone = set(shared_lines(lines, other))
        most = 2 * sum(len(texts[k]) for k in gone) > sum(map(len, texts))
        if most or any(inside[k] for k in gone):
            twice = set(shared_lines(lines, second)) if second else set()
            gone = {k for k in gone if k in twice or not (most or inside[k])}
        texts = [t for k, t in enumerate(texts) if k not in gone]
    return "\n".join(texts)


def _keyed(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]+)", 1))
    path = F.regexp_replace(F.regexp_extract("url", r"^[^:]*://[^/?#]*([^?#]*)", 1), r"(/|/?index\.\w+|\.\w{3,5})$", "")
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    ).select("*", F.xxhash64("page_id", "url", "html").alias("_key"), host.alias("_host"), path.alias("_path"))


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((k for k in range(n) if a[k] != b[k]), n)


def neighbours(keyed: DataFrame) -> DataFrame:
    """(_key, other): of each page the page before or after it on its host, by the longer common path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if last is not None and row[2] == last[2]:
                    continue
                out += _pair(last, row)
                first = first or row
                last = row
            yield _rows(out, [])
        if first is not None:
            yield _rows([], [first, last])

    kinds = "_key long, other long, common int, _host string, _path string"
    light = keyed.where(F.length("_host") > 0).select("_host", "_path", "_key")
    found = stored(
        light.repartitionByRange("_host", "_path", "_key")
        .sortWithinPartitions("_host", "_path", "_key")
        .mapInArrow(run, kinds)
    )
    # The first and last row of each partition: as many as twice the number of partitions.
    ends = found.where("_host is not null").select("_host", "_path", "_key").collect()
    ends = sorted((r["_host"], r["_path"], r["_key"]) for r in ends)
    over = [p for a, b in zip(ends, ends[1:], strict=False) if a[2] != b[2] for p in _pair(a, b)]
    more = keyed.sparkSession.createDataFrame([(*p, None, None) for p in over], kinds)
    return (
        found.where("_host is null")
        .union(more)
        .groupBy("_key")
        .agg(F.max_by("other", F.struct("common", "other")).alias("other"))
    )


def _pair(a, b) -> list[tuple[int, int, int]]:
    if a is None or a[0] != b[0]:
        return []
    common = _common(a[1], b[1])
    return [(a[2], b[2], common), (b[2], a[2], common)]


def _rows(pairs: list, ends: list) -> pa.RecordBatch:
    rows = [(*p, None, None) for p in pairs] + [(e[2], None, None, e[0], e[1]) for e in ends]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string()]
    names = ["_key", "other", "common", "_host", "_path"]
    columns = list(zip(*rows, strict=True)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _line_hash():
    """Lines inside a main element and others are never the same line."""
    return F.transform(F.arrays_zip("texts", "inside"), lambda x: F.xxhash64(x["texts"], x["inside"]))


def _pairs(light: DataFrame) -> DataFrame:
    """(_key, _other, _second): the lines of the neighbour of each page, and of a second page of its host.

    light: _key, _host, _path, _lines and their hash _set.
    """
    one = F.min(F.struct("_path", "_key")).alias("_one")
    ones = light.where(F.length("_host") > 0).groupBy("_host", "_set").agg(one)
    ones = stored(ones.select("_host", "_set", "_one._path", "_one._key"))
    lines = light.select("_key", "_lines").dropDuplicates(["_key"])
    # Three pages of each host, so that one is neither the page nor its neighbour.
    parts = ones.groupBy("_host", F.pmod("_set", F.lit(PARTS)).alias("_part")).agg(F.min(F.struct("_set", "_key")).alias("_far"))
    few = parts.groupBy("_host").agg(F.slice(F.sort_array(F.collect_list("_far")), 1, 3).alias("_far"))
    far = few.select("_host", F.explode("_far._key").alias("_key")).join(lines, "_key")
    far = stored(far.groupBy("_host").agg(F.sort_array(F.collect_list(F.struct("_key", "_lines"))).alias("_far")))

    near = neighbours(ones).join(lines.select(F.col("_key").alias("other"), F.col("_lines").alias("_other")), "other")
    third = F.filter("_far", lambda x: (x["_key"] != F.col("_key")) & (x["_key"] != F.col("other")))
    paired = ones.join(near, "_key").join(far, "_host").select("_host", "_set", "_other", F.get(third, F.lit(0))["_lines"].alias("_second"))
    return light.select("_key", "_host", "_set").distinct().join(paired, ["_host", "_set"]).select("_key", "_other", "_second")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    keyed = _keyed(pages)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [blocks(html or "") for html in batch.column(5).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:5],
                    pa.array([[t for t, _ in f] for f in found], pa.list_(pa.string())),
                    pa.array([[i for _, i in f] for f in found], pa.list_(pa.bool_())),
                ],
                names=["_key", "page_id", "url", "_host", "_path", "texts", "inside"],
            )

    schema = "_key long, page_id long, url string, _host string, _path string, texts array<string>, inside array<boolean>"
    parsed = keyed.select("_key", "page_id", "url", "_host", "_path", "html").mapInArrow(cut, schema)
    light = parsed.select("_key", "_host", "_path", _line_hash().alias("_lines"))
    paired = _pairs(stored(light.withColumn("_set", F.xxhash64("_lines"))))

    def difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[2:]]
            texts = [main_text(*row) for row in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    return (
        parsed.join(paired, "_key", "left")
        .select("page_id", "url", "texts", "inside", _line_hash().alias("_lines"), "_other", "_second")
        .mapInArrow(difference, "page_id long, url string, text string")
        .withColumn("n_chars", F.length("text").cast("long"))
    )


def op4_page_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract(read(spark, folder, "pages"))
