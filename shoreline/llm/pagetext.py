"""Main text of web pages: marked articles, and nearest-URL differencing of all pages.

A page becomes blocks of text, each judged by the elements around it:

* menus, headers, footers, sidebars, notices, adverts, forms, comments: dropped, by element
  name, role, or a name in their class or id. ``site-header`` is a header, ``with-sidebar`` and
  ``main-nav-layout`` say something of a layout and are not dropped;
* ``article`` or ``main`` inside a form or an element with the class of a layout part: text of
  the page if nothing else is marked;
* inside ``article`` or ``main`` (or their roles): the page says itself that this is its text;
* anything else is open.

Marked text stays. Open blocks are judged by differencing, on pages with marked text as on others:
all pages of a host are sorted by URL path, each is paired with the one before it (the first with
the one after), its open lines and all lines of the other that are not marked, dropped ones too, are
aligned by a longest common subsequence, and shared lines are deleted: what two pages of a site
share is its frame, unless the other says that it is its text. Lines are compared in order of the
pages.

Pages are parsed twice, which costs time and saves disk: first for digests of their lines, which are sorted by URL and
compared and give the places of the lines to delete, then for their texts, which are shuffled once to meet these.

Edge cases. A null or empty html, and one without text, has the empty text. Unclosed elements end
with the page, an unclosed comment or script as well. Pages without text, or with marked text
only, have nothing to compare and are nobody's neighbours. A page that is alone on its host
is its marked text or, without any, its open lines. Pages with the same url are
neighbours; equal pages would delete each other whole, so lines are only deleted while the page
keeps at least one. Rows that repeat are pages of their own; those equal in all columns share a name, and the
deletions of that name are dealt out among them. Further columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from hashlib import blake2b
from itertools import batched, groupby
from math import isqrt

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoreline.llm.common import slices, written
from shoreline.llm.urlfilter import host_and_path

TAG = re.compile(
    r"""<(?:!--(?P<comment>.*?)(?:--!?>|\Z)
    |(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attributes>
        (?:[\s/]++|=?[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?)?+|=)*+)>
    |/?[a-zA-Z][^>]*+(?:>|\Z)|[!?][^>]*+(?:>|\Z))""",
    re.S | re.X,
)
ATTRIBUTE = re.compile(r"""([^\s=/>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*)))?""")
CLASS_WORD = re.compile(r"[a-z]+")
BLANKS = re.compile(r"\s+")

#: Their content is not text of the page.
RAW = frozenset(
    "script style template noscript textarea title iframe svg object audio video canvas annotation annotation-xml".split()
)
#: Those of them that can lie in one another.
NESTED = frozenset("template svg object audio video canvas".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("head nav header footer aside form dialog menu button select fieldset".split())
MARKED = frozenset(("article", "main"))
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody"
    " td tfoot th thead tr ul".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer"
    " header masthead menu modal nav navbar navigation newsletter notice notices popup promo promoted related share sharing sidebar"
    " social sponsor sponsored subscribe toolbar widget".split()
)

#: Of those, names of layout parts; page-wide wrappers have them too and may hold the article.
LAYOUT_WORDS = frozenset("banner footer header masthead menu modal nav navbar navigation notice notices popup sidebar toolbar widget".split())
#: Words that say where such a part is or what it is made of. With any other word a name means something else.
PLACE_WORDS = frozenset(
    "area article bar block bottom box button buttons column container content count entry form global group inner item items"
    " left link links list main media outer page panel post posts primary right row secondary section site slot text thread"
    " title top unit wrap wrapper".split()
)
#: A header named with one of them is that of the text.
ARTICLE_WORDS = frozenset("article entry post".split())

#: Pairs of equal lines up to which two pages are aligned pair by pair, and beyond that by bits.
MAX_PAIRS = 2_000_000

_OPEN, _MARKED, _DROPPED, _WRAPPER, _WRAPPED = range(5)


def _dropped_words(names: str) -> set[str]:
    """Words of DROPPED_WORDS in the classes and ids that consist of them and of places only."""
    found = set()
    for name in names.lower().split():
        parts = set(CLASS_WORD.findall(name))
        dropped = parts & DROPPED_WORDS
        if dropped and parts <= DROPPED_WORDS | PLACE_WORDS:
            found |= dropped - ({"header"} if ARTICLE_WORDS & parts else set())
    return found


def _zone(name: str, attributes: str, outer: int) -> int:
    """How the text of an element is judged, given the element around it.

    ``_WRAPPER`` is dropped but for articles in it, which are ``_WRAPPED``. An ``article`` or
    ``main`` is not judged by its own names: they say what it is about or what it has.
    """
    inside = outer in (_MARKED, _WRAPPED)
    if outer == _DROPPED or (name in DROPPED and name != "form" and not (name == "header" and inside)):
        return _DROPPED
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)} if attributes.strip() else {}
    role = entities.unescape(found.get("role", "")).lower().strip()
    if role in DROPPED_ROLES or "hidden" in found:
        return _DROPPED
    words = set() if name in MARKED or name in ("body", "html") else _dropped_words(f"{found.get('class', '')} {found.get('id', '')}")
    if name == "header" and inside:
        words -= {"header"}
    marks = name in MARKED or role in MARKED
    if words - LAYOUT_WORDS or ((words or name == "form") and (inside or marks)):
        return _DROPPED
    if words or name == "form":
        return _WRAPPER
    if marks and outer == _WRAPPER:
        return _WRAPPED
    return _MARKED if marks and outer == _OPEN else outer


def _end_of_raw(html: str, name: str, attributes: str, at: int) -> int:
    """Where the content of an element that is not text ends; at the end of the page if nothing closes it."""
    if name not in NESTED:
        closing = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
        return closing.end() if closing else len(html)
    depth = 0 if attributes.rstrip().endswith("/") else 1
    inner = re.compile(rf"<(/?){name}(?=[\s/>])[^>]*?(/?)>", re.I)
    while depth:
        tag = inner.search(html, at)
        if tag is None:
            return len(html)
        depth += -1 if tag[1] else 0 if tag[2] else 1
        at = tag.end()
    return at


def _judged(html: str) -> list[tuple[int, str]]:
    """Zone and text of each block with text, in page order: open, marked or dropped."""
    found, pieces, stack, zone, at = [], [], [], _OPEN, 0

    def flush() -> None:
        text = BLANKS.sub(" ", "".join(pieces)).strip()
        pieces.clear()
        if text:
            found.append((zone, text))

    while True:
        tag = TAG.search(html, at)
        pieces.append(entities.unescape(html[at : tag.start() if tag else len(html)]))
        if tag is None:
            break
        at, name = tag.end(), (tag["name"] or "").lower()
        if not name:
            continue
        if tag["end"]:
            if name in BLOCKS:
                flush()
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    flush() if zone != stack[depth][1] else None
                    zone = stack[depth][1]
                    del stack[depth:]
                    break
            continue
        if name in RAW:
            at = _end_of_raw(html, name, tag["attributes"], at)
            continue
        if name == "br":
            pieces.append(" ")
        if name in BLOCKS:
            flush()
            if stack and stack[-1][0] in ("p", "li", "dt", "dd", "option") and (stack[-1][0] == "p" or stack[-1][0] == name):
                zone = stack.pop()[1]
        if name in VOID or tag["attributes"].rstrip().endswith("/"):
            continue
        inner = _zone(name, tag["attributes"], zone)
        if inner != zone:
            flush()
        stack.append((name, zone))
        zone = inner
    flush()
    if not any(z == _MARKED for z, _ in found):
        found = [(_MARKED if z == _WRAPPED else z, text) for z, text in found]
    return [(z if z in (_OPEN, _MARKED) else _DROPPED, text) for z, text in found]


def blocks(html: str) -> list[tuple[int, str]]:
    """Zone and text of the blocks that are not dropped."""
    return [(zone, text) for zone, text in _judged(html) if zone != _DROPPED]


def shared(a: Sequence, b: Sequence) -> set[int]:
    """Places in ``a`` of a longest common subsequence of the two lists.

    Of several it is the one whose last line comes first in ``b`` and then last in ``a``, and so on
    backwards, whatever the size: Hunt and Szymanski's way, whose work grows with the pairs of equal lines,
    and above ``MAX_PAIRS`` the one by bits find the same. Of equal lines in a row the first are named.
    """
    counts, others = Counter(a), Counter(b)
    few = sum(n * others[line] for line, n in counts.items()) <= MAX_PAIRS
    return _first_of_rows(a, _by_pairs(a, b) if few else _by_bits(a, b))


def _by_pairs(a: Sequence, b: Sequence) -> set[int]:
    places = defaultdict(list)
    for j, line in enumerate(b):
        places[line].append(j)
    ends: list[int] = []
    links: list[tuple] = []
    for i, line in enumerate(a):
        for j in reversed(places.get(line, ())):
            k = bisect_left(ends, j)
            link = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            else:
                ends[k], links[k] = j, link
    chosen, link = set(), links[-1] if links else None
    while link:
        chosen.add(link[0])
        link = link[1]
    return chosen


def _by_bits(a: Sequence, b: Sequence) -> set[int]:
    """The same by a bit per line of ``b`` (Allison and Dix): set are the bits that ``ends`` holds.

    Only lines of both pages are looked at. Of the states along ``a`` every so many-th is kept, those between are
    made again on the way back, and only lines with many places keep their bits: for n and m
    lines the memory is about sqrt(n) * m / 4 bytes, the work n * m / 30 steps of a long integer.
    """
    both = set(a) & set(b)
    rows, b = [i for i, line in enumerate(a) if line in both], [line for line in b if line in both]
    places = defaultdict(list)
    for j, line in enumerate(b):
        places[line].append(j)
    often = len(b) // 256
    masks: dict = {}

    def mask(line) -> int:
        if line in masks:
            return masks[line]
        bits = bytearray(len(b) // 8 + 1)
        for j in places[line]:
            bits[j >> 3] |= 1 << (j & 7)
        found = int.from_bytes(bits, "little")
        if len(places[line]) > often:
            masks[line] = found
        return found

    def after(ends: int, line) -> int:
        either = ends | mask(line)
        return either & (either ^ (either - (ends << 1 | 1)))

    step, kept, ends = isqrt(len(rows)) + 1, [], 0
    for place, i in enumerate(rows):
        if place % step == 0:
            kept.append(ends)
        ends = after(ends, a[i])
    chosen, j = set(), ends.bit_length() - 1
    for number in reversed(range(len(kept))):
        part, states = rows[number * step : (number + 1) * step], [kept[number]]
        for i in part[:-1]:
            states.append(after(states[-1], a[i]))
        for i, before in zip(reversed(part), reversed(states)):
            if a[i] == b[j]:
                chosen.add(i)
                j = (before & ((1 << j) - 1)).bit_length() - 1
                if j < 0:
                    return chosen
    return chosen


def _first_of_rows(lines: Sequence, chosen: set[int]) -> set[int]:
    """As many of equal lines in a row, the first of them: the text without them is the same."""
    result = set()
    for _, row in groupby(range(len(lines)), key=lines.__getitem__):
        row = list(row)
        result.update(row[: sum(i in chosen for i in row)])
    return result


def _deleted(lines: Sequence, neighbour: Sequence | None, marked: bool = False) -> set[int]:
    """Places of the open lines to delete; ``marked`` says that the page has marked ones besides.

    Without a neighbour nothing tells which open lines beside marked ones are the page's own.
    """
    gone = shared(lines, neighbour) if neighbour else set(range(len(lines)) if marked else ())
    return gone if marked or len(gone) < len(lines) else set()


def without_shared(lines: list[str], neighbour: list[str] | None) -> str:
    gone = _deleted(lines, neighbour)
    return "\n".join(line for i, line in enumerate(lines) if i not in gone)


#: Bytes of the digests that stand for lines and pages; lines with equal digests count as equal.
DIGEST = 16


def _digest(*parts: bytes) -> bytes:
    found = blake2b(digest_size=DIGEST)
    for part in parts:
        found.update(part)
    return found.digest()


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes], list[list[tuple[int, str]]]]]:
    """Pages with their names, which are equal for equal rows only, and their blocks."""
    for batch in batches:
        for part in slices(batch, "html"):
            columns = [part.column(c).to_pylist() for c in ("page_id", "url", "html")]
            names = [_digest(repr((page_id, url, data is None)).encode(), b"\n", data or b"") for page_id, url, data in zip(*columns)]
            yield part, names, [_judged((data or b"").decode("utf-8", "replace")) for data in columns[2]]


_COMPARED = "page_id bigint, url string, name binary, lines binary, zones binary"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pages with text outside marks the digests of its lines, in a row, and a byte per block with its zone."""
    for part, names, pages in _parsed(batches):
        places = [i for i, found in enumerate(pages) if any(zone != _MARKED for zone, _ in found)]
        lines = [b"".join(_digest(text.encode()) for zone, text in pages[i] if zone != _MARKED) for i in places]
        zones = [bytes(zone for zone, _ in pages[i]) for i in places]
        taken = [part.column(c).take(pa.array(places, pa.int32())) for c in ("page_id", "url")]
        taken += [pa.array(x, pa.binary()) for x in ([names[i] for i in places], lines, zones)]
        yield pa.RecordBatch.from_arrays(taken, names=["page_id", "url", "name", "lines", "zones"])


_TEXTS = "page_id bigint, url string, name binary, text string"


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The open and marked blocks of every page, joined by a line feed, which is in no block."""
    for part, names, pages in _parsed(batches):
        texts = ["\n".join(text for zone, text in found if zone != _DROPPED) for found in pages]
        columns = [part.column("page_id"), part.column("url"), pa.array(names, pa.binary()), pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "name", "text"])


#: Rows of a batch that are Python objects at the same time.
_ROWS = 256


def _rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            part = batch.slice(start, _ROWS)
            yield from zip(*(part.column(name).to_pylist() for name in names))


def _split(lines: bytes) -> list[bytes]:
    return [lines[k : k + DIGEST] for k in range(0, len(lines), DIGEST)]


def _places(page: tuple, neighbour: bytes | None) -> list[int]:
    """Places of the lines to delete among those of the page's text. A page is host, name, lines and zones."""
    zones = [zone for zone in page[3] if zone != _MARKED]
    own = [line for line, zone in zip(_split(page[2]), zones) if zone == _OPEN]
    gone = _deleted(own, _split(neighbour or b""), _MARKED in page[3])
    places = [k for k, zone in enumerate(zone for zone in page[3] if zone != _DROPPED) if zone == _OPEN]
    return [places[k] for k in sorted(gone)]


_DELETED = "name binary, gone array<int>"
_DIFFERENCED = f"{_DELETED}, part int, place int, host string, waits boolean, lines binary, zones binary, after binary"
_KINDS = dict(name=pa.binary(), gone=pa.list_(pa.int32()))
_ALL_KINDS = _KINDS | dict(part=pa.int32(), place=pa.int32(), host=pa.string(), waits=pa.bool_(), lines=pa.binary(), zones=pa.binary(), after=pa.binary())


def _batches(rows: Iterator[tuple], kinds: dict[str, pa.DataType]) -> Iterator[pa.RecordBatch]:
    for some in batched(rows, _ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*some), kinds.values())], names=list(kinds))


def _difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbours by url path within each host, in the order of the partition; what is deleted of those with open lines.

    Besides it gives the partition's first and last page as border rows; one ``waits``
    if its neighbour may be in another partition. ``after`` is the first page's neighbour if
    the partition before ends with another host.
    """

    def compared() -> Iterator[tuple]:
        part, first, before, opening = TaskContext.get().partitionId(), None, None, None
        given, count = False, 0

        def result(page: tuple, neighbour: tuple | None) -> Iterator[tuple]:
            if _OPEN in page[3] and (gone := _places(page, neighbour and neighbour[2])):
                yield (page[1], gone, *[None] * 7)

        def border(page: tuple, place: int, waits: bool, after: bytes | None) -> tuple:
            return (page[1], None, part, place, page[0], waits and _OPEN in page[3], *page[2:], after)

        for page in _rows(batches, "host", "name", "lines", "zones"):
            same, count = before is not None and before[0] == page[0], count + 1
            if first is None:
                first = page
            else:
                if not given:
                    yield border(first, 0, True, page[2] if same else b"")
                    given = True
                if opening is not None:  # the first page of a host waits for the second
                    yield from result(opening, page if same else None)
                    opening = None
                if same:
                    yield from result(page, before)
                else:
                    opening = page
            before = page
        if count == 1:
            yield border(first, 0, True, None)
        elif count:
            yield border(before, 1, opening is not None, None)

    return _batches(compared(), _ALL_KINDS)


def _join_borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is deleted of the waiting border rows; ``after`` is null where the next border row is the next page."""

    def compared() -> Iterator[tuple]:
        before, held = None, None

        def result(page: tuple, following: tuple | None) -> Iterator[tuple]:
            if page[4]:
                if before is not None and before[0] == page[0]:
                    neighbour = before[2]
                elif page[5] is not None:
                    neighbour = page[5]
                else:
                    neighbour = following[2] if following is not None and following[0] == page[0] else None
                if gone := _places(page, neighbour):
                    yield page[1], gone

        for page in _rows(batches, "host", "name", "lines", "zones", "waits", "after"):
            if held is not None:
                yield from result(held, page)
                before = held
            held = page
        if held is not None:
            yield from result(held, None)

    return _batches(compared(), _KINDS)


_TEXT = "page_id bigint, url string, text string"


def _delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their deleted lines; of each name the rows with these come first, then its pages."""
    name, waiting = None, []
    for batch in batches:
        names, deleted = (batch.column(c).to_pylist() for c in ("name", "gone"))
        places, changed = [], {}
        for i, gone in enumerate(deleted):
            if names[i] != name:
                name, waiting = names[i], []
            if gone is not None:
                waiting.append(gone)
                continue
            if waiting:
                lines, gone = batch.column("text")[i].as_py().split("\n"), set(waiting.pop())
                changed[len(places)] = "\n".join(line for k, line in enumerate(lines) if k not in gone)
            places.append(i)
        found = batch.select(["page_id", "url", "text"]).take(pa.array(places, pa.int32()))
        if changed:
            mask, texts = pa.array([i in changed for i in range(len(places))]), pa.array(changed.values(), pa.string())
            found = found.set_column(2, "text", pc.replace_with_mask(found.column("text"), mask, texts))
        yield found


def main_text(pages: DataFrame, partitions: int | None = None) -> DataFrame:
    """``page_id``, ``url`` and ``text`` of every page, blocks joined by a line feed."""
    sources = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", F.col("html").cast("binary").alias("html"))
    host, path = host_and_path(F.col("url"))
    compared = written(sources.mapInArrow(_compare, _COMPARED), "page-lines").select(host.alias("host"), path.alias("path"), "*")
    order = ("host", "path", "url", "page_id", "name")
    ranged = compared.repartitionByRange(*order) if partitions is None else compared.repartitionByRange(partitions, *order)
    differenced = written(ranged.sortWithinPartitions(*order).mapInArrow(_difference, _DIFFERENCED), "differenced")
    borders = differenced.where("part IS NOT NULL").repartition(1).sortWithinPartitions("part", "place")  # two rows per partition
    deleted = differenced.where("part IS NULL").select("name", "gone").union(borders.mapInArrow(_join_borders, _DELETED))
    texts = sources.mapInArrow(_texts, _TEXTS).unionByName(deleted, allowMissingColumns=True)
    return texts.repartition("name").sortWithinPartitions("name", F.col("gone").isNull()).mapInArrow(_delete, _TEXT)
