"""Main text of web pages, by what a page does not share with the page at the nearest URL.

A page becomes lines, one for each block of text. Of a host, pages stand in the
order of their paths, and each is paired with that neighbour whose path begins
alike for longer. The lines of both are aligned by their longest common
subsequence, and those that both have are deleted as the host's template.

Two things are known without a neighbour, from the elements and their names.
Lines in menus, headers, footers, sidebars, notices, adverts, forms and reader
comments go even if no neighbour has them, since sites fill these by page. And
where a page marks its article, paragraphs, headings and the like in it stay
even if a neighbour has the same, since notices of licences, quotations and
whole mirrored articles are shared without being template; what is outside of
the article goes. The alignment decides on all the rest: every line of pages
that mark no article, and bare text inside an article.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filehaul.llm.common import slices
from filehaul.llm.url_filter import url_parts
from filehaul.operators.ordering import with_rank
from filehaul.storage import delete_stored, store_once

# Pages in a block of neighbours; blocks overlap by one page at each end.
NEIGHBOURS = 4096
# Bits of an alignment kept at once; larger ones are halved.
ALIGNMENT_BITS = 1 << 28

# Elements of HTML by what they are to a reader.
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
PROSE = set("p h1 h2 h3 h4 h5 h6 li pre blockquote td th dd dt figcaption caption".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
EMPTY = set("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = set("script style template noscript iframe noembed noframes object svg math canvas audio video select textarea button datalist title map".split())
OUTSIDE = set("nav aside footer menu dialog".split())
ENDS_ITS_LIKE = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}}
ENDS_NO_FURTHER = set("ul ol menu dl table article section div main nav aside body".split())
OUTSIDE_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
OUTSIDE_NAMES = re.compile(
    r"(?<![a-z0-9])(?:ad|ads|adbox|adsense|adslot|adunit|banner|promo|promos|promotion|menu|menus|nav|navbar|navigation|subnav|crumbs|pager|pagination|"
    r"sidebar|footer|masthead|topbar|toolbar|widget|widgets|notice|notices|popup|modal|overlay|consent|gdpr|signup|signin|login|search|searchbox|"
    r"share|sharing|social|related|recommended|recommendations|replies|respond|disqus|skip)(?![a-z0-9])"
    r"|advert|sponsor|cookie|sidebar|breadcrumb|newsletter|subscri|comment"
)
_COMMENT_NAMES = re.compile("comment|(?<![a-z0-9])(?:reply|replies|disqus)(?![a-z0-9])")
_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^\"'>])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S
)
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|style|hidden|aria-hidden)(?![\w-])(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class State(NamedTuple):
    """Where text stands. outside: 1 in a form, 2 in another part that is no text; main: 1 in the main part, 2 in an article."""

    outside: int = 0
    main: int = 0
    prose: bool = False
    header: bool = False


class Line(NamedTuple):
    text: str
    state: State


def _entered(name: str, attributes: str, state: State) -> State:
    """State inside of an element."""
    classes = role = ""
    hidden = False
    if attributes.strip(" /"):
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'").lower()
            if key in ("class", "id"):
                classes += f" {value}"
            elif key == "role":
                role = value
            elif key == "hidden" or key == "style" and _HIDING.search(value) or key == "aria-hidden" and value == "true":
                hidden = True
    main = state.main
    if name in ("main", "article") or role in ("main", "article"):
        outside = 2 if state.outside == 2 or _COMMENT_NAMES.search(classes) else 0
        main = max(main, 2 if "article" in (name, role) else 1)
    elif name in ("html", "body"):
        outside, hidden = state.outside, False
    elif name in OUTSIDE or role in OUTSIDE_ROLES or classes and OUTSIDE_NAMES.search(classes):
        outside = 2
    else:
        outside = max(state.outside, 1 if name == "form" else 0)
    header = state.header
    if name == "header":
        outside, header = (outside, True) if main else (2, header)
    elif name in HEADINGS:
        header = False
    return State(2 if hidden else outside, main, state.prose or name in PROSE, header)


def page_lines(page: str) -> list[Line]:
    """All lines of text of a page, in its order."""
    lines: list[Line] = []
    parts: list[str] = []
    stack: list[tuple[str, State]] = []
    open_: dict[str, int] = {}
    state = State()

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                lines.append(Line(text, state))

    def leave(size: int) -> None:
        nonlocal state
        flush()
        state = stack[size][1]
        for name, _ in stack[size:]:
            open_[name] -= 1
        del stack[size:]

    def text(raw: str) -> None:
        if raw:
            parts.append(references.unescape(raw) if "&" in raw else raw)

    at = 0
    while True:
        tag = _TAG.search(page, at)
        if tag is None:
            text(page[at:])
            break
        text(page[at : tag.start()])
        at = tag.end()
        closing, name, attributes = (tag[1], tag[2], tag[3]) if tag[2] else (tag[4], tag[5], tag[6])
        if not name:
            continue
        name = name.lower()
        if name == "br":
            parts.append(" ")
        elif closing:
            if name in BLOCKS:
                flush()
            if open_.get(name):
                place = len(stack) - 1
                while stack[place][0] != name:
                    place -= 1
                leave(place)
        elif name in UNSEEN:
            if not attributes.endswith("/") or name not in ("svg", "math"):
                end = re.compile(rf"</{name}(?![\w-])[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
        else:
            block = name in BLOCKS
            if block:
                flush()
                like = ENDS_ITS_LIKE.get(name)
                for place in range(len(stack) - 1, -1, -1):
                    other = stack[place][0]
                    if other == "p" or like and other in like:
                        leave(place)
                        break
                    if other in BLOCKS and (not like or other in ENDS_NO_FURTHER):
                        break
            if name in EMPTY:
                continue
            inside = _entered(name, attributes, state)
            # Inline elements matter only if they change something, or stand within one of their name that does.
            if block or inside != state or open_.get(name):
                if inside.outside != state.outside:
                    flush()
                stack.append((name, state))
                open_[name] = open_.get(name, 0) + 1
                state = inside
    flush()
    return lines


def judged_lines(page: str) -> tuple[list[str], list[int], list[str]]:
    """Lines that are text unless the alignment deletes them, their places among those aligned or -1, and the lines aligned."""
    lines = page_lines(page)
    good = [not line.state.outside and not line.state.header for line in lines]
    level = max((line.state.main for line, fine in zip(lines, good) if fine), default=0)
    texts, places, aligned = [], [], []
    for line, fine in zip(lines, good):
        kept = fine and line.state.main == level
        safe = kept and level == 2 and line.state.prose
        if kept:
            texts.append(line.text)
            places.append(-1 if safe else len(aligned))
        if not safe:
            aligned.append(line.text)
    return texts, places, aligned


def shared_places(own: list[int], other: list[int]) -> list[int]:
    """Places of a longest common subsequence in the first list."""
    start, end, shift = 0, len(own), len(other) - len(own)
    while start < min(len(own), len(other)) and own[start] == other[start]:
        start += 1
    while end > start and end + shift > start and own[end - 1] == other[end - 1 + shift]:
        end -= 1
    middle = _aligned(own[start:end], other[start : end + shift])
    return [*range(start), *(start + place for place in middle), *range(end, len(own))]


def _steps(own: list[int], other: list[int]) -> Iterator[int]:
    """For each line of ``own`` a number whose zero bits tell where the common length grows along ``other``."""
    full = (1 << len(other)) - 1
    masks: dict[int, int] = {}
    for place, line in enumerate(other):
        masks[line] = masks.get(line, 0) | 1 << place
    row = full
    for line in own:
        hit = row & masks.get(line, 0)
        row = ((row + hit) | (row - hit)) & full
        yield row


def _aligned(own: list[int], other: list[int]) -> list[int]:
    if not own or not other:
        return []
    if len(own) * len(other) > ALIGNMENT_BITS and len(own) > 1:
        half = len(own) // 2

        def lengths(lines: list[int], against: list[int]) -> np.ndarray:
            for row in _steps(lines, against):
                last = row
            data = np.frombuffer(last.to_bytes(len(against) // 8 + 1, "little"), np.uint8)
            grows = 1 - np.unpackbits(data, bitorder="little")[: len(against)].astype(np.int64)
            return np.concatenate([[0], np.cumsum(grows)])

        split = int((lengths(own[:half], other) + lengths(own[half:][::-1], other[::-1])[::-1]).argmax())
        return _aligned(own[:half], other[:split]) + [half + place for place in _aligned(own[half:], other[split:])]
    rows = list(_steps(own, other))
    found, i, j = [], len(own), len(other)
    while i and j:
        bit = 1 << (j - 1)
        if rows[i - 1] & bit:
            j -= 1
        elif i > 1 and not rows[i - 2] & bit:
            i -= 1
        else:
            i, j = i - 1, j - 1
            found.append(i)
    return found[::-1]


def _alike(one: str, other: str) -> int:
    """Length of the common beginning."""
    low, high = 0, min(len(one), len(other))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if one[:middle] == other[:middle] else (low, middle - 1)
    return low


def _parsed(pages: DataFrame, whole: bool) -> DataFrame:
    """``host, path, digest`` and, of the whole page, ``row, texts, places``, else ``lines``, the hashes of the lines aligned."""
    names = ["row", "texts", "places"] if whole else ["lines"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, bodies in slices(batches):
            texts, places, lines, digests = [], [], [], []
            for body in bodies:
                kept, at, aligned = judged_lines(body.decode("utf-8", "replace"))
                hashes = np.array([xxhash.xxh64_intdigest(line.encode()) for line in aligned], np.uint64)
                texts.append(kept)
                places.append(at)
                lines.append(hashes.view(np.int64))
                digests.append(xxhash.xxh3_128_digest(hashes.tobytes()))
            kinds = {"texts": pa.list_(pa.string()), "places": pa.list_(pa.int32()), "lines": pa.list_(pa.int64())}
            made = {"texts": texts, "places": places, "lines": lines}
            own = [batch.column(name) if name == "row" else pa.array(made[name], kinds[name]) for name in names]
            arrays = [batch.column("host"), batch.column("path"), pa.array(digests, pa.binary()), *own]
            yield pa.RecordBatch.from_arrays(arrays, names=["host", "path", "digest", *names])

    row = pages.schema["row"].dataType.simpleString()
    kinds = {"row": row, "texts": "array<string>", "places": "array<int>", "lines": "array<long>"}
    source = pages if whole else pages.drop("row")
    return source.mapInArrow(run, "host string, path string, digest binary, " + ", ".join(f"{name} {kinds[name]}" for name in names))


def shared_lines(nodes: DataFrame) -> DataFrame:
    """``host, path, digest, shared`` for distinct rows ``host, path, digest, lines``: what a page has in common with its neighbour.

    ``shared`` are places in ``lines``. Pages without a host have no neighbour,
    nor has the only one of a host; they are left out, like those that share nothing.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ("host", "path", "digest", "lines", "rank", "block")

        def answered(before: tuple | None, own: tuple, after: tuple | None) -> list[int]:
            near = [x for x in (before, after) if x and x[5] == own[5] and x[0] == own[0]]
            if own[4] // NEIGHBOURS != own[5] or not near or not own[0]:
                return []
            return shared_places(own[3], max(near, key=lambda x: _alike(own[1], x[1]))[3])

        before, own = None, None
        for batch in batches:
            found = []
            for after in zip(*(batch.column(name).to_pylist() for name in columns)):
                if own and (shared := answered(before, own, after)):
                    found.append((*own[:3], shared))
                before, own = own, after
            if found:
                yield _found(found)
        if own and (shared := answered(before, own, None)):
            yield _found([(*own[:3], shared)])

    ranked = with_rank(nodes.select("host", "path", "digest", "lines"), "host", "path", "digest")
    around = F.array_distinct(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda step: F.floor((F.col("rank") + step) / NEIGHBOURS)))
    blocks = ranked.withColumn("block", F.explode(around)).where("block >= 0").repartition("block").sortWithinPartitions("block", "rank")
    return blocks.mapInArrow(run, "host string, path string, digest binary, shared array<int>")


def _found(rows: list[tuple]) -> pa.RecordBatch:
    hosts, paths, digests, shared = zip(*rows)
    arrays = [pa.array(hosts), pa.array(paths), pa.array(digests, pa.binary()), pa.array(shared, pa.list_(pa.int32()))]
    return pa.RecordBatch.from_arrays(arrays, names=["host", "path", "digest", "shared"])


def extract_text(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """``page_id, url, text, n_chars, n_lines, n_shared``, one row per row.

    ``text`` joins the lines that are left by a space, with character
    references decoded and white space within a line made one space;
    ``n_lines`` are the lines left, ``n_shared`` those that the page has in
    common with its neighbour outside of marked prose. A null or empty page
    has an empty text; other columns are left out; repeated rows stay. Pages of
    one host and path with the same lines are one to the alignment, so a
    copy's template is found from another page; of pages with one path and
    different lines, each is the other's neighbour.
    """
    host, path = url_parts(F.col(url_column))
    rows = pages.select(
        F.struct(F.col(id_column).alias("page_id"), F.col(url_column).alias("url")).alias("row"),
        host.alias("host"), path.alias("path"), F.coalesce(F.col(html_column).cast("binary"), F.lit(b"")).alias("body"),
    )
    nodes, _ = store_once(_parsed(rows, whole=False).dropDuplicates(["host", "path", "digest"]), "page-lines")
    shared, _ = store_once(shared_lines(nodes), "shared-lines")
    delete_stored(nodes)
    joined = _parsed(rows, whole=True).join(shared, ["host", "path", "digest"], "left")
    common = F.coalesce("shared", F.array().cast("array<int>"))
    left = F.filter(F.arrays_zip("texts", "places"), lambda line: ~F.array_contains(common, line["places"]))
    texts = F.transform(left, lambda line: line["texts"])
    made = joined.select("row.page_id", "row.url", F.array_join(texts, " ").alias("text"), F.size(left).cast("long").alias("n_lines"), F.size(common).cast("long").alias("n_shared"))
    return made.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_lines", "n_shared")
