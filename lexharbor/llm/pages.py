"""Main text of web pages: structure, and differences from the nearest URL of the same host."""

from __future__ import annotations

import html as entities
import re
from array import array
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import BROADCAST_ROWS, broadcast_within, materialize
from .common import small_batches

# HTML's element names by role, and words of class, id and role attributes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg math object canvas audio video".split())
ASIDE = frozenset("nav footer aside form head menu dialog button select textarea".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol "
    "option p pre section summary table tbody td tfoot th thead title tr ul".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert "
                  "menu menubar toolbar form".split())
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertisements banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies disqus footer gdpr menu menus modal nav navbar navigation "
    "newsletter notice notices pagination popup promo promos promotion related share sharing "
    "sidebar sidebars social sponsor sponsored subscribe toolbar".split())
# Elements that an opening tag of the named kind closes.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
          "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)((?>[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
LOOSE_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)([^>]*+)>")
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true", re.I)
PARTS = re.compile(r"[^a-z0-9]+")
OUT, OPEN, MAIN = 0, 1, 2
# Cells of one alignment table; longer pairs are halved first.
CELLS = 1 << 27


def _aside(name: str, attributes: str, inside_main: bool) -> bool:
    if name in ASIDE or (name == "header" and not inside_main):
        return True
    if not attributes:
        return False
    for kind, a, b, c in ATTRIBUTE.findall(attributes):
        words = PARTS.split((a or b or c).lower())
        if not MARKS.isdisjoint(words) or (kind.lower() == "role" and not ROLES.isdisjoint(words)):
            # the page itself may be marked up so; its article is still the article
            return name not in ("html", "body", "main", "article")
    return bool(HIDDEN.search(attributes))


def blocks_of(page: str) -> list[tuple[int, str]]:
    """Text blocks in order with their zone: outside, open, or in the article (else ``main``).

    An article counts if it gives a block: one in a comment, script or aside, or an empty one,
    leaves the page to ``main``, and where that gives none either, all that is not outside is open.
    """
    named = [t for t in ("article", "main") if re.search(rf"<{t}[\s/>]", page, re.I)]
    for first in named:
        out = _parsed(page, first)
        if has_main(out):
            return out
    return out if named else _parsed(page, None)


def has_main(blocks: list[tuple[int, str]]) -> bool:
    return any(z == MAIN for z, _ in blocks)


def _parsed(page: str, first: str | None) -> list[tuple[int, str]]:
    """Blocks and zones with elements named ``first`` as the main ones."""
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = []
    buffer: list[str] = []
    asides = mains = 0
    at, size = 0, len(page)

    def flush() -> None:
        if buffer:
            text = " ".join(entities.unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                out.append((OUT if asides else MAIN if mains else OPEN, text))

    def pop_to(k: int) -> None:
        nonlocal asides, mains
        for _, zone in stack[k:]:
            asides -= zone == OUT
            mains -= zone == MAIN
        del stack[k:]

    while at < size:
        tag = page.find("<", at)
        if tag < 0:
            buffer.append(page[at:])
            break
        if tag > at:
            buffer.append(page[at:tag])
        after = page[tag + 1:tag + 2]
        if page.startswith("<!--", tag):
            end = page.find("-->", tag + 4)
            at = size if end < 0 else end + 3
            continue
        if after in ("!", "?"):
            end = page.find(">", tag)
            at = size if end < 0 else end + 1
            continue
        if not (after.isalpha() or (after == "/" and page[tag + 2:tag + 3].isalpha())):
            buffer.append("<")
            at = tag + 1
            continue
        found = TAG.match(page, tag) or LOOSE_TAG.match(page, tag)
        if not found:
            break  # cut off within a tag
        at = found.end()
        name, attributes = found.group(1).lower(), found.group(2)
        if after == "/":
            if name in BLOCKS:
                flush()
            k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), -1)
            if k >= 0:
                if name not in BLOCKS and stack[k][1] == OUT:
                    flush()
                pop_to(k)
            continue
        if name in RAW:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = end.end() if end else size
            continue
        if name == "br":
            buffer.append(" ")
            continue
        aside = _aside(name, attributes, mains > 0)
        if name in BLOCKS or aside:
            flush()
        if name in BLOCKS and stack:
            for k in range(len(stack) - 1, -1, -1):
                inner = stack[k][0]
                if inner == "p" or inner in CLOSES.get(name, ()):
                    pop_to(k)
                    break
                if inner in BLOCKS:
                    break
        if name not in VOID and not attributes.endswith("/"):
            zone = OUT if aside else MAIN if name == first else OPEN
            asides += zone == OUT
            mains += zone == MAIN
            stack.append((name, zone))
    flush()
    return out


def is_article(page: str) -> bool:
    return has_main(blocks_of(page))


def line_names(blocks: list[tuple[int, str]]) -> list[int]:
    """Names of the lines that differencing may delete: all outside the article."""
    return [xxhash.xxh64_intdigest(t.encode()) - (1 << 63) for z, t in blocks if z != MAIN]


def _table(a: list[int], b: list[int]) -> list[int]:
    """Rows of the longest-common-subsequence table, a bit for each place of ``b``."""
    where: dict[int, int] = {}
    for j, y in enumerate(b):
        where[y] = where.get(y, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, []
    for x in a:
        hit = row & where.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    return rows


def common_lines(a: list[int], b: list[int]) -> set[int]:
    """Places in ``a`` of one longest common subsequence of ``a`` and ``b``."""
    lead = 0
    while lead < len(a) and lead < len(b) and a[lead] == b[lead]:
        lead += 1
    tail = 0
    while tail < min(len(a), len(b)) - lead and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    found = set(range(lead)) | set(range(len(a) - tail, len(a)))
    x, y = a[lead:len(a) - tail], b[lead:len(b) - tail]
    if not x or not y:
        return found
    if len(x) > 1 and len(x) * len(y) > CELLS:
        half = len(x) // 2
        over, under = _lengths(x[:half], y), _lengths(x[half:][::-1], y[::-1])
        cut = max(range(len(y) + 1), key=lambda j: over[j] + under[len(y) - j])
        found |= {lead + k for k in common_lines(x[:half], y[:cut])}
        found |= {lead + half + k for k in common_lines(x[half:], y[cut:])}
        return found
    rows = _table(x, y)
    i, j = len(x) - 1, len(y) - 1
    while i >= 0 and j >= 0:
        if rows[i] >> j & 1:               # no match ends here
            j -= 1
        elif i and not rows[i - 1] >> j & 1:
            i -= 1
        else:
            found.add(lead + i)
            i, j = i - 1, j - 1
    return found


def _lengths(a: list[int], b: list[int]) -> list[int]:
    """Length of the longest common subsequence of ``a`` and each head of ``b``."""
    rows = _table(a, b)
    last = rows[-1] if rows else (1 << len(b)) - 1
    out = [0]
    for j in range(len(b)):
        out.append(out[-1] + (not last >> j & 1))
    return out


def host_and_path(url: str | None) -> tuple[str | None, str]:
    try:
        parts = urlsplit(url or "")
        return (parts.netloc.lower() or None), parts.path
    except ValueError:
        return None, ""


def _beginning(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((k for k in range(n) if a[k] != b[k]), n)


def shared_lines(lines: list[int], path: str,
                 others: list[tuple[str, list[int]]]) -> list[int] | None:
    """Places of the lines shared with the page of nearest path, ``None`` if there is none to
    compare with; a copy of the page tells nothing."""
    told = [(p, o) for p, o in others if o != lines]
    if not lines or not told:
        return None
    _, best = max(told, key=lambda t: _beginning(path, t[0]))
    return sorted(common_lines(lines, best))


def page_name(blocks: list[tuple[int, str]]) -> int:
    """Name of a whole page: its blocks with their zones."""
    hashed = xxhash.xxh64()
    for zone, text in blocks:
        hashed.update(b"%d%s\0" % (zone, text.encode()))
    return hashed.intdigest() - (1 << 63)


def line_key(host: str, lines: list[int]) -> bytes:
    return xxhash.xxh128_digest(host.encode() + b"\0" + array("q", lines).tobytes())


def _neighbours(light: DataFrame) -> DataFrame:
    """Each row of ``host, path, lines, several`` with the rows before and after it.

    Rows are dealt by ranges of (host, path), so a host with a third of all pages lies in many
    tasks; the rows at the ends of ranges are found through one row for each range.
    """
    order = ["host", "path", "lines"]
    dealt = materialize(
        light.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "page-lines")
    item = F.struct("path", "lines", "host")
    here = Window.partitionBy("part").orderBy(*order)
    rows = dealt.withColumn("before", F.lag(item).over(here)).withColumn(
        "after", F.lead(item).over(here))
    key = F.struct(*order)
    ends = (dealt.groupBy("part").agg(F.min_by(item, key).alias("first"),
                                      F.max_by(item, key).alias("last")))
    parts = Window.orderBy("part")
    ends = ends.select("part", F.lag("last").over(parts).alias("from_before"),
                       F.lead("first").over(parts).alias("from_after"))
    return (rows.join(ends, "part")
            .withColumn("before", F.coalesce("before", "from_before"))
            .withColumn("after", F.coalesce("after", "from_after"))
            .drop("part", "from_before", "from_after"))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages`` (``page_id, url, html``).

    Lines (blocks) of a page are compared with those of the nearest URL path on its host, the one
    before or after it in order of paths (pages with nothing outside an article left out) that
    begins more alike, aligned by longest common subsequence; shared ones are deleted. Pages of one
    host with equal lines are one page here, at the least of their paths: however many copies
    there are, the nearest different page is found and all copies lose the same lines. Every page
    with such lines is compared. The lines of an article (or ``main``) are never deleted: copies of
    an article on one host are text all the same. Open lines beside an article are text if the
    comparison finds them to be the page's own; where there is no page to compare with they are not,
    nor are those that several pages of a host have around different articles. What differencing
    cannot tell, menus, adverts and the like that differ from page to page, is left out by elements,
    roles and class words. A null or empty page gives an empty text; a null url has no partner; a
    page cut off in a tag ends there; rows that repeat a (page_id, url) count each for itself; extra
    columns are not read.
    """
    small_batches(pages.sparkSession)
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                          F.coalesce("html", F.lit("")).alias("html"))

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for url, page in zip(b.column("url").to_pylist(), b.column("html").to_pylist(),
                                 strict=True):
                host, path = host_and_path(url)
                blocks = blocks_of(page) if host is not None else []
                names = line_names(blocks)
                if names:  # pages without such lines have nothing to align
                    rows.append((host, path, names, page_name(blocks)))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_pydict({n: pa.array(c, t) for n, c, t in zip(
                ("host", "path", "lines", "name"), columns,
                (pa.string(), pa.string(), pa.list_(pa.int64()), pa.int64()), strict=True)})

    light = (source.select("url", "html")
             .mapInArrow(lines, "host string, path string, lines array<long>, name long")
             .groupBy("host", "lines").agg(F.min("path").alias("path"),
                                           (F.min("name") != F.max("name")).alias("several")))

    def differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, cuts, own_lines = [], [], []
            for host, path, own, several, before, after in zip(*(b.column(c).to_pylist() for c in (
                    "host", "path", "lines", "several", "before", "after")), strict=True):
                others = [(o["path"], o["lines"]) for o in (before, after)
                          if o and o["host"] == host]
                cut = shared_lines(own, path, others)
                if cut is not None:
                    keys.append(line_key(host, own))
                    cuts.append(cut)
                    own_lines.append(not several)
            yield pa.RecordBatch.from_pydict({
                "cut_key": pa.array(keys, pa.binary()),
                "cut": pa.array(cuts, pa.list_(pa.int32())),
                "own": pa.array(own_lines, pa.bool_())})

    cuts = materialize(_neighbours(light).mapInArrow(
        differences, "cut_key binary, cut array<int>, own boolean"), "page-cuts")

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, texts, places = [], [], []
            for k, (page_id, url, page) in enumerate(zip(*(b.column(c).to_pylist() for c in (
                    "page_id", "url", "html")), strict=True)):
                blocks = blocks_of(page)
                host, names = host_and_path(url)[0], line_names(blocks)
                if host is not None and names:
                    keys.append(line_key(host, names))
                else:  # nothing to look up; spread over the tasks
                    keys.append(f"{page_id} {url} {k}".encode())
                # a line's place is counted among those outside the article; lines of one have none
                kept, n = [], 0
                for zone, text in blocks:
                    if zone != OUT:
                        kept.append((text, n if zone == OPEN else -1))
                    n += zone != MAIN
                texts.append([t for t, _ in kept])
                places.append([n for _, n in kept])
            yield pa.RecordBatch.from_pydict({
                "page_id": b.column("page_id"), "url": b.column("url"),
                "key": pa.array(keys, pa.binary()),
                "texts": pa.array(texts, pa.list_(pa.string())),
                "places": pa.array(places, pa.list_(pa.int32()))})

    parsed = source.mapInArrow(candidates, "page_id long, url string, key binary, "
                                           "texts array<string>, places array<int>")
    joined = parsed.join(broadcast_within(cuts, cuts.count(), BROADCAST_ROWS // 100),
                         parsed["key"] == cuts["cut_key"], "left").select(
        "page_id", "url", "texts", "places", "cut", "own")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for texts, places, cut, own in zip(*(b.column(c).to_pylist() for c in (
                    "texts", "places", "cut", "own")), strict=True):
                # beside an article only what a comparison finds to be the page's own is text
                gone = set(places) - {-1} if -1 in places and not own else set(cut or ())
                out.append("\n".join(t for t, n in zip(texts, places, strict=True)
                                     if n not in gone))
            yield pa.RecordBatch.from_pydict({
                "page_id": b.column("page_id"), "url": b.column("url"),
                "text": pa.array(out, pa.string()),
                "n_chars": pa.array([len(t) for t in out], pa.int64())})

    return joined.mapInArrow(finish, "page_id long, url string, text string, n_chars long")
