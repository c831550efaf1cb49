"""Main text of web pages by differencing each page against its nearest neighbour by URL.

A page becomes a list of text lines, one per block element.  Pages are sorted by host and path; each is paired with
the neighbour on its host whose path shares the longest beginning.  The two line lists are aligned by their longest
common subsequence, and the lines they share go: a site's menus, notices and footers are on both pages, the article
is on one.  Markup that says what a block is comes first: lines inside `article` or `main` stay even if shared (two
pages can carry the same article), lines inside menus, footers, adverts, forms, comments and the like go even if no
neighbour has them.  So the difference decides about every line that the markup leaves open.  A neighbour that
is a copy of the page under another URL decides nothing; the nearest page that is none does.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import settle
from millrace.llm.neighbours import OWN, ranged

KEEP, OPEN, DROP, DROP_FORM = 1, 0, -1, -2
ROWS = 1000  # of a batch of results

# Element names of the HTML standard.
_SILENT = ("script", "style", "noscript", "template", "svg", "iframe", "object", "title", "textarea", "select")
_CHROME = ("nav", "footer", "aside", "form", "menu", "dialog", "button")
_BODY = ("article", "main")
_OF_PAGES = ("article", "main", "nav", "header", "footer", "h1", "h2")
_BLOCKS = (
    "address", "article", "aside", "blockquote", "body", "caption", "dd", "details", "dialog", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr",
    "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td",
    "tfoot", "th", "thead", "tr", "ul",
)
_VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
_TEXTS = (
    "blockquote", "caption", "h1", "h2", "h3", "h4", "h5", "h6", "p", "pre", "table", "tbody", "td", "tfoot", "th",
    "thead", "tr",
)
_NOISE_NAMES = (
    r"(?:ads?|advert\w*|banner|breadcrumbs?|comments?|cookies?|disqus|footer|gdpr|menu|modal|nav\w*|newsletter|notice|"
    r"pagination|popup|promo\w*|related|share|sharing|sidebar|social|sponsor\w*|subscribe|toolbar|widget)"
)
# Words that sites put before or after such a name: `comment-list`, `reader-comments`, `ad-slot`, `cookie-notice`.
_BEFORE = r"(?:article|bottom|footer|left|main|mobile|page|post|reader|right|site|sticky|top|user|header)"
_AFTER = (
    r"(?:area|bar|block|body|bottom|box|buttons?|consent|container|content|feed|footer|form|header|icons?|inner|left|"
    r"links?|list|message|notice|overlay|panel|popup|posts|right|section|signup|slot|stories|thread|top|unit|widget|wrap|wrapper)"
)
_NOISE = re.compile(rf"(?i)(?:^|[\s_-]){_NOISE_NAMES}(?:$|[\s_-])")
_WHOLE_NOISE = re.compile(rf"(?i)(?:^|\s)(?:{_BEFORE}[_-])?{_NOISE_NAMES}(?:[_-]{_AFTER})*(?:$|\s)")
_NOISY_ROLES = ("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "form")

# A well-formed tag; possessive, and no quoted value beyond the next `<`, so a tag that is not costs its length once.
_TAG = re.compile(
    r"<(/?)([a-zA-Z][^\s/>]*+)((?:\s++[^\s/>=\"'<]++(?:\s*+=\s*+(?:\"[^\"<]*+\"|'[^'<]*+'|[^\s\"'>=<`]++))?+)*+\s*+/?)>"
)
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_GAP, _KEY, _EQUALS, _BARE = (re.compile(x) for x in (r"[\s/]*+", r"=?[^\s/>=]*+", r"\s*+=\s*+", r"[^\s>]*+"))
_ATTRIBUTE = re.compile(r"([a-zA-Z][\w-]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_CLOSE = {name: re.compile(rf"</{name}\b[^>]*+>", re.I) for name in _SILENT}
_WHITE = re.compile(r"\s+")
_BLOCK_SET, _VOID_SET = frozenset(_BLOCKS), frozenset(_VOID)
_NAMED = _BLOCK_SET - {"html", "body", *_TEXTS}  # elements that a class or an id can call noise


def _noisy(element: str, attributes: list[tuple[str, str]], kind: int) -> bool:
    """Whether attributes call an element noise.

    An id is often a heading's words joined by hyphens, and a class one of many, so inside an article only a role or a
    whole name tells, and of ids only those of containers; outside, an article is judged by whole classes.
    """
    for name, value in attributes:
        name = name.lower()
        if name == "role" and value.lower() in _NOISY_ROLES:
            return True
        if name == "class" and element in _NAMED:
            if (_WHOLE_NOISE if kind == KEEP or element in _BODY else _NOISE).search(value):
                return True
        if name == "id" and element in _NAMED and element not in _BODY and _WHOLE_NOISE.search(value):
            return True
        if kind == KEEP:
            continue
        if name == "hidden":
            return True
        if name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


class _Scanner:
    """Tags of a page one after the other, in time linear in the page.

    Values end as in the HTML standard: at their quote, bare ones at white space or `>`; a quote that is never closed
    ends at the next `>`.  A comment or tag that the page cuts off reaches to its end.
    """

    def __init__(self, page: str):
        self.page, self.size, self.missing = page, len(page), set()

    def find(self, what: str, at: int) -> int:
        """Like str.find, but what is not in the rest of the page is not looked for again."""
        if what in self.missing:
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.missing.add(what)
        return found

    def next(self, at: int):
        """(start, end, closing, name, attributes, empty) of the next tag, comment or declaration from `at` on; the
        name is empty for the latter two.  None if there is none; `end` is the page's end if it is cut off."""
        page = self.page
        while True:
            start = self.find("<", at)
            if start < 0:
                return None
            after = page[start + 1 : start + 2]
            if after in ("!", "?"):
                comment = page.startswith("<!--", start)
                end = self.find("-->" if comment else ">", start + (4 if comment else 1))
                return start, self.size if end < 0 else end + (3 if comment else 1), False, "", [], False
            if found := _TAG.match(page, start):
                text = found[3]
                return start, found.end(), bool(found[1]), found[2].lower(), _attributes(text) if text and not text.isspace() else [], text.endswith("/")
            if found := _NAME.match(page, start):
                attributes, end, empty = self.loose(found.end())
                return start, end, bool(found[1]), found[2].lower() if end <= self.size else "", attributes, empty
            at = start + 1

    def close(self, name: str, at: int) -> int | None:
        """Behind the end tag of an element whose content is no markup, if it has one."""
        if name in self.missing:
            return None
        end = _CLOSE[name].search(self.page, at)
        if not end:
            self.missing.add(name)
        return end.end() if end else None

    def loose(self, at: int) -> tuple[list[tuple[str, str]], int, bool]:
        """Attributes of a tag that is not well formed, from behind its name; its end is beyond the page if cut off."""
        page, attributes, empty = self.page, [], False
        while True:
            gap = _GAP.match(page, at)
            empty, at = gap[0].endswith("/"), gap.end()
            if at >= self.size:
                return attributes, self.size + 1, False
            if page[at] == ">":
                return attributes, at + 1, empty
            key = _KEY.match(page, at)
            at, value = key.end(), ""
            if equals := _EQUALS.match(page, at):
                at = equals.end()
                quote = page[at : at + 1]
                if quote in ('"', "'") and quote:
                    end = self.find(quote, at + 1)
                    if end < 0:
                        end = self.find(">", at)
                        value, at = page[at + 1 : end if end >= 0 else self.size], end if end >= 0 else self.size
                    else:
                        value, at = page[at + 1 : end], end + 1
                else:
                    bare = _BARE.match(page, at)
                    value, at = bare[0], bare.end()
            attributes.append((key[0], value))


def _attributes(text: str) -> list[tuple[str, str]]:
    return [(name, value.strip("\"'")) for name, value in _ATTRIBUTE.findall(text)]


def page_lines(page: str) -> tuple[list[str], list[int]]:
    """The text lines of a page in order, and for each whether its markup keeps it, drops it or leaves it open.

    Unclosed elements end with the element around them; a page cut off in mid-tag ends there.  A form is noise unless it
    holds most of the page's text and elements that make up pages, not forms: then it is a wrapper around the page.
    """
    lines, kinds, wraps = _lines(page, DROP_FORM)
    size = lambda wanted: sum(len(line) for line, kind in zip(lines, kinds) if wanted(kind))
    if wraps and size(lambda kind: kind == DROP_FORM) > size(lambda kind: kind >= OPEN):
        lines, kinds, _ = _lines(page, None)
    return lines, [max(kind, DROP) for kind in kinds]


def _lines(page: str, form: int | None) -> tuple[list[str], list[int], bool]:
    """`page_lines` with the kind `form` for the lines of forms, or with forms as plain blocks, and whether a form holds
    elements that make up pages."""
    lines: list[str] = []
    kinds: list[int] = []
    parts: list[str] = []
    stack: list[tuple[str, int]] = []
    kind, at, size, wraps = OPEN, 0, len(page), False

    def flush():
        if parts:
            text = _WHITE.sub(" ", html.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                lines.append(text)
                kinds.append(kind)

    scanner = _Scanner(page)
    while at < size:
        tag = scanner.next(at)
        if not tag:
            parts.append(page[at:])
            break
        start, end, closing, name, attributes, empty = tag
        if start > at:
            parts.append(page[at:start])
        at = end
        if not name:
            continue
        if name in _BLOCK_SET:
            flush()
        elif name == "br":
            parts.append(" ")
            continue
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    kind = stack[depth][1]
                    del stack[depth:]
                    break
            continue
        if name in _CLOSE and not (name == "svg" and empty):
            hidden = scanner.close(name, at)
            at = size if hidden is None else hidden
            continue
        if name in _VOID_SET or empty:
            continue
        if name in ("p", "li", "td", "th", "tr", "dd", "dt", "option") and stack and stack[-1][0] == name:
            kind = stack.pop()[1]  # the end tag of these may be left out
        if name not in _BLOCK_SET and not attributes:
            continue  # plain inline elements change nothing
        stack.append((name, kind))
        wraps = wraps or kind == DROP_FORM and name in _OF_PAGES
        if kind > DROP or kind == DROP_FORM:
            if name == "form" and kind != DROP_FORM:
                kind = kind if form is None else form
            elif name in _CHROME and name != "form" or _noisy(name, attributes, kind) or name == "header" and kind != KEEP:
                kind = DROP
            elif name in _BODY and kind != DROP_FORM:
                kind = KEEP
    flush()
    return lines, kinds, wraps


def shared(mine: list[str], other: list[str]) -> set[int]:
    """Positions of my lines in a longest common subsequence."""
    head = 0
    while head < len(mine) and head < len(other) and mine[head] == other[head]:
        head += 1
    tail = 0
    while tail < len(mine) - head and tail < len(other) - head and mine[-1 - tail] == other[-1 - tail]:
        tail += 1
    found = {*range(head), *range(len(mine) - tail, len(mine))}
    rest, more = mine[head : len(mine) - tail], other[head : len(other) - tail]
    # Lines of one page only are in no common subsequence.
    both = set(rest) & set(more)
    places = [head + i for i, line in enumerate(rest) if line in both]
    number = {line: i for i, line in enumerate(both)}
    a, b = [number[mine[i]] for i in places], [number[line] for line in more if line in both]
    if a and b:
        found.update(places[i] for i in (_by_pairs if _pairs(a, b) <= MOST_PAIRS else _by_halves)(a, b))
    return found


# The alignment by pairs of equal lines takes time and memory by their number, beyond this it goes by halves.
MOST_PAIRS = 1_000_000
STORED_BITS, MASK_BYTES = 16_000_000, 64_000_000


def _pairs(a: list[int], b: list[int]) -> int:
    kinds = max(max(a), max(b)) + 1
    return int(np.bincount(a, minlength=kinds) @ np.bincount(b, minlength=kinds))


def _by_pairs(a: list[int], b: list[int]) -> list[int]:
    """Positions in `a` of a longest common subsequence, as a longest increasing run of places in `b`."""
    places: dict[int, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        places.setdefault(b[j], []).append(j)
    ends, tops, links = [], [], []  # least last place of a run of each length, its newest link, all links
    for i, line in enumerate(a):
        for j in places.get(line, ()):
            at = bisect_left(ends, j)
            links.append((i, tops[at - 1] if at else -1))
            if at == len(ends):
                ends.append(j)
                tops.append(len(links) - 1)
            else:
                ends[at], tops[at] = j, len(links) - 1
    out, link = [], tops[-1] if tops else -1
    while link >= 0:
        i, link = links[link]
        out.append(i)
    return out[::-1]


def _rows(a: list[int], b: list[int], keep: bool) -> list[int]:
    """Bit rows of the usual table: a zero in bit j of row i means that b[:j + 1] has one more line in common with
    a[:i + 1] than b[:j].  Only the last row unless `keep`."""
    places: dict[int, list[int]] = {}
    for j, line in enumerate(b):
        places.setdefault(line, []).append(j)
    full, width, masks = (1 << len(b)) - 1, (len(b) + 7) // 8, {}
    few = len(places) * width <= MASK_BYTES  # else masks are made when needed
    row, rows = full, []
    for line in a:
        mask = masks.get(line)
        if mask is None:
            bits = bytearray(width)
            for j in places.get(line, ()):
                bits[j >> 3] |= 1 << (j & 7)
            mask = int.from_bytes(bits, "little")
            if few:
                masks[line] = mask
        hit = row & mask
        row = ((row + hit) | (row - hit)) & full
        if keep:
            rows.append(row)
    return rows if keep else [row]


def _lengths(row: int, n: int) -> np.ndarray:
    """Lengths of the common subsequence with b[:j] for j from 0 to n."""
    bits = np.unpackbits(np.frombuffer(row.to_bytes((n + 7) // 8, "little"), np.uint8), bitorder="little")[:n]
    return np.concatenate(([0], np.cumsum(1 - bits.astype(np.int64))))


def _by_halves(a: list[int], b: list[int]) -> list[int]:
    """The same in space linear in the lines: cut `a` in half, and `b` where both halves have most in common."""
    out, stack = [], [(0, len(a), 0, len(b))]
    while stack:
        a0, a1, b0, b1 = stack.pop()
        if a0 == a1 or b0 == b1:
            continue
        mine, other = a[a0:a1], b[b0:b1]
        if len(mine) * len(other) <= STORED_BITS or len(mine) == 1:
            out += [a0 + i for i in _walk_back(mine, other)]
            continue
        half = len(mine) // 2
        ahead = _lengths(_rows(mine[:half], other, False)[0], len(other))
        back = _lengths(_rows(mine[:half - 1 if half else None:-1], other[::-1], False)[0], len(other))[::-1]
        cut = int(np.argmax(ahead + back))
        stack += [(a0, a0 + half, b0, b0 + cut), (a0 + half, a1, b0 + cut, b1)]
    return sorted(out)


def _walk_back(a: list[int], b: list[int]) -> list[int]:
    rows, out = _rows(a, b, True), []
    i, j = len(a), len(b)
    while i and j:
        bit = 1 << (j - 1)
        if rows[i - 1] & bit:
            j -= 1
        elif i > 1 and not rows[i - 2] & bit:
            i -= 1
        else:
            out.append(i - 1)
            i, j = i - 1, j - 1
    return out


def _copy(lines: list[str], kinds: list[int], other: list[str], other_kinds: list[int], found: set[int]) -> bool:
    """Whether a page's open lines are the other page's text: 90 % of the characters of the smaller and half of those
    of the larger are shared, so a print view is a copy and a page of menus only is not."""
    mine = sum(len(t) for t, k in zip(lines, kinds) if k == OPEN)
    yours = sum(len(t) for t, k in zip(other, other_kinds) if k != DROP)
    both = sum(len(lines[i]) for i in found if kinds[i] == OPEN)
    return 10 * both >= 9 * min(mine, yours) and 2 * both >= max(mine, yours) > 0


def _alike(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def main_texts(pages: DataFrame) -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars, n_shared (lines that the difference deleted).

    A null page is empty and gives an empty text.  Pages without a URL form a host of their own.  Repeated URLs are
    neighbours in order of page_id.  A page alone on its host is judged by markup only.  A neighbour that is a copy
    (`_copy`) says nothing about open lines; the page on the other side is asked, and behind pages with the same html
    the next ones.  If all are copies, open lines stay.  Each page moves once, to the range of its host and path, so a
    host with a third of all pages spreads over many tasks; only pages beside a range's ends move again.
    """
    settle(pages.sparkSession)
    url = F.coalesce(F.col("url"), F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://([^/?#]*)", 1))
    path = F.regexp_extract(url, r"^(?:[a-zA-Z][\w+.-]*://[^/?#]*)?([^#]*)", 1)
    key = {
        "_host": host, "_path": path, "_id": F.coalesce(F.col("page_id"), F.lit(-(2**63))),
        "_tie": F.xxhash64("html"),
    }
    rows = ranged(
        pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"), key, before=True, alike=("_host", "_tie")
    )

    def texts(run, around):
        """Results of a run of pages with one html; `around` has the page before it and the page after it."""
        pages, (lines, kinds), _ = run
        found = {None: (set(range(len(lines))), OPEN in kinds)}  # shared lines with a page, and whether it is a copy

        def compared(i):
            if i not in found:
                both = shared(lines, around[i][1][0])
                found[i] = both, _copy(lines, kinds, *around[i][1], both)
            return found[i]

        for at, (page_id, url, path, side) in enumerate(pages):
            if side != OWN:
                continue
            paths = [n and n[0][2] for n in around]  # of the pages before and after; None in `near` is the run itself
            near = [
                (pages[at - 1][2], None) if at else (paths[0], 0),
                (pages[at + 1][2], None) if at + 1 < len(pages) else (paths[1], 1),
            ]
            far = [(paths[i], i) for i in (0, 1) if near[i][1] is None]
            # The nearest page first, of equally near ones the page before; behind a run the next pages.
            order = [i for part in (near, far) for p, i in sorted(
                (x for x in part if x[0] is not None), key=lambda x: -_alike(path, x[0])
            )]
            gone = set()
            if order:
                both, is_copy = compared(next((i for i in order if not compared(i)[1]), order[0]))
                gone = {i for i in both if kinds[i] == DROP or kinds[i] == OPEN and not is_copy}
            text = "\n".join(t for i, (t, k) in enumerate(zip(lines, kinds)) if k != DROP and i not in gone)
            yield page_id, url, text, len(text), len(gone)

    def run(batches):
        last = now = None  # runs: pages, parsed html, (range, host, html)

        def results(last, now, following):
            around = []
            for other, end in ((last, -1), (following, 0)):
                around.append((other[0][end], other[1]) if other and other[2][:2] == now[2][:2] else None)
            return texts(now, around)

        def rows_of(batches):
            nonlocal last, now
            for batch in batches:
                names = ("page_id", "url", "_path", "_side", "_range", "_host", "html")
                for page_id, url, path, side, *same in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                    same[2] = same[2] or ""
                    if now and now[2] == same:
                        now[0].append((page_id, url, path, side))
                        continue
                    following = [(page_id, url, path, side)], page_lines(same[2]), same
                    if now:
                        yield from results(last, now, following)
                    last, now = now, following
            if now:
                yield from results(last, now, None)

        rows = rows_of(batches)
        while part := list(islice(rows, ROWS)):
            yield _batch(part)

    return rows.select("page_id", "url", "_host", "_path", "html", "_side", "_range").mapInArrow(
        run, "page_id long, url string, text string, n_chars long, n_shared long"
    )


def _batch(rows) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["page_id", "url", "text", "n_chars", "n_shared"]
    )
