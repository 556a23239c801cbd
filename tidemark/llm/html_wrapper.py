"""Main text of web pages by wrappers: union-free regular expressions inferred for each host.

A page is a stream of block tags and texts, read as nested sequences. Texts that most pages of a host
share are counted by Spark first: they are tokens of the template and anchor the alignment; every
other text is a slot. The sequences of a host's pages are then aligned one after the other. A
mismatch that repeats its neighbours makes them a repeated group, any other becomes optional.
The result is the host's wrapper, one expression without alternatives, whose slots carry
statistics over all pages. They tell which slots are main text; every page is then parsed by its
host's wrapper and gives the texts of those slots.

Each task folds its pages into one wrapper a host; wrappers are then merged in rounds of at most
FAN_IN, so a host with a third of all pages is spread over all tasks and no page is shuffled for it.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, maybe_broadcast, staged
from tidemark.llm.url_filter import host_and_path

#: Wrappers of a host that one task merges in a round.
FAN_IN = 32
#: A text is a token of the template if it is on so many pages of the host and on this share of them; it
#: is left out of main text from STAYS pages on and from FIXED of the pages that have the main text.
LEAST_PAGES, SHARED, STAYS, FIXED = 3, 0.6, 8, 0.9
#: Items of a sequence from which labels that come more than twice are one repeated group; from WIDE on classes count no more.
LONG, WIDE = 24, 64
#: Elements nested deeper are siblings inside the one at this depth.
DEPTH = 48
#: Share of a host's free text that makes article or main elements the main region, that leads into an element, and that
#: an element with a class word such as sidebar holds if it is not aside after all.
ENOUGH, MOST, NEARLY = 0.3, 0.5, 0.75

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|iframe|textarea|select)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPACE = re.compile(r"\s+")
_PART = re.compile(r"[a-z]+")
_ODD = re.compile(r"[.~=#(!]")
#: Elements without an end tag, elements inside a line, regions that are never main text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
ASIDE = frozenset("head nav header footer aside form button menu dialog input object audio video canvas map".split())
COMMENT_WORDS = frozenset("comment comments disqus replies reply respond".split())
ASIDE_WORDS = COMMENT_WORDS | frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs cookie cookies copyright "
    "footer header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted "
    "related share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget".split()
)
#: Of these, words that also stand before what an article is about: such an element inside the main region is aside only if it reads so.
MODIFIERS = frozenset("header related share sharing social".split())
#: Words with which a header is an article's own.
OWN = frozenset("article blog content entry page post story".split())
#: Elements that are part of a sentence that they stand in.
IN_LINE = frozenset("button input object".split())
#: Words of a class that say what its element has or does, not what it is.
STATES = frozenset("has no not with without is open closed enabled disabled active on off".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
MAIN = ("article", "main")
WHOLE = frozenset(["page", "html", "body", *MAIN])
LINES = frozenset("p li h1 h2 h3 h4 h5 h6 td th tr dt dd blockquote pre caption figcaption figure".split())
HEADS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose start ends an open paragraph, headline or list item.
CLOSES = dict.fromkeys(HEADS, HEADS) | {
    "p": frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option"]),
    "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]),
}

#: An item of a sequence is a list: label, items inside (none for a text), pages, characters, characters in links, optional,
#: and the text (of a page) or whether it is main text (of a wrapper). Labels: an element's name and classes, TEXT for a slot,
#: = and a hash for a text of the template, GROUP for a sequence that repeats.
LABEL, KIDS, PAGES, CHARS, LINKED, OPTIONAL, VALUE = range(7)
TEXT, GROUP = "#", "("
Item = list


def aside_word(token: str) -> str | None:
    """The word for which a class or id sets its element aside, if it has one and no word of STATES."""
    parts = _PART.findall(token)
    word = next((p for p in parts if p in ASIDE_WORDS), None) if STATES.isdisjoint(parts) else None
    return None if word == "header" and not OWN.isdisjoint(parts) else word


@lru_cache(maxsize=20_000)
def element_label(name: str, attributes: str) -> str:
    """The element's name with its classes and id (those without a digit), role and whether it is hidden."""
    marks = []
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key == "hidden" or key == "role" and value in ROLES:
            marks.append("!")
        elif key in ("class", "id") and (name not in WHOLE or name == "article"):
            for t in value.split():
                word = aside_word(t)
                if name == "article":
                    marks += [word] if word in COMMENT_WORDS else []
                elif word or name not in LINES and not any(c.isdigit() for c in t):
                    marks.append(word or _ODD.sub("_", t))
    return ".".join([name, *sorted(set(marks))]) if marks else name


@lru_cache(maxsize=20_000)
def name_of(label: str) -> str:
    return re.split(r"[.~=]", label, maxsplit=1)[0] if label[0] not in "=#(" else label


def page_tree(page: str, template: frozenset[int] = frozenset()) -> Item:
    """The page as nested items: blocks with their texts, each text with its white space runs as one space.

    ``template``: hashes of the host's shared texts. A block that holds one of them alone is labelled by it.
    """
    root = _read(page, template)
    _finish(root)
    return root


def outline(item: Item) -> list:
    """A page as read, without its texts: label and items of an element, hash, length and linked characters of a text."""
    return [[text_hash(k[VALUE]), k[CHARS], k[LINKED]] if k[KIDS] is None else [k[LABEL], outline(k)] for k in item[KIDS]]


def from_outline(kids: list, template: frozenset[int]) -> Item:
    """The page's items, without texts, as ``page_tree`` has them."""

    def items(kids: list) -> list[Item]:
        return [
            [_text_label(k[0], template), None, 1, k[1], k[2], False, None] if len(k) == 3 else [k[0], items(k[1]), 1, 0, 0, False, None]
            for k in kids
        ]

    root: Item = ["page", items(kids), 1, 0, 0, False, None]
    _finish(root)
    return root


def _text_label(h: int, template: frozenset[int]) -> str:
    return f"={h & 0xFFFFFFFFFFFF:x}" if h in template else TEXT


def _read(page: str, template: frozenset[int]) -> Item:
    root: Item = ["page", [], 1, 0, 0, False, None]
    open_: list[tuple[str, Item, str | None]] = [("", root, None)]
    parts: list[str] = []
    linked, in_link, at = 0, False, 0
    within: list[str] = []  # elements of IN_LINE that a sentence goes on in

    def flush() -> None:
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                label = _text_label(text_hash(text), template) if template else TEXT
                open_[-1][1][KIDS].append([label, None, 1, len(text), min(linked, len(text)), False, text])
            linked = 0

    def put(raw: str) -> None:
        nonlocal linked
        parts.append(raw)
        if in_link:
            linked += len(raw.strip())

    for m in _TAG.finditer(page):
        if m.start() > at:
            put(page[at : m.start()])
        at = m.end()
        name = m[3]
        if name is None:
            continue
        name = name.lower()
        if name in INLINE:
            if name == "a":
                in_link = not m[2]
            elif name == "br":
                put(" ")
            continue
        if name in IN_LINE:
            if m[2] and within and within[-1] == name:
                within.pop()
                continue
            if not m[2] and open_[-1][0] in LINES and any(p.strip() for p in parts):
                within += [name] if name not in VOID else []
                continue
        flush()
        within.clear()
        in_link = False
        if m[2]:
            place = next((i for i in range(len(open_) - 1, 0, -1) if open_[i][0] == name), None)
            if place is not None:
                del open_[place:]
        else:
            while name in CLOSES.get(open_[-1][0], ()):
                del open_[-1]
            if name not in VOID:
                label, outer = element_label(name, m[4] or ""), open_[-1][2]
                item: Item = [outer or label, [], 1, 0, 0, False, None]
                open_[min(len(open_) - 1, DEPTH)][1][KIDS].append(item)
                deep = len(open_) > DEPTH and is_aside(label)
                open_.append((name, item, outer or (label if deep else None)))
    if at < len(page):
        put(page[at:])
    flush()
    return root


def text_hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _finish(item: Item) -> bool:
    """Sum up characters; name plain containers by what they hold. Whether there is a paragraph or headline inside."""
    lines = False
    for kid in item[KIDS]:
        if kid[KIDS] is not None:
            lines = _finish(kid) or lines
        item[CHARS] += kid[CHARS]
        item[LINKED] += kid[LINKED]
    item[KIDS] = [k for k in item[KIDS] if k[CHARS]]
    name = item[LABEL]
    if len(item[KIDS]) == 1 and item[KIDS][0][LABEL][0] == "=":
        item[LABEL] += item[KIDS][0][LABEL]
    elif name not in WHOLE and name not in LINES and "." not in name and name not in ASIDE:
        item[LABEL] += "~l" if item[LINKED] >= 0.8 * item[CHARS] else "~h" if lines else "~t"
    return lines or name == "p" or name in HEADS


def names(item: Item) -> set[str]:
    return {k[LABEL] for k in item[KIDS]} if item[LABEL] == GROUP else {item[LABEL]}


def similarity(a: Item, b: Item) -> float:
    """0 if the items can't be the same part of the wrapper, else 1 to 2 by what they hold."""
    if a[LABEL] != b[LABEL]:
        return 0.0
    if a[KIDS] is None:
        return 1.5
    x, y = {k[LABEL] for k in a[KIDS]}, {k[LABEL] for k in b[KIDS]}
    both = len(x & y) / max(1, len(x | y))
    return both and 1.0 + both if a[LABEL] == GROUP else 1.0 + both


def steps(a: list[Item], b: list[Item]) -> list[tuple[int | None, int | None]]:
    """The best alignment of two sequences in order: pairs of places, one of them none where an item has no partner."""
    n, m = len(a), len(b)
    if n == m and all(x[LABEL] == y[LABEL] != GROUP for x, y in zip(a, b)):
        return [(i, i) for i in range(n)]
    if n * m > 40_000:  # long irregular sequences: by labels alone
        out: list[tuple[int | None, int | None]] = []
        for what, i, j, k, l in SequenceMatcher(None, [x[LABEL] for x in a], [x[LABEL] for x in b], autojunk=False).get_opcodes():
            out += zip(range(i, j), range(k, l)) if what == "equal" else [(x, None) for x in range(i, j)] + [(None, y) for y in range(k, l)]
        return out
    best = [[0.0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            s = similarity(a[i], b[j])
            best[i][j] = max(best[i + 1][j], best[i][j + 1], best[i + 1][j + 1] + s if s else 0.0)
    out, i, j = [], 0, 0
    while i < n or j < m:
        s = similarity(a[i], b[j]) if i < n and j < m else 0.0
        if s and best[i][j] == best[i + 1][j + 1] + s:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif j == m or i < n and best[i][j] == best[i + 1][j]:
            out.append((i, None))
            i += 1
        else:
            out.append((None, j))
            j += 1
    return out


def _runs(seq: list[Item], groups: list[Item]) -> list[list[Item]]:
    """The sequence in parts: each longest run of items that a group repeats, every other item by itself."""
    sets = [names(g) for g in groups]
    out: list[list[Item]] = []
    inside = None
    for item in seq:
        own = names(item)
        if inside is not None and own <= inside:
            out[-1].append(item)
            continue
        inside = next((s for s in sets if own <= s), None)
        out.append([item])
    return out


def repeated(items: list[Item], same_page: bool = True) -> Item:
    """One repeated group of the items: each label once, in order of first appearance, optional if a repetition lacks it."""
    optional = all(x[OPTIONAL] for x in items)
    place: dict[str, int] = {}
    for x in items:
        for k in x[KIDS] if x[LABEL] == GROUP else [x]:
            place.setdefault(k[LABEL], len(place))
    kids: dict[str, Item] = {}
    times, rounds, last = Counter(), 0, len(place)
    loose: set[str] = set()
    for x in items:
        inside = x[LABEL] == GROUP
        if inside:
            last = len(place)
        for k in x[KIDS] if inside else [x]:
            label = k[LABEL]
            if place[label] <= last:
                rounds += 1
            last = place[label]
            times[label] += 1
            if inside and k[OPTIONAL]:
                loose.add(label)
            kids[label] = merged(kids[label], k, same_page) if label in kids else list(k)
        if inside:
            last = len(place)
    own = list(kids.values())
    for k in own:
        k[OPTIONAL] = k[LABEL] in loose or times[k[LABEL]] < rounds
    return [GROUP, own, max(k[PAGES] for k in own), sum(k[CHARS] for k in own), sum(k[LINKED] for k in own), optional, None]


def _absorbed(seq: list[Item], others: list[Item]) -> list[Item]:
    groups = [x for x in others if x[LABEL] == GROUP]
    if not groups:
        return seq
    fits = [names(g) for g in groups]
    return [repeated(run) if any(names(run[0]) <= s for s in fits) else run[0] for run in _runs(seq, groups)]


def merged(a: Item, b: Item, same_page: bool = False) -> Item:
    """One item for both; pages are counted once where both are of one page."""
    pages = max(a[PAGES], b[PAGES]) if same_page else a[PAGES] + b[PAGES]
    if a[LABEL] == GROUP:
        out = repeated([a, b], same_page)
        out[PAGES], out[OPTIONAL] = pages, a[OPTIONAL] or b[OPTIONAL]
        return out
    kids = None if a[KIDS] is None else aligned(a[KIDS], b[KIDS], same_page)
    return [a[LABEL], kids, pages, a[CHARS] + b[CHARS], a[LINKED] + b[LINKED], a[OPTIONAL] or b[OPTIONAL], None]


def aligned(a: list[Item], b: list[Item], same_page: bool = False) -> list[Item]:
    """One sequence for both: partners are merged, a run of mismatches whose labels all stand beside it is one
    repeated group with those neighbours, any other mismatch is optional.
    """
    a, b = folded(a), folded(b)
    a, b = _absorbed(a, b), _absorbed(b, a)
    pairs = [(None if i is None else a[i], None if j is None else b[j]) for i, j in steps(a, b)]
    own = [names(x or y) for x, y in pairs]
    out: list[Item] = []
    begins: list[int] = []  # for each item of out, the first pair in it
    i = floor = 0
    while i < len(pairs):
        x, y = pairs[i]
        if x and y:
            out.append(merged(x, y, same_page))
            begins.append(i)
            i += 1
            continue
        end = i
        while end < len(pairs) and None in pairs[end]:
            end += 1
        run = set().union(*own[i:end])
        left, right = i, end
        while left > floor and own[left - 1] <= run:
            left -= 1
        while right < len(pairs) and own[right] <= run:
            right += 1
        if run <= set().union(*own[left:i], *own[end:right]):
            while begins and begins[-1] >= left:
                del out[-1], begins[-1]
            sides = [[p[k] for p in pairs[left:right] if p[k]] for k in (0, 1)]
            groups = [repeated(side) for side in sides if side]
            out.append(repeated(groups, same_page) if len(groups) > 1 else groups[0])
            out[-1][OPTIONAL] = len(groups) < 2 or groups[0][OPTIONAL] or groups[1][OPTIONAL]
            begins.append(left)
            i = floor = right
        else:
            for item in (x or y for x, y in pairs[i:end]):
                item[OPTIONAL] = True
                out.append(item)
                begins.append(i)
            i = end
    return folded(out)


def folded(seq: list[Item]) -> list[Item]:
    """A long sequence with the stretch of labels that come more than twice as one repeated group.

    With over WIDE items still, elements are told apart by name alone; nothing is dropped.
    """
    if len(seq) <= LONG:
        return seq
    times = Counter(n for x in seq for n in names(x))
    many = {n for n, k in times.items() if k > 2}
    if many:
        at = [i for i, x in enumerate(seq) if not many.isdisjoint(names(x))]
        seq = [*seq[: at[0]], repeated(seq[at[0] : at[-1] + 1]), *seq[at[-1] + 1 :]]
    if sum(len(names(x)) for x in seq) > WIDE:
        for x in seq:
            for y in x[KIDS] if x[LABEL] == GROUP else [x]:
                y[LABEL] = name_of(y[LABEL]) if y[LABEL][0] != "=" else TEXT
        seq = [repeated(seq)]
    return seq


def regular_expression(item: Item) -> str:
    """The wrapper in the usual notation: ? optional, + repeated, * both, # a slot."""
    inside = " ".join(regular_expression(k) for k in item[KIDS] or ())
    if item[LABEL] == GROUP:
        return f"({inside}){'*' if item[OPTIONAL] else '+'}"
    body = item[LABEL] if item[KIDS] is None else f"<{item[LABEL]}>{inside}</>"
    return f"({body})?" if item[OPTIONAL] else body


@lru_cache(maxsize=20_000)
def aside_kind(label: str) -> str:
    """Why an element may be set aside: its name, role or being hidden ("sure"), "comments", a "modifier", another "word"; "" if nothing says so."""
    name, *marks = re.split(r"[~=]", label, maxsplit=1)[0].split(".")
    words = {aside_word(t) for t in marks} - {None}
    if name in ASIDE or "!" in marks:
        return "sure"
    if not words:
        return ""
    return "comments" if not words.isdisjoint(COMMENT_WORDS) else "modifier" if words <= MODIFIERS else "word"


def is_aside(label: str) -> bool:
    return bool(aside_kind(label))


def _has(item: Item, wanted: frozenset[str]) -> bool:
    return any(name_of(k[LABEL]) in wanted or k[KIDS] and _has(k, wanted) for k in item[KIDS] or ())


def _fixed(item: Item) -> int:
    """Characters of texts of the template in an item."""
    return sum((k[CHARS] if k[LABEL][0] == "=" else 0) if k[KIDS] is None else _fixed(k) for k in item[KIDS] or ())


def choose(root: Item) -> Item:
    """Mark the slots of a wrapper (VALUE) that hold main text, by the statistics of its pages.

    Free text is outside links and elements set aside, and no text of the template. Article elements, else
    main elements, are the main region if they have ENOUGH of it; else the way leads from the root into each
    element that has MOST of it. An element with a class word such as sidebar, and a form, is set aside unless an article or
    nearly all text is in it; reader comments are unless the headline is, whatever elements they are written in. Where a word
    may also say what an article is about, the slots decide: inside the main region such an element is aside if it is
    mostly links or texts of the template. In the region a text of the template, if no headline, is marked
    "template" instead, and left out if it is a menu.
    """
    total = root[CHARS]
    free: dict[int, float] = {}

    def put_aside(item: Item, in_main: bool) -> bool:
        name, kind = name_of(item[LABEL]), aside_kind(item[LABEL])
        if not kind or name in WHOLE and kind != "comments" or name == "header" and in_main and "!" not in item[LABEL]:
            return False
        if kind == "sure" and (name != "form" or "!" in item[LABEL]):
            return True
        if kind == "comments":
            return not _has(item, frozenset(["h1", "main"]))
        if kind == "modifier" and in_main:
            return item[LINKED] >= MOST * item[CHARS] or _fixed(item) >= MOST * item[CHARS]
        if _has(item, frozenset(MAIN)):
            return False
        return item[CHARS] <= NEARLY * total

    def weigh(item: Item, literal: bool, in_main: bool) -> float:
        if item[KIDS] is None:
            fixed = item[LABEL][0] == "=" and not literal or item[LINKED] >= 0.8 * item[CHARS]
            w = 0.0 if fixed else float(item[CHARS] - item[LINKED])
        elif put_aside(item, in_main):
            w = 0.0
        else:
            inner = in_main or name_of(item[LABEL]) in MAIN
            w = sum(weigh(k, literal, inner) for k in item[KIDS])
        free[id(item)] = w
        return w

    all_free = weigh(root, False, False) or weigh(root, True, False)

    def find(item: Item, name: str) -> list[Item]:
        if name_of(item[LABEL]) == name:
            return [item]
        return [x for k in item[KIDS] or () if free.get(id(k)) for x in find(k, name)]

    regions = next((r for r in (find(root, name) for name in MAIN) if r and sum(free[id(x)] for x in r) >= ENOUGH * all_free > 0), None)
    if regions is None:
        at = root
        while at[KIDS]:
            best = max(at[KIDS], key=lambda k: free.get(id(k), 0.0))
            if best[KIDS] is None or name_of(best[LABEL]) in LINES or free.get(id(best), 0.0) <= MOST * all_free:
                break
            if best[LABEL] == GROUP and not any(name_of(k[LABEL]) not in LINES and free.get(id(k), 0.0) > MOST * all_free for k in best[KIDS]):
                break
            at = best
        regions = [at]

    def mark(item: Item, pages: int, headline: bool = False) -> None:
        if item[KIDS] is None:
            fixed = item[LABEL][0] == "=" and item[PAGES] >= LEAST_PAGES and not headline
            menu = item[LINKED] >= 0.8 * item[CHARS]
            item[VALUE] = not (fixed and menu) and ("template" if fixed and item[PAGES] >= max(STAYS, FIXED * pages) else True)
            return
        for k in item[KIDS]:
            if k[KIDS] is None or not put_aside(k, True):
                mark(k, pages, name_of(item[LABEL]) in HEADS)

    for region in regions:
        mark(region, max(x[PAGES] for x in regions))
    return root


def located(wrapper: list[Item], page: list[Item]) -> Iterator[tuple[str, bool | str]]:
    """(text, what ``choose`` says of its slot) of each text of the page, as the wrapper parses it."""
    groups = [x for x in wrapper if x[LABEL] == GROUP]
    fits = [names(g) for g in groups]
    units = [[GROUP, run, 1, 0, 0, False, None] if any(names(run[0]) <= s for s in fits) else run[0] for run in _runs(page, groups)]
    partner = {j: wrapper[i] for i, j in steps(wrapper, units) if i is not None and j is not None}
    known: dict[str, Item] = {}
    if len(partner) < len(units):  # what was generalised, or stands elsewhere, goes by its name
        for x in wrapper:
            for y in x[KIDS] if x[LABEL] == GROUP else [x]:
                known.setdefault(y[LABEL], y)
    for j, unit in enumerate(units):
        for item in unit[KIDS] if unit[LABEL] == GROUP else [unit]:
            mate = partner.get(j)
            if mate is None:
                mate = known.get(item[LABEL]) or known.get(name_of(item[LABEL]))
            elif mate[LABEL] == GROUP:
                mate = next((k for k in mate[KIDS] if k[LABEL] == item[LABEL]), None)
            if item[KIDS] is None:
                yield item[VALUE], bool(mate) and bool(mate[VALUE]) and mate[VALUE]
            else:
                yield from located(mate[KIDS] if mate and mate[KIDS] else [], item[KIDS])


def main_text(wrapper: Item | None, page: str, template: frozenset[int]) -> str:
    """The page's main text by its host's wrapper.

    Where that names no text of the page, as in a layout few pages have, the page is its own wrapper. On a page whose
    main region is mostly text of the template, as copies of one article are, such text stays.
    """
    tree = page_tree(page, template)
    found = list(located(wrapper[KIDS], tree[KIDS])) if wrapper else []
    if not any(main for _, main in found):
        found = list(located(choose(_slim(tree))[KIDS], tree[KIDS]))
    kept, left = (sum(len(t) for t, main in found if main == what) for what in (True, "template"))
    return "\n".join(t for t, main in found if main is True or main and left > kept)


def _summing(most: int):
    """Each page's outline (host, null, 1, outline), and its texts once, summed for each host by the task (host, h, n, null)."""
    names = ["host", "h", "n", "outline"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()

        def emit() -> pa.RecordBatch:
            keys = list(sums)
            hosts, hashes = pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64())
            batch = pa.RecordBatch.from_arrays([hosts, hashes, pa.array(list(sums.values()), pa.int64()), pa.nulls(len(keys), pa.string())], names)
            sums.clear()
            return batch

        def hashes(kids: list) -> Iterator[int]:
            for k in kids:
                if len(k) == 3:
                    yield k[0]
                else:
                    yield from hashes(k[1])

        for batch in batches:
            outlines = []
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                kids = outline(_read(page.as_py() or "", frozenset()))
                sums.update({(host, h) for h in hashes(kids)})
                outlines.append(json.dumps(kids, separators=(",", ":")))
            if outlines:
                n = len(outlines)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.nulls(n, pa.int64()), pa.array([1] * n, pa.int64()), pa.array(outlines)], names)
            if len(sums) > most:
                yield emit()
        yield emit()

    return run


def outlines(pages: DataFrame) -> DataFrame:
    """``pages`` (host, html) read once: a row with the outline of each, and the sums of their texts' hashes."""
    return staged(pages.sparkSession, pages.mapInArrow(_summing(200_000), "host string, h long, n long, outline string"), "page-outlines")


def templates(read: DataFrame) -> DataFrame:
    """host, template: the hashes of texts on LEAST_PAGES pages and SHARED of all pages of the host, for hosts that have some; from ``outlines``."""
    sums = read.groupBy("host", "h").agg(F.sum("n").alias("n"))
    sums = sums.where((F.col("n") >= LEAST_PAGES) | F.col("h").isNull())
    sums = staged(read.sparkSession, sums, "page-texts")
    of = sums.where("h IS NULL").select(F.col("host").alias("w_host"), F.col("n").alias("pages"))
    often = sums.where("h IS NOT NULL").join(maybe_broadcast(of), F.col("host") == F.col("w_host"))
    # of a host's texts each page has, so many can be on SHARED of the pages as a page holds
    return often.where(F.col("n") >= SHARED * F.col("pages")).groupBy("host").agg(F.sort_array(F.collect_list("h")).alias("template"))


def _folder(pages_in: bool):
    """Fold the rows of each key into one wrapper: pages (host, outline, template), or wrappers (host, share, wrapper) in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Item] = {}

        def emit() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in held], pa.string()), pa.array([json.dumps(w, separators=(",", ":")) for w in held.values()], pa.string())], ["host", "wrapper"]
            )
            held.clear()
            return batch

        for batch in batches:
            columns = [batch.column(i) for i in range(3)]
            for host, b, c in zip(columns[0].to_pylist(), columns[1] if pages_in else columns[1].to_pylist(), columns[2].to_pylist()):
                key = (host, None) if pages_in else (host, b)
                if not pages_in and held and key not in held and len(held) > 200 or pages_in and len(held) > 2_000:
                    yield emit()
                other = from_outline(json.loads(b.as_py()), frozenset(c or ())) if pages_in else json.loads(c)
                held[key] = merged(held[key], other) if key in held else other
        yield emit()

    return run


def _slim(item: Item) -> Item:
    """A page's items without their texts."""
    return [*item[:KIDS], None if item[KIDS] is None else [_slim(k) for k in item[KIDS]], *item[PAGES:VALUE], None]


def infer(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """host, wrapper (JSON of its items) for every host of ``pages`` (host, outline, template)."""
    schema = "host string, wrapper string"
    found = staged(spark, pages.select("host", "outline", "template").mapInArrow(_folder(True), schema), "wrappers")
    while True:
        most = found.groupBy("host").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return found
        shares = -(-most // FAN_IN)
        dealt = found.select("host", F.pmod(F.xxhash64("wrapper"), F.lit(shares)).cast("int").alias("share"), "wrapper")
        dealt = dealt.repartition("host", "share").sortWithinPartitions("host", "share", "wrapper")
        found = staged(spark, dealt.mapInArrow(_folder(False), schema), "wrappers")


def extract(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages`` (page_id, url, html).

    Pages of one host share its wrapper; a null or odd url has the empty host. Null html is
    empty. Blocks of main text are joined by one newline; if there is none, the text is empty.
    Repeated rows give repeated rows; other columns are not read; an empty table gives none.
    """
    bounded_batches(spark)
    host, _ = host_and_path(pages["url"])
    base = pages.select(pages["page_id"].alias("page_id"), pages["url"].alias("url"), host.alias("host"), pages["html"].cast("string").alias("html"))
    read = outlines(base.select("host", "html"))
    template = staged(spark, templates(read), "page-templates").withColumnRenamed("host", "t_host")
    anchored = read.where(F.col("outline").isNotNull()).join(maybe_broadcast(template), F.col("host") == F.col("t_host"), "left")
    wrappers = infer(spark, anchored).withColumnRenamed("host", "w_host")
    known = wrappers.join(maybe_broadcast(template), F.col("w_host") == F.col("t_host"), "left").select("w_host", "wrapper", "template")
    known = maybe_broadcast(staged(spark, known, "host-wrappers"))
    joined = base.join(known, F.col("host") == F.col("w_host"), "left").select("page_id", "url", "html", "host", "wrapper", "template")
    kinds = dict(base.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: dict[str, tuple[Item | None, frozenset[int]]] = {}
        for batch in batches:
            texts = []
            for page, name, wrapper, template in zip(*(batch.column(i) for i in range(2, 6))):
                name = name.as_py()
                if name not in ready:
                    if len(ready) > 2_000:
                        ready.clear()
                    w = wrapper.as_py()
                    ready[name] = (choose(json.loads(w)) if w else None, frozenset(template.as_py() or ()))
                texts.append(main_text(ready[name][0], page.as_py() or "", ready[name][1]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
