"""Main text of web pages, by wrappers inferred from the pages of a host.

``infer`` aligns the token streams of a host's pages, one after the other, into a
union-free regular expression, the host's wrapper.  An element of a stream is its
opening tag (name, class and id words, role), what it holds, and its closing tag;
closing tags that HTML lets pages leave out are supplied.  Streams are aligned
element by element, and what two elements hold is aligned in turn:

- equal tags become one; texts that differ become a text slot;
- at a mismatch the nearest later place where either stream meets the other is
  searched; what is skipped becomes optional;
- neighbours with the same tag become one repeated element, neighbours whose tags
  repeat with a period of 2 to PERIOD a repeated group.

There is no alternative (a|b): a wrapper is a sequence of elements, groups and text
slots, each perhaps optional or repeated, so its size does not grow with the pages
aligned.  Every element counts its pages, the characters in its text slots and those
of them inside links.

``marked`` chooses the main element of a wrapper: of those called article, then main,
then content (MAIN_WORDS), the one with the most text; else it goes down from the body
while one child holds most of the text outside links, up to a heading.  ``extract``
matches every page with its host's wrapper and takes the text of the main element
without menus, footers, sidebars, notices, adverts, forms and comments (SKIP_TAGS,
SKIP_WORDS), scripts, styles and markup.  A page in which the host's main element
does not occur is its own host.

At scale: every task aligns the pages it reads into one wrapper a host before anything
is shuffled; partial wrappers meet by host and salt, then by host.  No html is moved
for that.  Wrappers of less than BROADCAST_BYTES in all (measured) are broadcast;
otherwise pages are dealt by host and salt, so that a hot host is split, and each
deal starts with its wrapper.  A wrapper keeps at most MAX_NODES elements, the ones
on most pages; elements of a page that it does not know are judged by their own tags.

Null or empty html, or a page without any text: empty text.  Null urls and urls without
a host form one host.  Repeated rows are pages of their own.  Columns of the input that
clash with the added ones are replaced by them.
"""

from __future__ import annotations

import json
import re
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, written

MAX_NODES = 4000
MAX_DEPTH = 80
PERIOD = 8
BROADCAST_BYTES = 16 << 20
SALTS = 32
HELD_HOSTS = 500
# A child holds most of the text if it holds this share of it.
MOST = 0.6

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|textarea|title|noscript|iframe|template|svg|xmp|noembed|noframes"
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rt rp s "
                   "samp small span strike strong sub sup time tt u var wbr img".split())
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header "
                   "hr main menu nav ol p pre section table ul".split())
# An opening tag closes the first of these that is open below the second.
IMPLIED = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
           "tr": ("tr", ("table", "tbody", "thead", "tfoot")), "td": ("td th", ("tr", "table")),
           "th": ("td th", ("tr", "table")), "option": ("option", ("select",)),
           "tbody": ("thead tbody", ("table",)), "tfoot": ("thead tbody", ("table",))}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# What is left out of the main element, by tag and by word of class, id or role.
SKIP_TAGS = frozenset("nav footer aside form button select option dialog menu fieldset input object head".split())
SKIP_WORDS = re.compile(
    r"(?<![a-z])(?:ads?|adv|advert\w*|adsense|adslot|sponsor\w*|promo\w*|banner\w*|sidebar\w*|nav|navbar\w*|navigation|"
    r"menu\w*|breadcrumb\w*|footer\w*|cookie\w*|consent\w*|notice\w*|popup\w*|modal\w*|newsletter\w*|subscri\w*|signup|"
    r"shar(?:e|ing)\w*|social\w*|related\w*|recommend\w*|comment\w*|disqus\w*|repl(?:y|ies)|respond|widget\w*|"
    r"toolbar\w*|paginat\w*|pager|complementary|contentinfo|search)(?![a-z])")
MAIN_WORDS = re.compile(r"(?<![a-z])(?:articlebody|article|content|post|entry|story|main)(?![a-z])")
HEAD_WORDS = re.compile(r"(?<![a-z])(?:header|masthead)(?![a-z])")

_TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<(?:{RAW})\b[^>]*>(?:.*?</(?P<raw>{RAW})\s*>|.*\Z)|<[!?][^>]*>"""
    r"""|</(?P<close>[a-z][^\s>/]*)[^>]*>"""
    r"""|<(?P<open>[a-z][^\s>/]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(?P<bad>[a-z][^\s>/]*)[^>]*>""",
    re.S | re.I)
_ATTR = re.compile(r"""(?<![\w-])(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORD = re.compile(r"[a-z]+(?:-[a-z]+)*")

# A wrapper's element: label, optional, repeated, pages, characters, characters in
# links, main, what it holds.  A text slot is labelled "#" and holds its text where
# all pages agree (else null); a repeated group is labelled "()".
LABEL, OPTIONAL, REPEATED, PAGES, CHARS, LINKS, MAIN, HELD = range(8)
TEXT, GROUP = "#", "()"


def _label(name: str, attrs: str) -> str:
    """A tag's name with the words of its class, id and role (numbers left out)."""
    if not attrs:
        return name
    words = []
    for m in _ATTR.finditer(attrs):
        words += _WORD.findall((m.group(2) or m.group(3) or m.group(4) or "").lower())
    return f"{name} {' '.join(sorted(set(words)))}" if words else name


def parse(html: str | None) -> list:
    """The page as nested [label, [elements and texts]], closing tags supplied."""
    root: list = ["", []]
    stack = [root]
    names = [""]
    at = 0

    def close(i: int) -> None:
        del stack[i:], names[i:]

    def up_to(wanted, stops) -> int:
        for i in range(len(names) - 1, 0, -1):
            if names[i] in wanted:
                return i
            if names[i] in stops:
                return 0
        return 0

    for m in _TOKEN.finditer(html or ""):
        if m.start() > at:
            stack[-1][1].append(html[at:m.start()])
        at = m.end()
        name = m.group("open") or m.group("bad")
        if name:
            name = name.lower()
            if name in ENDS_P and (i := up_to(("p",), ("td", "th", "button", "caption", "object"))):
                close(i)
            if name in IMPLIED:
                wanted, stops = IMPLIED[name]
                if i := up_to(wanted.split(), stops):
                    close(i)
            node = [_label(name, m.group("attrs") or ""), []]
            if name in VOID:
                stack[-1][1].append(node)
            elif len(stack) < MAX_DEPTH or _skipped(node[0]):
                stack[-1][1].append(node)
                if not (m.group("attrs") or "").endswith("/"):
                    stack.append(node)
                    names.append(name)
            else:       # too deep: its text belongs to the element around it
                stack.append(stack[-1])
                names.append(name)
        elif name := m.group("close"):
            name = name.lower()
            stops = () if name not in INLINE else ENDS_P | {"td", "th", "li", "body"}
            if i := up_to((name,), stops):
                close(i)
    if at < len(html or ""):
        stack[-1][1].append(html[at:])
    return root


def _skipped(label: str) -> bool:
    name, _, words = label.partition(" ")
    if name in SKIP_TAGS:
        return True
    return bool(words) and name not in HEADINGS and name not in ("html", "body", "article", "main") \
        and SKIP_WORDS.search(words) is not None


def wrapper_of(node: list, in_link: bool = False) -> list:
    """One page's element as a wrapper: texts are slots, repeats are folded."""
    label, held = node
    in_link = in_link or label == "a" or label.startswith("a ")
    parts, chars, links = [], 0, 0
    for part in held:
        if isinstance(part, str):
            text = " ".join(unescape(part).split())
            if text:
                n = len(text)
                parts.append([TEXT, False, False, 1, n, n if in_link else 0, False, text if n <= 80 else None])
        else:
            parts.append(wrapper_of(part, in_link))
    for part in parts:
        chars += part[CHARS]
        links += part[LINKS]
    return [label, False, False, 1, chars, links, False, _folded(parts)]


def _joined(a: list, b: list, same_page: bool) -> list:
    """One element for both; on one page it is a repeat."""
    held = (a[HELD] if a[HELD] == b[HELD] else None) if a[LABEL] == TEXT else _aligned(a[HELD], b[HELD], same_page)
    return [a[LABEL], a[OPTIONAL] or b[OPTIONAL] if not same_page else a[OPTIONAL] and b[OPTIONAL],
            a[REPEATED] or b[REPEATED] or same_page, max(a[PAGES], b[PAGES]) if same_page else a[PAGES] + b[PAGES],
            a[CHARS] + b[CHARS], a[LINKS] + b[LINKS], False, held]


def _folded(parts: list) -> list:
    """Neighbours with one tag become a repeated element, periods a repeated group."""
    out: list = []
    for part in parts:
        if out and out[-1][LABEL] == part[LABEL] != GROUP:
            out[-1] = _joined(out[-1], part, True)
        else:
            out.append(part)
    for p in range(2, PERIOD + 1):
        if len(out) < 2 * p:
            break
        labels = [x[LABEL] for x in out]
        i, new = 0, []
        while i < len(out):
            j = i + p
            if GROUP not in labels[i:j]:
                while labels[j:j + p] == labels[i:i + p] and j + p <= len(out):
                    j += p
            if j > i + p:
                members = out[i:i + p]
                for k in range(i + p, j):
                    members[(k - i) % p] = _joined(members[(k - i) % p], out[k], True)
                for x in members:
                    x[REPEATED] = x[REPEATED] and any(out[k][REPEATED] for k in range(i, j)
                                                      if out[k][LABEL] == x[LABEL])
                new.append(_group(members))
                i = j
            else:
                new.append(out[i])
                i += 1
        out = new
    return out


def _group(members: list) -> list:
    return [GROUP, False, True, max(x[PAGES] for x in members), sum(x[CHARS] for x in members),
            sum(x[LINKS] for x in members), False, members]


def _member(group: list, label: str, after: int = 0) -> int:
    """Which part of a group has the label, from ``after`` on around; -1 if none."""
    held = group[HELD]
    for k in range(len(held)):
        if held[(after + k) % len(held)][LABEL] == label:
            return (after + k) % len(held)
    return -1


def _optional(part: list) -> list:
    return part if part[OPTIONAL] else [part[LABEL], True, *part[2:]]


def _keys(part: list) -> list[str]:
    return [x[LABEL] for x in part[HELD]] if part[LABEL] == GROUP else [part[LABEL]]


def _aligned(a: list, b: list, same_page: bool = False) -> list:
    """One sequence that fits both.  Linear in their lengths."""
    if not a or not b:
        return [_optional(x) for x in a or b]
    places: list[dict[str, list[int]]] = [{}, {}]
    for seq, where in zip((a, b), places):
        for i in range(len(seq) - 1, -1, -1):
            for key in _keys(seq[i]):
                where.setdefault(key, []).append(i)     # nearest last

    def next_place(side: int, part: list, at: int, size: int) -> int:
        best = size
        for key in _keys(part):
            found = places[side].get(key)
            while found and found[-1] < at:
                found.pop()
            if found:
                best = min(best, found[-1])
        return best

    out: list = []
    i = j = 0
    while i < len(a) and j < len(b):
        x, y = a[i], b[j]
        if x[LABEL] == GROUP or y[LABEL] == GROUP:
            into, seq, at, flip = (x, b, j, False) if x[LABEL] == GROUP else (y, a, i, True)
            members, after, end = list(into[HELD]), 0, at
            while end < len(seq):
                other = seq[end]
                if other[LABEL] == GROUP:
                    spots = [_member(into, z[LABEL]) for z in other[HELD]]
                    if min(spots) < 0 and (end > at or max(spots) < 0):
                        break
                    for z, k in zip(other[HELD], spots):
                        if k >= 0:
                            members[k] = _joined(members[k], z, same_page)
                        else:
                            members.append(_optional(z))
                else:
                    k = _member(into, other[LABEL], after)
                    if k < 0:
                        break
                    members[k] = _joined(members[k], other, same_page)
                    after = k + 1
                end += 1
            if end > at:
                group = _group(members)
                group[OPTIONAL] = into[OPTIONAL]
                out.append(group)
                i, j = (end, j + 1) if flip else (i + 1, end)
                continue
        elif x[LABEL] == y[LABEL]:
            joined = _joined(x, y, same_page)
            if same_page:
                joined[REPEATED] = x[REPEATED] or y[REPEATED]
            out.append(joined)
            i, j = i + 1, j + 1
            continue
        later_b, later_a = next_place(1, x, j, len(b)), next_place(0, y, i, len(a))
        if later_b == len(b) and later_a == len(a):
            out += [_optional(x), _optional(y)]
            i, j = i + 1, j + 1
        elif later_a == len(a) or later_b < len(b) and later_b - j <= later_a - i:
            out += [_optional(z) for z in b[j:later_b]]
            j = later_b
        else:
            out += [_optional(z) for z in a[i:later_a]]
            i = later_a
    out += [_optional(z) for z in a[i:] + b[j:]]
    return _squared(out)


def _squared(parts: list) -> list:
    """Neighbours with one tag, as alignment leaves them, become one repeated element."""
    out: list = []
    for part in parts:
        if out and out[-1][LABEL] == part[LABEL] != GROUP:
            last = out[-1]
            pages = last[PAGES] + part[PAGES]
            out[-1] = _joined(last, part, True)
            out[-1][PAGES] = pages if last[OPTIONAL] and part[OPTIONAL] else max(last[PAGES], part[PAGES])
        else:
            out.append(part)
    return out


def _size(part: list) -> int:
    return 1 + (sum(map(_size, part[HELD])) if part[LABEL] != TEXT else 0)


def _pruned(wrapper: list) -> list:
    """The wrapper with the MAX_NODES elements that are on most pages."""
    seen: list[tuple] = []

    def walk(part: list, depth: int) -> None:
        seen.append((-part[PAGES], depth, -part[CHARS], len(seen)))
        if part[LABEL] != TEXT:
            for x in part[HELD]:
                walk(x, depth + 1)

    walk(wrapper, 0)
    if len(seen) <= MAX_NODES:
        return wrapper
    kept = {x[3] for x in sorted(seen)[:MAX_NODES]}
    number = iter(range(len(seen)))

    def cut(part: list) -> list | None:
        mine = next(number) in kept
        if part[LABEL] == TEXT:
            return part if mine else None
        held = [y for x in part[HELD] if (y := cut(x)) is not None]
        return [*part[:HELD], held] if mine else None

    return cut(wrapper) or wrapper[:HELD] + [[]]


def merged(a: list, b: list) -> list:
    """The wrapper of both wrappers' pages."""
    return _pruned(_joined(a, b, False))


def marked(wrapper: list) -> list:
    """The wrapper with its main element marked (in place); none without text."""
    found: dict[str, list] = {}

    def look(part: list, skipped: bool) -> None:
        if part[LABEL] == TEXT:
            return
        name, _, words = part[LABEL].partition(" ")
        skipped = skipped or _skipped(part[LABEL])
        if not skipped and part[LABEL] != GROUP and name not in INLINE and part[CHARS]:
            kind = ("article" if name == "article" else "main" if name == "main" or "main" in words.split()
                    else "content" if MAIN_WORDS.search(words) and name not in HEADINGS | {"html", "body", "p"}
                    and not HEAD_WORDS.search(words) else None)
            if kind:
                best = found.get(kind)
                if best is None or part[CHARS] - part[LINKS] > best[CHARS] - best[LINKS]:
                    found[kind] = part
        for x in part[HELD]:
            look(x, skipped)

    def plain(part: list) -> int:
        """Characters outside links and outside what is skipped."""
        if part[LABEL] == TEXT:
            return part[CHARS] - part[LINKS]
        name, _, words = part[LABEL].partition(" ")
        if _skipped(part[LABEL]) or name == "header" or HEAD_WORDS.search(words):
            return 0
        return sum(map(plain, part[HELD]))

    look(wrapper, False)
    chosen = found.get("article") or found.get("main") or found.get("content")
    if chosen is None:
        at, total = wrapper, plain(wrapper)
        while at is not None and total:
            chosen = at
            held = [y for x in at[HELD] if x[LABEL] != TEXT
                    for y in (x[HELD] if x[LABEL] == GROUP else [x]) if y[LABEL] != TEXT]
            if any(x[LABEL].split(" ")[0] in HEADINGS for x in held):
                break
            at = next((x for x in held if plain(x) >= MOST * total
                       and x[LABEL].split(" ")[0] not in INLINE | {"p", "ul", "ol", "table", "dl", "pre", "blockquote"}), None)
    if chosen is not None:
        chosen[MAIN] = True
    return wrapper


def _matches(held: list, parts: list) -> list:
    """For each element of a page its part of the wrapper, None if unknown."""
    out: list = []
    places: dict[str, list[int]] = {}
    for j, part in enumerate(parts):
        for key in _keys(part):
            places.setdefault(key, []).append(j)
    j = after = 0
    for node in held:
        if isinstance(node, str):
            out.append(None)
            continue
        j2 = next((p for p in places.get(node[0], ()) if p >= j), None)
        if j2 is None:
            out.append(None)
            continue
        part = parts[j2]
        if part[LABEL] == GROUP:
            k = _member(part, node[0], after if j2 == j else 0)
            after = k + 1
            out.append(part[HELD][k])
            j = j2
        else:
            out.append(part)
            j, after = (j2 if part[REPEATED] else j2 + 1), 0
    return out


def _collect(node: list, part: list | None, inside: bool, whole: int, out: list) -> bool:
    """Texts of the main element, a blank at the border of blocks; whether it was met."""
    met = inside
    parts = _matches(node[1], part[HELD]) if part is not None and part[LABEL] != TEXT else [None] * len(node[1])
    for child, match in zip(node[1], parts):
        if isinstance(child, str):
            if inside:
                out.append(unescape(child))
            continue
        main = match is not None and match[MAIN]
        if inside and _skipped(child[0]):
            words = child[0].split(" ")[0] not in SKIP_TAGS
            if not (words and match is not None and whole and 2 * match[CHARS] > whole):
                out.append(" ")
                continue
        block = child[0].split(" ")[0] not in INLINE
        if block:
            out.append(" ")
        met |= _collect(child, match, inside or main, match[CHARS] if main else whole, out)
        if block:
            out.append(" ")
    return met


def _has_main(part: list) -> bool:
    return part[MAIN] or part[LABEL] != TEXT and any(map(_has_main, part[HELD]))


def main_text(html: str | None, wrapper: list | None) -> str:
    """The main text of a page by a marked wrapper, by its own where that does not fit."""
    page = parse(html)
    out: list[str] = []
    met = wrapper is not None and _collect(page, wrapper, wrapper[MAIN], wrapper[CHARS], out)
    if not met:
        own = marked(wrapper_of(page))
        out = []
        _collect(page, own, own[MAIN], own[CHARS], out)
    return " ".join("".join(out).split())


def host_of(url: Column) -> Column:
    """A-Z lower-cased host: after the first ``://`` up to ``/``, ``?`` or ``#``; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


_PARTIAL = "host string, salt int, wrapper string"


def _dump(wrapper: list) -> str:
    return json.dumps(wrapper, ensure_ascii=False, separators=(",", ":"))


def _partial_batches(held: dict[str, list]) -> pa.RecordBatch:
    texts = [_dump(w) for w in held.values()]
    return pa.RecordBatch.from_pydict({
        "host": pa.array(list(held), pa.string()),
        "salt": pa.array([sum(t.encode()) % SALTS for t in texts], pa.int32()),
        "wrapper": pa.array(texts, pa.string())})


def _align_pages(batches):
    """Rows (host, html) to one partial wrapper a host."""
    held: dict[str, list] = {}
    for batch in batches:
        for part in slices(batch, 1):
            for host, html in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                page = _pruned(wrapper_of(parse(html)))
                held[host] = merged(held[host], page) if host in held else page
                if len(held) > HELD_HOSTS:
                    yield _partial_batches(held)
                    held = {}
    if held:
        yield _partial_batches(held)


def _align_wrappers(batches):
    """Partial wrappers, those of a host together, to one a host."""
    host, wrapper = None, None
    for batch in batches:
        for h, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            part = json.loads(text)
            if wrapper is not None and h == host:
                wrapper = merged(wrapper, part)
                continue
            if wrapper is not None:
                yield _partial_batches({host: wrapper})
            host, wrapper = h, part
    if wrapper is not None:
        yield _partial_batches({host: wrapper})


def infer(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, wrapper): each host's wrapper as JSON, its main element marked."""
    source = pages.select(host_of(F.col(f"`{url}`")).alias("host"), F.col(f"`{html}`").alias("html"))
    partial = source.mapInArrow(_align_pages, _PARTIAL)
    for keys in (["host", "salt"], ["host"]):
        partial = (partial.repartition(*keys).sortWithinPartitions("host", "salt", "wrapper")
                   .mapInArrow(_align_wrappers, _PARTIAL))

    def mark(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({
                "host": batch.column(0),
                "wrapper": pa.array([_dump(marked(json.loads(w))) for w in batch.column(2).to_pylist()], pa.string())})

    return written(partial.mapInArrow(mark, "host string, wrapper string"), "wrappers")


def extract(pages: DataFrame, wrappers: DataFrame, url: str = "url", html: str = "html",
            broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``pages`` plus ``main_text``, by the wrappers as of :func:`infer`."""
    names = [c for c in pages.columns if c.lower() != "main_text"]
    source = pages.select(*[F.col(f"`{c}`") for c in names], host_of(F.col(f"`{url}`")).alias("__host"),
                          F.col(f"`{html}`").alias("__html"))
    schema = T.StructType([pages.schema[c] for c in names]).add("main_text", "string")
    width = len(names)

    def texts(batch: pa.RecordBatch, wrapper) -> pa.RecordBatch:
        found = [main_text(page, wrapper(host)) for host, page in
                 zip(batch.column(width).to_pylist(), batch.column(width + 1).to_pylist())]
        return pa.RecordBatch.from_arrays([*batch.columns[:width], pa.array(found, pa.string())],
                                          [*names, "main_text"])

    if (wrappers.agg(F.sum(F.octet_length("wrapper"))).first()[0] or 0) <= broadcast_bytes:
        sent = source.sparkSession.sparkContext.broadcast(
            {row["host"]: row["wrapper"] for row in wrappers.toLocalIterator()})

        def by_broadcast(batches):
            read: dict[str, list | None] = {}

            def wrapper(host):
                if host not in read:
                    if len(read) > HELD_HOSTS:
                        read.clear()
                    text = sent.value.get(host)
                    read[host] = json.loads(text) if text else None
                return read[host]

            for batch in batches:
                for part in slices(batch, width + 1):
                    yield texts(part, wrapper)

        return source.mapInArrow(by_broadcast, schema)

    salt = F.pmod(F.xxhash64("__html"), F.lit(SALTS)).cast("int")
    dealt = source.withColumns({"__salt": salt, "__wrapper": F.lit(None).cast("string")})
    first = wrappers.select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields[:-1]],
        F.col("host").alias("__host"), F.lit(None).cast("string").alias("__html"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt"), F.col("wrapper").alias("__wrapper"))
    dealt = (dealt.unionByName(first).repartition("__host", "__salt")
             .sortWithinPartitions("__host", "__salt", F.col("__wrapper").desc_nulls_last()))

    def by_deal(batches):
        now = None
        for batch in batches:
            given = batch.column(width + 3).to_pylist()
            starts = [i for i, w in enumerate(given) if w is not None]
            for i, j in zip([0, *starts], [*starts, len(given)]):
                if i < len(given) and given[i] is not None:
                    now, i = json.loads(given[i]), i + 1
                for part in slices(batch.slice(i, j - i), width + 1):
                    yield texts(part, lambda host: now)

    return dealt.mapInArrow(by_deal, schema)
