"""Main text of web pages by equivalence-class template deduction.

The tokens of a page are its block elements, named by their path (tag, class and id); its words, named by the element they
stand in and by how many times that element has had them before; and the whole text of each element. Tokens of a host with equal numbers of occurrences on
each of its pages share an occurrence vector and form a class. A class is valid if it has at least two tokens, one of them an
element, and is on at least half of the host's pages. Valid classes nest by their elements into the host's template; the
words and texts in them are fixed, and what stands between fixed tokens are slots.

The article is found among the slots once for a host. Variable text is text outside links, less the fixed words. The core is
the deepest article or main element, or else the deepest element once a page, that holds at least half of the variable text; the
article grows to each element around the core that has headings or paragraphs of variable text of its own. It takes in a variable
h1 beside it and, where no article or main element says better, headings and paragraphs of the body and boxes of some SHARE. On a page, all blocks of those slots are its text, but for

- what HTML itself marks as no article: nav, aside, footer, form, script, a header outside article and main, some roles;
- boxes inside it whose whole text is fixed (notices, static adverts), unless these are most of the page's article (a host of copies);
  a fixed paragraph or heading beside varying text stays, and so does an item, term, cell or caption of a list or table that has any;
- last, boxes that bear a name of HINTS or of FAMILY as a whole class or id, unless they hold the article (or the h1 where there is none).

A header outside article and main gives its h1 where that is the page's only one, varies over the host's pages and so is a title.

Vectors are compared by two sums of hashed (page, count), which combine on the map side, so a host may hold any share of the
pages. A word that some instance of its element lacks on a page can't share that element's vector and is left out there.

Null and empty pages have no text. A page without its host's article falls back to the same choice on itself alone, and so
does the only page of a host, whose words can't be told to be fixed. A null or malformed url belongs to the host
''. An attribute whose quote is never closed ends at the next `>`. Repeated pages give repeated rows and count as often; other columns
pass through."""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored

#: Tokens that a task holds before it hands them on, and letters of a fixed text that a template shows.
HELD, SHOWN = 200_000, 40
#: A box beside the article belongs to it if it has at least this share of the article's variable text over the host's pages.
SHARE = 0.25
_RAW = r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|select|svg|iframe|object|title)(?=[\s/>]).*?(?:</\1\s*>|\Z)|<[!?][^>]*+(?:>|\Z)"
_NAME, _TEXT = r"<(/?)([a-zA-Z][^\s/>]*+)", r"([^<]++|<)"
#: Tags with quoted attributes; and, from the first unclosed quote of a page on, tags that end at the next `>`.
_TOKEN = re.compile(rf"{_RAW}|{_NAME}((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|{_TEXT}", re.S | re.I)
_BROKEN = re.compile(rf"{_RAW}|{_NAME}([^>]*+)(?:>|\Z)|{_TEXT}", re.S | re.I)
_NAMED = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br img".split())
_CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: Elements that end an open one of their group, and elements across which that isn't done.
_GROUPS = {"p": 0, "li": 1, "dt": 2, "dd": 2, "tr": 3, "td": 4, "th": 4, "option": 5}
_LIST_EDGE = frozenset("ul ol dl table".split())
_CONTENT = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre".split())
#: Parts of lists, tables and figures, which are fixed only as a whole.
_PARTS = frozenset("li dt dd tr td th thead tbody tfoot caption colgroup figcaption legend summary".split())
_OUT_TAGS = frozenset("head nav footer aside button dialog menu".split())
_OUT_ROLES = frozenset("navigation banner complementary contentinfo search alert dialog".split())
#: Whole classes or ids that name what is no article: the last resort where neither elements nor classes of tokens tell.
HINTS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo banner sidebar navbar breadcrumb breadcrumbs footer comment comments comment-list comments-area reader-comments "
    "respond disqus_thread notice alert cookie-notice cookie-banner consent newsletter newsletter-signup subscribe share-buttons social-links related related-posts pagination".split()
)
#: And such names in two parts, of what and how it stands there.
FAMILY = re.compile(
    r"(?:ads?|adverts?|advertisement|sponsor|sponsored|promo|comments?|reply|replies|cookies?|consent|newsletter|sidebar|breadcrumbs?|disqus)"
    r"[-_](?:slot|box|unit|container|wrapper|wrap|banner|block|section|list|area|thread|form|widget|bar|holder|zone|panel|item|notice|signup)s?"
)


class Node:
    """An element of a page. `label` stands for its path of block elements; `mass` is letters outside links in its subtree."""

    __slots__ = ("above", "block", "box", "hinted", "holds", "inside", "label", "main", "mass", "name", "open", "out", "tag", "words")

    def __init__(self, tag: str, attributes: str, above: Node | None, at: int):
        self.tag, self.above, self.block = tag, above, tag not in _INLINE
        self.box = self if self.block else above.box
        self.name, self.hinted, self.holds, self.inside, self.mass, self.words = tag, False, False, False, 0, None
        self.out = tag in _OUT_TAGS or (tag == "header" and not (above and above.main))
        if attributes and "=" in attributes:
            for m in _NAMED.finditer(attributes):
                value = (m[2] or m[3] or m[4] or "").strip().lower()
                if m[1].lower() == "role":
                    self.out = self.out or value in _OUT_ROLES
                else:
                    self.hinted = self.hinted or any(v in HINTS or FAMILY.fullmatch(v) for v in value.split())
                    if tag not in ("html", "body", "article", "main"):
                        self.name += "." + re.sub(r"\d{3,}", "#", value)
        self.main = (above.main if above else False) or tag in ("article", "main")
        self.label = 0 if above is None else _path(above.label, self.name) if self.block else above.label
        # for each group, where in the stack the element stands that the next of its kind ends
        open_ = (-1,) * 6 if above is None else above.open
        if tag in _GROUPS:
            self.open = tuple(at if i == _GROUPS[tag] else -1 if i in (0, 3, 4)[: 1 + 2 * (tag == "tr")] else x for i, x in enumerate(open_))
        elif not self.block or open_ == (-1,) * 6:
            self.open = open_
        else:
            self.open = (-1, *((-1,) * 5 if tag in _LIST_EDGE else open_[1:]))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _path(label: int, name: str) -> int:
    return _signed(xxhash.xxh3_64_intdigest(name.encode("utf-8", "replace"), label & 0xFFFFFFFFFFFFFFFF))


def _matches(page: str):
    """Tokens of a page in linear time: the first unclosed quote ends the careful reading of attributes."""
    at, pattern = 0, _TOKEN
    while at < len(page):
        for m in pattern.finditer(page, at):
            if pattern is _TOKEN and m[5] == "<" and (m.end() < len(page)) and (page[m.end()].isalpha() or page[m.end()] == "/"):
                at, pattern = m.start(), _BROKEN
                break
            yield m
        else:
            return


def parse(page: str) -> tuple[list[Node], list]:
    """All elements in order, the root first, and (element, text, is in a link) with None between blocks; end tags are implied."""
    root = Node("", "", None, 0)
    stack, nodes, events, links, open_tags = [root], [root], [], 0, defaultdict(int)

    def close(to: int) -> None:
        nonlocal links
        for n in stack[to:]:
            open_tags[n.tag] -= 1
            links -= n.tag == "a"
        del stack[to:]
        events.append(None)

    for m in _matches(page):
        text, tag = m[5], m[3]
        if text is not None:
            events.append((stack[-1], html.unescape(text) if "&" in text else text, links > 0))
        elif tag is not None:
            tag = tag.lower()
            if m[2]:
                if open_tags[tag] > 0:
                    to = len(stack) - 1
                    block = stack[to].block
                    while stack[to].tag != tag:
                        to -= 1
                        block = block or stack[to].block
                    if block:
                        close(to)
                    else:
                        for n in stack[to:]:
                            open_tags[n.tag] -= 1
                            links -= n.tag == "a"
                        del stack[to:]
                elif tag not in _INLINE:
                    events.append(None)
                continue
            group = 0 if tag in _CLOSES_P else _GROUPS.get(tag)
            if group is not None and (to := stack[-1].open[group]) > 0:
                close(to)
            if tag == "tr" and (to := stack[-1].open[3]) > 0:
                close(to)
            node = Node(tag, m[4], stack[-1], len(stack))
            nodes.append(node)
            if node.block:
                events.append(None)
            if tag == "br":
                events.append((stack[-1], " ", links > 0))
            elif tag not in _VOID and not m[4].endswith("/"):
                stack.append(node)
                open_tags[tag] += 1
                links += tag == "a"
    _settle(nodes, events)
    return nodes, events


def _settle(nodes: list[Node], events: list) -> None:
    """Decides which elements are no article, and sums the letters outside links and outside those."""
    holders = [n for n in nodes if n.tag in ("article", "main")] or [n for n in nodes if n.tag == "h1"][:1]
    for n in holders:
        while n is not None and not n.holds:
            n.holds, n = True, n.above
    titles = [n for n in nodes if n.tag == "h1"]
    title = titles[0] if len(titles) == 1 and not titles[0].main and _in_header(titles[0]) else None
    for n in nodes[1:]:
        n.out = n is not title and (n.above.out or n.out or (not n.holds and (n.hinted or n.tag == "form")))
    for e in events:
        if e is not None and not e[2] and not e[0].out:
            e[0].mass += len(e[1]) - e[1].count(" ")
    for n in reversed(nodes[1:]):
        n.above.mass += n.mass


def _in_header(n: Node) -> bool:
    """Whether a header is the only thing around the element that is no article."""
    seen = False
    while (n := n.above) is not None:
        if n.out and n.tag != "header":
            return False
        seen = seen or n.tag == "header"
    return seen


def _word(label: int, word: str, nth: int) -> int:
    return _path(label, f"{nth} {word}")


def _whole(label: int, text: str) -> int:
    return _path(label, "= " + text)


def tokens(page: str) -> dict[int, list]:
    """token: [name, kind (element, word or text), label around it, occurrences, letters that count as text]."""
    nodes, events = parse(page)
    out: dict[int, list] = {}
    linked = set()
    for e in events:
        if e is not None and (words := e[1].split()):
            box = e[0].box
            if box.words is None:
                box.words = []
            box.words += words
            if e[2] or e[0].out:
                linked.update((box.label, w) for w in words)
    partly = {label for label, _ in linked}
    # words that every instance of an element has, as often as the one that has them least
    common: dict[int, dict[str, int]] = {}
    for n in nodes[1:]:
        if n.block:
            words, have = n.words or [], common.get(n.label)
            if have is None:
                common[n.label] = Counter(words)
            elif have:
                seen = Counter(words)
                common[n.label] = {w: min(c, seen[w]) for w, c in have.items() if w in seen}
            row = out.setdefault(n.label, [n.name, "element", n.above.box.label, 0, 0])
            row[3] += 1
            row[4] += n.mass
            if words:
                text = " ".join(words)
                token = _whole(n.label, text)
                if token not in out:
                    out[token] = [text if len(text) <= SHOWN else text[:SHOWN] + "...", "text", n.label, 0, 0]
                row = out[token]
                row[3] += 1
                row[4] += sum(len(w) for w in words if (n.label, w) not in linked) if n.label in partly else len(text) - len(words) + 1
    for label, words in common.items():
        times = out[label][3]
        for w, c in words.items():
            letters = 0 if (label, w) in linked else len(w) * times
            for nth in range(c):
                out[_word(label, w, nth)] = [w, "word", label, times, letters]
    return out


_KINDS = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
_OCCURRENCE = "host string, token long, name string, kind string, around long, pages long, total long, mass long, v1 long, v2 long"
_NAMES = [c.split()[0] for c in _OCCURRENCE.split(", ")]


def occurrences(pages: DataFrame) -> DataFrame:
    """(host, token, name, kind, around, pages, total, mass, v1, v2) of the tokens that can be in a template. pages: key, host, page."""

    def run(batches):
        found: dict[tuple[str, int], list] = {}

        def flush():
            columns = list(zip(*((h, t, *r) for (h, t), r in found.items())))
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS)], names=_NAMES)

        for batch in batches:
            for key, host, page in zip(*(c.to_pylist() for c in batch.columns)):
                of_count: dict[int, int] = {}
                for token, (name, kind, around, n, mass) in tokens(page or "").items():
                    if (row := found.get((host, token))) is None:
                        row = found[host, token] = [name, kind, around, 0, 0, 0, 0, 0]
                    if (h := of_count.get(n)) is None:
                        h = of_count[n] = xxhash.xxh3_64_intdigest(b"%d %d" % (key, n))
                    row[3] += 1
                    row[4] += n
                    row[5] += mass
                    row[6] += h >> 32
                    row[7] += h & 0xFFFFFFFF
                if len(found) > HELD:
                    yield flush()
        if found:
            yield flush()

    sums = [F.sum(c).alias(c) for c in ("pages", "total", "mass", "v1", "v2")]
    found = pages.mapInArrow(run, _OCCURRENCE).groupBy("host", "token").agg(*(F.min(c).alias(c) for c in ("name", "kind", "around")), *sums)
    # a word or text of one page can't be told to be fixed
    return found.where("kind = 'element' or pages >= 2")


def classes(found: DataFrame) -> DataFrame:
    """Tokens on at least half of their host's pages, with host_pages and `valid`: whether their class is valid.

    A host has at most twice as many of these as a page of it has tokens on average."""
    most = found.groupBy("host").agg(F.max("pages").alias("host_pages"))
    often = found.join(most, "host").where("2 * pages >= host_pages")
    sizes = often.groupBy("host", "pages", "v1", "v2").agg(F.count("*").alias("__size"), F.count_if(F.col("kind") == "element").alias("__elements"))
    return often.join(sizes, ["host", "pages", "v1", "v2"]).withColumn("valid", F.expr("__size >= 2 and __elements >= 1")).drop("__size", "__elements")


def choose(rows: list[dict], host_pages: int) -> tuple[list[int], list[dict], list[dict]]:
    """(slots that hold the article, fixed words, nested template) from tokens as classes() has them."""
    elements = {r["token"]: r for r in rows if r["kind"] == "element"}
    fixed = [r for r in rows if r["kind"] != "element" and r["valid"]]
    children = defaultdict(list)
    for t, r in elements.items():
        children[r["around"]].append(t)
    # outer elements first; an element whose own surroundings are rare is a top of its own
    depth = {t: 1 for t, r in elements.items() if r["around"] not in elements}
    order = list(depth)
    for t in order:
        depth.update((c, depth[t] + 1) for c in children[t])
        order += children[t]

    def tag(label: int) -> str:
        return elements[label]["name"].partition(".")[0]

    def around_all(label: int) -> list[int]:
        out = []
        while (label := elements[label]["around"]) in elements:
            out.append(label)
        return out

    mass = {t: r["mass"] for t, r in elements.items()}
    # letters of fixed words and of fixed texts overlap
    both = {"word": defaultdict(int), "text": defaultdict(int)}
    for r in fixed:
        both[r["kind"]][r["around"]] += r["mass"]
    loose = defaultdict(int, {t: max(both["word"][t], both["text"][t]) for t in elements})
    for t in reversed(order):
        mass[t] -= loose[t]
        loose[elements[t]["around"]] += loose[t]
    if not any(m > 0 for m in mass.values()):
        # a host of copies, or without text
        mass, fixed = {t: r["mass"] for t, r in elements.items()}, []
    template = [{"token": r["token"], "name": r["name"], "kind": r["kind"], "inside": r["around"]} for r in rows if r["valid"]]
    once = [t for t, r in elements.items() if r["total"] == r["pages"] and mass[t] > 0]
    named = [t for t in once if tag(t) in ("article", "main")]
    pool = named or once
    if not pool:
        return [], fixed, template
    most = max(mass[t] for t in pool)
    core = max((t for t in pool if 2 * mass[t] >= most), key=lambda t: (depth[t], mass[t], t))
    chain = [core]
    while (around := elements[chain[-1]]["around"]) in elements:
        chain.append(around)
    on_chain, main = set(chain), core
    own_content = lambda q: [c for c in children[q] if c not in on_chain and tag(c) in _CONTENT and mass[c] > 0]
    for q in chain[1:]:
        if tag(q) not in ("html", "body") and own_content(q):
            main = q
    slots = [main]
    for q in [] if named else [*chain[chain.index(main) + 1 :], elements[chain[-1]]["around"]]:
        slots += own_content(q) if q not in elements or tag(q) == "body" else []
        slots += [c for c in children[q] if c not in on_chain and c not in slots and mass[c] >= SHARE * mass[main]]
    inside = set()
    for t in order:
        if t == main or elements[t]["around"] in inside:
            inside.add(t)
    if not any(tag(t) == "h1" and mass[t] > 0 for t in inside):
        # the only page of a host can't tell a title in a header from a site's name
        slots += [t for t in once if tag(t) == "h1" and t not in slots and (host_pages > 1 or not any(tag(a) == "header" for a in around_all(t)))]
    return slots, fixed, template


def templates(valid: DataFrame) -> DataFrame:
    """(host, slots, fixed, boxes, template) from classes(), boxes the elements that hold fixed words: a host's tokens go through one task; their number is that of a page's."""
    longs = pa.list_(pa.int64())
    kind = "host string, slots array<long>, fixed array<long>, boxes array<long>, template array<struct<token:long,name:string,kind:string,inside:long>>"

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["token"])
        slots, fixed, template = choose(rows, rows[0]["host_pages"])
        entry = pa.list_(pa.struct([("token", pa.int64()), ("name", pa.string()), ("kind", pa.string()), ("inside", pa.int64())]))
        lists = {"slots": slots, "fixed": [r["token"] for r in fixed], "boxes": sorted({r["around"] for r in fixed})}
        return pa.table({"host": pa.array([rows[0]["host"]], pa.string()), **{k: pa.array([v], longs) for k, v in lists.items()}, "template": pa.array([template], entry)})

    return valid.groupBy("host").applyInArrow(run, kind)


def _own_slots(nodes: list[Node]) -> list[int]:
    rows: dict[int, dict] = {}
    for n in nodes[1:]:
        if n.block:
            r = rows.setdefault(n.label, {"token": n.label, "name": n.name, "kind": "element", "around": n.above.box.label, "pages": 1, "total": 0, "mass": 0, "valid": True})
            r["total"] += 1
            r["mass"] += n.mass
    return choose(sorted(rows.values(), key=lambda r: r["token"]), 1)[0]


def extract(page: str | None, slots: list[int] | None, fixed: frozenset[int] = frozenset(), boxes: frozenset[int] = frozenset()) -> str:
    """Blocks of the slots' text, parted by line feeds; slots None or absent from the page are chosen on the page itself."""
    if not page:
        return ""
    nodes, events = parse(page)
    if not slots or not any(n.label == slots[0] and n.block for n in nodes):
        slots = _own_slots(nodes)
    wanted = set(slots) if slots else {0}
    nodes[0].inside = 0 in wanted
    for n in nodes[1:]:
        n.inside = n.above.inside or n.label in wanted

    kept = [e if e is None or (e[0].inside and not e[0].out) else () for e in [*events, None]]
    held_by = {e[0].box for e in kept if e and e[0].box.label in boxes}
    for e in kept:
        if e and e[0].box in held_by:
            if e[0].box.words is None:
                e[0].box.words = []
            e[0].box.words += e[1].split()
    same_on_all = {b for b in held_by if _whole(b.label, " ".join(b.words)) in fixed or all(_word(b.label, w, i) in fixed for w, c in Counter(b.words).items() for i in range(c))}
    varied: set[Node] = set()
    for e in kept:
        if e and e[0].box not in same_on_all and not e[1].isspace():
            n = e[0].box
            while n is not None and n not in varied:
                varied.add(n)
                n = n.above

    def is_fixed(box: Node) -> bool:
        """Whether a box with no varying text at all holds the text; headings, paragraphs and parts of lists and tables are no boxes."""
        while box.tag in _CONTENT or box.tag in _PARTS:
            box = box.above.box
        return box not in varied and box.label not in wanted

    blocks: list[tuple[str, bool]] = []
    held: list[str] = []
    for e in kept:
        if e:
            held.append(e[1])
            box = e[0].box
        elif e is None and held:
            text = " ".join("".join(held).split())
            if text:
                blocks.append((text, box in same_on_all and is_fixed(box)))
            held = []
    size, same = sum(len(t) for t, _ in blocks), sum(len(t) for t, f in blocks if f)
    return "\n".join(t for t, f in blocks if not f or 2 * same > size)


def host_of(url: str):
    return F.coalesce(F.lower(F.try_parse_url(F.col(url), F.lit("HOST"))), F.lit(""))


def deduced(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(host, slots, fixed, template) of all hosts of the pages."""
    rows = pages.select(F.xxhash64(key, url, page).alias("key"), host_of(url).alias("host"), F.col(page))
    return templates(classes(stored(occurrences(rows), "tokens")))


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", text: str = "text") -> DataFrame:
    """pages with `text`, the article of each page (the empty string if none)."""
    parts = ("slots", "fixed", "boxes")
    known = stored(deduced(pages, key, url, page).select(F.col("host").alias("__host"), F.struct(*parts).alias("__known")), "templates")
    keep = [f for f in pages.schema.fields if f.name != text]
    names = [f.name for f in keep]

    def run(batches):
        for batch in batches:
            column = lambda c: batch.column(batch.schema.get_field_index(c))
            sets: dict[str, tuple] = {}
            made = []
            for i, (body, host) in enumerate(zip(column(page).to_pylist(), column("__host").to_pylist())):
                if host not in sets:
                    own = column("__known")[i].as_py() or {}
                    sets[host] = own.get("slots"), frozenset(own.get("fixed") or ()), frozenset(own.get("boxes") or ())
                made.append(extract(body, *sets[host]))
            yield pa.RecordBatch.from_arrays([*map(column, names), pa.array(made, pa.string())], names=[*names, text])

    hosted = pages.drop(text).withColumn("__host", host_of(url))
    return hosted.join(known, "__host", "left").select(*names, "__host", "__known").mapInArrow(run, T.StructType([*keep, T.StructField(text, T.StringType())]))
