"""Main text of pages by template deduction from equivalence classes of tokens.

A page is read as tags (with their place: the chain of open block elements and their class or id) and text. Per host,
the occurrence vector of a place is how often it occurs on each page; places with equal vectors form an equivalence
class. A vector is summarised by its number of pages and a sum of keyed hashes of (page, count), so classes are found by
aggregation and no host's pages meet in one task. A class is valid if it occurs on at least half of the host's pages (and
on two or more) and its places nest, each inside the place that encloses it. The valid classes, nested by their places,
are the host's template; hosts whose pages are too few use the template of all pages together. What lies between
template tokens are the slots. Text outside the main element that recurs on most pages of a host is template too; on a
host of few pages, text that all of them have, if different pages have it and most text varies.

From the slots the article is read: the content of article or main elements when the template has them. Where it has
none, the template decides: from the top it is followed down to the place whose slots hold nearly all of the host's
varying text, with no paragraph or heading beside it, and the article is what varies there; a page that has most of its
text elsewhere is read whole, and article or main elements that few pages have are kept with it. Never read are slots
that are navigation, header, footer, sidebar, notice, advert, form, comment or code by their place. Words in
a class, id or role count as places too, but not on html, body and main, and only as whole names on what encloses the
article or main element with the most text. Inside a main element a header with a heading, and what is only named as a
header, is text; paragraphs, headings, lists and tables there go only if named as advert, comment or navigation.
Character references are decoded, white space in a block becomes one space, and blocks are joined in page order by one
space.

A null or empty html gives an empty text. A null url is a host of its own. Pages may repeat, ids may repeat or be null.
An empty table gives an empty result. Broken markup is read as browsers do: unknown or unclosed tags never lose text. A tag
whose quotes never close ends at the next ``>``, and so do the tags behind it; a ``<`` with no ``>`` behind it is text. Reading takes time and memory in
proportion to the page, however deep its elements nest. Other columns are ignored.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from helixframe.llm.common import save

MIN_PAGES = 4
MIN_SHARE = 0.5
# Text at a place is template when this share of the pages of a host, and this many, have it there.
TEXT_SHARE, TEXT_PAGES = 0.6, 8
# The article's place holds this share of the varying text of a host; text counts as varying where this share varies.
SLOT_SHARE, VARYING_SHARE = 0.8, 0.5
ALL_HOSTS, ELSEWHERE = "*", "?"

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table html body div article section main aside nav header footer form".split())

# Elements and words in a class, id or role that mark what is not the article.
SIDE_TAGS = frozenset("nav header footer aside form menu dialog button select option script style head title noscript template iframe svg object textarea input label fieldset".split())
SIDE_WORDS = frozenset("""ad ads advert adverts advertisement advertising adsense adslot banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb
 breadcrumbs header masthead footer foot sidebar side aside rail widget related recommended recommendations notice notices cookie cookies consent gdpr banner popup modal
 newsletter subscribe subscription signup login share sharing social comment comments reply replies disqus respond reader-comments pagination pager toolbar form search tags
 contentinfo complementary copyright legal alert overlay""".split())
COMMENT_WORDS = frozenset("comment comments reply replies disqus respond".split())
# Inside the main element: words that do not name what the article is without, and those that count for paragraphs and the like.
TOPIC_WORDS = frozenset("related tags alert legal header masthead".split())
FLOW_WORDS = COMMENT_WORDS | frozenset("""ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored nav navbar navigation menu breadcrumb breadcrumbs
 share sharing social pagination pager toolbar sidebar""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN_TAGS = frozenset(["article", "main"])
FLOW_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre table ul ol dl li figure figcaption".split())
WHOLE_TAGS = frozenset(["html", "body", "main"])
MAIN_WORDS = frozenset("article main-content article-body post-content entry-content post-body story-body articlebody maincontent".split())

TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)")
VALUE = re.compile(r"=\s*([\"'])|>")
# Names begin behind a blank, a slash or a quote, so each character is looked at once.
ATTRIBUTE = re.compile(r"(?<![^\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
DIGIT = re.compile(r"\d")


def host_of(url: Column) -> Column:
    """Host of a URL in lower case; empty for null."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]*)", 1), F.lit(""))


class Node:
    """An open element. ``settle`` says whether it is beside or in the main text, when the page has been read.

    Its place is a number made of the place around it and its label, as a path would grow with the depth.
    """

    __slots__ = ("tag", "label", "place", "side", "main", "names", "parts", "parent", "size", "heading", "within", "templated")

    def __init__(self, tag: str, attributes: str, parent: Node | None):
        self.tag, self.parent, self.size, self.heading = tag, parent, 0, False
        words = " ".join(a or b or c for _, a, b, c in ATTRIBUTE.findall(attributes)).lower() if "=" in attributes else ""
        self.names = frozenset(words.split())
        self.parts = self.names | set(re.split(r"[^a-z0-9]+", words)) if words else self.names
        self.side = self.main = self.within = self.templated = False
        # Numbers in a class or id are those of one page.
        self.label = ".".join([tag, *sorted(x for x in self.parts if x and not DIGIT.search(x))]) if words else tag
        self.place = xxhash.xxh64_hexdigest(f"{parent.place}/{self.label}") if parent is not None else ""

    @property
    def names_main(self) -> bool:
        return self.tag in MAIN_TAGS or not MAIN_WORDS.isdisjoint(self.parts)

    def settle(self, wrappers: set[Node]) -> None:
        tag, parent = self.tag, self.parent
        inside = parent is not None and parent.main
        # Classes of a page, or of what encloses its main element, describe the layout; inside, some words describe the text.
        if tag in WHOLE_TAGS:
            side = False
        elif self in wrappers:
            side = not SIDE_WORDS.isdisjoint(self.names)
        elif inside:
            side = not (FLOW_WORDS if tag in FLOW_TAGS else SIDE_WORDS - TOPIC_WORDS).isdisjoint(self.parts)
        else:
            side = not SIDE_WORDS.isdisjoint(self.parts)
        side = side and (tag != "article" or not COMMENT_WORDS.isdisjoint(self.parts))
        # A heading block inside the article belongs to it.
        if tag in SIDE_TAGS and not (tag == "header" and inside and (self.heading or not self.names)):
            side = True
        self.side = side or parent is not None and parent.side
        self.main = self.names_main and not side or inside


def settle(nodes: list[Node], texts: list[tuple[str, Node, bool]]) -> None:
    """Find the main element with the most text and the article with the most in it, and so what wraps them."""
    for part, node, _ in texts:
        node.size += len(part)
    for node in reversed(nodes):  # children come before their parents
        if node.parent is None:
            continue
        if node.tag not in SIDE_TAGS:
            node.parent.size += node.size
        if node.tag != "article" and (node.heading or node.tag in HEADINGS):
            node.parent.heading = True
    wrappers: set[Node] = set()
    within = None
    for tag in ("main", "article"):
        below = {within}
        for node in nodes:  # parents come before their children
            if node.parent in below:
                below.add(node)
        found = [n for n in nodes if n.tag == tag and (within is None or n in below)]
        if found:
            within = max(found, key=lambda n: n.size)
            node = within
            while node is not None:
                wrappers.add(node)
                node = node.parent
    for node in nodes:
        node.settle(wrappers)


def pieces(html: str) -> Iterator[tuple[str, str, bool, str, int]]:
    """(text before, tag, whether it closes, attributes, end) for each tag; comments and declarations have no tag. ``send`` the place to go on at.

    Each character is looked at a bounded number of times.
    """
    at = start = 0
    last, quotes = html.rfind(">"), True
    while (begin := html.find("<", at)) >= 0:
        tag = TAG.match(html, begin)
        if tag is None or begin > last:
            if html.startswith(("<!", "<?"), begin):
                mark = "-->" if html.startswith("<!--", begin) else ">"
                end = html.find(mark, begin + 2)
                end = len(html) if end < 0 else end + len(mark)
                at = start = (yield html[start:begin], "", False, "", end) or end
            else:
                at = begin + 1
            continue
        end = tag.end()
        while quotes:
            found = VALUE.search(html, end)
            if found and not found[1]:
                end = found.start()
                break
            close = html.find(found[1], found.end()) if found else -1
            quotes, end = close >= 0, close + 1
        if not quotes:
            end = html.index(">", tag.end())
        at = start = (yield html[start:begin], tag[1].lower(), html[begin + 1] == "/", html[tag.end() : end], end + 1) or end + 1
    yield html[start:], "", False, "", len(html)


def read(html: str) -> tuple[list[Node], list[tuple[str, Node, bool]]]:
    """The block elements in order, first the page itself, and (text, element, whether a block starts before it)."""
    root = Node("", "", None)
    stack, texts, nodes = [root], [], [root]
    # Where each tag is open, and where the elements are that end the search for one to close.
    open_at: dict[str, list[int]] = {}
    scopes = [0]
    fresh = True

    def close(to: int) -> None:
        while len(stack) > to:
            tag = stack.pop().tag
            open_at[tag].pop()
            if tag in SCOPE:
                scopes.pop()

    scan = pieces(html)
    at = None
    while True:
        try:
            before, tag, closing, attributes, end = scan.send(at)
        except StopIteration:
            break
        at = None
        if before:
            texts.append((before, stack[-1], fresh))
            fresh = False
        if not tag or tag in INLINE:
            continue
        fresh = True
        if closing:
            where = open_at.get(tag)
            if where and (tag in SCOPE or where[-1] > scopes[-1]):
                close(where[-1])
            continue
        closed = CLOSES.get(tag, set()) | ({"p"} if tag in CLOSES_P else set())
        where = max((open_at[x][-1] for x in closed if open_at.get(x)), default=0)
        if where > scopes[-1]:
            close(where)
        node = Node(tag, attributes, stack[-1])
        nodes.append(node)
        if tag in RAW:
            found = re.compile(rf"</{tag}\s*>", re.I).search(html, end)
            at = found.end() if found else len(html)
        elif tag not in VOID and not attributes.endswith("/"):
            open_at.setdefault(tag, []).append(len(stack))
            if tag in SCOPE:
                scopes.append(len(stack))
            stack.append(node)
    settle(nodes, texts)
    return nodes, texts


def squeeze(text: str) -> str:
    return " ".join(references.unescape(text).split())


def blocks(texts: list[tuple[str, Node, bool]]) -> list[tuple[str, Node]]:
    """Text per block; inline markup does not split it."""
    out: list[tuple[list[str], Node]] = []
    for part, node, fresh in texts:
        if fresh or not out:
            out.append(([part], node))
        else:
            out[-1][0].append(part)
    squeezed = ((squeeze("".join(parts)), node) for parts, node in out)
    return [(t, node) for t, node in squeezed if t]


def occurrences(pages: DataFrame) -> DataFrame:
    """(host, token, kind, parent, label, n, hash) per page and token: how often each place, and each text outside the main element, occurs."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                hosts, tokens, kinds, parents, labels, counts, marks = [], [], [], [], [], [], []
                for host, html in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True):
                    nodes, texts = read(html or "")
                    first = {x.place: x for x in nodes[1:]}
                    page = xxhash.xxh64_intdigest((html or "").encode())
                    seen = [((p, "place"), n) for p, n in Counter(x.place for x in nodes[1:]).items()]
                    seen += [((f"{node.place}\n{t}", "text"), n) for (t, node), n in Counter((t, node) for t, node in blocks(texts) if not node.main and not node.side).items()]
                    for (token, kind), n in seen:
                        hosts.append(host)
                        tokens.append(token)
                        kinds.append(kind)
                        parents.append(first[token].parent.place if kind == "place" else "")
                        labels.append(first[token].label if kind == "place" else "")
                        counts.append(n)
                        marks.append(xxhash.xxh64_intdigest(f"{page}:{n}", seed=1) >> 16)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hosts, pa.string()), pa.array(tokens, pa.string()), pa.array(kinds, pa.string()), pa.array(parents, pa.string()),
                     pa.array(labels, pa.string()), pa.array(counts, pa.int64()), pa.array(marks, pa.int64())], ["host", "token", "kind", "parent", "label", "n", "mark"])

    return pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(
        rows, "host string, token string, kind string, parent string, label string, n long, mark long")


def templates(pages: DataFrame) -> DataFrame:
    """(host, n_pages, places as "place, tab, place around it, tab, label", constants, slots): the nested valid classes of each host, and of all hosts together as ``*``."""
    seen = occurrences(pages)
    own = seen.groupBy("host", "kind", "token").agg(
        F.first("parent").alias("parent"), F.first("label").alias("label"), F.count(F.lit(1)).alias("pages"), F.sum("n").alias("total"), F.sum(F.col("mark").cast("decimal(38,0)")).alias("vector"),
        (F.min("mark") != F.max("mark")).alias("differ"))
    # Pages are read once for this; what follows works on one row per host and token.
    own = save(own, "places")
    everywhere = own.where("kind = 'place'").groupBy("kind", "token").agg(
        F.first("parent").alias("parent"), F.first("label").alias("label"), F.sum("pages").alias("pages"), F.sum("total").alias("total"), F.sum("vector").alias("vector"))
    counted = own.unionByName(everywhere.select(F.lit(ALL_HOSTS).alias("host"), "kind", "token", "parent", "label", "pages", "total", "vector", F.lit(True).alias("differ")))
    n_pages = pages.select(host_of(F.col("url")).alias("host")).groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"))
    n_pages = n_pages.unionByName(n_pages.agg(F.sum("n_pages").alias("n_pages")).select(F.lit(ALL_HOSTS).alias("host"), "n_pages"))
    sized = counted.join(n_pages, "host")
    often = sized.where((F.col("pages") >= F.greatest(F.lit(2), F.col("n_pages") * MIN_SHARE)) & (F.col("kind") == "place"))
    # An equivalence class is one row; it holds at most twice the places of an average page, as each is on half of them.
    grouped = often.groupBy("host", "pages", "vector", "n_pages").agg(
        F.collect_list(F.struct("token", "parent", "label")).alias("members"))
    held = grouped.groupBy("host", "n_pages").agg(F.collect_list("members").alias("classes"))
    place = F.substring_index("token", "\n", 1)
    recurs = (F.col("pages") >= TEXT_PAGES) & (F.col("pages") >= F.col("n_pages") * TEXT_SHARE)
    on_all = (F.col("n_pages") < TEXT_PAGES) & (F.col("pages") == F.col("n_pages")) & F.col("differ")
    texts = sized.where("kind = 'text'").select(
        "host", "token", place.alias("place"), (F.col("total") * (F.length("token") - F.length(place) - 1)).alias("chars"), recurs.alias("recurs"), on_all.alias("on_all"))
    # Few pages tell template and article apart only if most of their text varies.
    telling = texts.groupBy("host").agg((F.sum(F.when(F.col("on_all"), 0).otherwise(F.col("chars"))) >= VARYING_SHARE * F.sum("chars")).alias("telling"))
    marked = texts.join(telling, "host").select("host", "token", "place", "chars", (F.col("recurs") | F.col("on_all") & F.col("telling")).alias("constant"))
    constants = marked.where("constant").groupBy("host").agg(F.collect_set("token").alias("constants"))  # at most 1 / TEXT_SHARE texts per block of a page
    # Varying text per place of the template, as "characters, tab, place"; all that is in other places is one slot.
    varying = marked.where("NOT constant").groupBy("host", "place").agg(F.sum("chars").alias("chars"))
    known = often.select("host", F.col("token").alias("place"), F.lit(True).alias("known"))
    named = varying.join(known, ["host", "place"], "left").select(
        "host", F.when(F.col("known") | (F.col("place") == ""), F.col("place")).otherwise(ELSEWHERE).alias("place"), "chars")
    slots = named.groupBy("host", "place").agg(F.sum("chars").alias("chars")).groupBy("host").agg(
        F.sort_array(F.collect_list(F.concat_ws("\t", "chars", "place"))).alias("slots"))
    # Nesting: a class stays if every place in it has its enclosing place in a class of the template, or at the top.
    every = F.flatten("classes")
    names = F.concat(F.array(F.lit("")), F.transform(every, lambda m: m["token"]))
    nested = F.filter("classes", lambda c: F.size(F.array_except(F.transform(c, lambda m: m["parent"]), names)) == 0)
    written = F.transform(F.flatten(nested), lambda m: F.concat_ws("\t", m["token"], m["parent"], m["label"]))
    return held.select("host", "n_pages", written.alias("places")).join(
        constants, "host", "left").join(slots, "host", "left")


def article_place(places: frozenset, tree: tuple[str, ...], slots: tuple[str, ...]) -> str:
    """Place that holds the varying text of a host, given the host's places, how much is where, and the template."""
    tags: dict[str, str] = {}
    children: dict[str, list[str]] = {}
    for place, parent, label in sorted(x.split("\t", 2) for x in tree):
        tags[place] = label.partition(".")[0]
        children.setdefault(parent, []).append(place)
    held = {place: int(chars) for chars, place in (x.split("\t", 1) for x in slots)}
    order, rest = [], [""]
    while rest:
        order.append(rest.pop())
        rest += children.get(order[-1], [])
    size, flows = {}, {}  # text in a place, and whether some of it is in a paragraph or heading
    for place in reversed(order):
        below = children.get(place, [])
        size[place] = held.get(place, 0) + sum(size[x] for x in below)
        flows[place] = size[place] > 0 and tags.get(place) in FLOW_TAGS or any(flows[x] for x in below)
    least, at = SLOT_SHARE * sum(held.values()), ""
    while True:
        child = max(children.get(at, []), key=lambda x: size[x], default="")
        if not child or not size[child] or size[child] < least or child not in places or tags[child] in FLOW_TAGS:
            return at
        if held.get(at) or any(flows[x] for x in children[at] if x != child):
            return at
        at = child


def article(html: str | None, places: frozenset, constants: frozenset, at: str = "", own: bool = False) -> str:
    """Main text of a page, given the template of its host and the article's place; ``own`` if the host has it for itself."""
    if not html:
        return ""
    nodes, texts = read(html)
    for node in nodes:
        node.within = node.place == at or node.parent is not None and node.parent.within
        node.templated = node.main and node.names_main and node.place in places or node.parent is not None and node.parent.templated
    slots = [(t, node) for t, node in blocks(texts) if not node.side]
    named = [t for t, node in slots if node.main]
    if named and (not own or any(node.templated for _, node in slots if node.main)):
        return " ".join(named)
    free = [(t, node) for t, node in slots if node.main or f"{node.place}\n{t}" not in constants]
    chosen = [(t, node) for t, node in free if node.main or node.within]
    size = lambda pairs: sum(len(t) for t, node in pairs if not node.main)
    if 2 * size(chosen) < size(free):
        chosen = free
    # A main element that the template does not have is all of the article only if it outweighs the rest.
    if named and sum(map(len, named)) >= size(chosen):
        return " ".join(named)
    return " ".join(t for t, _ in chosen)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row."""
    found = save(templates(pages), "templates")
    shared = {r["host"]: r for r in found.where(F.col("host") == ALL_HOSTS).collect()}.get(ALL_HOSTS)  # one row
    fallback = frozenset(x.partition("\t")[0] for x in shared["places"]) if shared else frozenset()
    own = found.where((F.col("host") != ALL_HOSTS) & (F.col("n_pages") >= 2)).select(
        "host", (F.col("n_pages") >= MIN_PAGES).alias("own"), "places", "constants", "slots")
    joined = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host")).join(own, "host", "left").select(
        "page_id", "url", "html", "own", "places", "constants", "slots")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[tuple, tuple] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = []
                for html, enough, *known in zip(*(part.column(c).to_pylist() for c in ("html", "own", "places", "constants", "slots")), strict=True):
                    key = (bool(enough), *(tuple(x or ()) for x in known))
                    if key not in sets:
                        if len(sets) > 500:
                            sets.clear()
                        own_places = frozenset(x.partition("\t")[0] for x in key[1])
                        template = own_places if key[0] and own_places else fallback
                        sets[key] = (template, frozenset(key[2]), article_place(template, key[1], key[3]), key[0] and bool(own_places))
                    texts.append(article(html, *sets[key]))
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    fields = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    read_out = joined.mapInArrow(rows, f"page_id {fields['page_id']}, url string, text string")
    return read_out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
