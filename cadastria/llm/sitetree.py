"""Main text of web pages by site style trees.

The pages of a host are merged into one style tree: a node for each path of element labels (tag and
class). A node gathers over its pages how its children are laid out (presentation) and what it says
(content). The importance of a node is the entropy of either distribution, with the number of pages as
the base: 0 where all pages show the same, 1 where no two agree. Nodes of low importance are the
site's template; their branches are removed from each page, and so are branches that their tag, role or
class names as navigation, adverts, notices, forms, comments or the like; inside main content only
a whole class or id does that, and never an id made from a heading. A node stays as long as a node below
it does. Nodes seen on few pages count as important.

What the page marks as its main content is judged too, with a prior that raises its importance. Since
paragraphs there share a path, each is also judged by what it says: its importance is the self-information
of that text among the pages that have such a node, with their number as the base. What is repeated between
parts of the article's own is the article's, a list item or a cell as much as a paragraph: only a run of template at the very
beginning or end of the main content goes, and only if it says ``LEAST_WORDS`` words or has a heading of its own that is template too. A
label (heading, table cell, term) goes only if what it labels goes. A page whose whole main content would go keeps it.
Copies of a page on one host would make it look like template, so each distinct page of a host counts
once, and inside main content each distinct main content.

Distinct pages are told by digest, one row of digests a page. The tree is merged as counts per (host,
path, layout, content), which combine before the shuffle, so a host with a third of all pages is no single
task's work. Pages meet their host's template in parts of about ``PART_PAGES``, and the template is sent once a part, ahead of its pages.

Null html is empty and gives an empty text. A page without a host in its url belongs to the host ''.
Repeated rows give repeated rows. Columns other than page_id, url and html are left out.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastria.llm.common import slices, written

#: What a node is counted by.
LAYOUT, CONTENT, TEXT = range(3)
#: Below this a branch is template; so many pages are needed to say so.
LEAST_IMPORTANCE = 0.2
LEAST_PAGES = 5
#: Weight of content against presentation.
CONTENT_WEIGHT = 0.7
#: Importance of marked main content before anything is known of it.
MAIN_PRIOR = 0.1
#: A template run at an edge of main content, without a heading, says so many words at least.
LEAST_WORDS = 8
LONGEST_PATH = 400
#: Pages of a host that share one copy of its template.
PART_PAGES = 250

TOKEN = re.compile(
    r"<(?:(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|/?[a-zA-Z][^>]*\Z)", re.DOTALL)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
INLINE = set("a abbr b bdi bdo big cite code del dfn em font i img ins kbd label mark q s samp small "
             "span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp noscript iframe".split())
#: An opening tag of the first kind ends an open element of the second.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}
HOLDS = {"ul", "ol", "dl", "table", "select", "body", "html", "article", "main", "div", "section"}

#: Names that say what a branch is.
ASIDE_TAGS = set("head nav footer aside form script style noscript template iframe button select textarea svg "
                 "dialog menu title object canvas audio video input".split())
ASIDE_ROLES = set("navigation banner contentinfo search complementary dialog alert alertdialog menu menubar form".split())
ASIDE_NAMES = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice popup modal newsletter subscribe subscription sidebar menu nav navbar navigation breadcrumb "
    "breadcrumbs footer header masthead comment comments disqus replies share sharing social related widget".split())
COMMENT_NAMES = set("comment comments disqus replies".split())
#: What a class may add to such a name and still say nothing else.
FRAME_NAMES = set("top bottom left right inner outer box block area bar body list item items link links button buttons icons "
                  "form signup container wrapper wrap section unit slot sticky inline x js".split())
MAIN_TAGS = {"article", "main"}
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: Elements that say what the one behind them is.
LABEL_TAGS = HEADINGS | {"td", "th", "dt"}
#: Elements that don't show and so don't end a word either.
UNSEEN = {"script", "style", "template", "noscript", "title"}


@dataclass
class Node:
    tag: str
    attributes: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)

    def names(self) -> list[str]:
        return re.findall(r"[a-z]+", f"{self.attributes.get('class', '')} {self.attributes.get('id', '')}".lower())

    def label(self) -> str:
        return ".".join([self.tag, *sorted(self.attributes.get("class", "").split())])

    def is_main(self) -> bool:
        return self.tag in MAIN_TAGS or self.attributes.get("role") == "main"

    def is_aside(self, in_main: bool) -> bool:
        if self.is_main():
            # one inside another, or a reader's comment, may be an aside all the same
            return self.tag == "article" and self.attributes.get("role") != "main" and self.is_named(ASIDE_NAMES if in_main else COMMENT_NAMES)
        return (self.tag in ASIDE_TAGS or self.attributes.get("role") in ASIDE_ROLES or self.tag == "header" and not in_main
                or (self.is_named(ASIDE_NAMES) if in_main else not ASIDE_NAMES.isdisjoint(self.names())))

    def is_named(self, names: set[str]) -> bool:
        """Whether a whole class, or an id that isn't made from a heading, is one of ``names`` or its frame."""
        def is_one(token: str) -> bool:
            parts = set(re.findall(r"[a-z]+", token.lower()))
            return not names.isdisjoint(parts) and parts <= names | FRAME_NAMES

        if any(map(is_one, self.attributes.get("class", "").split())):
            return True
        own = self.attributes.get("id", "")
        return self.tag not in HEADINGS and is_one(own) and re.findall(r"\w+", own.lower()) != self.heading_words()

    def heading_words(self) -> list[str]:
        """The words of the heading that the element begins with."""
        first = next((c for c in self.children if not isinstance(c, str) or c.strip()), "")
        return re.findall(r"\w+", " ".join(blocks(first)).lower()) if isinstance(first, Node) and first.tag in HEADINGS else []


def path_to(path: str, child: Node) -> str:
    """The path of a child; a long one is named by its digest, so that deep pages have short paths too."""
    below = f"{path}/{child.label()}"
    return below if len(below) <= LONGEST_PATH else f"#{digest(below)}"


def parse(source: str) -> Node:
    """The element tree of a page, with open elements ended as browsers end them."""
    root = Node("root")
    stack = [root]
    at = 0

    def say(text: str) -> None:
        if text:
            stack[-1].children.append(html.unescape(text) if "&" in text else text)

    def end(tags: set[str], until: set[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                del stack[i:]
                return
            if stack[i].tag in until:
                return

    while found := TOKEN.search(source, at):
        say(source[at:found.start()])
        at = found.end()
        tag = (found["tag"] or "").lower()
        if not tag:
            continue
        if found["close"]:
            end({tag}, set())
            continue
        if tag not in INLINE and tag != "br":
            end({"p"}, HOLDS)
        if tag in ENDS:
            end(ENDS[tag], HOLDS)
        rest = found["rest"]
        attributes = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(rest)} if rest else {}
        node = Node(tag, attributes)
        stack[-1].children.append(node)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.IGNORECASE).search(source, at)
            node.children.append(source[at:close.start() if close else len(source)])
            at = close.end() if close else len(source)
        elif tag not in VOID and not rest.endswith("/"):
            stack.append(node)
    say(source[at:])
    return root


def blocks(node: Node) -> list[str]:
    """The texts of the block elements below ``node``, in order, with single spaces."""
    out, line = [], []

    def flush() -> None:
        text = " ".join("".join(line).split())
        line.clear()
        if text:
            out.append(text)

    todo: list = [node]
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            line.append(x)
        elif x.tag == "br":
            line.append(" ")
        elif x.tag in INLINE:
            todo += reversed(x.children)
        else:
            flush()
            todo.append(None)
            todo += reversed(x.children)
    flush()
    return out


def without(node: Node, template: frozenset[str] = frozenset()) -> None:
    """Takes asides out of the tree, then branches in ``template`` that hold nothing but template."""
    todo = [(node, "", False)]
    judged = []
    by_text = {entry.partition(" ")[0] for entry in template if " " in entry}
    while todo:
        x, path, in_main = todo.pop()
        left = []
        for child in x.children:
            if isinstance(child, str):
                left.append(child)
                continue
            if child.is_aside(in_main):
                left += [] if child.tag in INLINE or child.tag in UNSEEN else [" "]
                continue
            left.append(child)
            if child.children:
                below, main = path_to(path, child), in_main or child.is_main()
                todo.append((child, below, main))
                if (in_main or not main) and (below in template or below in by_text):
                    judged.append((x, child, below, in_main))
        x.children = left
    gone: set[int] = set()
    behind = {id(child): then for x in {id(x): x for x, *_ in judged}.values()
              for elements in [[c for c in x.children if not isinstance(c, str)]] for child, then in zip(elements, elements[1:])}
    low = {id(child) for _, child, path, _ in judged if path in template or f"{path} {said(own_text(child))}" in template}
    at_edge = edges(node, low)
    # children come after their parents, and the ones behind after the ones before
    for parent, child, path, in_main in reversed(judged):
        if id(child) not in low or in_main and id(child) not in at_edge:
            continue
        if not all(isinstance(c, str) or c.tag in INLINE or c.tag in VOID or id(c) in gone for c in child.children):
            continue
        if in_main and child.tag in LABEL_TAGS and id(child) in behind and id(behind[id(child)]) not in gone:
            continue
        gone.add(id(child))
    for x in {id(x): x for x, *_ in judged}.values():
        x.children = [" " if id(c) in gone else c for c in x.children]


def edges(node: Node, low: set[int]) -> set[int]:
    """The nodes of ``low`` that main content begins or ends with, as far as such a run is worth the name."""
    out: set[int] = set()
    for main in mains(node) if low else []:
        # what says something, in page order
        items, todo = [], list(reversed(main.children))
        while todo:
            x = todo.pop()
            if isinstance(x, str) or x.tag in INLINE:
                if isinstance(x, str) and x.strip() or not isinstance(x, str) and own_text(x):
                    items.append((None, 0))
                continue
            words = own_text(x)
            if words:
                items.append((x if id(x) in low else None, len(words)))
            todo += [c for c in reversed(x.children) if not isinstance(c, str) and c.tag not in INLINE]
        first = next((i for i, (x, _) in enumerate(items) if x is None), len(items))
        last = next((i for i in range(len(items), 0, -1) if items[i - 1][0] is None), 0)
        for run, is_last in ((items[:first], False), (items[last:], True)):
            if sum(n for _, n in run) < LEAST_WORDS:
                headed = next((i for i, (x, _) in enumerate(run) if is_last and x.tag in HEADINGS), len(run))
                run = run[headed:]
            out |= {id(x) for x, _ in run}
    return out


def mains(node: Node) -> list[Node]:
    """The outermost elements that the page marks as main content."""
    out, todo = [], [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            continue
        if x.is_main():
            out.append(x)
        else:
            todo += reversed(x.children)
    return out


def text_of(root: Node) -> str:
    return " ".join(b for part in mains(root) or [root] for b in blocks(part))


def main_text(source: str, template: frozenset[str] = frozenset()) -> str:
    root = parse(source)
    without(root, template)
    text = text_of(root)
    if not text and template and mains(root):
        root = parse(source)
        without(root)
        text = text_of(root)
    return text


def digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def said(words: list[str]) -> int:
    return digest(" ".join(words))


def own_text(node: Node) -> list[str]:
    """What a branch says outside block elements with a node of their own."""
    out, todo = [], list(reversed(node.children))
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out += x.split()
        elif x.tag in INLINE:
            todo += reversed(x.children)
    return out


def styles(source: str) -> list[tuple[bool, tuple[int, list[tuple[str, int, int]]]]]:
    """The page's nodes outside and inside main content, each part with a digest that equal parts share.

    A node gives its path with its layout (LAYOUT) and content (CONTENT); equal paths of a page are one node.
    Inside main content it also gives the distinct texts of its elements (TEXT).
    """
    root = parse(source)
    without(root)
    parts: list[dict] = [{}, {}]
    todo = [(root, "", False)]
    while todo:
        x, path, in_main = todo.pop()
        for child in x.children:
            if isinstance(child, str) or child.tag in INLINE or child.tag in VOID:
                continue
            below, main = path_to(path, child), in_main or child.is_main()
            layout, content, texts = parts[main].setdefault(below, ([], [], set()))
            layout += [c.label() for c in child.children if not isinstance(c, str)]
            own = own_text(child)
            content += own
            if in_main and own:
                texts.add(said(own))
            todo.append((child, below, main))
    keys = [digest(source), digest("\n".join(b for part in mains(root) for b in blocks(part)))]
    return [(main, (key, [row for path, (layout, content, texts) in nodes.items() for row in (
        (path, LAYOUT, digest(" ".join(dict.fromkeys(layout)))), (path, CONTENT, said(content)), *((path, TEXT, t) for t in texts))]))
        for main, key, nodes in zip((False, True), keys, parts) if nodes]


def rows_of(pages: DataFrame) -> DataFrame:
    host = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url"), F.lower(host).alias("host"),
                        F.coalesce("html", F.lit("")).alias("html"))


def node_counts(pages: DataFrame) -> DataFrame:
    """host, path, main, kind, value and n: on how many distinct pages of the host the node has the value."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            rows = [(host, main, key, *map(list, zip(*nodes)))
                    for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist())
                    for main, (key, nodes) in styles(source)]
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (
                pa.string(), pa.bool_(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int64())))],
                ["host", "main", "key", "path", "kind", "value"])

    seen = rows_of(pages).select("host", "html").mapInArrow(
        read, "host string, main boolean, key long, path array<string>, kind array<int>, value array<long>")
    return (seen.dropDuplicates(["host", "main", "key"])
            .select("host", "main", F.explode(F.arrays_zip("path", "kind", "value")).alias("x"))
            .groupBy("host", "x.path", "main", "x.kind", "x.value").agg(F.count("*").alias("n")))


def merged_trees(counts: DataFrame) -> DataFrame:
    is_kind = lambda k, c: F.when(F.col("kind") == k, c)
    n = F.col("n")
    sums = counts.groupBy("host", "path", "main").agg(
        F.sum(is_kind(LAYOUT, n)).alias("n_pages"),
        *[F.sum(is_kind(k, n * F.log("n"))).alias(f"s{k}") for k in (LAYOUT, CONTENT)],
        # only texts on several pages can be template
        F.collect_list(is_kind(TEXT, F.when(n >= LEAST_PAGES, F.struct("value", "n")))).alias("texts"))
    m = F.col("n_pages")
    entropy = lambda k: F.when(m == 1, 1.0).otherwise((F.log(m) - F.col(f"s{k}") / m) / F.log(m))
    return sums.select("host", "path", "main", "n_pages", entropy(LAYOUT).alias("presentation"),
                       entropy(CONTENT).alias("content"), "texts").withColumn(
        "importance", with_prior((1 - CONTENT_WEIGHT) * F.col("presentation") + CONTENT_WEIGHT * F.col("content")))


def with_prior(importance: Column) -> Column:
    return F.when(F.col("main"), MAIN_PRIOR + (1 - MAIN_PRIOR) * importance).otherwise(importance)


def site_trees(pages: DataFrame) -> DataFrame:
    """host, path, main, n_pages, presentation, content and importance of every node of the merged trees."""
    return merged_trees(node_counts(pages)).drop("texts")


def templates(pages: DataFrame) -> DataFrame:
    """host and path of the nodes of low importance, or path and digest where one text of a node is of low importance."""
    trees = merged_trees(node_counts(pages)).filter(F.col("n_pages") >= LEAST_PAGES)
    m = F.col("n_pages")
    is_low = lambda t: with_prior(F.log(m / t["n"]) / F.log(m)) < LEAST_IMPORTANCE
    texts = F.transform(F.filter("texts", is_low), lambda t: F.concat_ws(" ", "path", t["value"].cast("string")))
    whole = F.when(F.col("importance") < LEAST_IMPORTANCE, F.array("path")).otherwise(texts)
    return trees.select("host", F.explode(whole).alias("path"))


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url and ``text``, the main text of every page."""
    rows = rows_of(pages)
    # large hosts only, at most one for every PART_PAGES pages; a table, whose size Spark knows before it joins
    large = written(rows.groupBy("host").count().filter(F.col("count") > PART_PAGES).select(
        "host", F.ceil(F.col("count") / PART_PAGES).cast("int").alias("parts")), "hosts")
    parts = F.coalesce("parts", F.lit(1))
    template = (templates(pages).groupBy("host").agg(F.collect_list("path").alias("template")).join(large, "host", "left")
                .select("host", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), "template"))
    placed = rows.join(large, "host", "left").select(
        "host", F.pmod(F.xxhash64("page_id", "html"), parts).cast("int").alias("part"), "page_id", "url", "html")
    met = (placed.unionByName(template, allowMissingColumns=True).repartition("host", "part")
           .sortWithinPartitions("host", "part", F.col("template").isNull()))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, known = None, frozenset()
        for batch in slices(batches, "html"):
            page, texts = [], []
            of_batch = (batch.column(c).to_pylist() for c in ("host", "part", "html", "template"))
            for i, (host, part, source, template) in enumerate(zip(*of_batch)):
                if key != (host, part):
                    key, known = (host, part), frozenset()
                if template is not None:
                    known = frozenset(template)
                else:
                    page.append(i)
                    texts.append(main_text(source, known))
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(page, pa.int64())) for c in ("page_id", "url")),
                                              pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return met.mapInArrow(extract, "page_id long, url string, text string")
