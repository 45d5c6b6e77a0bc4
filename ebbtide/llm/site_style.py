"""Main text of web pages by site style trees."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ebbtide.llm.staging import batches, id_back, id_or_least, keep, only

SLICE = 4 << 20
TREE_DEPTH = 32  # deeper elements share the style node above them
# Fixed values of HTML: elements without content, raw elements, and elements that make a block.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT = frozenset(("head title script style noscript template iframe svg math object canvas "
                    "select option textarea audio video map datalist button").split())
BLOCKS = frozenset((
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu "
    "nav ol p pre section summary table tbody td tfoot th thead tr ul br").split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
WALLS = frozenset("article aside body div footer form header html main nav section table".split())
# Names by which pages mark what is and what is not their article.
CONTENT_TAGS = frozenset(("article", "main"))
CONTENT_ROLES = frozenset(("main", "article"))
NOISE_TAGS = frozenset("nav header footer aside form menu dialog".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog "
                        "alertdialog menu menubar".split())
NOISE_NAMES = frozenset((
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager "
    "header masthead topbar footer copyright colophon "
    "sidebar aside widget widgets related recommended recommendations "
    "cookie cookies consent gdpr notice notices notification popup modal overlay "
    "comment comments respond replies disqus "
    "newsletter subscribe signup login search searchform share sharing social").split())
ARTICLE_NAMES = frozenset("article post entry content story".split())
# Words of a class that says what a page has or allows, not what the element is.
STATE_NAMES = frozenset("has with without no enabled disabled open closed on off".split())
# Blocks that belong to the text beside them.
TITLES = frozenset("h1 h2 h3 h4 h5 h6 li dt".split())
NAME = re.compile(r"[^\W_]+")


def name_words(attributes: dict[str, str | None]) -> list[set[str]]:
    """The words of each class and of the id, without those that only state something."""
    values = (attributes.get("class") or "").split() + [attributes.get("id") or ""]
    found = ({w.lower() for w in NAME.findall(value)} for value in values)
    return [words for words in found if words and not words & STATE_NAMES]


def cue(tag: str, attributes: dict[str, str | None]) -> int:
    """1: marked as the article, 0: not marked, -1: named as something else, -2: it is something
    else by its element, role or style (a form may hold a whole page, so it counts as a name)."""
    role = (attributes.get("role") or "").lower()
    style = re.sub(r"\s", "", attributes.get("style") or "").lower()
    if ("hidden" in attributes or attributes.get("aria-hidden") == "true"
            or "display:none" in style or tag in NOISE_TAGS or role in NOISE_ROLES):
        return -1 if tag == "form" else -2
    noise = content = False
    for words in name_words(attributes):
        odd = words & NOISE_NAMES
        if odd - {"header"} or odd and not words & ARTICLE_NAMES:
            noise = True
        elif words & ARTICLE_NAMES:
            content = True
    if noise:  # one class against another leaves it to the tree
        return 0 if content or tag in CONTENT_TAGS or tag in ("html", "body") else -1
    return 1 if tag in CONTENT_TAGS or role in CONTENT_ROLES else 0


def inherited(above: int, mark: int, tag: str) -> int:
    """The cue of an element that marks itself, below one with the cue above.

    An article in a menu, aside or hidden element is none; in one that is only named like
    something else the names contradict each other, and the style tree decides.
    """
    if above == -2:
        return -2
    if mark > 0 and above == -1 and tag != "form":
        return 0
    return mark or above


class Node:
    __slots__ = ("tag", "path", "cue", "landmark", "named", "children")

    def __init__(self, tag: str, path: str, mark: int, landmark: bool, named: str = ""):
        self.tag, self.path, self.cue, self.landmark = tag, path, mark, landmark
        self.named = named  # tag of the innermost element here or above whose cue is -1
        self.children: list[str] = []


class Page(HTMLParser):
    """Blocks of one page in order, and the child sequence of each element.

    Inline elements without a cue do not count, however many are left open.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack = [Node("", "", 0, False)]
        self.opened: Counter[str] = Counter()
        self.silent = 0
        self.text: list[str] = []
        self.blocks: list[tuple[str, int, str]] = []
        self.nodes: list[Node] = []
        self.landmark = self.main = False

    def end_block(self) -> None:
        text = " ".join("".join(self.text).split())
        self.text = []
        if text:
            top = self.stack[-1]
            self.blocks.append((top.path, top.cue, text))

    def pop_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            tag = self.stack[-1].tag
            if tag in BLOCKS:
                self.end_block()
            if tag in SILENT:
                self.silent -= 1
            self.stack.pop()
            self.opened[tag] -= 1

    def open_depth(self, tags, walls=WALLS) -> int | None:
        """Depth of the innermost open element of tags, not looking past a wall."""
        if not any(self.opened[tag] for tag in tags):
            return None
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag in tags:
                return depth
            if self.stack[depth].tag in walls:
                return None
        return None

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS and not self.silent:
            if tag != "br":
                depth = self.open_depth({"p"})
                if depth is not None:
                    self.pop_to(depth)
            depth = self.open_depth(CLOSES.get(tag, ()), WALLS | {"ul", "ol", "dl"})
            if depth is not None:
                self.pop_to(depth)
            self.end_block()
        elif tag == "body" or (self.silent and tag in ("article", "main")):
            depth = next((i for i, n in enumerate(self.stack) if n.tag == "head"), None)
            if depth is not None:
                self.pop_to(depth)
        if tag in VOID:
            return
        parent = self.stack[-1]
        mark = cue(tag, dict(attrs))
        if not mark and tag not in BLOCKS and tag not in SILENT and not self.opened[tag]:
            return
        shown = dict(attrs).get("class")
        step = tag + ("." + ".".join(sorted(shown.split())) if shown else "")
        if tag in BLOCKS:
            if not parent.children or parent.children[-1] != step:
                parent.children.append(step)
            path = parent.path
            if path.count("/") < TREE_DEPTH:
                path = f"{path}/{step}"
        else:
            path = parent.path
        own = inherited(parent.cue, mark, parent.named)
        node = Node(tag, path, own, mark > 0 and own > 0, tag if own == -1 else parent.named)
        if node.landmark and not self.silent:
            self.landmark = True
            self.main |= tag == "main" or (dict(attrs).get("role") or "").lower() == "main"
        self.stack.append(node)
        self.opened[tag] += 1
        if tag in SILENT:
            self.silent += 1
        if tag in BLOCKS:
            self.nodes.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "math", "iframe", "object"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if not self.opened[tag]:
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag == tag:
                self.pop_to(depth)
                return
            if self.stack[depth].tag in WALLS and tag not in WALLS:
                return

    def handle_data(self, data):
        top = self.stack[-1]
        if not self.silent and (top.cue != -2 or top.tag in BLOCKS):
            self.text.append(data)

    def finish(self) -> None:
        self.close()
        self.pop_to(1)
        self.end_block()


def parse(html: str) -> tuple[list[tuple[str, int, str]], list[tuple[str, str, int]], int]:
    """Blocks (path, cue, text) that may be main text, (path, children, kinds) of elements, and a
    hash of all visible blocks, which equal pages share.

    Cue 1: in the marked article; 0: not marked, on a page that marks none; -1: not marked, on a
    page that marks an article but no main element, which says that the rest is not main text.
    The elements are those that hold such blocks; a marked one counts no kinds of children, as
    the look of an article tells nothing about it.
    """
    page = Page()
    page.feed(html)
    page.finish()
    lowered = 1 if page.landmark else 0
    blocks = [(path, mark if mark > 0 else mark - lowered, text) for path, mark, text
              in page.blocks if mark > 0 or (mark == 0 and not page.main)]
    above = {p[:i] for p in {path for path, _, _ in blocks} for i in range(1, len(p) + 1)
             if i == len(p) or p[i] == "/"}
    nodes = sorted({(n.path, " ".join(n.children), 0 if n.landmark else len(n.children))
                    for n in page.nodes if n.path in above})
    sight = number_of("\0".join(f"{path}\0{text}" for path, _, text in page.blocks))
    return blocks, nodes, sight


def beside(blocks: list[tuple[str, int, str]]) -> list[int]:
    """For a heading or list item of a marked article the place of the text it belongs to, or -1.

    That is the next block, or else the last one before, which is neither and lies in the same
    element, for list items in the element that has the list.
    """
    out = [-1] * len(blocks)

    def step(path: str) -> str:
        return path.rsplit("/", 1)[-1].split(".", 1)[0]

    plain = [i for i, (path, *_) in enumerate(blocks) if step(path) not in TITLES]
    for i, (path, mark, _) in enumerate(blocks):
        if mark <= 0 or step(path) not in TITLES:
            continue
        above = path.rsplit("/", 1)[0]
        if step(path) in ("li", "dt"):
            above = above.rsplit("/", 1)[0]
        at = bisect(plain, i)
        for near in plain[at:at + 1] + plain[max(0, at - 1):at]:
            if blocks[near][1] > 0 and blocks[near][0].startswith(above + "/"):
                out[i] = near
                break
    return out


def number_of(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode(), digest_size=8).digest(), signed=True)


def digest(html: str) -> tuple[int, list[dict], list[dict]]:
    """Hash of the page's looks and texts, its blocks and its elements.

    new_text and new_leaf tell the first block of the page with its text and place, and with its
    place; new_path the first element of its path.
    """
    blocks, nodes, sight = parse(html)
    seen: set = set()

    def new(item) -> int:
        first = item not in seen
        seen.add(item)
        return int(first)

    leaves = {path: number_of(path) for path, _, _ in blocks}
    made = [{"leaf": leaves[path], "cue": mark, "new_text": new((path, text)),
             "new_leaf": new(path), "beside": near, "text": text}
            for (path, mark, text), near in zip(blocks, beside(blocks))]
    seen = set()
    places = [{"id": leaves.get(path) or number_of(path), "path": path,
               "shape": number_of(children), "kinds": kinds, "new_path": new(path)}
              for path, children, kinds in nodes]
    return sight, made, places


def parsed_pages(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    def run(items):
        for batch in batches(items, SLICE):
            made = [digest(value) for value in batch.column(2).to_pylist()]
            block = pa.struct([("leaf", pa.int64()), ("cue", pa.int32()),
                               ("new_text", pa.int32()), ("new_leaf", pa.int32()),
                               ("beside", pa.int32()), ("text", pa.string())])
            node = pa.struct([("id", pa.int64()), ("path", pa.string()), ("shape", pa.int64()),
                              ("kinds", pa.int32()), ("new_path", pa.int32())])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array([m[0] for m in made], pa.int64()),
                 pa.array([m[1] for m in made], pa.list_(block)),
                 pa.array([m[2] for m in made], pa.list_(node))],
                names=["page", "url", "sight", "blocks", "nodes"])

    rows = only(pages, page=key, url=url, html=html).select(
        id_or_least("page").alias("page"), "url",
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    made = rows.mapInArrow(
        run, "page long, url string, sight long, blocks array<struct<leaf:long,cue:int,"
             "new_text:int,new_leaf:int,beside:int,text:string>>, "
             "nodes array<struct<id:long,path:string,shape:long,kinds:int,new_path:int>>")
    return made.withColumns({"row": F.monotonically_increasing_id(),
                             "host": F.xxhash64(host_of(F.col("url")))})


def host_of(url: str) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1)
    return F.lower(rest)


def branches(path: Column) -> Column:
    """The paths of a block's element and of all elements above it, without html and body."""
    steps = F.split(F.substring(path, 2, 1 << 30), "/")
    prefixes = F.transform(steps, lambda _, i: F.concat(
        F.lit("/"), F.array_join(F.slice(steps, 1, i + 1), "/")))
    return F.filter(prefixes, lambda p: ~p.rlike("^(/html[^/]*)?(/body[^/]*)?$"))


def counted_once(parsed: DataFrame) -> DataFrame:
    """The pages that count for the tree: of equal pages of a host one, whatever their URLs."""
    twice = keep(parsed.groupBy("host", "sight").agg(
        F.min("row").alias("least"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1).drop("n"))
    return parsed.join(twice, ["host", "sight"], "left").where(
        F.col("least").isNull() | (F.col("least") == F.col("row")))


def verdicts(parsed: DataFrame, threshold: float, sure: float, least_pages: int,
             damping: float = 0.9) -> DataFrame:
    """(host, leaf, shown): the places of blocks that the merged style tree of a host decides on.

    Presentation: entropy of the child sequences of an element over the host's pages, to the
    base of the number of pages. Content: one minus the mean entropy of a leaf's texts over the
    pages; a text on every page has entropy 1, one on a single page 0. An element combines its
    own presentation with the leaves below it, and the more kinds of children it has the more
    the former counts; a marked article is as important as the best of its leaves. Everything is a sum over rows, combined before it is shuffled. A place is
    as important as the least of the elements it is in that least_pages pages have.
    """
    once = counted_once(parsed)
    texts = once.select("host", F.explode("blocks").alias("b")).groupBy(
        "host", F.col("b.leaf").alias("leaf"), F.xxhash64("b.text").alias("words")).agg(
        F.sum("b.new_text").alias("k"), F.sum("b.new_leaf").alias("m"),
        F.count(F.lit(1)).alias("n"), F.min("b.cue").alias("cue"))
    content = F.when(F.sum("m") > 1, 1 - F.avg(F.log("k")) / F.log(F.sum("m"))).otherwise(1.0)
    leaves = texts.groupBy("host", "leaf").agg(
        F.sum("n").alias("n"), content.alias("content"), F.min("cue").alias("cue"))
    shapes = once.select("host", F.explode("nodes").alias("e")).groupBy(
        "host", F.col("e.id").alias("id"), F.col("e.path").alias("path"),
        F.col("e.shape").alias("shape")).agg(
        F.count(F.lit(1)).alias("n"), F.max("e.kinds").alias("kinds"),
        F.sum("e.new_path").alias("n_pages"))
    total, logs = F.sum("n"), F.sum(F.col("n") * F.log("n"))
    looks = shapes.groupBy("host", "id", "path").agg(
        F.when(total > 1, (F.log(total) - logs / total) / F.log(total)).otherwise(1.0)
        .alias("look"), F.max("kinds").alias("kinds"), F.sum("n_pages").alias("n_pages"))
    placed = (keep(leaves).join(looks.select("host", F.col("id").alias("leaf"), "path"),
                                ["host", "leaf"])
              .select("host", "leaf", "n", "content", "cue",
                      F.explode(branches(F.col("path"))).alias("path")))
    below = placed.groupBy("host", "path").agg(
        (F.sum(F.col("n") * F.col("content")) / F.sum("n")).alias("below"),
        F.max("content").alias("best"))
    weight = F.pow(F.lit(damping), F.col("kinds"))
    tree = looks.join(below, ["host", "path"]).where(F.col("n_pages") >= least_pages).select(
        "host", "path", F.when(F.col("kinds") == 0, F.col("best")).otherwise(
            (1 - weight) * F.col("look") + weight * F.col("below")).alias("importance"))
    worth = placed.join(keep(tree), ["host", "path"]).groupBy("host", "leaf").agg(
        F.min("importance").alias("importance"), F.min("cue").alias("cue"))
    return worth.where((F.col("importance") < threshold)
                       | (F.col("cue") < 0) & (F.col("importance") >= sure)).select(
        "host", "leaf", (F.col("importance") >= sure).alias("shown"))


def main_text(pages: DataFrame, *, threshold: float = 0.3, sure: float = 0.6,
              least_pages: int = 3, key: str = "page_id", url: str = "url",
              html: str = "html") -> DataFrame:
    """Per row of pages: key, url, text and n_chars of the main text of the whole page.

    The style tree of the host decides, with the names of elements as what to begin with. Blocks
    whose place is less important than threshold go, inside an element marked as the article
    too; the marked element itself is as important as its best text, and headings and list items of an
    article stay with the text beside them. Blocks outside of it stay only
    if their place has an importance of sure and the page has no main element. A place is judged
    if at least least_pages different pages of the host have it, so a lone page keeps what it
    marks or does not mark. What is named as something else (navigation, advert, comments and
    so on) goes, as its texts are often as varied as those of an article. Blocks are separated
    by one line feed, white space in a block is one space. NULL or empty HTML gives an empty
    text, repeated rows get the same text, pages that are equal count once in the tree, a NULL
    URL is a host of its own, other columns are ignored and an empty table gives an empty result.
    """
    parsed = keep(parsed_pages(pages, key, url, html))
    judged = keep(verdicts(parsed, threshold, sure, least_pages))
    leaves = parsed.select("row", "host", F.explode(F.array_distinct(
        F.transform("blocks", lambda b: b["leaf"]))).alias("leaf"))
    by_page = leaves.join(judged, ["host", "leaf"]).groupBy("row").agg(
        F.collect_list(F.when(~F.col("shown"), F.col("leaf"))).alias("gone"),
        F.collect_list(F.when(F.col("shown"), F.col("leaf"))).alias("back"))
    none = F.array().cast("array<long>")
    def stays(b):
        return F.when(b["cue"] < 0, F.array_contains(F.coalesce("back", none), b["leaf"])).otherwise(
            ~F.array_contains(F.coalesce("gone", none), b["leaf"]))

    # a heading or list item that a site repeats stays with the text it belongs to
    shown = F.filter("blocks", lambda b: stays(b) | (b["beside"] >= 0) & stays(
        F.get("blocks", b["beside"])))
    text = F.array_join(F.transform(shown, lambda b: b["text"]), "\n")
    return parsed.join(keep(by_page), "row", "left").select(
        id_back(F.col("page")).alias(key), F.col("url").alias(url), text.alias("text"),
        F.char_length(text).cast("long").alias("n_chars"))
