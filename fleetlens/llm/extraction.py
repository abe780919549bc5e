"""Main text of web pages by wrapper induction over same-host pages.

Every page is parsed into a tolerant DOM tree. The trees of a host's different pages are
brought together and each is aligned with the host's reference pages by simple tree matching
(runs of equal siblings are folded, so long lists align in a few steps). Text nodes that are
aligned and equal are counted per host, path and text over all pages; those on at least ``SHARE`` of a host's different pages (and ``PAGES`` of
them) are its template, everything that varies is a content slot. A page's text is what its
content slots hold inside the article (or, without one, the body), less elements that are
never article text by their meaning: menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles, reader comments.

Defined results: a null or empty page gives an empty text of 0 characters; a null url is a
host of its own; copies of a page count once for the template; repeated rows are extracted
each; an empty table gives no rows; other columns are ignored. Pages are parsed whole.
"""

from __future__ import annotations

import html as entities
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from fleetlens.llm.common import load, query, stage

SHARE, PAGES = 0.8, 5
REFERENCES = 3
GROUP = 64  # pages of a host that are brought together; a larger host is salted
NO_HOST = "/"  # what a null url has for a host; no host holds a slash

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section "
                  "summary table tbody tfoot thead tr ul".split())
NOISE = frozenset("aside audio button canvas dialog footer form head iframe input menu nav noembed noframes noscript object "
                  "option script select style svg template textarea title video".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
HINTS = frozenset("ad ads aside banner consent disclaimer gdpr masthead menu modal nav navigation notice notices overlay "
                  "pager pagination popup promo promoted rail related replies reply share sharing signup skip social subscribe "
                  "toolbar topbar".split())
HINT_STARTS = ("advert", "breadcrumb", "comment", "cookie", "disqus", "footer", "navbar", "newsletter", "sidebar", "sponsor")
CLOSES = {"li": ("li", ("ul", "ol", "menu", "dir")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)),
          "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
                 r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
WORD = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "attrs", "children", "noise")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.children, self.noise = tag, attrs, [], None


def parse(page: str) -> Node:
    """A tolerant DOM tree: elements are ``Node``, text is ``str`` (references decoded)."""
    root = Node("#page")
    open_ = [root]
    at = 0
    raw_until = None
    for m in TAG.finditer(page):
        if m.start() < at:
            continue
        if m.start() > at:
            open_[-1].children.append(entities.unescape(page[at:m.start()]))
        at = m.end()
        name = m.group(2) or m.group(5)
        if name is None:
            if page.startswith("<![CDATA[", m.start()):
                open_[-1].children.append(page[m.start() + 9:m.end()].removesuffix("]]>"))
            continue
        name = name.lower()
        if m.group(1) or m.group(4):
            if name in BLOCK or name in CLOSES:
                if any(n.tag == name for n in open_):
                    while open_[-1].tag != name:
                        open_.pop()
                    open_.pop()
                elif name == "p":
                    open_[-1].children.append(Node("p"))
            else:  # an inline end tag does not leave the block it stands in
                for i in range(len(open_) - 1, 0, -1):
                    if open_[i].tag == name:
                        del open_[i:]
                        break
                    if open_[i].tag in BLOCK:
                        break
            continue
        if name in BLOCK and name != "option":
            for i in range(len(open_) - 1, 0, -1):  # a block ends an open paragraph
                if open_[i].tag == "p":
                    del open_[i:]
                    break
                if open_[i].tag in BLOCK:
                    break
        if name in CLOSES:
            ended, scope = CLOSES[name]
            ended = ended.split()
            for i in range(len(open_) - 1, 0, -1):
                if open_[i].tag in ended:
                    del open_[i:]
                    break
                if open_[i].tag in scope:
                    break
        attrs = m.group(3) if m.group(2) else m.group(6)
        node = Node(name, attrs or "")
        open_[-1].children.append(node)
        if name in RAW:
            end = re.compile(f"</{name}(?=[\\s/>]|\\Z)[^>]*(?:>|\\Z)", re.I).search(page, at)
            node.children.append(page[at:end.start()] if end else page[at:])
            at = end.end() if end else len(page)
        elif name not in VOID and not (attrs or "").rstrip().endswith("/"):
            open_.append(node)
        elif name not in VOID and name in BLOCK:
            open_.append(node)  # a slash does not close an HTML element
    if at < len(page):
        open_[-1].children.append(entities.unescape(page[at:]))
    return root


def attributes(node: Node) -> dict[str, str]:
    return {m.group(1).lower(): (m.group(2) or m.group(3) or m.group(4) or "").lower() for m in ATTRIBUTE.finditer(node.attrs)} if node.attrs else {}


def find(node: Node, tags: tuple[str, ...]) -> Iterator[Node]:
    todo = [node]
    while todo:
        n = todo.pop()
        if n.tag in tags:
            yield n
        todo += [c for c in n.children if type(c) is Node]


def is_noise(node: Node, in_article: bool) -> bool:
    """Never article text, by the element's meaning (tag, role, class and id words)."""
    if node.noise is None:
        noise = node.tag in NOISE or node.tag == "header" and not in_article
        if not noise and node.attrs and node.tag not in ("html", "body", "main", "h1"):
            a = attributes(node)
            words = WORD.findall(a.get("class", "") + " " + a.get("id", ""))
            if node.tag == "article":
                noise = any(w.startswith(("comment", "advert")) for w in words)
            else:
                noise = (a.get("role") in ROLES or "hidden" in node.attrs.lower().split() or a.get("aria-hidden") == "true"
                         or "display:none" in a.get("style", "").replace(" ", "")
                         or any(w in HINTS or w.startswith(HINT_STARTS) or w == "header" and not in_article for w in words))
                noise = noise and next(find(node, ("article", "main")), None) is None
        node.noise = noise
    return node.noise


def content_roots(root: Node) -> list[Node]:
    """The outermost articles that are no noise, else the main element, else the body, else the page."""
    for tags in (("article",), ("main",), ("body",)):
        found, todo = [], [root]
        while todo:
            n = todo.pop()
            if n.tag in tags and not is_noise(n, False):
                found.append(n)
            elif n is root or not is_noise(n, False):
                todo += [c for c in reversed(n.children) if type(c) is Node]
        if found:
            return found
    return [root]


def blocks_of(top: Node) -> list[tuple[Node, str, str]]:
    """(element, path, text) of every block of article text of a content root, in page order; white space is one space."""
    out: list[tuple[Node, str, str]] = []
    in_article = top.tag in ("article", "main")
    run: list[str] = []

    def flush(node: Node, path: str) -> None:
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            out.append((node, path, text))

    # (node, path, next child); iterative, so that deep trees are no problem
    stack = [(top, label(top), 0)]
    while stack:
        node, path, i = stack.pop()
        if i >= len(node.children):
            if node.tag in BLOCK or not stack:
                flush(node, path)
            elif node.tag in ("td", "th"):
                run.append(" ")
            continue
        stack.append((node, path, i + 1))
        child = node.children[i]
        if type(child) is str:
            run.append(child)
        elif child.tag == "br":
            run.append(" ")
        elif not is_noise(child, in_article):
            if child.tag in BLOCK:
                flush(node, path)
            stack.append((child, f"{path}>{label(child)}", 0))
        elif child.tag in BLOCK:
            flush(node, path)
    return out


def text_blocks(root: Node) -> list[tuple[str, str]]:
    """(path, text) of every block of article text of a page."""
    return [(path, text) for top in content_roots(root) for _, path, text in blocks_of(top)]


def label(node: Node) -> str:
    """Tag and class words: what simple tree matching compares."""
    if not node.attrs:
        return node.tag
    c = attributes(node).get("class", "")
    return f"{node.tag}.{'.'.join(sorted(c.split()))}" if c else node.tag


def _same(a: tuple, b: tuple) -> bool:
    todo = [(a, b)]  # a loop: trees may be deeper than the stack
    while todo:
        x, y = todo.pop()
        if x[0] != y[0] or len(x[2]) != len(y[2]):
            return False
        todo += zip(x[2], y[2])
    return True


def _merge(a: tuple, b: tuple) -> None:
    todo = [(a, b)]
    while todo:
        x, y = todo.pop()
        x[1].extend(y[1])
        todo += zip(x[2], y[2])


def folded(top: Node) -> tuple:
    """(label, texts, children) of what holds article text; runs of like siblings are one node.

    The texts of an element are the blocks that ``text_blocks`` gives for it, so that keys agree.
    """
    held: dict[int, list[str]] = {}
    for node, _, text in blocks_of(top):
        held.setdefault(id(node), []).append(text)

    def build(node: Node) -> tuple:
        kids: list[tuple] = []
        for c in node.children:
            if type(c) is Node and not c.noise:  # the walk has asked every element it came by
                k = build(c)
                if kids and _same(kids[-1], k):
                    _merge(kids[-1], k)
                elif k[1] or k[2]:
                    kids.append(k)
        return label(node), held.get(id(node), []), kids

    return build(top)


def align(a: tuple, b: tuple, path: str, out: list[tuple[str, str]]) -> int:
    """Simple tree matching of two folded trees; equal texts of matched nodes go to ``out``."""
    if a[0] != b[0]:
        return 0
    here = f"{path}>{a[0]}" if path else a[0]
    common = set(a[1]) & set(b[1])
    out += [(here, t) for t in common]
    x, y = a[2], b[2]
    parts: dict[tuple[int, int], tuple[int, list]] = {}
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i, p in enumerate(x):
        for j, q in enumerate(y):
            size, found = 0, []
            if p[0] == q[0]:
                size = align(p, q, here, found)
            parts[i, j] = size, found
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + size)
    i, j = len(x), len(y)
    while i and j:
        size, found = parts[i - 1, j - 1]
        if size and best[i][j] == best[i - 1][j - 1] + size:
            out += found
            i, j = i - 1, j - 1
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return best[len(x)][len(y)] + 1


def _key(path: str, text: str) -> int:
    return xxhash.xxh64_intdigest(f"{path}\n{text}") - (1 << 63)


def packed(page: str) -> list[int]:
    """The folded content roots of a page as numbers, depth first: label, texts, children, key of each text."""
    out: list[int] = []

    def put(tree: tuple, path: str) -> None:
        here = f"{path}>{tree[0]}" if path else tree[0]
        texts = dict.fromkeys(tree[1])
        out.extend((xxhash.xxh32_intdigest(tree[0]), len(texts), len(tree[2])))
        out.extend(_key(here, t) for t in texts)
        for k in tree[2]:
            put(k, here)

    roots = [folded(r) for r in content_roots(parse(page))]
    out += 0, 0, len(roots)
    for r in roots:
        put(r, "")
    return out


def unpacked(numbers: list[int]) -> tuple:
    at = 0

    def take() -> tuple:
        nonlocal at
        name, texts, kids = numbers[at:at + 3]
        at += 3 + texts
        return name, numbers[at - texts:at], [take() for _ in range(kids)]

    return take()


def page_trees(pages: DataFrame) -> DataFrame:
    """(host, page, tree): every different page of a host once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sys.setrecursionlimit(10 ** 7)  # trees may be deep; these calls use no C stack
        for batch in batches:
            rows = [(h, xxhash.xxh64_intdigest(p) - (1 << 63), packed(p))
                    for h, p in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()) if p]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.list_(pa.int64())))],
                                             names=["host", "page", "tree"])

    return pages.select("host", "html").mapInArrow(run, "host string, page long, tree array<long>").dropDuplicates(["host", "page"])


def host_salts(rows: DataFrame, sizes: DataFrame, *by: str) -> DataFrame:
    """``rows`` with a salt: one group for every ``GROUP`` pages of the row's host."""
    hot = sizes.where(F.col("salts") > 1).select("host", "salts")
    return rows.join(hot, "host", "left").withColumn("salt", F.pmod(F.xxhash64(*by), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")


def every_salt(rows: DataFrame) -> DataFrame:
    return rows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")


def host_sizes(trees: DataFrame, least: int = PAGES) -> DataFrame:
    """(host, pages, salts) of the hosts with enough different pages for a template."""
    return (trees.groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") >= least)
            .withColumn("salts", F.ceil(F.col("pages") / GROUP).cast("int")))


def aligned_nodes(trees: DataFrame, sizes: DataFrame) -> DataFrame:
    """(host, node, n): on how many pages of the host a text node is aligned with an equal one of a reference page.

    A host's references are the same for all its pages: of ``REFERENCES`` classes by content hash
    the page of least hash. A node on ``SHARE`` of the pages is hardly ever on none of them, so one
    odd page does no harm.
    """
    first = trees.groupBy("host", F.pmod("page", F.lit(REFERENCES)).alias("class")).agg(F.min_by("tree", "page").alias("tree"))
    models = first.groupBy("host").agg(F.collect_list("tree").alias("models")).join(sizes.select("host", "salts"), "host")
    met = host_salts(trees, sizes, "page").join(every_salt(models), ["host", "salt"]).select("host", "tree", "models")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sys.setrecursionlimit(10 ** 7)
        for batch in batches:
            known: dict[str, list[tuple]] = {}
            hosts, nodes = [], []
            for i, host in enumerate(batch.column("host").to_pylist()):
                if host not in known:
                    known[host] = [unpacked(m) for m in batch.column("models")[i].as_py()]
                tree = unpacked(batch.column("tree")[i].as_py())
                equal: list[tuple[str, int]] = []
                for model in known[host]:
                    align(model, tree, "", equal)
                keys = {key for _, key in equal}
                hosts += [host] * len(keys)
                nodes += keys
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(nodes, pa.int64())], names=["host", "node"])

    return met.mapInArrow(run, "host string, node long").groupBy("host", "node").agg(F.count("*").alias("n"))


def templates(trees: DataFrame, sizes: DataFrame, share: float = SHARE, least: int = PAGES) -> DataFrame:
    """host, salts and the sorted keys of its constant text nodes."""
    constant = aligned_nodes(trees, sizes).where(F.col("n") >= least).join(sizes, "host").where(F.col("n") >= F.col("pages") * share)
    return constant.groupBy("host", "salts").agg(F.sort_array(F.collect_list("node")).alias("template"))  # bounded by a page's text nodes / share


def extract(table: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages``."""
    id_type = table.schema["page_id"].dataType.simpleString()
    host = F.lower(F.regexp_extract(F.col("url"), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))
    pages = table.select("page_id", "url", "html", F.coalesce(host, F.lit(NO_HOST)).alias("host"))
    trees = stage(page_trees(pages), "wrapper-trees")
    sizes = stage(host_sizes(trees), "wrapper-hosts")
    known = stage(templates(trees, sizes), "wrapper-templates")
    joined = host_salts(pages, sizes, "page_id", "html").join(every_salt(known), ["host", "salt"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, template in zip(batch.column("html").to_pylist(), batch.column("template").to_pylist()):
                kept = text_blocks(parse(page)) if page else []
                if template:
                    constant = set(template)
                    kept = [(p, t) for p, t in kept if _key(p, t) not in constant]
                texts.append("\n\n".join(t for _, t in kept))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return joined.select("page_id", "url", "html", "template").mapInArrow(run, f"page_id {id_type}, url string, text string, n_chars long")


@query("op4_html_extraction")
def op4_html_extraction(spark, sf_dir):
    """Main text of every page of ``pages``."""
    return extract(load(spark, sf_dir, "pages"))
