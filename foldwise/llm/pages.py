"""Operator 4: main text of web pages, with site templates removed.

A page is read into a tree of elements. Every element's subtree gets a hash of its name, its texts and
its children. Elements that are no text by their name, role or class (menus, headers, footers, sidebars,
forms, scripts, adverts, notices, reader comments) are deleted and play no part in the hashes; but nothing that
holds the article is, whatever its name or class. Inside the article only names count, and classes all of whose
words say so; a class that speaks of the layout (``with-sidebar``) says nothing. On a page without a marked article, classes
and forms are not believed if no text would be left, nor a class of the layout on an element with most of the text. Spark counts
on how many distinct pages of a host each hash occurs (once a page; pages whose whole trees have one hash are
one page, however many rows repeat it). Of a host's n distinct pages, the subtree of a block-level element
outside the article belongs to the site's template and is deleted as well if it recurs on at least ``least``
and at least ``share`` of them, or on ``many`` and ``low_share`` (menus of a section, adverts in turn); with
n below ``least``, if it is on all of two or more. ``html``, ``body`` and elements around an article stay.
If the page marks its article, the text is what is left of that; else of the whole body. ``main`` (or its role) is the
article, or without it every ``article`` (or its role); one inside a menu, sidebar, footer or element deleted by its class
counts only if there is no other. In a marked article only elements that hold no running text themselves (``div``, ``section``, lists,
tables) are deleted as template, and only on ``least`` pages at a share of ``inner_share``: a paragraph that
many articles quote stays.

Near copies share their text, not only a template. So recurrence is judged twice: what recurs among all
distinct pages is taken off, and only pages with ``own_share`` of their text left are counted the second
time. A site none of whose pages has that much text of its own keeps all.

A block is the text between two block-level tags; white space in it becomes one space. Nulls and pages
without text give the empty text. A url without a scheme has its host in front; null urls and those that
begin with a path share the empty host, whose template is counted alike. Repeated rows give their texts
each. Columns beside those asked for play no part. A host has at most 1 / low_share times the subtrees of a
page in its template, so the templates of all hosts stay small; they are joined by host, broadcast only if
their measured size allows it, and otherwise in a join that splits hosts with many pages.
"""

from __future__ import annotations

import html as entities
import re
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import kept, slices, texts

#: Fixed values of HTML and of common page markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
ENDS_P = BLOCK - frozenset("body dd dt head html legend li option optgroup tbody td tfoot th thead tr".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"}, "option": {"select"}}
NO_TEXT = frozenset("nav footer aside header form script style noscript template iframe svg canvas object button select textarea input dialog menu head title audio video map xmp noembed noframes".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
LAYOUT_WORDS = "banner sidebar side-bar menu nav navbar navigation masthead site-header page-header widget toolbar".split()
OTHER_WORDS = "ad ads advert adverts advertisement advertising sponsor sponsored promo cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login breadcrumb breadcrumbs footer comment comments commentlist disqus replies respond social share sharing related recommended skip-link".split()
SAYS_LAYOUT = ("with-", "without-", "has-", "no-", "is-", "hide-", "show-")
CONTENT = frozenset(("article", "main"))
HOLDERS = frozenset("div section ul ol dl table figure".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Why an element goes: its name or role; it is a form; each word of its class says so (some of the layout), or only one does.
KEEP, NAMED, FORM, SAID, SAID_LAID, HINTED, LAID = range(7)
DOUBTED = (FORM, SAID, SAID_LAID, HINTED, LAID)
WORDS = {kind: re.compile(rf"(?:^|[_-])(?:{'|'.join(words)})(?=$|[_-])") for kind, words in ((HINTED, OTHER_WORDS), (LAID, LAYOUT_WORDS))}

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
GAPS = re.compile(r"\s+")


class Node:
    __slots__ = ("name", "parts", "drop", "key", "content", "holds", "size")

    def __init__(self, name: str, drop: int = KEEP, content: str = ""):
        self.name, self.drop, self.content, self.parts, self.key, self.holds, self.size = name, drop, content, [], 0, False, 0


def word_kind(word: str) -> int:
    """What one word of a class or id says."""
    if word.startswith(SAYS_LAYOUT):
        return KEEP
    return next((kind for kind, words in WORDS.items() if words.search(word)), KEEP)


def read_attributes(name: str, attributes: str) -> tuple[int, str]:
    """Why the element goes, if it does, and which article it marks: "main", "article" or none."""
    drop, content = KEEP, name if name in CONTENT else ""
    if name in NO_TEXT:
        drop = FORM if name == "form" else NAMED
    if not attributes or name in ("html", "body"):
        return drop, content
    for kind, *values in ATTRIBUTE.findall(attributes):
        value = next((v for v in values if v), "").lower()
        if kind.lower() == "role":
            if value in CONTENT:
                content = value
            elif value in ROLES:
                drop = drop or (FORM if value == "form" else NAMED)
        elif not drop and not content and name not in HEADINGS and value:
            said = [word_kind(w) for w in value.split()]
            if any(said):
                drop = (SAID_LAID if LAID in said else SAID) if all(said) else HINTED if HINTED in said else LAID
    return (KEEP if content else drop), content


def settle(root: Node) -> None:
    """Decides which marked article counts, and keeps what it stands in and what it holds."""
    found: list[tuple[Node, list[Node], int]] = []  # an article, what it stands in, the strongest reason to drop that
    todo: list[tuple[Node, list[Node]]] = [(root, [])]
    suspects = []
    while todo:
        own, above = todo.pop()
        if own.content:
            reasons = {n.drop for n in above}
            found.append((own, above, 2 if NAMED in reasons else 1 if reasons & {SAID, SAID_LAID, HINTED} else 0))
        if own.drop in DOUBTED:
            suspects.append(own)
        if own.name not in RAW:
            inside = [*above, own] if own.drop or own.content else above
            todo += [(p, inside) for p in own.parts if isinstance(p, Node)]
    ranks = [[x for x in found if (x[0].content, x[2]) in kinds] for kinds in ((("main", 0), ("main", 1)), (("article", 0),), (("article", 1),), (("main", 2),), (("article", 2),))]
    chosen = next((some for some in ranks if any(amount(x[0]) for x in some)), [])
    for own, _, _ in found:
        own.content = ""
    for own, above, _ in chosen:
        own.content, own.holds = "main", True
        for n in above:
            n.drop = KEEP
    if chosen:
        inner = [x[0] for x in chosen]
        while inner:
            own = inner.pop()
            own.drop = KEEP if own.drop in (HINTED, LAID) or own.name == "header" else own.drop
            inner += [p for p in own.parts if isinstance(p, Node) and p.name not in RAW]
    elif suspects:
        whole = amount(root, {KEEP, *DOUBTED})
        for own in suspects:
            if own.drop in (SAID_LAID, LAID) and 2 * amount(own, {KEEP, *DOUBTED}) > whole:
                own.drop = KEEP
        if whole and not amount(root):
            for own in suspects:
                own.drop = KEEP


def amount(root: Node, kept_kinds: frozenset | set = frozenset({KEEP})) -> int:
    """Characters of text under an element, whatever it says of itself, in what is kept for one of the reasons."""
    total, todo = 0, list(root.parts)
    while todo:
        p = todo.pop()
        if isinstance(p, str):
            total += len(p.strip())
        elif p.drop in kept_kinds and p.name not in RAW:
            todo += p.parts
    return total


def tree(page: str) -> Node:
    root = Node("")
    stack = [root]
    at = 0
    while at < len(page):
        m = TAG.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text:
            stack[-1].parts.append(text)
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if not page.endswith(">", m.start(), m.end()):
            break  # cut off inside a tag
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    del stack[k:]
                    break
                if stack[k].content and name not in ("body", "html"):
                    break
            else:
                if name == "p":
                    stack[-1].parts.append(Node("p"))
            continue
        if name in ENDS_P:
            close(stack, {"p"}, ())
        if name in CLOSES:
            close(stack, CLOSES[name], SCOPE.get(name, ()))
        node = Node(name, *read_attributes(name, m[3]))
        stack[-1].parts.append(node)
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, at)
            node.parts.append(page[at : end.start() if end else len(page)])
            at = end.end() if end else len(page)
        elif name not in VOID and not m[3].endswith("/"):
            stack.append(node)
    settle(root)
    return root


def close(stack: list[Node], names: set[str], scope) -> None:
    """End the nearest open element among ``names``, unless one of ``scope`` stands between."""
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].name in names:
            del stack[k:]
            return
        if stack[k].name in scope or (not scope and stack[k].name in BLOCK):
            return


def deletable(node: Node, in_article: bool) -> bool:
    """Whether the element can be template: not the page, nor what an article stands in (known once hashed)."""
    return node.key != 0 and node.name in BLOCK and not node.holds and node.name not in ("html", "body") and (not in_article or node.name in HOLDERS)


def hashed(root: Node) -> list[tuple[Node, bool, int]]:
    """Give every subtree that stays its key. All nodes, each before those it holds, with whether it is in
    the article and the place of its parent. Deep trees are walked without recursion."""
    order, todo = [], [(root, False, -1)]
    while todo:
        own, inner, up = todo.pop()
        at = len(order)
        order.append((own, inner, up))
        inner = inner or bool(own.content)
        todo += [(p, inner, at) for p in own.parts if isinstance(p, Node) and not p.drop]
    for own, _, _ in reversed(order):
        h = blake2b(own.name.encode(), digest_size=8)
        some = False
        for p in own.parts:
            if isinstance(p, Node):
                if not p.drop:
                    h.update(b"<%d>" % p.key)
                    some = some or p.key != 0
                    own.holds = own.holds or p.holds
                    own.size += p.size
            elif t := GAPS.sub(" ", p).strip():
                h.update(t.encode("utf-8", "surrogatepass"))
                some = True
                own.size += len(t)
        own.key = int.from_bytes(h.digest(), "little", signed=True) if some else 0
    return order


def candidates(order: list[tuple[Node, bool, int]]) -> tuple[list[int], list[int], list[int]]:
    """Key and text size of the subtrees that may be template, and the place of the next one around each."""
    keys, sizes, ups, at = [], [], [], []
    for own, inner, up in order:
        around = at[up] if up >= 0 else -1
        if deletable(own, inner):
            at.append(len(keys))
            keys.append(own.key)
            sizes.append(own.size)
            ups.append(around)
        else:
            at.append(around)
    return keys, sizes, ups


def left(total: int, subtrees, often: set[int]) -> int:
    """How much of a page's text stands in none of the subtrees that occur often."""
    gone: list[bool] = []
    for key, size, up in zip(*subtrees, strict=True):
        inside = up >= 0 and gone[up]
        gone.append(inside or key in often)
        total -= size if gone[-1] and not inside else 0
    return total


def blocks(root: Node, template: dict[int, bool]) -> list[str]:
    """Texts of the blocks that stay, in page order; of the marked article if there is one. ``template`` says
    whether a subtree goes in an article too."""
    marked, every = [], []
    now: list[str] = []
    has_article = False

    def flush(inner: bool) -> None:
        if now:
            text = GAPS.sub(" ", entities.unescape("".join(now))).strip()
            now.clear()
            if text:
                every.append(text)
                if inner:
                    marked.append(text)

    todo: list = [(root, False)]
    while todo:
        item, inner = todo.pop()
        if item is None:
            flush(inner)
        elif isinstance(item, str):
            now.append(item)
        elif item.name == "br":
            now.append(" ")
        elif item.drop:
            if item.name in BLOCK:
                flush(inner)
        else:
            if item.key in template and deletable(item, inner) and (not inner or template[item.key]):
                flush(inner)
                continue
            has_article = has_article or bool(item.content)
            below = inner or bool(item.content)
            ends = item.name in BLOCK
            if ends:
                flush(inner)
                todo.append((None, below))
            todo += [(p, below) for p in reversed(item.parts)]
    flush(False)
    return marked if has_article else every


def host_of(url_col: str):
    return F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^\s*(?:(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//)?(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def recurring(keys: DataFrame, least: int, share: float, many: int, low_share: float, inner_share: float, tag: str) -> DataFrame:
    """``host``, ``template``: a map from the keys that recur on the host's pages to whether they do so in
    an article. ``keys``: ``host`` and the distinct ``keys`` of a page, with 0 for the page itself."""
    counts = keys.select("host", F.explode("keys").alias("key")).groupBy("host", "key").count()
    counts = kept(counts.filter((F.col("count") >= min(2, least)) | (F.col("key") == 0)), tag)
    total = counts.filter("key = 0").select("host", F.col("count").alias("pages"))
    n, count = F.col("pages"), F.col("count")
    enough = F.when(n < least, (count >= n) & (n > 1)).otherwise((count >= least) & (count >= share * n) | (count >= many) & (count >= low_share * n))
    often = counts.filter("key <> 0").join(total, "host").filter(enough)
    entry = F.struct("key", ((count >= least) & (count >= inner_share * n)).alias("inner"))
    return kept(often.groupBy("host").agg(F.map_from_entries(F.collect_list(entry)).alias("template")), f"{tag}-often")


def with_templates(rows: DataFrame, found: DataFrame, broadcast_entries: int) -> DataFrame:
    entries = found.agg(F.sum(F.size("template"))).first()[0] or 0
    return rows.join(F.broadcast(found) if entries <= broadcast_entries else found, "host", "left")


def templates(pages: DataFrame, own_share: float, broadcast_entries: int, html_col: str, url_col: str, **limits) -> DataFrame:
    """``host``, ``template``: see ``recurring``."""
    lists = "keys array<long>, sizes array<int>, ups array<int>"
    kinds = [pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())]

    def run(batches):
        for batch in slices(batches, html_col):
            page, total, subtrees = [], [], []
            for html in texts(batch, html_col):
                order = hashed(tree(html))
                page.append(order[0][0].key)
                total.append(order[0][0].size)
                subtrees.append(candidates(order))
            columns = [pa.array([s[k] for s in subtrees], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(page, pa.int64()), pa.array(total, pa.int64()), *columns], names=["host", "page", "total", "keys", "sizes", "ups"])

    def different(batches):
        for batch in batches:
            keep = []
            for total, often, *subtrees in zip(*(batch.column(c).to_pylist() for c in ("total", "template", "keys", "sizes", "ups")), strict=True):
                keep.append(total > 0 and left(total, subtrees, {k for k, _ in often or ()}) >= own_share * total)
            yield batch.select(["host", "keys"]).filter(pa.array(keep, pa.bool_()))

    each = pages.select(host_of(url_col).alias("host"), html_col).mapInArrow(run, f"host string, page long, total long, {lists}")
    first = F.first(F.struct("total", "keys", "sizes", "ups")).alias("p")  # one tree, one list
    distinct = kept(each.groupBy("host", "page").agg(first).select("host", "p.*"), "distinct")
    keys = lambda df: df.select("host", F.array_union(F.array(F.lit(0).cast("long")), "keys").alias("keys"))
    every = recurring(keys(distinct), tag="subtrees", **limits)
    apart = with_templates(distinct, every, broadcast_entries).select("host", "total", "keys", "sizes", "ups", "template").mapInArrow(different, "host string, keys array<long>")
    return recurring(keys(apart), tag="templates", **limits)


def extract(pages: DataFrame, least: int = 5, share: float = 0.5, inner_share: float = 0.6, broadcast_entries: int = 50_000, id_col: str = "page_id", html_col: str = "html", url_col: str = "url", many: int = 20, low_share: float = 0.05, own_share: float = 0.1) -> DataFrame:
    """``page_id``, ``url``, ``text``."""
    found = templates(pages, own_share, broadcast_entries, html_col, url_col, least=least, share=share, many=many, low_share=low_share, inner_share=inner_share)
    own = pages.select(id_col, url_col, html_col, host_of(url_col).alias("host"))
    joined = with_templates(own, found, broadcast_entries).select(id_col, url_col, html_col, "template")
    schema = f"{id_col} {dict(pages.dtypes)[id_col]}, {url_col} string, text string"

    def run(batches):
        for batch in slices(batches, html_col):
            out = []
            for page, template in zip(texts(batch, html_col), batch.column("template").to_pylist(), strict=True):
                root = tree(page)
                hashed(root)
                out.append("\n".join(blocks(root, dict(template or ()))))
            yield pa.RecordBatch.from_arrays([batch.column(id_col), batch.column(url_col), pa.array(out, pa.string())], names=[id_col, url_col, "text"])

    return joined.mapInArrow(run, schema)
