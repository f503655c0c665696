"""Main text of web pages by a style tree of every site.

**Tree of a page.** Elements that do not merely mark up words are nodes; the words between them are leaves. Tags
may be missing or crossed: a block ends an open paragraph, a list item the one before it, and so on.

**Style tree of a site.** The pages of a host are merged from the root down. Two elements are one node of the
site if they stand at the same place in the same sequence of children of one parent node, with the same tag, classes and
id; that whole path is hashed, so merging is a grouping by hash. A node has a number of *styles*
(sequences of children), a leaf a number of *contents* (texts, digits made equal).

**Importance.** With ``m`` pages at a node, ``l`` variants and ``k`` pages per variant:

- presentation of an element: entropy of its styles, base ``m``, times ``1 - DAMPING ** l``; plus ``DAMPING ** l`` times the mean importance
  of its children on the page;
- content of a leaf: one less the mean, over its contents, of ``log_m k``, drawn towards 1 where ``m`` is small
  (``PRIOR`` pages without any agreement are added).

An importance is multiplied by what the page itself declares: 0 for what HTML, a role or a class name marks as menu, header,
footer, sidebar, notice, advert, form, script, style or reader comments, and for what lies outside a marked article; else 1. Branches
in which every node is below ``THRESHOLD`` are cut, the others kept.

Pages of a host with the same title and heading are one page of evidence, so copies of an article do not make it a template.
Statistics are narrow rows of hashes, summed with partial sums. Elements of low importance are looked up from a
broadcast while they are at most ``BROADCAST`` rows, else by a join on the node and a second one on the page.

A null html is empty; a null or odd URL is a host of its own kind (the empty one). Rows that repeat are treated alike. Pages without any
tag, unclosed comments and tags, and very long or deeply nested pages are taken as they are. An empty
table gives no rows. Extra columns are left out.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusml.llm.common import slices
from corpusml.storage import discard, materialize

DAMPING = 0.9
PRIOR = 2.0
THRESHOLD = 0.3
#: Rows of low importance that every task may hold (24 bytes each).
BROADCAST = 1_000_000

# Elements of HTML by their part in a page.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr img".split())
_RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
_UNREAD = frozenset(
    "head script style noscript template iframe noembed noframes object embed applet canvas svg math audio video map select option optgroup button "
    "textarea input datalist progress meter title meta link base param source track area frameset frame".split())
_BOILERPLATE = frozenset("nav footer aside form menu dialog".split())
# A start tag on the left ends the open elements on the right, up to the ones that bound them.
_ENDS = {
    **dict.fromkeys("li".split(), ({"li"}, {"ul", "ol", "menu"})), **dict.fromkeys("dt dd".split(), ({"dt", "dd"}, {"dl"})),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    **dict.fromkeys("tbody thead tfoot".split(), ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"})),
    "option": ({"option"}, {"select"}), "body": ({"head"}, set()),
}
_KEEPS_HEAD = frozenset("html head meta title link base script style noscript template".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
_WORDS = frozenset("""nav navbar navigation topnav sidenav menu menubar submenu dropdown breadcrumb breadcrumbs crumbs masthead topbar banner footer bottombar copyright
    colophon sidebar sidenav sidepanel rail aside widget widgets ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored
    sponsors promo promos promotion promoted cookie cookies consent gdpr notice notices notification notifications alert announcement popup modal overlay lightbox newsletter
    subscribe subscription signup login signin register search searchbox searchform form share sharing social related recommended recommendations trending
    comment comments commentlist disqus reply replies respond pagination pager skip skiplink toolbar""".split())
_COMMENTS = frozenset("comment comments commentlist disqus reply replies respond".split())
_STATES = frozenset("has no not with without is open closed enabled disabled off on count".split())
_SOFT = frozenset("header head".split())
_ARTICLE_WORDS = frozenset("article post entry story content main text body".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
_NOT_WORD = re.compile(r"[^a-zA-Z]+")
_DIGITS = re.compile(r"\d+")
_HIDDEN = re.compile(r"display\s*:\s*none", re.I)

# What can make an element more than its tag.
_MARKED = re.compile(r"class|id\s*=|role|hidden|style|itemprop", re.I)


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


_signatures: dict[str, int] = {}


def _signature(text: str) -> int:
    found = _signatures.get(text)
    if found is None:
        if len(_signatures) > 100_000:
            _signatures.clear()
        found = _signatures[text] = _hash(text)
    return found


class Page:
    """The tree of a page: per node its tag, declared part, parent and children (nodes, or texts as ``str``)."""

    def __init__(self, source: str) -> None:
        self.tags, self.marks, self.parents, self.children = ["#root"], [("", False, False)], [-1], [[]]
        self._read(source)
        self._declare()

    # reading ------------------------------------------------------------------------------

    def _read(self, source: str) -> None:
        n, at, tag_at = len(source), 0, _TAG.match
        stack, open_inline = [0], set()
        children, tags, marks, parents = self.children, self.tags, self.marks, self.parents
        find = source.find
        while True:
            opened = find("<", at)
            if opened < 0:
                opened = n
            if opened > at:
                text = source[at:opened]
                children[stack[-1]].append(entities.unescape(text) if "&" in text else text)
            if opened == n:
                break
            found = tag_at(source, opened)
            if found is None:
                after = source[opened + 1 : opened + 2]
                if after == "!" or after == "?" or after == "/" and not source[opened + 2 : opened + 3].isalpha():
                    close = "-->" if source.startswith("<!--", opened) else ">"
                    ended = find(close, opened + 2)
                    at = n if ended < 0 else ended + len(close)
                    if at == n:
                        break
                    continue
                if after.isalpha() or after == "/":
                    found = _LOOSE_TAG.match(source, opened)
                    if found is None:
                        break  # cut off within a tag
                    tag_at = _LOOSE_TAG.match  # a quote that never closes: from here on tags end at the next bracket
                else:
                    children[stack[-1]].append("<")
                    at = opened + 1
                    continue
            at = found.end()
            end, name, rest = found.groups()
            name = name.lower()
            if end:
                if tags[stack[-1]] == name:
                    stack.pop()
                else:
                    self._end(stack, name)
                continue
            if name == "br" or name == "hr":
                children[stack[-1]].append(" ")
                continue
            marked = rest and _MARKED.search(rest)
            if name in _INLINE:
                # Words' markup that says nothing is seen through, unless its end could be taken for another's.
                if not marked and name not in open_inline:
                    continue
                open_inline.add(name)
            self._start(stack, name)
            node = len(tags)
            tags.append(name)
            marks.append(self._marks(name, rest) if marked else (name, False, False))
            parents.append(stack[-1])
            children[stack[-1]].append(node)
            children.append([])
            if name in _VOID:
                continue
            if name in _RAW:
                ended = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(source, at)
                stop = ended.start() if ended else n
                if name == "title":
                    self._text(node, source[at:stop])
                close = find(">", stop)
                at = n if close < 0 or not ended else close + 1
                continue
            if rest.endswith("/") and name in ("svg", "path"):
                continue
            stack.append(node)

    def _text(self, node: int, text: str) -> None:
        self.children[node].append(entities.unescape(text) if "&" in text else text)

    def _start(self, stack: list[int], name: str) -> None:
        tags = self.tags
        rule = _ENDS.get(name)
        if rule:
            ends, bounds = rule
            for depth in range(len(stack) - 1, 0, -1):
                tag = tags[stack[depth]]
                if tag in bounds:
                    break
                if tag in ends:
                    del stack[depth:]
                    if name not in ("tr", "tbody", "thead", "tfoot"):
                        break
        if name in _INLINE:
            return
        if tags[stack[-1]] == "head" and name not in _KEEPS_HEAD:
            stack.pop()
        # A block ends an open paragraph, and the words' markup in it.
        for depth in range(len(stack) - 1, 0, -1):
            tag = tags[stack[depth]]
            if tag == "p":
                del stack[depth:]
                return
            if tag not in _INLINE:
                return

    def _end(self, stack: list[int], name: str) -> None:
        tags = self.tags
        for depth in range(len(stack) - 1, 0, -1):
            tag = tags[stack[depth]]
            if tag == name:
                del stack[depth:]
                return
            if name in _INLINE and tag not in _INLINE:
                return

    @staticmethod
    def _marks(name: str, rest: str) -> tuple[str, bool, bool]:
        """``(signature, boilerplate, comments)`` of an element with attributes."""
        attributes = {}
        for key, *values in _ATTRIBUTE.findall(rest):
            attributes.setdefault(key.lower(), values[0] or values[1] or values[2])
        label = attributes.get("class", "") + " " + attributes.get("id", "")
        words = set()
        for token in label.split():
            of_token = {w.lower() for w in _NOT_WORD.split(_HUMP.sub(" ", token)) if w}
            # "has-sidebar", "comments-open": what is said of the page, not what the element is.
            if not of_token & _STATES:
                words |= of_token
        role = attributes.get("role", "").strip().lower()
        hidden = "hidden" in attributes or bool(_HIDDEN.search(attributes.get("style", "")))
        boilerplate = hidden or role in _ROLES or bool(words & _WORDS) or bool(words & _SOFT) and not words & _ARTICLE_WORDS
        main = role == "main" or attributes.get("itemprop", "").lower() == "articlebody"
        signature = f"{name} {' '.join(sorted(words))} {role}" + (" *main" if main else "")
        return signature, boilerplate, bool(words & _COMMENTS) or hidden

    # what the page declares -----------------------------------------------------------------

    def _declare(self) -> None:
        """``dropped``: parts of weight 0; ``scope``: the marked articles."""
        tags, marks, parents = self.tags, self.marks, self.parents
        n = len(tags)
        centre = [tags[i] in ("main", "article") and not marks[i][2] or marks[i][0].endswith("*main") for i in range(n)]
        holds = list(centre)
        for i in range(n - 1, 0, -1):
            if holds[i]:
                holds[parents[i]] = True
        dropped, inside = [False] * n, [False] * n
        for i in range(1, n):
            above, tag = parents[i], tags[i]
            _, boilerplate, comments = marks[i]
            inside[i] = inside[above] or centre[i]
            if dropped[above] or tag in _UNREAD or comments and tag not in ("html", "body", "main"):
                dropped[i] = True
            elif holds[i] or tag in ("html", "body"):
                dropped[i] = False  # what holds the article is its frame, whatever its name
            else:
                dropped[i] = boilerplate or tag in _BOILERPLATE or tag == "header" and not inside[above]
        # Main parts before articles: an article may be one of several in it.
        scope: list[int] = []
        for kind in (lambda i: tags[i] == "main" or marks[i][0].endswith("*main") and tags[i] != "article", lambda i: centre[i]):
            scope = [i for i in range(1, n) if centre[i] and not dropped[i] and kind(i)]
            if any(self._words(i, dropped) for i in scope):
                break
        else:
            scope = []
        if scope:
            keep = [False] * n
            chosen = set(scope)
            for i in range(1, n):
                keep[i] = keep[parents[i]] or i in chosen
            frame = [False] * n
            for i in range(n - 1, 0, -1):
                if keep[i] or frame[i]:
                    frame[parents[i]] = True
            self.outside = [not k for k in keep]
            dropped = [d or not (k or f) for d, k, f in zip(dropped, keep, frame)]
        else:
            self.outside = [False] * n
        self.dropped = dropped

    def _words(self, top: int, dropped: list[bool]) -> bool:
        todo = [top]
        while todo:
            for child in self.children[todo.pop()]:
                if isinstance(child, str):
                    if child and not child.isspace():
                        return True
                elif not dropped[child]:
                    todo.append(child)
        return False

    # nodes of the site ------------------------------------------------------------------------

    def parts(self):
        """Nodes and leaves in page order: ``(parent, node or -1, signature, text)``, words' markup seen through.

        Every node is listed before its children; a leaf is the text between two nodes.
        """
        tags, marks, dropped = self.tags, self.marks, self.dropped
        out: list[tuple[int, int, str, str]] = []
        words: list[str] = []
        todo: list = [(0, iter(self.children[0]))]

        def flush(parent: int) -> None:
            text = " ".join("".join(words).split())
            words.clear()
            if text and not self.outside[parent]:
                out.append((parent, -1, "#text", text))

        while todo:
            owner, rest = todo[-1]
            for child in rest:
                if isinstance(child, str):
                    words.append(child)
                elif dropped[child]:
                    if tags[child] not in _INLINE:
                        flush(owner)
                        out.append((owner, -2, marks[child][0], ""))
                elif tags[child] in _INLINE:
                    todo.append((owner, iter(self.children[child])))
                    break
                else:
                    flush(owner)
                    out.append((owner, child, marks[child][0], ""))
                    todo.append((child, iter(self.children[child])))
                    break
            else:
                todo.pop()
                if not todo or todo[-1][0] != owner:
                    flush(owner)
        return out

    def title(self) -> str:
        """Title and first heading."""
        texts = []
        for name in ("title", "h1"):
            if name in self.tags:
                todo, words = [self.tags.index(name)], []
                while todo:
                    top = todo.pop()
                    if isinstance(top, str):
                        words.append(top)
                    else:
                        todo.extend(reversed(self.children[top]))
                texts.append(" ".join("".join(words).split()))
        return "\0".join(texts) if any(texts) else ""


def site_nodes(page: Page, host: str):
    """``(parts, ids, styles)``: the parts of a page, the site's node of each, and of elements the hash of its style."""
    parts = page.parts()
    signatures: dict[int, list[tuple[int, int]]] = {}
    for at, (parent, _, signature, _) in enumerate(parts):
        signatures.setdefault(parent, []).append((at, _signature(signature)))
    ids, styles = [0] * len(parts), [0] * len(parts)

    def place_children(node: int, own: int) -> int:
        listed = signatures.get(node, ())
        style = hash((own, *[signature for _, signature in listed]))
        for place, (at, signature) in enumerate(listed):
            ids[at] = hash((style, place, signature))
        return style

    # Hashes of tuples of numbers are the same in every process.
    place_children(0, hash((_signature(host), 1)))
    for at, (_, node, _, _) in enumerate(parts):
        if node >= 0:
            styles[at] = place_children(node, ids[at])
    return parts, ids, styles


def evidence(source: str, host: str) -> tuple[int, list[int], list[int], list[bool]]:
    """``(page of evidence, nodes, variants, leaf)`` of a page."""
    page = Page(source)
    parts, ids, styles = site_nodes(page, host)
    title = page.title() or max((p[3] for p in parts), key=len, default="")
    nodes, variants, leaves = [], [], []
    for (_, node, _, text), own, style in zip(parts, ids, styles):
        if node == -2:
            continue
        nodes.append(own)
        variants.append(style if node >= 0 else _hash(_DIGITS.sub("0", text)))
        leaves.append(node < 0)
    return _hash(title), nodes, variants, leaves


def main_text(source: str, host: str, low) -> str:
    """Text of a page without its branches of low importance; ``low(ids)`` gives ``{id: (own, share of children)}``."""
    page = Page(source)
    parts, ids, _ = site_nodes(page, host)
    known = low(ids)
    removed: set[int] = set()
    if known:
        # Children come after their parents: from the end on, all below a part is decided before it.
        below: dict[int, list[float]] = {}
        stays: set[int] = set()
        for at in range(len(parts) - 1, -1, -1):
            parent, node, _, _ = parts[at]
            if node == -2:
                continue
            own, share = known.get(ids[at], (1.0, 0.0))
            inner = below.get(node, []) if node >= 0 else []
            importance = own + share * (sum(inner) / len(inner)) if inner else own
            below.setdefault(parent, []).append(importance)
            if importance < THRESHOLD and node not in stays:
                if node >= 0:
                    removed.add(node)
            else:
                stays.add(parent)
    out = []
    gone: set[int] = set()
    for parent, node, _, text in parts:
        if node >= 0:
            if node in removed or parent in gone:
                gone.add(node)
        elif text and parent not in gone:
            out.append(text)
    return " ".join(out)


# over a table -----------------------------------------------------------------------------

def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def _decode(body: bytes | None) -> str:
    return (body or b"").decode("utf-8", "replace")


def importances(pages: DataFrame) -> DataFrame:
    """``(node, own, share)`` of all nodes of all sites that may be below the threshold."""
    schema = pa.schema([("unit", pa.int64()), ("nodes", pa.list_(pa.int64())), ("variants", pa.list_(pa.int64())), ("leaves", pa.list_(pa.bool_()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            rows = [evidence(_decode(body), host) for host, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    found = pages.select("host", "body").mapInArrow(run, "unit long, nodes array<long>, variants array<long>, leaves array<boolean>")
    rows = found.select("unit", F.explode(F.arrays_zip("nodes", "variants", "leaves")).alias("x"))
    rows = rows.select(F.col("x.nodes").alias("node"), F.col("x.variants").alias("variant"), F.col("x.leaves").alias("leaf"), "unit")
    k = rows.distinct().groupBy("node", "variant", "leaf").agg(F.count(F.lit(1)).alias("k"))
    sums = k.groupBy("node", "leaf").agg(
        F.sum("k").alias("m"), F.count(F.lit(1)).alias("l"), F.sum(F.log("k")).alias("logs"), F.sum(F.col("k") * F.log("k")).alias("klogs"))
    # Where a node is on one page only, nothing speaks against it.
    sums = sums.filter("m > 1")
    m, l = F.col("m"), F.col("l")
    agreement = F.col("logs") / l / F.log(m) * m / (m + PRIOR)
    entropy = (F.log(m) - F.col("klogs") / m) / F.log(m)
    share = F.pow(F.lit(DAMPING), l)
    own = F.when(F.col("leaf"), 1 - agreement).otherwise((1 - share) * entropy)
    return sums.select("node", own.alias("own"), F.when(F.col("leaf"), 0.0).otherwise(share).alias("share")).filter(F.col("own") < THRESHOLD)


_RESULT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
_RESULT_SQL = "page_id long, url string, text string, n_chars long"


def _by_broadcast(pages: DataFrame, low: DataFrame) -> DataFrame:
    rows = low.toPandas().sort_values("node")
    shared = pages.sparkSession.sparkContext.broadcast(tuple(rows[c].to_numpy() for c in ("node", "own", "share")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, own, share = shared.value

        def look_up(ids: list[int]) -> dict[int, tuple[float, float]]:
            if not len(nodes) or not ids:
                return {}
            wanted = np.array(ids, np.int64)
            at = np.minimum(np.searchsorted(nodes, wanted), len(nodes) - 1)
            hit = np.flatnonzero(nodes[at] == wanted)
            return {ids[i]: (float(own[at[i]]), float(share[at[i]])) for i in hit.tolist()}

        for batch in slices(batches, 500):
            columns = [batch.column(c).to_pylist() for c in range(4)]
            texts = [main_text(_decode(body), host, look_up) for host, body in zip(*columns[2:])]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((*columns[:2], texts, map(len, texts)), _RESULT)], schema=_RESULT)

    return pages.select("page_id", "url", "host", "body").mapInArrow(run, _RESULT_SQL)


def _by_join(pages: DataFrame, low: DataFrame) -> DataFrame:
    """The same for any number of rows: a page's nodes are joined with theirs, and gathered by page."""
    keyed = pages.withColumn("page", F.sha2(F.concat_ws("|", F.hex("body"), "host", F.col("page_id").cast("string")), 256))

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            found = [evidence(_decode(body), host)[1] for host, body in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["page", "nodes"])

    own = keyed.select("page", "host", "body").mapInArrow(nodes, "page string, nodes array<long>")
    own = own.select("page", F.explode("nodes").alias("node")).join(low, "node")
    facts = own.dropDuplicates(["page", "node"]).groupBy("page").agg(F.collect_list(F.struct("node", "own", "share")).alias("facts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            columns = [batch.column(c).to_pylist() for c in range(5)]
            texts = []
            for host, body, rows in zip(*columns[2:]):
                known = {r["node"]: (r["own"], r["share"]) for r in rows or ()}
                texts.append(main_text(_decode(body), host, lambda ids, known=known: known))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((*columns[:2], texts, map(len, texts)), _RESULT)], schema=_RESULT)

    return keyed.join(facts, "page", "left").select("page_id", "url", "host", "body", "facts").mapInArrow(run, _RESULT_SQL)


def extract(table: DataFrame, idx: str = "page_id", url: str = "url", html: str = "html", broadcast_rows: int = BROADCAST) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page."""
    pages = table.select(F.col(idx).cast("long").alias("page_id"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"), F.encode(F.col(html), "UTF-8").alias("body"))
    low = materialize(importances(pages), "site-nodes")
    if low.count() > broadcast_rows:
        return _by_join(pages, low)
    out = _by_broadcast(pages, low)
    discard(low)
    return out
