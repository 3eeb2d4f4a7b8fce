"""Main text of web pages by union-free wrappers inferred for each host.

A page's element tree is read as a token stream. Within a page, neighbouring
repeats are squeezed into repeated groups; then the pages of a host are aligned
one by one: elements of equal label are matched in order (longest common
subsequence), an element that one side lacks becomes optional, neighbouring
copies become a repeated group, and text that differs becomes a text slot.
The result is a regular expression without unions over tags and slots, one
wrapper a host, which also counts the text each element held.

The wrapper decides which elements hold the article: declared ones (``article``,
``main``) or, without those, the container into which most of the varying text
leads. Menus, headers, footers, sidebars, notices, adverts, forms and comments
are known by element, role, or class and id names; without declared elements
also by being mostly links, or by holding the same text on every page of the
host. Each page is then matched against its host's wrapper and its text read.

On Spark: tasks fold their own pages into one wrapper a host (what is sent is
bounded by hosts and layouts, not pages), partial wrappers are merged by (host,
salt) and then by host, and pages meet their host's wrapper in a merge join.
Hosts with more than one in ``HOT_SHARE`` of the pages (so fewer hosts than
that) are dealt to several tasks.

Defined cases: null and empty pages, and pages without text, give an empty text;
a page without a host in its url is its own wrapper; equal rows give equal rows;
an element nested deeper than ``MOST_DEPTH`` is handled like its ancestor there.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .html_tree import HEADINGS, Node, parse

#: A host is hot beyond one in this many pages; it is dealt to a task for each such share.
HOT_SHARE = 256
#: Wrappers that one task holds before it sends them on.
MOST_HOSTS = 4096
MOST_DEPTH = 64
MOST_KIDS = 40
MERGE_SALTS = 64

# Names by which boilerplate elements are commonly marked.
DROPPED_TAGS = frozenset("head nav aside footer form fieldset button select option optgroup noscript template svg canvas object video audio map menu dialog".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar tablist".split())
DROPPED_NAMES = frozenset(
    (
        "ad ads adv advert adverts advertisement advertising adsbygoogle sponsor sponsored sponsors promo promos promotion promoted banner sidebar sidebars "
        "menu menus nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar cookie cookies consent gdpr notice notices alert alerts popup modal overlay "
        "newsletter subscribe subscription signup login share sharing social related recommended recommendations comment comments commentlist respond disqus replies reply "
        "widget widgets pagination pager toolbar skip copyright disclaimer search searchform taboola outbrain"
    ).split()
)
_COMMENT_HEADING = re.compile(r"(?:\d+\s+)?(?:reader\s+|leave a\s+)?(?:comments?|responses|replies|reply|kommentare?|commentaires?|comentarios?)\b(?:\s*\(?\d*\)?)?:?\s*$", re.I)
#: Elements whose class names mark the page, not a part of it.
_WHOLE = frozenset(["#root", "html", "body", "main", "article"])
#: Elements that are alike only if their contents are.
_GENERIC = frozenset("div section td th ul ol table center dl".split())
_CONTAINERS = frozenset("#root html body div section main article center table tbody tr td".split())
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SAME, _VARIES = "", "*"


def _marked(names: tuple[str, ...], role: str = "") -> bool:
    if role in DROPPED_ROLES:
        return True
    for name in names:
        for part in _PARTS.findall(name):
            if part.lower() in DROPPED_NAMES:
                return True
    return False


class W:
    """A wrapper element: quantifiers, ordered kids, and what the host's pages hold there."""

    __slots__ = ("label", "tag", "kids", "opt", "rep", "boiler", "pages", "chars", "links", "literal")

    def __init__(self, label: str, boiler: bool = False, chars: int = 0, links: int = 0, literal: str = _SAME):
        self.label, self.boiler = label, boiler
        self.tag = re.split(r"[.\[]", label, maxsplit=1)[0]
        self.kids: list[W] = []
        self.opt = self.rep = False
        self.pages, self.chars, self.links, self.literal = 1, chars, links, literal

    def dump(self) -> list:
        return [self.label, int(self.opt), int(self.rep), int(self.boiler), self.pages, self.chars, self.links, self.literal, [k.dump() for k in self.kids]]

    @classmethod
    def load(cls, raw: list) -> W:
        w = cls(raw[0], bool(raw[3]), raw[5], raw[6], raw[7])
        w.opt, w.rep, w.pages = bool(raw[1]), bool(raw[2]), raw[4]
        w.kids = [cls.load(k) for k in raw[8]]
        return w

    def total(self) -> int:
        return self.chars + sum(k.total() for k in self.kids)

    def total_links(self) -> int:
        return self.links + sum(k.total_links() for k in self.kids)

    def has(self, test) -> bool:
        return test(self) or any(k.has(test) for k in self.kids)


def _boilerplate(node: Node) -> bool:
    if node.tag in DROPPED_TAGS or node.tag == "header":
        return True
    if node.tag == "article":
        return any(p.lower() in ("comment", "comments", "reply", "replies", "respond") for n in node.names for p in _PARTS.findall(n))
    if node.tag in _WHOLE:
        return False
    if _marked(node.names, node.role):
        return True
    if node.tag in ("section", "div", "ol", "ul") and node.kids:
        first = next((k for k in node.kids if not isinstance(k, tuple) or k[0].strip()), None)
        if isinstance(first, Node) and first.tag in HEADINGS:
            return bool(_COMMENT_HEADING.match(" ".join("".join(k[0] for k in first.kids if isinstance(k, tuple)).split())))
    return False


def fold(node: Node, depth: int = 0) -> W:
    """The page's own wrapper: repeats squeezed, text counted."""
    chars = links = 0
    pieces = []
    kids: list[W] = []
    for k in node.kids:
        if isinstance(k, tuple):
            size = len(k[0])
            if k[1]:
                links += size
            else:
                chars += size
            pieces.append(k[0])
        elif depth < MOST_DEPTH:
            own = fold(k, depth + 1)
            if kids and _alike(kids[-1], own):
                kids[-1] = merge(kids[-1], own, across=False)
                kids[-1].rep = True
            else:
                kids.append(own)
        else:
            chars += sum(len(x[0]) for x in _pieces(k))
    text = " ".join("".join(pieces).split())
    w = W(node.label, _boilerplate(node), chars if text else 0, links if text else 0, xxhash.xxh64_hexdigest(text)[:8] if text else _SAME)
    w.kids = _squeeze(kids)
    return w


def _pieces(node: Node) -> Iterator[tuple[str, bool]]:
    """All text pieces below ``node`` (iterative: pages may nest deeply)."""
    todo = list(reversed(node.kids))
    while todo:
        k = todo.pop()
        if isinstance(k, tuple):
            yield k
        else:
            todo += reversed(k.kids)


def _alike(a: W, b: W) -> bool:
    """Whether two elements may be the same part of a layout."""
    if a.label != b.label:
        return False
    if a.tag != a.label or a.tag not in _GENERIC:
        return True
    # a row of links isn't the same part as a text
    return _similar(_labels(a), _labels(b)) and (bool(a.kids) or (a.links > a.chars) == (b.links > b.chars))


def _labels(w: W) -> set[str]:
    return {x.label for k in w.kids for x in (k.kids if k.label.startswith("(") else (k,))}


def _similar(x: set[str], y: set[str]) -> bool:
    return (not x and not y) or 3 * len(x & y) > len(x | y)


def merge(a: W, b: W, across: bool) -> W:
    """Alignment of two elements of one label; ``across`` pages their page counts add up."""
    w = W(a.label, a.boiler or b.boiler, a.chars + b.chars, a.links + b.links, a.literal if a.literal == b.literal else _VARIES)
    w.opt, w.rep = a.opt or b.opt, a.rep or b.rep
    w.pages = a.pages + b.pages if across else max(a.pages, b.pages)
    w.kids = _align(a.kids, b.kids, across)
    return w


def _align(a: list[W], b: list[W], across: bool) -> list[W]:
    if len(a) == len(b) and all(_alike(x, y) for x, y in zip(a, b, strict=True)):
        return [merge(x, y, across) for x, y in zip(a, b, strict=True)]
    a, b = _grouped_as(a, b), _grouped_as(b, a)
    n, m = len(a), len(b)
    best = np.zeros((n + 1, m + 1), dtype=np.int32)
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            skip = max(best[i + 1, j], best[i, j + 1])
            best[i, j] = max(skip, best[i + 1, j + 1] + 1) if _alike(a[i], b[j]) else skip
    out, i, j = [], 0, 0
    while i < n and j < m:
        if _alike(a[i], b[j]) and best[i, j] == best[i + 1, j + 1] + 1:
            out.append(merge(a[i], b[j], across))
            i, j = i + 1, j + 1
        elif best[i + 1, j] >= best[i, j + 1]:
            out.append(_optional(a[i]))
            i += 1
        else:
            out.append(_optional(b[j]))
            j += 1
    out += [_optional(x) for x in a[i:]] + [_optional(x) for x in b[j:]]
    joined: list[W] = []
    for x in out:
        if joined and _alike(joined[-1], x):
            opt = joined[-1].opt and x.opt
            joined[-1] = merge(joined[-1], x, across=False)
            joined[-1].rep, joined[-1].opt = True, opt
        else:
            joined.append(x)
    return _squeeze(joined)


def _optional(w: W) -> W:
    w.opt = True
    return w


def _group(members: list[W]) -> W:
    g = W("(" + " ".join(k.label for k in members) + ")")
    g.kids, g.rep = members, True
    g.pages = max(k.pages for k in members)
    return g


def _squeeze(kids: list[W]) -> list[W]:
    """Neighbouring repeats of two to four elements become a repeated group; a long irregular mixture one group of optionals."""
    if len(kids) < 4:
        return kids
    for size in (2, 3, 4):
        labels = [k.label for k in kids]
        out, i = [], 0
        while i < len(kids):
            j = i + size
            while labels[i : i + size] == labels[j : j + size] and j + size <= len(kids) and all(_alike(x, y) for x, y in zip(kids[i : i + size], kids[j : j + size], strict=True)):
                j += size
            if j > i + size:
                members = kids[i : i + size]
                for at in range(i + size, j, size):
                    members = [merge(x, y, across=False) for x, y in zip(members, kids[at : at + size], strict=True)]
                out.append(_group(members))
                i = j
            else:
                out.append(kids[i])
                i += 1
        kids = out
    if len(kids) <= MOST_KIDS:
        return kids
    by: dict[str, W] = {}
    todo = list(kids)
    while todo:
        k = todo.pop(0)
        if k.label.startswith("("):
            todo[:0] = k.kids
            continue
        label = k.label if len(by) < MOST_KIDS or k.label in by else k.tag
        if label != k.label:
            k.label = label
        by[label] = merge(by[label], k, across=False) if label in by else k
        by[label].rep = by[label].opt = True
    return [_group(list(by.values()))]


def _grouped_as(kids: list[W], other: list[W]) -> list[W]:
    """``kids`` with runs that match a repeated group of ``other`` put into such a group."""
    for g in other:
        if not g.label.startswith("(") or any(k.label == g.label for k in kids):
            continue
        labels, size = [k.label for k in g.kids], len(g.kids)
        members = {k.label for k in g.kids}
        for i in range(len(kids) - size + 1):
            if [k.label for k in kids[i : i + size]] == labels:
                kids = kids[:i] + [_group(kids[i : i + size])] + kids[i + size :]
                break
        else:
            if any(k.opt for k in g.kids) and all(k.label in members for k in kids) and kids:
                by = {k.label: k for k in kids if not k.label.startswith("(")}
                if len(by) == len(kids) and [x for x in labels if x in by] == list(by):
                    fill = [by[x] if x in by else _empty(y) for x, y in zip(labels, g.kids, strict=True)]
                    return [_group(fill)]
    return kids


def _empty(like: W) -> W:
    w = W(like.label, like.boiler)
    w.opt, w.pages = True, 0
    return w


# ---------------------------------------------------------------- decisions


def decide(root: W) -> dict:
    """The wrapper with a verdict for each element: part of the article, dropped, or neither."""
    _spare(root, root.total())
    regions = _declared(root, "article", "[article]") or _declared(root, "main", "[main]")
    declared = bool(regions)
    if not regions:
        regions = [_container(root)]
    return _verdicts(root, {id(r) for r in regions}, declared, root.pages)


def _spare(w: W, total: int) -> None:
    """An element that holds a declared article, or a headline and most of the text, is no boilerplate, whatever its names say."""
    for k in w.kids:
        _spare(k, total)
    if w.boiler and w.tag in ("div", "section", "center", "td", "table"):
        article = w.has(lambda x: x is not w and x.tag in ("article", "main") and not x.boiler)
        w.boiler = not article and not (w.has(lambda x: x.tag == "h1") and 2 * w.total() > total)


def _declared(root: W, tag: str, role: str) -> list[W]:
    found: list[W] = []

    def walk(w: W) -> None:
        if w.boiler:
            return
        if w.tag == tag or role in w.label:
            found.append(w)
            return
        for k in w.kids:
            walk(k)

    walk(root)
    most = max((_own_text(w) for w in found), default=0)
    # teasers beside the article hold little text
    return [w for w in found if most and 10 * _own_text(w) >= 3 * most]


def _own_text(w: W) -> int:
    """Text below ``w`` that isn't boilerplate, the same on every page, or a list of links."""
    if w.boiler:
        return 0
    own = 0 if w.literal not in (_SAME, _VARIES) and w.pages >= 3 and not w.rep else w.chars
    return own + sum(_own_text(k) for k in w.kids)


def _container(root: W) -> W:
    """The deepest container to which most of the varying text leads."""
    w = root
    while True:
        total = _own_text(w)
        if any(k.tag in ("h1", "h2") and not k.boiler for k in w.kids):
            return w
        kids = [k for g in w.kids for k in (g.kids if g.label.startswith("(") else [g])]
        heavy = [k for k in kids if k.tag in _CONTAINERS and not k.boiler and 10 * _own_text(k) >= 7 * total]
        if not total or not heavy or heavy[0].rep:
            return w
        w = heavy[0]


def _verdicts(w: W, regions: set[int], declared: bool, pages: int, inside: bool = False) -> dict:
    inside = inside or id(w) in regions
    out: dict = {"label": w.label, "tag": w.tag, "in": int(inside), "drop": int(w.boiler), "kids": []}
    if inside and not declared and id(w) not in regions and w.tag not in HEADINGS and not w.boiler:
        links, chars = w.total_links(), w.total()
        if w.tag != "p" and links >= 20 and 2 * links > 3 * chars:
            out["drop"] = 1
        if pages >= 3 and not w.rep and not w.opt and _constant(w):
            out["drop"] = 1
    for k in w.kids:
        own = _verdicts(k, regions, declared, pages, inside)
        out["kids"] += [{**x, "loop": 1} for x in own["kids"]] if k.label.startswith("(") else [own]
    out["labels"] = sorted({k["label"] for k in out["kids"]})
    return out


def _constant(w: W) -> bool:
    """All text below is the same on every page, and there is some."""
    some = w.has(lambda x: x.literal not in (_SAME, _VARIES))
    return some and not w.has(lambda x: x.literal == _VARIES or (x is not w and (x.opt or x.rep)))


# ---------------------------------------------------------------- extraction


def main_text(root: Node, verdict: dict) -> str:
    """The blocks of the article, joined by two line feeds."""
    blocks: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            blocks.append(text)

    # explicit stack: (node, verdict or None, article?, kid index, pointer into the verdict's kids)
    stack = [[root, verdict, bool(verdict["in"]), 0, 0]]
    while stack:
        frame = stack[-1]
        node, own, inside, i, pointer = frame
        if i >= len(node.kids):
            stack.pop()
            if not node.inline:
                flush()
            continue
        frame[3] += 1
        k = node.kids[i]
        if isinstance(k, tuple):
            if inside:
                run.append(k[0])
            continue
        found, frame[4] = _match(k, own, pointer)
        if not k.inline:
            flush()
        header = k.tag == "header" and inside and node.tag != "#root"
        # what the wrapper doesn't know is judged by its names alone
        drop = bool(found["drop"]) if found is not None else _boilerplate(k)
        if header:
            for h in k.kids:
                if isinstance(h, Node) and h.tag in HEADINGS:
                    run += [p[0] for p in _pieces(h)]
                    flush()
        if not drop:
            stack.append([k, found, inside or bool(found is not None and found["in"]), 0, 0])
    flush()
    return "\n\n".join(blocks)


def _match(node: Node, own: dict | None, pointer: int) -> tuple[dict | None, int]:
    """The wrapper element for ``node``: the next alike one in order, else one of a repeated group or of equal label."""
    if own is None:
        return None, pointer
    kids = own["kids"]
    same = [x for x in range(len(kids)) if kids[x]["label"] == node.label]
    if not same:
        return None, pointer
    if len(same) > 1:
        labels = {k.label for k in node.kids if not isinstance(k, tuple)}
        fit = [x for x in same if _similar(labels, set(kids[x]["labels"]))]
        same = fit or same
    ahead = [x for x in same if x >= pointer]
    at = (ahead or same)[0]
    return kids[at], at


# ---------------------------------------------------------------- on Spark


_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def _column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def _fold_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One partial wrapper a host and task."""
    held: dict[str, W] = {}

    def send() -> pa.RecordBatch:
        out = pa.RecordBatch.from_pydict(
            {"host": pa.array(list(held), type=pa.string()), "wrapper": pa.array([json.dumps(w.dump(), separators=(",", ":")) for w in held.values()], type=pa.string())}
        )
        held.clear()
        return out

    for batch in batches:
        for host, page in zip(_column(batch, "host"), _column(batch, "html"), strict=True):
            own = fold(parse(page, _marked))
            held[host] = merge(held[host], own, across=True) if host in held else own
            if len(held) >= MOST_HOSTS:
                yield send()
    yield send()


def _merge_wrappers(table: pa.Table) -> pa.Table:
    whole: W | None = None
    for raw in sorted(table.column("wrapper").to_pylist()):
        own = W.load(json.loads(raw))
        whole = own if whole is None else merge(whole, own, across=True)
    text = json.dumps(whole.dump(), separators=(",", ":"))
    return pa.table({"host": pa.array(table.column("host").to_pylist()[:1], type=pa.string()), "wrapper": pa.array([text], type=pa.string())})


def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host, wrapper``: the wrapper of each host as JSON text."""
    own = pages.select(F.lower(F.regexp_extract(F.col(url_col), _HOST, 1)).alias("host"), F.col(html_col).alias("html"))
    own = own.where("host <> '' and html <> ''")
    ddl = "host string, wrapper string"
    partial = own.mapInArrow(_fold_pages, ddl).withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(MERGE_SALTS)))
    partial = partial.groupBy("host", "salt").applyInArrow(lambda t: _merge_wrappers(t.select(["host", "wrapper"])), ddl)
    return partial.groupBy("host").applyInArrow(_merge_wrappers, ddl)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, tuple[str, dict]] = {}
    for batch in batches:
        texts = []
        for page, host, wrapper in zip(_column(batch, "html"), _column(batch, "host"), _column(batch, "wrapper"), strict=True):
            if not page:
                texts.append("")
                continue
            root = parse(page, _marked)
            if wrapper is None:
                texts.append(main_text(root, decide(fold(root))))
                continue
            if known.get(host, ("",))[0] != wrapper:
                if len(known) >= MOST_HOSTS:
                    known.clear()
                known[host] = (wrapper, decide(W.load(json.loads(wrapper))))
            text = main_text(root, known[host][1])
            # a page that has nothing where its host's wrapper looks is read by itself
            texts.append(text or main_text(root, decide(fold(root))))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, type=pa.string())], names=["page_id", "url", "text"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages``."""
    own = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    own = own.withColumn("host", F.lower(F.regexp_extract(F.col("url"), _HOST, 1))).withColumn("host", F.when(F.col("host") != "", F.col("host")))
    wrappers = infer_wrappers(pages, url_col, html_col)
    # fewer than HOT_SHARE hosts can be hot, so their table is bounded whatever the input
    counts = own.where("host is not null").groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    shares = F.floor(F.col("n") * HOT_SHARE / counts.agg(F.sum("n")).scalar()).cast("int")
    hot = counts.withColumn("salts", shares).where("salts > 1").select("host", "salts")
    salt = F.pmod(F.xxhash64("page_id", "html"), F.coalesce(F.col("salts"), F.lit(1))).cast("int")
    dealt = own.join(F.broadcast(hot), "host", "left").withColumn("salt", salt).drop("salts")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("salts"), F.lit(1)) - 1))
    wrappers = wrappers.join(F.broadcast(hot), "host", "left").select("host", "wrapper", copies.alias("salt"))
    met = dealt.join(wrappers.hint("merge"), ["host", "salt"], "left").select("page_id", "url", "html", "host", "wrapper")
    schema = T.StructType([own.schema["page_id"], own.schema["url"], T.StructField("text", T.StringType())])
    return met.mapInArrow(_extract, schema).withColumn("n_chars", F.length("text").cast("long"))
