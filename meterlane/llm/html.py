"""Main text of web pages by deducing each host's template from equivalence classes.

Every page is read into tokens: the opening of each element with the path of its parents,
its closing, and whole runs of text outside the article. For each token a host combines hashes
of (page, count on it) by exclusive or: tokens with equal results have the same occurrence
vector, but for chance, and make an equivalence class. The order doesn't matter, so a
host's pages never meet in one task. A class is valid if an opening and its closing are both
in it, which nests it; classes on most pages of the host make its template.

The template says in which element the text that changes from page to page lies, and which
runs of text outside belong to the template. Without a template (a host with one or two
pages) the page's own elements decide.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlane.llm.words import portions
from meterlane.session import materialize

# A token belongs to the template if at least this share of the host's pages has it, and
# at least so many pages.
SHARE, PAGES = 0.5, 3
# An element is followed inward while one child holds this share of its text.
DOMINANT = 0.6
# What marks or a form drop is kept if it holds more than this share of the page's text.
MOST = 0.5

# Element names by their part in a page.
BOILERPLATE = frozenset("nav header footer aside menu dialog button select input textarea label fieldset iframe object embed "
                        "svg canvas audio video map math head title".split())
RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "xmp", "noembed", "noframes")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
                   "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary "
                   "table tbody td tfoot th thead tr ul caption".split())
#: Opening one of these closes an open paragraph.
CLOSES_P = BLOCKS - frozenset("td th tr tbody thead tfoot caption option optgroup legend body html".split())
CLOSED_BY_SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",), "option": ("select",)}
# Words in class, id or role that mark what is not the article.
MARKS = frozenset("ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
                  "cookies copyright disclaimer disqus footer header masthead menu nav navbar navigation newsletter notice notices "
                  "pager pagination popup promo promotion related replies reply respond share sharing sidebar signup skip social "
                  "sponsor sponsored subscribe subscription tags toolbar topbar widget widgets".split())
#: Elements that hold the article by their meaning.
ARTICLE = frozenset(("article", "main"))
#: What a head may hold; any other element, or text, ends it.
HEAD = frozenset("title base link meta script style noscript template".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{'|'.join(RAW)})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?/][^>]*>", re.S | re.I)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HEADED = re.compile(r">(?:head|title)(?:[.>]|$)")
_MARK_WORD = re.compile(r"[a-z]+")


class Element(NamedTuple):
    """``dropped`` by its name; ``doubtful`` by marks or as a form, unless it holds the article."""

    place: int
    name: str
    path: str
    dropped: bool
    doubtful: bool
    article: bool


class Run(NamedTuple):
    """A block of text, the paths around it, and whether it is boilerplate by its elements."""

    text: str
    paths: tuple[str, ...]
    dropped: bool
    article: bool


def read(page: str, root: str = "") -> tuple[list[Run], list[str]]:
    """All blocks of a page in order, and its tokens (openings and closings by path)."""
    blocks, tokens = _parse(page)
    kept = _kept(blocks, root)
    runs = []
    for text, owner in blocks:
        dropping = [e.place for e in owner if e.dropped or (e.doubtful and e.place not in kept)]
        article = any(e.article and not (dropping and dropping[0] < e.place) for e in owner)
        runs.append(Run(text, tuple(e.path for e in owner), bool(dropping), article))
    return runs, tokens


def _kept(blocks: list[tuple[str, tuple[Element, ...]]], root: str) -> set[int]:
    """Places of doubtful elements that are kept: forms that hold most of the page's text; if no article
    has text outside of doubtful elements, those around the largest one and those that hold most of it;
    without an article those around the template's root, or else all that hold most of the text."""
    open_blocks = [(len(text), owner) for text, owner in blocks if not any(e.dropped for e in owner)]
    if not any(e.doubtful for _, owner in open_blocks for e in owner):
        return set()
    chars: dict[int, int] = defaultdict(int)
    for size, owner in open_blocks:
        for e in owner:
            chars[e.place] += size
    whole = sum(size for size, _ in open_blocks)
    kept = {e.place for _, owner in open_blocks for e in owner if e.name == "form" and chars[e.place] > MOST * whole}
    articles: dict[int, int] = {}
    roots: dict[int, int] = {}
    free_root = False
    for k, (_, owner) in enumerate(open_blocks):
        free = not any(e.doubtful and e.place not in kept for e in owner)
        for e in owner:
            if e.article and free:
                return kept
            if e.article:
                articles.setdefault(e.place, k)
            if root and e.path == root:
                roots.setdefault(e.place, k)
                free_root |= free
    found = articles or roots
    if free_root and not articles:
        return kept
    if not found:
        return kept | {place for place, size in chars.items() if size > MOST * whole}
    largest = max(found, key=lambda place: (chars[place], -place))
    around = {e.place for e in open_blocks[found[largest]][1] if e.place <= largest}
    inside = {e.place for _, owner in open_blocks if any(o.place == largest for o in owner)
              for e in owner if e.place > largest and chars[e.place] > MOST * chars[largest]}
    return kept | around | inside


def _parse(page: str) -> tuple[list[tuple[str, tuple[Element, ...]]], list[str]]:
    """The blocks of text with the elements around them, and the tokens."""
    stack: list[Element] = []
    runs: list[tuple[str, tuple[Element, ...]]] = []
    tokens: list[str] = []
    parts: list[str] = []
    owner: list[Element] = []
    places = count()

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            runs.append((text, tuple(owner)))

    def pop(until: int) -> None:
        nonlocal owner
        while len(stack) > until:
            element = stack.pop()
            if element.name in BLOCKS or element.name == "head" or (element.name == "title" and not any(e.name == "svg" for e in stack)):
                flush()
            tokens.append("/" + element.path)
        owner = list(stack)

    def add(text: str) -> None:
        nonlocal owner
        if text:
            if stack and stack[-1].name == "head" and not text.isspace():
                pop(len(stack) - 1)
            if not parts:
                owner = list(stack)
            parts.append(text)

    at = 0
    for m in TOKEN.finditer(page):
        add(page[at:m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if m["close"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].name == name:
                    pop(k)
                    break
                # An inline element's end doesn't close the blocks around it.
                if name not in BLOCKS and stack[k].name in BLOCKS:
                    break
            continue
        if name not in HEAD:
            for k, element in enumerate(stack):
                if element.name == "head":
                    pop(k)
                    break
        if name in VOID:
            if name in BLOCKS:
                flush()
            else:
                add(" " if name == "br" else "")
            continue
        if name in CLOSES_P:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].name == "p":
                    pop(k)
                    break
                if stack[k].name in BLOCKS:
                    break
        if name in CLOSED_BY_SAME:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].name in CLOSED_BY_SAME[name]:
                    break
                if stack[k].name == name or (name in ("dt", "dd") and stack[k].name in ("dt", "dd")) \
                        or (name in ("td", "th") and stack[k].name in ("td", "th")):
                    pop(k)
                    break
        if name in BLOCKS:
            flush()
        values = [" ".join(v for v in a.groups()[1:] if v) for a in ATTRIBUTE.finditer(m["attrs"])] if "=" in m["attrs"] else []
        signs = {w for value in values for w in _MARK_WORD.findall(value.lower())}
        label = name + "".join("." + value.lower() for value in values[:1])
        path = (stack[-1].path if stack else "") + ">" + label
        marked = bool(signs & MARKS)
        dropped = name in BOILERPLATE
        if name == "header" and any(e.article for e in stack):
            dropped = marked  # an article's own heading
        doubtful = not dropped and (name == "form" or (marked and name not in ("body", "html", *ARTICLE)))
        stack.append(Element(next(places), name, path, dropped, doubtful, name == "main" or (name in ARTICLE and not marked)))
        tokens.append(path)
        if not m["attrs"].rstrip().endswith("/") or name in BLOCKS:
            continue
        pop(len(stack) - 1)
    add(page[at:])
    pop(0)
    flush()
    return runs, tokens


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text, 7) - (1 << 63)


def host_column(url: str = "url"):
    """Lower-case host of a URL; pages without one share the empty host."""
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1)), F.lit(""))


def templates(pages: DataFrame) -> DataFrame:
    """(host, pages, tokens): the template tokens of each host from rows (host, page, html).

    tokens is an array of (token, path, class, chars); the token count of a host's template is
    bounded by that of a page, as each of them is on half of the pages.
    """
    counted = materialize(
        pages.mapInArrow(_count, "host string, token long, path string, vector long, pages long, times long, chars long")
        .groupBy("host", "token").agg(
            F.min("path").alias("path"), F.expr("bit_xor(vector)").alias("mixed"), F.sum("pages").alias("pages"),
            F.sum("times").alias("times"), F.sum("chars").alias("chars")), "page-tokens")
    total = counted.filter("token = 0").select("host", F.col("pages").alias("all_pages"))
    frequent = counted.filter(F.col("token") != 0).join(total, "host").filter(
        (F.col("pages") >= PAGES) & (F.col("pages") >= SHARE * F.col("all_pages")))
    return frequent.groupBy("host").agg(F.max("all_pages").alias("pages"), F.collect_list(F.struct(
        "token", "path", F.struct("mixed", "pages", "times").alias("class"), "chars")).alias("tokens"))


def _count(batches):
    """Sums by host and token of what this task has read, let go when they get many.

    ``vector`` is the xor over pages of a hash of the page and the count on it: equal for two
    tokens exactly if (but for chance) they occur equally often on every page.
    """
    sums: dict[tuple[str, int], list] = {}
    for batch in batches:
        for part in portions(batch, "html"):
            for host, page, text in zip(*(part.column(c).to_pylist() for c in ("host", "page", "html"))):
                runs, tokens = read(text or "")
                counts: dict[str, int] = defaultdict(int)
                chars: dict[str, int] = defaultdict(int)
                for token in tokens:
                    counts[token] += 1
                for run in runs:
                    if not run.article:
                        counts["=" + run.text] += 1
                    if not run.dropped:
                        for path in run.paths:
                            chars[path] += len(run.text)
                for token, times in [("", 1), *counts.items()]:
                    path = token if token[:1] in (">", "/") else ""
                    entry = sums.setdefault((host, _hash(token) if token else 0), [path, 0, 0, 0, 0])
                    entry[1] ^= xxhash.xxh64_intdigest(f"{page}:{times}", 11) - (1 << 63)
                    entry[2] += 1
                    entry[3] += times
                    entry[4] += chars.get(token, 0)
        if len(sums) > 200_000:
            yield _sums(sums)
            sums = {}
    if sums:
        yield _sums(sums)


def _sums(sums: dict) -> pa.RecordBatch:
    hosts, tokens = zip(*sums)
    paths, *numbers = zip(*sums.values())
    return pa.RecordBatch.from_arrays(
        [pa.array(hosts, pa.string()), pa.array(tokens, pa.int64()), pa.array(paths, pa.string()),
         *[pa.array(n, pa.int64()) for n in numbers]], ["host", "token", "path", "vector", "pages", "times", "chars"])


class Template(NamedTuple):
    """The element that holds the article (empty: none found) and the runs of the template."""

    root: str
    runs: frozenset[int]


def deduced(tokens: list[dict]) -> Template:
    """Nest the valid classes and follow the text inward from the outermost element."""
    classes = defaultdict(set)
    for t in tokens:
        classes[tuple(t["class"].values())].add(t["path"])
    elements = {t["path"]: t["chars"] for t in tokens if t["path"].startswith(">") and t["chars"]
                and "/" + t["path"] in classes[tuple(t["class"].values())] and t["class"]["times"] == t["class"]["pages"]}
    root, article = "", ""
    while True:
        children = {p: c for p, c in elements.items() if p.rpartition(">")[0] == root and p != root}
        best = max(children, key=lambda p: (children[p], p), default=None)
        if best is None:
            break
        name = best.rpartition(">")[2].split(".")[0]
        whole = elements.get(root) or sum(children.values())
        if name in ("p", "b", "h1", "h2", "h3", "li", "a", "span") or children[best] < DOMINANT * whole:
            break
        root = best
        if name in ARTICLE:
            article = root
    return Template(article or root, frozenset(t["token"] for t in tokens if not t["path"]))


def extract(page: str, template: Template | None) -> str:
    """The blocks of the article, joined by two line breaks.

    An article element of the page comes first, then the template's element, then the whole
    page; outside an article, the template's own runs are left out. If nothing is left by that,
    they stay, and if all is boilerplate, it stays but for the head.
    """
    runs, _ = read(page, template.root if template else "")
    left = [r for r in runs if not r.dropped] or [r for r in runs if not HEADED.search(r.paths[-1] if r.paths else "")]
    chosen = [r for r in left if r.article]
    if not chosen:
        own = [r for r in left if not template or _hash("=" + r.text) not in template.runs]
        inside = [r for r in own if template and template.root in r.paths]
        chosen = inside or own or left
    return "\n\n".join(r.text for r in chosen)


def main_text(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars), one row per row of ``pages``.

    A null page is empty and gives an empty text; rows that repeat are read each; pages with
    a null URL are one host. Extra columns are left out.
    """
    rows = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"),
                        F.col(html_column).cast("string").alias("html"))
    hosted = rows.withColumn("host", host_column())
    # Written, so that its size is known: a small table is broadcast, and beside a large one the
    # pages of a hot host are split.
    known = materialize(templates(hosted.select("host", F.xxhash64("page_id", "html").alias("page"), "html"))
                        .select("host", "tokens"), "templates")
    kinds = dict(rows.dtypes)
    return hosted.join(known, "host", "left").select("page_id", "url", "html", "host", "tokens").mapInArrow(
        _extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


def _extract(batches):
    seen: dict[str, Template | None] = {}
    for batch in batches:
        for part in portions(batch, "html"):
            tokens = part.column("tokens")
            texts = []
            for i, (host, page) in enumerate(zip(part.column("host").to_pylist(), part.column("html").to_pylist())):
                if host not in seen:
                    if len(seen) > 10_000:
                        seen.clear()
                    found = tokens[i].as_py()
                    seen[host] = deduced(found) if found else None
                texts.append(extract(page or "", seen[host]))
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                 pa.array(np.array([len(t) for t in texts], np.int64))], ["page_id", "url", "text", "n_chars"])
