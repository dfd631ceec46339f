"""Main text of web pages, by the path that the pages of a host agree on.

A page is read into its containers. Each container scores the characters of the blocks in it, without
links and without what is marked as a menu, a header, an advert and so on; the page's candidate is
the deepest container that holds most of them. Its generalised path (tags and classes from the
root, digits as ``#``) is the page's vote. Spark counts the votes of each host, and every page of
the host is then read again below the winning path. Pages without it use their own candidate.

A page is looked at by itself, so memory is bounded by one page. Votes shrink before the
shuffle: a host with a third of all pages is one row per task and path.
"""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.url_reputation import url_host
from larkspur.session import cut_lineage


class Settings(NamedTuple):
    """A container is the candidate if it holds this share of the page's text; an article or main element, less."""

    share: float = 0.75
    marked_share: float = 0.4


#: Elements of the language that stand on lines of their own, and parts of tables and forms.
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li listing main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that hold a block's text and are no containers.
_LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre tr td th caption figcaption legend summary address hr ul ol dl table tbody thead tfoot".split())
#: Elements without an end.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not read as markup.
_RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
#: Elements that are never part of the article.
_LEFT_OUT = frozenset(
    "head nav header footer aside menu form search dialog template noscript button select datalist label svg canvas object audio video map".split()
)
#: Words in a class or an id that mark what is no part of the article.
_MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu menubar breadcrumb "
    "breadcrumbs header masthead topbar footer bottombar sidebar aside notice notices cookie cookies consent gdpr alert disclaimer popup modal "
    "overlay comment comments reply replies respond disqus share sharing social newsletter subscribe subscription signup login related "
    "recommended pagination pager widget toolbar skip hidden".split()
)
#: Roles that mark the same.
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
#: What an element that begins closes, looked for up to an element of the second kind.
_CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)), "td": (("td", "th"), ("table", "tr")), "th": (("td", "th"), ("table", "tr")),
    "tbody": (("tbody", "thead", "tfoot"), ("table",)), "thead": (("tbody", "thead", "tfoot"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot"), ("table",)), "option": (("option",), ("select", "datalist")), "body": (("head",), ()),
}
_STRUCTURE = _BLOCKS | (_LEFT_OUT - {"label"})

#: A tag whose quoted values may hold ``>``; values and their number are bounded, so that a stray quote costs little.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]{0,64})((?:[^>"']++|"[^"]{0,4096}+"|'[^']{0,4096}+'){0,64}+)>""")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]{0,64})([^>]*+)>")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s{0,16}=\s{0,16}(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_TOLD = re.compile(r"class|id|role|hidden|style", re.I)
_COMMENT_END = re.compile(r"--!?>")
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_DIGITS = re.compile(r"[0-9]+")
_UNSEEN = re.compile(r"display\s{0,4}:\s{0,4}none|visibility\s{0,4}:\s{0,4}hidden", re.I)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in _RAW}


class Page(NamedTuple):
    """Elements in page order with parent, path and tag (0 is the page itself), and blocks: element, text, characters in links.

    ``steps`` names each path: its parent path and its last step.
    """

    parents: list[int]
    paths: list[int]
    tags: list[str]
    steps: dict[tuple[int, str], int]
    blocks: list[tuple[int, str, int]]


def _attributes(told: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(told):
        out.setdefault(m.group(1).lower(), unescape(m.group(2) or m.group(3) or m.group(4) or ""))
    return out


def _step_of(tag: str, told: str) -> tuple[str, bool]:
    """The generalised step of an element, and whether its attributes say that it is no part of the article."""
    if not told or not _TOLD.search(told):
        return tag, False
    own = _attributes(told)
    classes = own.get("class", "").split()
    step = ".".join([tag, *sorted({_DIGITS.sub("#", c.lower()).replace("/", "") for c in classes})])
    words = set(_WORD.findall(_CAMEL.sub(" ", " ".join([*classes, own.get("id", "")])).lower()))
    out = (
        (tag not in ("html", "body", "main") and not words.isdisjoint(_MARKS)) or own.get("role", "").lower() in _ROLES
        or "hidden" in own or own.get("aria-hidden", "").lower() == "true" or _UNSEEN.search(own.get("style", "")) is not None
    )
    return step, out


def read_page(html: str) -> Page:
    """Containers and blocks of a page. Unclosed elements end where their parent does, or where the language says.

    White space inside a block, a line break among it, is one space. What is left out has no blocks.
    """
    parents, paths, tags, left_out = [-1], [0], [""], [False]
    steps: dict[tuple[int, str], int] = {}
    blocks: list[tuple[int, str, int]] = []
    stack: list[int] = [0]  # elements that are open
    open_at: dict[str, list[int]] = {}  # for each tag, where in the stack it is open
    pieces: list[str] = []
    links: list[str] = []
    in_link = False

    def flush() -> None:
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                blocks.append((stack[-1], text, len(" ".join("".join(links).split()))))
            pieces.clear()
            links.clear()

    def put(raw: str) -> None:
        if raw and not left_out[stack[-1]]:
            text = unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if in_link:
                links.append(text)

    def close(tag: str, until: tuple[str, ...] = ()) -> None:
        places = open_at.get(tag)
        if places and not any(open_at.get(u) and open_at[u][-1] > places[-1] for u in until):
            flush()
            for element in reversed(stack[places[-1] :]):
                open_at[tags[element]].pop()
                stack.pop()

    def begin(tag: str, told: str) -> None:
        if open_at.get("p"):
            close("p", ("button", "table", "td", "th", "object", "caption"))
        for closed in _CLOSES.get(tag, ((), ()))[0]:
            close(closed, _CLOSES[tag][1])
        flush()
        parent = stack[-1]
        step, marked = _step_of(tag, told)
        path = steps.setdefault((paths[parent], step), len(steps) + 1)
        parents.append(parent)
        paths.append(path)
        tags.append(tag)
        left_out.append(left_out[parent] or marked or tag in _LEFT_OUT)
        if tag not in _VOID:
            open_at.setdefault(tag, []).append(len(stack))
            stack.append(len(tags) - 1)

    at, size = 0, len(html)
    while at < size:
        sign = html.find("<", at)
        if sign < 0:
            put(html[at:])
            break
        put(html[at:sign])
        after = html[sign + 1 : sign + 4]
        if after == "!--":
            end = _COMMENT_END.search(html, sign + 2)
            at = end.end() if end else size
            continue
        if after[:1] in ("!", "?") or (after[:1] == "/" and not after[1:2].isalpha()):
            end_sign = html.find(">", sign)
            at = end_sign + 1 if end_sign >= 0 else size
            continue
        found = _TAG.match(html, sign) or _LOOSE_TAG.match(html, sign)
        if not found:
            if after[:1].isascii() and (after[:1].isalpha() or after[:1] == "/"):
                if html.find(">", sign) < 0:
                    break  # the page ends within a tag
            put("<")
            at = sign + 1
            continue
        at = found.end()
        ends, tag, told = found.group(1), found.group(2).lower(), found.group(3)
        if ends:
            if tag == "a":
                in_link = False
            elif tag in _STRUCTURE:
                close(tag)
            elif tag == "br":
                put(" ")
        elif tag in _RAW:
            if tag == "plaintext":
                put(html[at:])
                break
            end = _RAW_END[tag].search(html, at)
            at = end.start() if end else size
        elif tag in _STRUCTURE:
            begin(tag, told)
        elif tag == "a":
            in_link = True
        elif tag == "br":
            put(" ")
    flush()
    return Page(parents, paths, tags, steps, blocks)


def _candidate(page: Page, cfg: Settings) -> tuple[int, int]:
    """The element that holds most of the page's text, and its score; (-1, 0) if there is no text at all."""
    own = [0] * len(page.tags)
    for element, text, in_links in page.blocks:
        own[element] += max(0, len(text) - 2 * in_links)
    children: dict[int, tuple[int, int]] = {}
    for element in range(len(own) - 1, 0, -1):  # children come after their parents
        parent = page.parents[element]
        own[parent] += own[element]
        best = children.get(parent, (0, 0))
        if own[element] >= best[0] and own[element]:
            children[parent] = (own[element], element)
    total, chosen, at = own[0], 0, 0
    if not total:
        return -1, 0
    while at in children:
        score, at = children[at]
        marked = page.tags[at] in ("article", "main")
        if score < total * (cfg.marked_share if marked else cfg.share):
            break
        if page.tags[at] not in _LEAVES:
            chosen = at
    return chosen, own[chosen]


def _path_text(page: Page, path: int) -> str:
    named = {number: key for key, number in page.steps.items()}
    out = []
    while path:
        path, step = named[path]
        out.append(step)
    return "/".join(reversed(out))


def vote(html: str, settings: Settings = Settings()) -> tuple[str, int] | None:
    """The generalised path of the page's candidate and its score; nothing for a page without text."""
    page = read_page(html)
    chosen, score = _candidate(page, settings)
    return None if chosen < 0 else (_path_text(page, page.paths[chosen]), score)


def main_text(html: str, path: str | None, settings: Settings = Settings()) -> str:
    """The blocks below the elements of a generalised path, one on a line; those of the candidate if no element has it."""
    page = read_page(html)
    wanted: int | None = None
    if path is not None:
        wanted = 0
        for step in path.split("/") if path else ():
            wanted = page.steps.get((wanted, step))
            if wanted is None:
                break
    if wanted is None:
        chosen, _ = _candidate(page, settings)
        roots = {chosen}
    else:
        roots = {i for i, p in enumerate(page.paths) if p == wanted}
    inside = [False] * len(page.tags)
    for element, parent in enumerate(page.parents):
        inside[element] = element in roots or (parent >= 0 and inside[parent])
    return "\n".join(text for element, text, _ in page.blocks if inside[element])


def page_votes(html: Column, settings: Settings = Settings()) -> Column:
    """``vote`` of each page as a struct of ``path`` and ``score``; null for null and for pages without text."""

    @F.arrow_udf("struct<path:string,score:bigint>")
    def votes(pages: pa.Array) -> pa.Array:
        found = (vote(x.as_py() or "", settings) for x in pages)
        kind = pa.struct([("path", pa.string()), ("score", pa.int64())])
        return pa.array([None if v is None else {"path": v[0], "score": v[1]} for v in found], type=kind)

    return votes(html)


def page_texts(html: Column, path: Column, settings: Settings = Settings()) -> Column:
    """``main_text`` of each page; empty for null."""

    @F.arrow_udf("string")
    def texts(pages: pa.Array, paths: pa.Array) -> pa.Array:
        return pa.array([main_text(x.as_py() or "", p.as_py(), settings) for x, p in zip(pages, paths)], type=pa.string())

    return texts(html, path)


def host_paths(pages: DataFrame, url: str = "url", html: str = "html", settings: Settings = Settings()) -> DataFrame:
    """``host, path, pages, score``: the path with most votes of each host.

    Of paths with as many votes that with the higher score wins, then the smaller path. Pages without a host or without
    text do not vote.
    """
    voted = pages.select(url_host(F.col(url)).alias("host"), page_votes(F.col(html), settings).alias("vote"))
    counted = (
        voted.where("host <> '' and vote is not null").groupBy("host", F.col("vote.path").alias("path"))
        .agg(F.count("*").alias("pages"), F.sum("vote.score").alias("score"))
    )
    best = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("pages"), F.desc("score"), "path"))
    return counted.withColumn("place", best).where("place = 1").drop("place")


def extract(pages: DataFrame, url: str = "url", html: str = "html", keep: tuple[str, ...] = ("page_id", "url"), settings: Settings = Settings()) -> DataFrame:
    """The columns ``keep`` of every page, ``text`` and ``n_chars``, its code points.

    Null and empty pages, and pages whose every part is left out, have an empty text. Pages without a host (null url, or
    none with ``://``) use their own candidate. Rows may repeat, ids may be null, and other columns are not read. A page
    below whose winning path there is no text is empty too: the host's other pages say where its article would be.
    """
    # written, so that its size is known before the pages are dealt: while it is small they stay where they are
    paths = cut_lineage(pages.sparkSession, host_paths(pages, url, html, settings).select("host", "path"), "paths")
    row = pages.select(F.struct(*keep).alias("row"), url_host(F.col(url)).alias("host"), F.col(html).alias("html"))
    found = row.join(paths, "host", "left").select("row", page_texts(F.col("html"), F.col("path"), settings).alias("text"))
    return found.select("row.*", "text", F.length("text").cast("bigint").alias("n_chars"))
