"""Main text of web pages by consensus of each host's pages.

1. Each page's containers are scored by the text they hold outside of boilerplate, less
   its links; a container that holds nearly all of the page's best is preferred the deeper it is.
   The page votes for the tag-class path of its best container, digits taken out of classes.
2. Votes are added up by host and path. A path counts if it has a thousandth of its host's votes.
3. Each page is extracted again from the containers at the first of its host's paths, most votes
   first, that holds most of what the page's own best holds; a page that has none uses its own best.

Boilerplate: elements, roles and `hidden` say so at once. Words of classes and ids only raise a
suspicion: an element that holds a main heading, or most of the page's text as paragraphs or an article, stays.
Readers' comments stay only around a heading or an article. Paragraphs and headings are suspected for
words of adverts and sign-ups in their class alone.

A page is scanned by one regular expression and a stack of open elements, so memory and
time are in proportion to its length. Votes are combined before they are shuffled; a hot
host sends one row per task and path. Pages are not shuffled: the paths, a thousand of a host at most
by the share they need, are broadcast if a count shows that they are few, else joined.

Text: character references are decoded, white space in a block (also a line break) becomes one
space, blocks are joined by line ends in the order of the page.

Defined cases: NULL or empty html gives an empty text, as does a page with boilerplate only;
a NULL url is a host of its own, the empty one; repeated rows vote and are extracted one
by one; an empty table gives an empty table.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeworks.llm.common import keep, sliced, small, table

# A path needs one of so many votes of its host.
VOTES = 1000
# A host's path must hold this share of the text of the page's own best.
MOST = 0.5
# An article or main element of less than these shares of the best text is a teaser.
ARTICLE_SHARE, MAIN_SHARE = 0.5, 0.3
# A deeper container wins if it holds this share of the text that the best one holds.
NEARLY_ALL = 0.9

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select "
    "summary table tbody td tfoot th thead tr ul".split()
)
# Elements that are never part of an article's text.
SKIP_TAGS = frozenset(
    "aside button canvas datalist dialog footer form head iframe input menu nav noscript object option script select "
    "style svg template textarea title".split()
)
SKIP_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
# Words of classes and ids that mark boilerplate, between hyphens, underscores and changes of case.
SKIP_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices popup promo promoted related "
    "replies reply share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget".split()
)
# Those that also count for a paragraph, and those of readers' comments.
ADVERT_WORDS = frozenset(
    "ad ads advert advertisement adverts consent cookie cookies gdpr newsletter popup promo promoted signup sponsor "
    "sponsored subscribe".split()
)
COMMENT_WORDS = frozenset("comment comments disqus replies reply".split())
PARAGRAPHS = frozenset("blockquote h1 h2 h3 h4 h5 h6 p pre".split())
CONTAINERS = frozenset("article body center dd div main section table tbody td tr".split())
# An open element of the first kind ends where one of the second begins.
ENDS = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}
SCOPES = frozenset("article aside body dialog div dl footer form header html main nav ol section table td th ul".split())

_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|title|noscript|template|svg|iframe)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>"
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")


class _Element:
    __slots__ = ("above", "depth", "dropped", "leads", "linked", "path", "prose", "real", "skipped", "suspect", "tag", "text", "total")

    def __init__(self, tag: str, name: str, above: _Element | None, skipped: bool, suspect: str = "") -> None:
        self.tag, self.above, self.skipped, self.suspect = tag, above, skipped, suspect
        self.depth = above.depth + 1 if above else 0
        self.path = f"{above.path}/{name}" if above else name
        self.text = self.linked = self.total = self.prose = 0
        self.leads = self.real = False
        self.dropped: bool | None = None


def _named(tag: str, attributes: str, inside: bool) -> tuple[str, bool, str]:
    """The general name of an element, whether it is boilerplate, and what its words raise: "", "words" or "comments"."""
    classes, words, skipped = "", set(), tag in SKIP_TAGS or (tag == "header" and not inside)
    if attributes and not attributes.isspace():
        for name, *values in _ATTRIBUTE.findall(attributes):
            value = "".join(values)
            name = name.lower()
            if name == "role":
                skipped |= value.lower() in SKIP_ROLES
            elif name in ("hidden", "aria-hidden"):
                skipped |= value.lower() in ("", "true", "hidden")
            elif name == "class" or (name == "id" and tag not in PARAGRAPHS):
                words.update(w.lower() for w in _WORD.findall(value))
                if name == "class":
                    classes = ".".join(sorted({re.sub(r"\d+", "", c) for c in value.split()}))
    words &= ADVERT_WORDS if tag in PARAGRAPHS else SKIP_WORDS
    suspect = "comments" if words & COMMENT_WORDS else "words" if words else ""
    return (f"{tag}.{classes}" if classes else tag), skipped, suspect


def _stays(element: _Element, page: int) -> bool:
    """Whether a suspected element of a page with so much text is none of its boilerplate."""
    if element.leads:
        return True
    whole = element.real or (element.suspect == "words" and element.prose > 1)
    return whole and 2 * element.total > page


def _kept(found: list[tuple[_Element, str, int]]) -> list[tuple[_Element, str]]:
    """The blocks outside of suspected elements that do not stay; what is left is added up."""
    page = 0
    for element, text, _ in found:
        page += len(text)
        prose, leads, real = False, False, False
        while element:
            element.total += len(text)
            element.prose += prose or element.tag in PARAGRAPHS
            element.leads |= leads
            element.real |= real
            prose |= element.tag in PARAGRAPHS
            leads |= element.tag == "h1"
            real |= element.tag in ("article", "main") and not element.suspect
            element = element.above
    kept = []
    for element, text, linked in found:
        chain, at = [], element
        while at and at.dropped is None:
            chain.append(at)
            at = at.above
        for at in reversed(chain):
            at.dropped = bool(at.above and at.above.dropped) or bool(at.suspect and not _stays(at, page))
        if not element.dropped:
            kept.append((element, text))
            at = element
            while at:
                at.text += len(text)
                at.linked += linked
                at = at.above
    return kept


def blocks(page: str) -> list[tuple[_Element, str]]:
    """The blocks of text outside of boilerplate, with their elements."""
    root = _Element("", "", None, False)
    stack, found, held, linked = [root], [], [], 0
    place = 0

    def flush() -> None:
        nonlocal linked
        if held:
            text = _SPACE.sub(" ", entities.unescape("".join(held))).strip()
            if text:
                found.append((stack[-1], text, min(linked, len(text))))
            held.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text and not stack[-1].skipped:
            held.append(text)
            if any(e.tag == "a" for e in stack[-3:]):
                linked += len(text.strip())

    def close(tag: str) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag == tag:
                if any(e.tag in BLOCK for e in stack[i:]):
                    flush()
                del stack[i:]
                return

    for piece in _PIECE.finditer(page):
        add(page[place : piece.start()])
        place = piece.end()
        end, tag, attributes = (piece[2], piece[3], piece[4]) if piece[3] else (piece[5], piece[6], piece[7])
        if not tag:
            continue
        tag = tag.lower()
        if end:
            close(tag)
        elif tag == "br":
            add(" ")
        elif tag in VOID:
            if tag == "hr":
                flush()
        else:
            if tag in BLOCK:
                flush()
                # A paragraph ends where a block begins; so do items and cells within their list or table.
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == "p" or tag in ENDS.get(stack[i].tag, ()):
                        del stack[i:]
                        break
                    if stack[i].tag in SCOPES:
                        break
            above = stack[-1]
            inside = any(e.tag in ("article", "main") for e in stack)
            name, skipped, suspect = _named(tag, attributes, inside)
            if tag in ("html", "body", "main"):
                skipped, suspect = False, ""
            elif tag not in BLOCK:
                skipped, suspect = skipped or bool(suspect), ""
            stack.append(_Element(tag, name, above, above.skipped or (skipped and tag != "article"), suspect))
            if tag not in BLOCK and not attributes.endswith("/"):
                continue
            if attributes.endswith("/"):
                stack.pop()
    add(page[place:])
    flush()
    return _kept(found)


def _worth(element: _Element) -> float:
    return element.text - 2 * element.linked


def best(found: list[tuple[_Element, str]]) -> _Element | None:
    """The container to vote for: an article if it has most of the text, else the deepest that has nearly all."""
    seen: dict[int, _Element] = {}
    for element, _ in found:
        while element and id(element) not in seen:
            seen[id(element)] = element
            element = element.above
    containers = [e for e in seen.values() if e.tag in CONTAINERS or e.above is None]
    if not containers:
        return None
    top = max(map(_worth, containers))
    for tag, share in (("article", ARTICLE_SHARE), ("main", MAIN_SHARE)):
        held = [e for e in containers if e.tag == tag and _worth(e) > 0 and _worth(e) >= share * top]
        if held:
            return max(held, key=lambda e: (_worth(e), -e.depth))
    return max((e for e in containers if _worth(e) >= NEARLY_ALL * top), key=lambda e: (e.depth, _worth(e)))


def extract(page: str, paths: list[str]) -> str:
    """The text at the first of `paths` that holds most of what the page's own best holds, else of that."""
    found = blocks(page)
    own = best(found)
    if own is None:
        return ""
    held: dict[str, list[int]] = {}
    for i, (element, _) in enumerate(found):
        above = set()
        while element:
            above.add(element.path)
            element = element.above
        for path in above:
            held.setdefault(path, []).append(i)
    for path in [*paths, own.path]:
        chosen = [found[i][1] for i in held.get(path, ())]
        if chosen and (path == own.path or sum(map(len, chosen)) >= MOST * own.text):
            return "\n".join(chosen)
    return ""


def _text(value: pa.Scalar) -> str:
    return (value.as_py() or b"").decode("utf-8", "replace")


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def votes(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """`host, path, n, text`: pages that vote for a path, and the text they have there."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "html"):
            chosen = [best(blocks(_text(page))) for page in batch["html"]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["host"],
                    pa.array([c.path if c else None for c in chosen], pa.string()),
                    pa.array([c.text if c else None for c in chosen], pa.int64()),
                ],
                ["host", "path", "text"],
            )

    rows = pages.select(host_of(F.col(url)).alias("host"), F.col(html).cast("binary").alias("html"))
    cast = rows.mapInArrow(scan, "host string, path string, text long").where("path is not null")
    return cast.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("text").alias("text"))


def winners(counted: DataFrame, votes: int = VOTES) -> DataFrame:
    """`_host, _paths`: each host's paths with one of `votes` votes or more, most votes first."""
    hosts = counted.groupBy(F.col("host").alias("_host")).agg(F.sum("n").alias("_n"))
    counting = counted.join(hosts, F.col("host") == F.col("_host")).where(F.col("n") * votes >= F.col("_n"))
    order = F.struct((-F.col("n")).alias("n"), (-F.col("text")).alias("text"), "path")
    listed = F.sort_array(F.collect_list(order))
    return counting.groupBy("_host").agg(F.transform(listed, lambda x: x["path"]).alias("_paths"))


def main_text(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """`pages` with `text` in place of the html, and `n_chars`."""
    best_paths = small(keep(winners(votes(pages, html, url)), "host-paths"))
    host = host_of(F.col(url))
    rows = pages.drop("text", "n_chars").join(best_paths, host == F.col("_host"), "left").drop("_host")
    rows = rows.withColumn(html, F.col(html).cast("binary"))
    kept = [f for f in rows.schema if f.name not in (html, "_paths")]
    schema = T.StructType([*kept, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, html):
            texts = [extract(_text(p), paths or []) for p, paths in zip(batch[html], batch["_paths"].to_pylist())]
            new = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*[batch[f.name] for f in kept], *new], schema.names)

    return rows.mapInArrow(scan, schema)


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text(pages).select("page_id", "url", "text", "n_chars")
