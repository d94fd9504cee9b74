"""Main text of web pages: site templates are found by hashing element subtrees per host.

Every subtree of the body (tag, text, children) is hashed; Spark counts on how many pages of a host with
different main content each hash recurs. Subtrees that recur on enough of them are deleted first; then
the article is looked for in what is left, and elements whose tag, role or class says that they aren't
the article go. What remains of the article (or, without one, of the body) is joined block by block.

Inside an article, prose blocks that recur may be passages that articles share. Those that other hosts
have too are content; those of one host are template where they stand before or behind all of the
article's own text, and content between parts of it. Inline elements and the cells and items of
tables and lists go with what holds them.

Defined results: a null or empty html has the empty text. A url without a host counts under the empty
host. Repeated rows are extracted row by row; copies of a page count once for recurrence. An empty table
gives an empty result. Further columns of pages are not read. Unclosed markup closes at the end.
"""

from __future__ import annotations

import html as entities
import re
from array import array
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored

#: A subtree is template if it recurs on so many different pages of its host and on no other host,
MIN_PAGES = 5
#: or, where other hosts have it too, on this share of its host's pages.
MIN_SHARE = 0.2
#: Template hashes that may be sent to every task; beyond, each page is joined to its own by a shuffle.
BROADCAST_HASHES = 500_000
#: Elements nested deeper become siblings, as in browsers.
DEPTH = 256

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe svg xmp noembed noframes".split())
_BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
_CLOSES_P = _BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html", "li", "dd", "dt"}
_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_LIST_STOP = frozenset("ul ol dl table div body html article section main td th".split())
_DROP = frozenset("nav footer aside form script style noscript template iframe svg button select textarea input dialog menu head title object canvas audio video".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tablist".split())
#: Words of class and id names that mark what isn't the article.
_MARKS = re.compile(
    r"(?:ad|ads|adv|advert\w*|adsense|sponsor\w*|promo\w*|banner|nav|navbar|navigation|menu\w*|breadcrumbs?|pagination|pager|footer|sidebar|side|widget\w*|cookies?|consent|gdpr|notice\w*|popup|modal|overlay|newsletter|subscri\w+|signup|login|share|sharing|social|related|recommend\w*|comments?|commentlist|disqus\w*|respond|replies|reply|toolbar|skip|outbrain|taboola)",
    re.I,
)
#: Of these the ones for what readers wrote.
_COMMENT_MARKS = re.compile(r"comments?|commentlist|disqus\w*|respond|replies|reply", re.I)
_HEADER_MARKS = re.compile(r"header|masthead|topbar", re.I)
_CONTENT_MARKS = re.compile(r"article|content|main|entry|post|story|body", re.I)
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption".split())
#: What inside an article is no subtree by itself.
_PARTS = frozenset("li td th dd dt tr tbody thead tfoot b i em strong a span code br".split())

_NAME_END = re.compile(r"[\s/>]")
_SPECIAL = re.compile(r"[>\"']")
_ATTR = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


class Node:
    __slots__ = ("attrs", "children", "hash", "n_text", "tag")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.children, self.hash, self.n_text = tag, attrs, [], 0, 0


class _Tags:
    """Comments and tags of a page, each place looked at a bounded number of times however broken the markup is.

    A tag ends at the first > outside quotes. One whose quotes never close, or that has no end, is text.
    """

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.name_end = self.special = -1  # the first ones behind the last place asked about
        self.dead: set[int] = set()  # quotes and ends of chains of quotes that lead to no >

    def _end(self, at: int) -> int:
        """Place of the > that ends a tag whose name ends at a place; -1 without one."""
        seen = []
        while at <= self.last:
            if self.special < at or seen:
                m = _SPECIAL.search(self.page, at, self.last + 1)
                found = m.start()
                if not seen:
                    self.special = found
            else:
                found = self.special
            if self.page[found] == ">":
                return found
            if found in self.dead:
                break
            seen.append(found)
            close = self.page.find(self.page[found], found + 1)
            if close < 0:
                break
            at = close + 1
        self.dead.update(seen)
        return -1

    def next(self, at: int) -> tuple[int, int, str | None, bool, str, bool] | None:
        """The next comment or tag from a place on: its begin and end, and a tag's name, whether it closes, its attributes and whether it closes itself."""
        page = self.page
        while (at := page.find("<", at)) >= 0:
            first = page[at + 1 : at + 2]
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                return at, end + 3 if end >= 0 else len(page), None, False, "", False
            if at < self.last:
                if first in ("!", "?"):
                    return at, page.index(">", at) + 1, None, False, "", False
                closes = first == "/"
                begin = at + 1 + closes
                letter = page[begin : begin + 1]
                if letter.isascii() and letter.isalpha():
                    if self.name_end <= begin:
                        self.name_end = _NAME_END.search(page, begin, self.last + 1).start()
                    end = self._end(self.name_end)
                    if end >= 0:
                        alone = page[end - 1] == "/"
                        return at, end + 1, page[begin : self.name_end].lower(), closes, page[self.name_end : end - alone], alone
            at += 1
        return None


def parse(page: str) -> Node:
    """The page's element tree; text nodes are str with character references decoded."""
    root, tags = Node("#root"), _Tags(page)
    stack, at = [root], 0
    while at < len(page):
        m = tags.next(at)
        if m is None:
            stack[-1].children.append(entities.unescape(page[at:]))
            break
        begin, end, tag, closes, attrs, alone = m
        if begin > at:
            stack[-1].children.append(entities.unescape(page[at:begin]))
        at = end
        if tag is None:
            continue
        if closes:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        if tag in _CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    del stack[i:]
                    break
                if stack[i].tag in _BLOCK:
                    break
        elif tag in _SAME:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in _SAME[tag]:
                    del stack[i:]
                    if tag != "tr" or stack[-1].tag != "tr":
                        break
                elif stack[i].tag in _LIST_STOP and not (tag == "tr" and stack[i].tag in ("td", "th")):
                    break
        node = Node(tag, attrs)
        stack[-1].children.append(node)
        if tag in _VOID or alone:
            continue
        if tag in _RAW:
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at, max(at, tags.last + 1))
            at = close.end() if close else len(page)
            continue
        if len(stack) < DEPTH:
            stack.append(node)
    return root


def attributes(node: Node) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(node.attrs)} if node.attrs.strip() else {}


def _has_heading(node: Node) -> bool:
    return any(isinstance(c, Node) and (c.tag in ("h1", "h2", "h3") or _has_heading(c)) for c in node.children)


def unwanted(node: Node, inside: bool, whole: int = 0) -> bool:
    """Whether tag, role, class or id say that an element isn't article text. inside: within the article, of so much text.

    A mark that is only a part of a name doesn't count for an element that holds more than half of the article.
    """
    if node.tag in _DROP:
        return True
    if node.tag == "header" and not (inside and _has_heading(node)):
        return True
    a = attributes(node)
    if not a:
        return False
    if _hidden(a):
        return True
    if node.tag in ("html", "body"):
        return False
    for name in f"{a.get('class', '')} {a.get('id', '')}".split():
        parts = re.split(r"[-_:]+|(?<=[a-z])(?=[A-Z])", name)
        if any(_MARKS.fullmatch(x) for x in parts) and (2 * node.n_text <= whole or not whole or _sure(name, parts)):
            return True
        if any(_HEADER_MARKS.fullmatch(x) for x in parts) and not (inside or any(_CONTENT_MARKS.fullmatch(x) for x in parts) or _has_heading(node)):
            return True
    return False


def _hidden(a: dict[str, str]) -> bool:
    return "hidden" in a or a.get("aria-hidden") == "true" or a.get("role", "").lower() in _ROLES or bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", "")))


def _sure(name: str, parts: list[str]) -> bool:
    """Whether a name is a mark as a whole, or one of readers' comments."""
    return bool(_MARKS.fullmatch(name)) or any(_COMMENT_MARKS.fullmatch(x) for x in parts)


def doubtful(node: Node) -> bool:
    """Whether a marked article has a name that says it is something else, such as a comment."""
    a = attributes(node)
    return any(_sure(name, re.split(r"[-_:]+|(?<=[a-z])(?=[A-Z])", name)) for name in f"{a.get('class', '')} {a.get('id', '')}".split())


def measure(node: Node) -> None:
    """Hash of every subtree, an even number, and the characters of text below it."""
    parts, n = [node.tag], 0
    for c in node.children:
        if isinstance(c, str):
            t = " ".join(c.split())
            n += len(t)
            parts.append(t)
        else:
            measure(c)
            n += c.n_text
            parts.append(f"\0{c.hash}")
    node.n_text = n
    node.hash = xxhash.xxh3_64_intdigest("\1".join(parts).encode("utf-8", "replace")) - (1 << 63) & ~1


def _find(node: Node, out: list[Node], template: frozenset[int] | set[int] = frozenset()) -> None:
    for c in node.children:
        if isinstance(c, Node) and c.hash not in template:
            if c.tag in ("article", "main") or "role" in c.attrs and attributes(c).get("role") in ("main", "article"):
                if not _hidden(attributes(c)):
                    out.append(c)
            elif not unwanted(c, False):
                _find(c, out, template)


def article(root: Node, template: frozenset[int] | set[int] = frozenset()) -> Node | None:
    """The element that holds the article, if one is marked as such and isn't template.

    One whose name is that of something else counts only where no other is marked, and if it holds more text
    than all of the page beside it.
    """
    marked: list[Node] = []
    _find(root, marked, template)
    found = [x for x in marked if not doubtful(x)]
    if not found and marked:
        best = max(marked, key=lambda x: x.n_text)
        return best if best.n_text > sum(map(len, blocks(body(root), False, template, set(map(id, marked))))) else None
    if not found:
        return None
    best = max(found, key=lambda x: x.n_text)
    inner: list[Node] = []
    if best.tag != "article":
        _find(best, inner, template)
    inner = [x for x in inner if x.n_text * 2 >= best.n_text and not doubtful(x)]
    return max(inner, key=lambda x: x.n_text) if inner else best


def body(root: Node) -> Node:
    for c in root.children:
        if isinstance(c, Node) and c.tag == "html":
            return body(c)
        if isinstance(c, Node) and c.tag == "body":
            return c
    return root


def edges(node: Node, template: frozenset[int] | set[int]) -> set[int]:
    """Ids of the recurring prose blocks of an article before or behind all of its own text."""
    units: list[int] = []  # 0 stands for own text

    def walk(x: Node) -> None:
        for c in x.children:
            if isinstance(c, str):
                if c.strip():
                    units.append(0)
            elif unwanted(c, True, node.n_text) or not c.n_text:
                continue
            elif c.tag in _PROSE and c.hash | 1 in template:
                units.append(id(c))
            elif c.tag in _PROSE or c.tag in _PARTS or c.hash not in template:
                walk(c)

    walk(node)
    own = [i for i, u in enumerate(units) if not u]
    return set(units[: own[0]] + units[own[-1] + 1 :]) if own else set()


def blocks(node: Node, inside: bool, template: frozenset[int] | set[int], without: set[int] | frozenset[int] = frozenset()) -> list[str]:
    """Texts of the blocks under node that are neither unwanted nor template, nor among the elements of the ids without."""
    out: list[str] = []
    line: list[str] = []
    outer = edges(node, template) if inside and template else set()

    def recurs(c: Node) -> bool:
        if inside and c.tag in _PROSE:
            return id(c) in outer
        return c.hash in template and not (inside and c.tag in _PARTS)

    def flush() -> None:
        text = " ".join("".join(line).split())
        line.clear()
        if text:
            out.append(text)

    def walk(x: Node) -> None:
        for c in x.children:
            if isinstance(c, str):
                line.append(c)
            elif c.tag == "br":
                line.append(" ")
            elif id(c) in without or unwanted(c, inside, node.n_text if inside else 0) or recurs(c):
                continue
            elif c.tag in _BLOCK:
                flush()
                walk(c)
                flush()
            else:
                walk(c)

    walk(node)
    flush()
    return out


def subtrees(page: str) -> tuple[int, list[int]]:
    """Hash of the page's main content, and the different hashes of the subtrees that may be template; odd ones are an article's prose."""
    root = parse(page)
    measure(root)
    main = article(root)
    found: set[int] = set()

    def walk(x: Node, inside: bool) -> None:
        for c in x.children:
            if isinstance(c, Node) and c.n_text:
                if not (inside and c.tag in _PARTS):
                    found.add(c.hash | (inside and c.tag in _PROSE))
                walk(c, inside or c is main or c.tag in ("article", "main"))

    main = main or body(root)
    walk(body(root), False)
    return main.hash, list(found)


def main_text(page: str | None, template: set[int] | frozenset[int] = frozenset()) -> str:
    """The page's article as blocks joined by blank lines."""
    if not page:
        return ""
    root = parse(page)
    measure(root)
    main = article(root, template) or article(root)
    return "\n\n".join(blocks(main or body(root), main is not None, template))


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        mains, all_hashes = [], []
        for page in batch.column(2):
            main, found = subtrees(page.as_py() or "")
            mains.append(main)
            all_hashes.append(found)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(mains, pa.int64()), pa.array(all_hashes, pa.list_(pa.int64()))], names=["host", "digest", "main", "hashes"])


def subtree_hashes(pages: DataFrame) -> DataFrame:
    """(host, digest, main, hashes) of every row of pages."""
    return stored(pages.select(_host(), _digest(), F.col("html").cast("string")).mapInArrow(_hash_batches, "host string, digest string, main bigint, hashes array<bigint>"), "subtrees")


def templates(own: DataFrame) -> DataFrame:
    """(host, hash): the subtrees of own (of subtree_hashes) that recur on different pages of each host.

    What one host alone has is template from MIN_PAGES pages on, however many pages the host has, so
    a section's template counts in full. What stands on other hosts too may be a shared passage and is
    template only with a share of its host's pages, and never as an article's prose.
    """
    different = stored(own.groupBy("host", "main").agg(F.first("hashes").alias("hashes")), "different-pages")
    n = stored(different.groupBy("host").agg(F.count(F.lit(1)).alias("n_pages")), "host-pages")
    counts = stored(different.select("host", F.explode("hashes").alias("hash")).groupBy("hash", "host").count(), "subtree-counts")
    # a hash may stand on any number of hosts, so these are counted and never gathered
    shared = stored(counts.groupBy("hash").agg(F.count(F.lit(1)).alias("n_hosts")).filter("n_hosts > 1"), "shared-subtrees")
    often = counts.filter(F.col("count") >= MIN_PAGES).join(shared, "hash", "left")
    alone = F.col("n_hosts").isNull()
    found = often.join(n, "host").filter(alone | (F.col("hash").bitwiseAND(1) == 0) & (F.col("count") >= MIN_SHARE * F.col("n_pages"))).select("host", "hash")
    found = stored(found, "templates")
    discard(different, n, counts, shared)
    return found


def _digest():
    return F.md5(F.col("html").cast("string").cast("binary")).alias("digest")


def _host():
    return F.lower(F.coalesce(F.regexp_extract(F.col("url").cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))).alias("host")


TEXTS = "page_id bigint, url string, text string, n_chars bigint"


def _text_batches(of_hosts: Broadcast | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Texts of (page_id, url, host, html), given the template hashes of all hosts, or with the page's own as a fifth column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[str, frozenset[int]] = {}
        for batch in batches:
            ids, urls, hosts = (batch.column(i) for i in range(3))
            texts = []
            for i, host in enumerate(hosts.to_pylist()):
                if of_hosts is None:
                    template = frozenset(batch.column(4)[i].as_py() or ())
                else:
                    if host not in sets:
                        sets[host] = frozenset(of_hosts.value.get(host, array("q")))
                    template = sets[host]
                texts.append(main_text(batch.column(3)[i].as_py(), template))
            yield pa.RecordBatch.from_arrays([ids, urls, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return run


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of pages(page_id, url, html)."""
    pages = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    own = subtree_hashes(pages)
    found = templates(own)
    rows = pages.withColumn("host", _host())
    if found.limit(BROADCAST_HASHES + 1).count() <= BROADCAST_HASHES:
        of_hosts: dict[str, array] = {}
        for host, value in found.toLocalIterator():
            of_hosts.setdefault(host, array("q")).append(value)
        return rows.select("page_id", "url", "host", "html").mapInArrow(_text_batches(pages.sparkSession.sparkContext.broadcast(of_hosts)), TEXTS)
    once = own.dropDuplicates(["host", "digest"]).select("host", "digest", F.explode("hashes").alias("hash"))
    of_page = once.join(found, ["host", "hash"]).groupBy("host", "digest").agg(F.collect_list("hash").alias("hashes"))
    joined = rows.withColumn("digest", _digest()).join(of_page, ["host", "digest"], "left")
    return joined.select("page_id", "url", "host", "html", "hashes").mapInArrow(_text_batches(None), TEXTS)
