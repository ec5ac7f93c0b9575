"""Main text by nearest-URL page differencing.

Pages of a host are ordered by URL path, equal ones once, at the first of their paths; each is paired with the neighbour
whose path agrees longest, so that all copies of a page are compared with one page that differs. The text blocks of
both are aligned by longest common subsequence, and blocks that both pages share are site furniture and go. Mark-up
guides this where it is explicit: blocks in menus, forms, adverts and the like go even if only one page has them, and
blocks inside an element marked as the article stay even if the neighbour repeats them (a quoted or syndicated paragraph is
no furniture) - but not at the start or end of that element, where a block that most of several neighbours have at the
same end is a notice or a menu. Where a page marks an article, blocks outside of it go.

A null html is empty, a null url has an empty host; pages without a neighbour on their host are cleaned by mark-up
alone. Repeated rows are judged alike; other columns stay out. Very long pages are
read whole; the alignment works on block hashes with one machine integer per page.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.indexing import contiguous_index
from .common import split_by_frequency, written
from .url_filters import host_of, path_of

DROP, PLAIN, MAIN = 0, 1, 2
#: A block hash keeps the block's length, up to 1023 characters, in its last bits.
LENGTH_BITS = 10
#: Only while a page is read: dropped for a class word, by which an article inside is not bound; the same for words that
#: name lists of other articles; and an article inside of such a list.
WRAPPED, LISTED, INNER = 3, 4, 5

# Element names of the HTML standard, and words that name furniture in class, id or role.
#: Neighbours in the order of URLs: those next to a page, then those after them.
SIDES = ((1, "before"), (-1, "after"), (2, "before2"), (-2, "after2"))
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script style noscript template svg math iframe textarea select button object canvas audio video".split()
BLOCKS = set(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td
    tfoot th thead title tr ul""".split()
)
FURNITURE = set("aside dialog fieldset footer form head header menu nav title".split())
ARTICLE = {"article", "main"}
#: Elements whose end is implied when the named one starts.
CLOSED_BY = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
FURNITURE_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|breadcrumbs?|sidebar|footer|header|masthead|cookies?|"
    r"consent|notices?|notification|alert|popup|modal|overlay|newsletter|subscribe|subscription|share|sharing|social|related|"
    r"recommend\w*|comments?|disqus|respond|repl(?:y|ies)|widget|toolbar|pag(?:ination|er)|login|signup|search|"
    r"navigation|contentinfo|complementary)(?:$|[\s_-])",
    re.I,
)
#: Words of elements that often hold other people's or other pages' articles.
LIST_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|sidebar|related|recommend\w*|comments?|disqus|respond|repl(?:y|ies)|widget)(?:$|[\s_-])", re.I
)
#: Class names that say how a page is laid out, not what the element is; and those that hide it.
MODIFIER = re.compile(r"(?:^|[_-])(?:has|with|without|no|overflow)[_-]", re.I)
HIDDEN_CLASS = re.compile(r"(?:^|\s)(?:(?:is|visually)[_-])?hidden(?:\s|$)", re.I)
ARTICLE_WORDS = re.compile(r"(?:^|[\s_-])(?:article(?:[_-]?body)?|(?:post|entry|story|main|page)[_-](?:body|content|text)|articlebody|main)(?:$|[\s_-])", re.I)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?"
    + rf"|<(?P<raw>{'|'.join(RAW)})(?=[\s/>])(?:[^<>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|$)"
    + r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attributes>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>"
    + r"|</?[a-zA-Z][^<>]*(?:>|$)",
    re.S | re.I,
)
_HINTS = re.compile(r"(?:^|\s)(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_MAY_HIDE = re.compile(r"hidden|display\s*:\s*none", re.I)
_ATTRIBUTE = re.compile(r"([^\s\"'=/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


def _hides(attributes: str) -> bool:
    """Whether an attribute (not a word in some attribute's value) hides the element."""
    if not _MAY_HIDE.search(attributes):
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or (name == "aria-hidden" and value.strip() == "true") or (name == "style" and "display:none" in "".join(value.split())):
            return True
    return False


def _zone(name: str, attributes: str, outer: int) -> int:
    """Zone of an element inside one of zone ``outer``; dropped elements drop all they hold, but see ``WRAPPED``."""
    if outer == DROP:
        return DROP
    hints = " ".join(a or b or c for a, b, c in _HINTS.findall(attributes)) if attributes else ""
    if attributes and _hides(attributes):
        return DROP
    if name in ("html", "body"):
        return outer
    inside = outer in (MAIN, INNER)
    # an article's own header holds its title
    if name in FURNITURE and not (name == "header" and inside):
        return DROP
    article = INNER if outer in (LISTED, INNER) else MAIN
    if hints:
        if name not in ARTICLE and ARTICLE_WORDS.search(hints):
            return article
        own = " ".join(h for h in hints.split() if not MODIFIER.search(h))
        if FURNITURE_WORDS.search(own) or HIDDEN_CLASS.search(own):
            return DROP if inside else LISTED if outer == LISTED or LIST_WORDS.search(own) else WRAPPED
    return article if name in ARTICLE else outer


def _settled(found: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """Zones of a read page as DROP, PLAIN or MAIN: an article in a list counts where it is most of the page's text."""
    size = lambda zone: sum(len(t) for t, z in found if z == zone)
    zones = {DROP: DROP, PLAIN: PLAIN, MAIN: MAIN, WRAPPED: DROP, LISTED: DROP, INNER: DROP}
    if any(z == INNER for _, z in found) and not size(MAIN) and size(INNER) > size(PLAIN):
        zones[INNER] = MAIN
    return [(t, zones[z]) for t, z in found]


def blocks(page: str | None) -> list[tuple[str, int]]:
    """(text, zone) of every block with text, in page order; white space is one space, references are decoded."""
    found: list[tuple[str, int]] = []
    pending: list[str] = []
    open_: list[tuple[str, int]] = []

    def flush() -> None:
        text = " ".join(entities.unescape("".join(pending)).split())
        if text:
            found.append((text, open_[-1][1] if open_ else PLAIN))
        pending.clear()

    page, at = page or "", 0
    for token in _TOKEN.finditer(page):
        pending.append(page[at : token.start()])
        at = token.end()
        name = (token["name"] or "").lower()
        if token["raw"] or not name:
            if token[0].startswith("<![CDATA["):
                pending.append(token[0][9:].removesuffix("]]>"))
            continue
        if name == "br":
            pending.append(" ")
            continue
        if name in BLOCKS:
            flush()
        if token["end"]:
            depth = next((d for d in range(len(open_) - 1, -1, -1) if open_[d][0] == name), None)
            # an inline end tag never closes a block
            if depth is not None and (name in BLOCKS or not any(n in BLOCKS for n, _ in open_[depth + 1 :])):
                if any(z != open_[depth][1] for _, z in open_[depth:]):
                    flush()
                del open_[depth:]
            continue
        if name in VOID:
            continue
        while open_ and name in BLOCKS and (open_[-1][0] not in BLOCKS or name in CLOSED_BY.get(open_[-1][0], ())):
            # blocks end what inline elements left open, and paragraphs, items and cells end each other
            if open_[-1][0] not in BLOCKS and not any(n in CLOSED_BY and name in CLOSED_BY[n] for n, _ in open_):
                break
            open_.pop()
        if name in ARTICLE:
            # an article ends furniture that was never closed
            while open_ and open_[-1][1] == DROP and open_[-1][0] in FURNITURE:
                open_.pop()
        if token["attributes"].endswith("/") and name not in BLOCKS:
            continue
        zone = _zone(name, token["attributes"], open_[-1][1] if open_ else PLAIN)
        if zone != (open_[-1][1] if open_ else PLAIN):
            flush()
        open_.append((name, zone))
    pending.append(page[at:])
    flush()
    return _settled(found)


def shared_lines(own: list[int], other: list[int]) -> list[bool]:
    """Which of ``own`` lie on a longest common subsequence with ``other``: bit-parallel, then traced back."""
    full = (1 << len(other)) - 1
    where: dict[int, int] = {}
    for j, line in enumerate(other):
        where[line] = where.get(line, 0) | 1 << j
    rows, v = [], full
    for line in own:
        u = v & where.get(line, 0)
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    shared = [False] * len(own)
    i, j = len(own), len(other)
    while i and j:
        bit = 1 << (j - 1)
        if rows[i - 1] & bit:
            j -= 1
        else:
            i -= 1
            if i == 0 or rows[i - 1] & bit:
                shared[i] = True
                j -= 1
    return shared


def _agreement(path: str, other: str) -> int:
    """Leading characters two paths have in common."""
    n = 0
    for a, b in zip(path, other):
        if a != b:
            break
        n += 1
    return n


def block_hash(text: str) -> int:
    most = (1 << LENGTH_BITS) - 1
    return xxhash.xxh3_64_intdigest(text) >> LENGTH_BITS + 1 << LENGTH_BITS | min(len(text), most)


def _edges(main: list[int], shared: list[bool]) -> tuple[set[int], set[int]]:
    """Shared blocks at the start of an article, before or after one own block (its title), and those at its end."""
    first, last, own = set(), set(), 0
    for line, s in zip(main, shared):
        own += not s
        if own > 1:
            break
        if s:
            first.add(line)
    for line, s in zip(reversed(main), reversed(shared)):
        if not s:
            break
        last.add(line)
    return first, last


def edge_furniture(main: list[int], neighbours: list[list[int]]) -> list[bool]:
    """Which of an article's blocks are site furniture: at one end, and there in most of at least two neighbours too.

    A neighbour that shares more than half of the article's text is a copy or a version and tells nothing; a block that
    the article repeats, such as its title's sentence, is its own.
    """
    length = lambda line: line & (1 << LENGTH_BITS) - 1
    first, last, asked = Counter(), Counter(), 0
    once = {line for line, n in Counter(main).items() if n == 1}
    for other in neighbours:
        shared = shared_lines(main, other)
        if 2 * sum(length(line) for line, s in zip(main, shared) if s) > sum(map(length, main)):
            continue
        theirs = shared_lines(other, main)
        asked += 1
        for count, own, its in zip((first, last), _edges(main, shared), _edges(other, theirs)):
            count.update(own & its & once)
    least = max(2, -(-3 * asked // 4))
    tail = len(main)
    while tail and last[main[tail - 1]] >= least:
        tail -= 1
    flags, own = [], 0
    for at, line in enumerate(main):
        leading = own <= 1 and first[line] >= least
        own += not leading
        flags.append(leading or at >= tail)
    return flags


def keep_flags(lines: list[int], zones: list[int], partner: list[int] | None, articles: list[list[int]] = ()) -> list[bool]:
    """Which blocks are main text, given the paired page's block hashes (None: no neighbour) and the neighbours' articles."""
    main = [line for line, z in zip(lines, zones) if z == MAIN]
    if main:
        furniture = iter(edge_furniture(main, articles))
        return [z == MAIN and not next(furniture) for z in zones]
    shared = shared_lines(lines, partner) if partner is not None and partner != lines else [False] * len(lines)
    return [z == PLAIN and not s for z, s in zip(zones, shared)]


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and text of every page."""
    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            found = [blocks(page) for page in batch["html"]]
            yield batch.drop(columns="html").assign(
                # blocks hold no line breaks; compressed, since they are shuffled once
                lines=[squeeze("\n".join(t for t, _ in f).encode("utf-8", "replace")) for f in found],
                zones=[[z for _, z in f] for f in found],
                hashes=[[block_hash(t) for t, _ in f] for f in found],
            )

    url = F.coalesce("url", F.lit(""))
    rows = pages.select(F.col("page_id").cast("string"), "url", host_of(url).alias("host"), path_of(url).alias("path"), "html")
    schema = "page_id string, url string, host string, path string, lines binary, zones array<int>, hashes array<long>"
    # parsed twice, for the alignment and for the result: texts would cost more disk than parsing costs time
    parsed = rows.mapInPandas(parse, schema).withColumns(
        {"key": F.xxhash64("host", "path", "zones", "hashes"), "content": F.xxhash64("host", "zones", "hashes")}
    )
    once = written(parsed.select("host", "path", "key", "content", "zones", "hashes").dropDuplicates(["key"]), "addresses")
    # equal pages of a host are one page here, so that no page meets only copies of itself
    same = (F.first(c).alias(c) for c in ("host", "zones", "hashes"))
    distinct = once.groupBy("content").agg(F.min("path").alias("path"), F.count(F.lit(1)).alias("addresses"), *same)
    ranked = written(contiguous_index(distinct, ["host", "path", "content"], "place"), "ranked")
    # neighbours in the order of URLs meet by place: unique keys, so a host with very many pages is no hot key
    side = lambda step, tag: ranked.select(
        (F.col("place") + step).alias("place"), *(F.col(c).alias(f"{c}_{tag}") for c in ("host", "path", "zones", "hashes"))
    )
    paired = ranked
    for step, tag in SIDES:
        paired = paired.join(side(step, tag), "place", "left")

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            flags = []
            for r in batch.itertuples(index=False):
                near = [
                    (getattr(r, f"hashes_{tag}").tolist(), getattr(r, f"path_{tag}"), getattr(r, f"zones_{tag}").tolist())
                    for _, tag in SIDES
                    if getattr(r, f"host_{tag}") == r.host
                ]
                lines = r.hashes.tolist()
                # one that differs, then the longer agreement, then the nearer and the earlier page
                best = max(near, key=lambda n: (n[0] != lines, _agreement(r.path, n[1])), default=None)
                articles = [[line for line, z in zip(h, zones) if z == MAIN] for h, _, zones in near]
                flags.append(keep_flags(lines, r.zones.tolist(), best and best[0], articles))
            yield pd.DataFrame({"content": batch["content"], "addresses": batch["addresses"], "keep": flags})

    judged = written(paired.mapInPandas(judge, "content long, addresses long, keep array<boolean>"), "judged")
    kept = split_by_frequency(once.select("key", "content"), judged, ["content"], "addresses").select("key", "keep")

    def select(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for squeezed, keep in zip(batch["lines"], batch["keep"]):
                lines = zstandard.ZstdDecompressor().decompress(squeezed).decode("utf-8").split("\n")
                texts.append("\n".join(line for line, k in zip(lines, keep) if k))
            yield batch[["page_id", "url"]].assign(text=texts)

    full = parsed.select("page_id", "url", "key", "lines").join(kept, "key").drop("key")
    found = full.mapInPandas(select, "page_id string, url string, text string")
    return found.withColumn("page_id", F.col("page_id").cast(pages.schema["page_id"].dataType))
