"""Main text of web pages: declared structure, and a host-wide suffix array for the rest.

A page is read into blocks of text. Text inside ``article`` or ``main`` is its article. Menus,
footers, sidebars, forms, adverts, notices and reader comments that say so (by element, role,
class or id) are furniture. All other visible text is open.

A page's text is its article blocks, whole: what an article repeats from another page is still its
text. A page without an article, or whose articles hold only a small part of its text, also keeps
the unique runs of its open text, what is left of a block when the boilerplate tokens are taken out.
Furniture never stays; an article inside it (a teaser, a comment) is part of it, unless the furniture
was never closed or is a wrapper around all of the page.

Boilerplate is judged per host: the token streams of its pages outside articles are concatenated, a
suffix array brings equal substrings together, and every substring of ``RUN`` tokens that occurs on
``MIN_SHARE`` of the host's distinct pages, on two at least, marks the tokens it covers; longer
repeats are covered by those that they consist of. Suffix arrays are built within tasks, over the
pages of a batch; each hands on its distinct (substring, page) pairs, and these meet by (host,
substring), so a host of any size is split over tasks and still judged as a whole.

Pages that are copies of each other are one page here: a page is told by the hash of all its
text outside furniture, else every page without an article that was copied would lose its text.

Defined results: null or empty html gives the empty text; pages with a null url share one host;
unclosed elements end with their parent or the page; repeated rows each get a row.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, materialize, steps
from .ngram_join import signed
from .textarrays import ranges_hash, windows_hash

#: Tokens of the shortest substring that counts as repeated: a power of two.
RUN = 8
#: Boilerplate recurs on so large a part of the distinct pages of its host, and on two at least.
MIN_SHARE = 0.1
ARTICLE, OPEN, FURNITURE = 0, 1, 2
#: While a page is read: an article in furniture that closes properly.
HELD = 3
#: Articles that hold less than one part in so many of the text outside furniture do not decide alone.
SMALL_PART = 4

#: A tag ends at the first ``>`` outside a quoted value; a stray quote belongs to an attribute's name.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)"
    r"((?:[\s/]+|[^\s/>][^\s/>=]*(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*))?)*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|(?<=\s)(hidden)(?=[\s/]|$)")
#: Elements by what they mean for text.
UNSEEN = frozenset("script style noscript template title svg math iframe object canvas audio video select textarea button datalist".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
CENTRE = frozenset(("article", "main"))
ASIDE = frozenset("nav footer aside form menu dialog header".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
NAMES = frozenset(
    """ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies
    copyright disclaimer disqus footer gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice notices pager
    pagination popup promo promotion promoted related replies reply respond share sharing sidebar signup skip social sponsor sponsored
    subscribe subscription toolbar topbar widget widgets""".split()
)
#: Of these, names that make furniture of a compound that ends in them (``main-nav``, ``google-ads``).
HEADS = frozenset(
    """ad ads advert adverts advertisement advertising breadcrumb breadcrumbs comments disqus footer login masthead menu menubar modal
    nav navbar navigation newsletter pager pagination popup sidebar signup toolbar topbar widget widgets""".split()
)
#: Words that tell no subject: ``social-links`` is furniture, ``social-policy`` is not.
PARTS = frozenset(
    """a area articles bar block body bottom box btn button buttons card col column container content count cta desktop fixed form grid group head
    heading holder icon icons inner item items left line link links list main media mobile module overlay page panel part posts right
    row section site slot small space stories strip tab tabs text thread title tools top unit wrap wrapper""".split()
)
#: Words before a name that say it belongs to the page and not to its subject (``site-header``, ``cookie-notice``).
PLACES = frozenset("bottom global left legal main page post privacy right site sticky top".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Names of the page's own content; they win over a word of NAMES beside them.
CONTENT = frozenset(("content", "article", "post", "entry", "story", "main", "body", "text"))
#: Names of what readers wrote; they win over CONTENT, unless the name only tells a state.
READERS = frozenset("comment comments disqus replies reply respond".split())
STATES = frozenset("allow closed disabled enabled has no off on open with without".split())
#: Furniture by these names never holds the page's article when it closes properly.
APART = READERS | {"related"}


def _names_furniture(words: list[str]) -> bool:
    """Whether a name, by its words, tells furniture and not what a text is about."""
    if not words or set(words) & STATES:
        return False
    first, *rest = words
    if first in NAMES and all(w in PARTS or w in NAMES for w in rest):
        return True
    last, before = words[-1], words[:-1]
    return last in HEADS or (last in NAMES and all(w in PLACES or w in NAMES or w in PARTS for w in before))


def _furniture(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in ASIDE and not (tag == "header" and in_article):
        return True
    if not attributes:
        return False
    for name, a, b, c, hidden in _ATTRIBUTE.findall(attributes):
        value = (a or b or c).lower()
        name = name.lower()
        if hidden or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if name == "role" and value in ROLES:
            return True
        if name in ("class", "id") and tag not in HEADINGS and tag not in ("html", "body"):
            each = _names(a or b or c)
            words = {w for n in each for w in n}
            own = tag in CENTRE and words & CONTENT and not any(READERS & set(n) and not STATES & set(n) for n in each)
            if not own and any(map(_names_furniture, each)):
                return True
    return False


def _names(value: str) -> list[list[str]]:
    """The words of each name in a class or id, in order."""
    spaced = [re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower() for name in value.split()]
    return [[w for w in re.split(r"[^a-z]+", name) if w] for name in spaced]


def _apart(tag: str, attributes: str) -> bool:
    """Whether furniture that closes properly cannot be a wrapper of the page's article."""
    if tag in ASIDE and tag != "form":
        return True
    named = [v for n, a, b, c, _ in _ATTRIBUTE.findall(attributes) if n.lower() in ("class", "id") for v in _names(a or b or c)]
    return any(APART & set(words) and not STATES & set(words) for words in named)


def _closed(page: str) -> set[int]:
    """Where the start tags stand that have an end tag of their own."""
    waiting: dict[str, list[int]] = defaultdict(list)
    found: set[int] = set()
    at = 0
    while (match := _TOKEN.search(page, at)) is not None:
        at = match.end()
        tag = (match[2] or "").lower()
        if tag in UNSEEN:
            if not match[1] and not match[3].rstrip().endswith("/"):
                ending = re.compile(rf"</{re.escape(tag)}\s*(?:>|\Z)", re.I).search(page, at)
                at = ending.end() if ending else len(page)
        elif match[1]:
            if waiting[tag]:
                found.add(waiting[tag].pop())
        elif tag:
            waiting[tag].append(match.start())
    return found


def blocks_of(page: str) -> list[tuple[int, str]]:
    """(zone, text) of every block with text, in page order."""
    out: list[tuple[int, str]] = []
    text: list[str] = []
    # Open elements as (tag, zone of what was around them).
    stack: list[tuple[str, int]] = []
    zone, at, end = OPEN, 0, len(page)
    # The outermost furniture that is open: where it starts, and whether it is apart.
    root, apart, closed = 0, False, None

    def close() -> None:
        words = " ".join("".join(text).split())
        text.clear()
        if words:
            out.append((zone, words))

    while at < end:
        match = _TOKEN.search(page, at)
        if match is None:
            text.append(entities.unescape(page[at:]))
            break
        if match.start() > at:
            text.append(entities.unescape(page[at : match.start()]))
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        if tag in VOID:
            if tag in ("br", "hr", "wbr"):
                text.append("" if tag == "wbr" else " ")
            continue
        if tag in UNSEEN:
            if not match[1] and not match[3].rstrip().endswith("/"):
                unseen = re.compile(rf"</{re.escape(tag)}\s*(?:>|\Z)", re.I)
                ending = unseen.search(page, at)
                at = ending.end() if ending else end
            text.append(" ")
            continue
        if tag in INLINE and (match[1] or not match[3] or not _furniture(tag, match[3], zone == ARTICLE)):
            if match[1]:
                # An inline element that was furniture ends here.
                if stack and stack[-1][0] == tag:
                    close()
                    zone = stack.pop()[1]
            continue
        close()
        if match[1]:
            if any(tag == name for name, _ in stack):
                while stack:
                    name, zone = stack.pop()
                    if name == tag:
                        break
            continue
        if tag == "p" and stack and stack[-1][0] == "p":
            zone = stack.pop()[1]
        held = False
        if tag in CENTRE and zone == FURNITURE and not _furniture(tag, match[3], False):
            if not any(name in CENTRE for name, _ in stack):
                closed = _closed(page) if closed is None else closed
                held = root in closed
                # A menu or header that was never closed does not swallow the article.
                while stack and zone == FURNITURE and not held:
                    zone = stack.pop()[1]
        stack.append((tag, zone))
        if held and not apart:
            zone = HELD
        elif zone != FURNITURE:
            if _furniture(tag, match[3], zone in (ARTICLE, HELD)):
                # Within what is held the furniture around it stays the outermost.
                if zone != HELD:
                    root, apart = match.start(), _apart(tag, match[3])
                zone = FURNITURE
            elif tag in CENTRE and zone == OPEN:
                zone = ARTICLE
    close()
    # Furniture around all of the page was no furniture: what an article in it held is the text.
    size = {z: sum(len(t) for y, t in out if y == z) for z in (ARTICLE, OPEN, HELD)}
    kept = ARTICLE if not size[ARTICLE] and size[HELD] > size[OPEN] else FURNITURE
    return [(kept if z == HELD else z, t) for z, t in out]


def host_of(url: str | None) -> str | None:
    if url is None:
        return None
    match = re.match(r"\s*(?:[a-zA-Z][\w+.-]*:)?(?://)?(?:[^/@?#]*@)?([^/:?#]*)", url)
    return match[1].lower() if match else ""


def suffix_ranks(tokens: np.ndarray, run: int = RUN) -> np.ndarray:
    """Ranks of all suffixes by their first ``run`` tokens, by prefix doubling.

    The suffix array is the order of these ranks; suffixes with one rank share that many tokens.
    """
    _, rank = np.unique(tokens, return_inverse=True)
    step = 1
    while step < run:
        behind = np.full(len(rank), -1, np.int64)
        behind[:-step] = rank[step:]
        _, rank = np.unique(rank.astype(np.int64) * (len(rank) + 1) + behind + 1, return_inverse=True)
        step *= 2
    return rank


class Streams:
    """The concatenated token streams of some pages; each page ends with a token of its own."""

    def __init__(self, pages: list[list[str]]):
        raw = [w.encode() for words in pages for w in words]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        ends = np.cumsum(lengths)
        data = np.frombuffer(b"".join(raw), np.uint8)
        hashes = ranges_hash(data, ends - lengths, ends) if len(raw) else np.zeros(0, np.uint64)
        counts = np.array([len(p) for p in pages], np.int64)
        page = np.repeat(np.arange(len(pages)), counts)
        place = np.arange(len(raw)) + page  # one end token after each page
        n = len(raw) + len(pages)
        self.tokens = np.zeros(n, np.uint64)
        self.tokens[place] = hashes
        self.page = np.repeat(np.arange(len(pages)), counts + 1)
        last = np.ones(n, bool)
        last[place] = False
        self.tokens[last] = np.arange(len(pages), dtype=np.uint64)
        windows = np.zeros(n, bool)
        if n >= RUN:
            windows[: n - RUN + 1] = self.page[: n - RUN + 1] == self.page[RUN - 1 :]
            stops = np.concatenate([[0], np.cumsum(last)])
            windows[: n - RUN + 1] &= stops[RUN:] == stops[: n - RUN + 1]
        #: Where whole runs start, and a hash of each that is the same in every task.
        self.starts = np.flatnonzero(windows)
        self.keys = windows_hash(self.tokens, RUN)[self.starts] if n >= RUN else np.zeros(0, np.uint64)
        self.first = np.concatenate([[0], np.cumsum(counts + 1)])[:-1]

    def occurrences(self, identity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct pairs of a run, by its key, and the identity of a page that it occurs on."""
        if not len(self.starts):
            return self.keys, identity[:0]
        rank = suffix_ranks(self.tokens)[self.starts]
        who = identity[self.page[self.starts]]
        order = np.lexsort((who, rank))  # the part of the suffix array that holds whole runs
        fresh = np.concatenate([[True], (rank[order][1:] != rank[order][:-1]) | (who[order][1:] != who[order][:-1])])
        heads = order[fresh]
        return self.keys[heads], who[heads]


def _declares(blocks: list[tuple[int, str]]) -> bool:
    """Whether the articles of a page are its text: they are no small part of it."""
    article, other = (sum(len(t) for z, t in blocks if z == zone) for zone in (ARTICLE, OPEN))
    return article > 0 and SMALL_PART * article >= article + other


PARSED = "page_id long, url string, host string, identity long, declared boolean, zones array<tinyint>, texts array<string>, row long"


def parse_pages(pages: DataFrame) -> DataFrame:
    """Pages as blocks: (page_id, url, host, identity, declared, zones, texts, row).

    ``row`` is equal for equal id, address and text only.
    """

    def parse(batch: pa.RecordBatch) -> Iterator[dict]:
        for start, part in steps(batch.column(2)):
            ids, urls = batch.column(0).slice(start, len(part)), batch.column(1).slice(start, len(part)).to_pylist()
            found = [blocks_of(p) for p in part.to_pylist()]
            own = [" ".join(t for z, t in b if z != FURNITURE).encode() for b in found]
            ends = np.cumsum([len(o) for o in own])
            data = np.frombuffer(b"".join(own), np.uint8)
            yield {
                "page_id": ids, "url": urls, "host": [host_of(u) for u in urls],
                "identity": signed(ranges_hash(data, np.concatenate([[0], ends[:-1]]), ends)),
                "declared": [_declares(b) for b in found],
                "zones": [[z for z, _ in b] for b in found],
                "texts": [[t for _, t in b] for b in found],
                "row": _rows(ids, urls, found),
            }

    source = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    return arrow_map(source, parse, PARSED)


def _rows(ids: pa.Array, urls: list[str | None], pages: list[list[tuple[int, str]]]) -> np.ndarray:
    named = [repr((i, u, *p)).encode() for i, u, p in zip(ids.to_pylist(), urls, pages)]
    ends = np.cumsum([len(x) for x in named], dtype=np.int64)
    return signed(ranges_hash(np.frombuffer(b"".join(named), np.uint8), np.concatenate([[0], ends[:-1]]), ends))


def _streams(batch: pa.RecordBatch) -> Iterator[tuple[str | None, list[int], Streams]]:
    """The pages of a batch by host, with the tokens of their text outside articles."""
    names = batch.schema.names
    hosts = batch.column(names.index("host")).to_pylist()
    zones = batch.column(names.index("zones")).to_pylist()
    texts = batch.column(names.index("texts")).to_pylist()
    by_host: dict[str | None, list[int]] = defaultdict(list)
    for i, host in enumerate(hosts):
        by_host[host].append(i)
    for host, rows in by_host.items():
        yield host, rows, Streams([[w for z, t in zip(zones[i], texts[i]) if z != ARTICLE for w in t.split()] for i in rows])


def repeated_runs(parsed: DataFrame, share: float = MIN_SHARE) -> DataFrame:
    """(host, run): substrings that occur on ``share`` of the distinct pages of a host, and on two at least."""

    def build(batch: pa.RecordBatch) -> Iterator[dict]:
        identity = batch.column(batch.schema.names.index("identity")).to_numpy()
        for host, rows, streams in _streams(batch):
            keys, pages = streams.occurrences(identity[rows])
            yield {"host": [host] * len(keys), "run": signed(keys), "page": pages}

    found = arrow_map(parsed.select("host", "identity", "zones", "texts"), build, "host string, run long, page long")
    counted = found.groupBy("host", "run").agg(F.count_distinct("page").alias("n")).where("n > 1")
    pages = parsed.groupBy(F.col("host").alias("of")).agg(F.count_distinct("identity").alias("pages"))
    often = F.col("n") >= share * F.col("pages")
    return counted.join(pages, F.col("host").eqNullSafe(F.col("of"))).where(often).select("host", "run")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every page."""
    parsed = materialize(parse_pages(pages), "pages", compression="zstd")
    whole = F.filter(F.arrays_zip("zones", "texts"), lambda b: b["zones"] == ARTICLE)
    declared = parsed.where("declared").select(
        "page_id", "url", F.array_join(F.transform(whole, lambda b: b["texts"]), " ").alias("text")
    )

    # Only the open text of pages that do not declare their article depends on the runs of their
    # host; the runs themselves come from all pages of it.
    loose = materialize(
        parsed.where(~F.col("declared")), "loose-pages"
    )

    def places(batch: pa.RecordBatch) -> Iterator[dict]:
        ids = batch.column(batch.schema.names.index("row")).to_pylist()
        for host, rows, streams in _streams(batch):
            page = streams.page[streams.starts]
            yield {
                "host": [host] * len(page), "run": signed(streams.keys), "row": [ids[rows[p]] for p in page],
                "at": streams.starts - streams.first[page],
            }

    at = arrow_map(loose.select("host", "zones", "texts", "row"), places, "host string, run long, row long, at long")
    runs = repeated_runs(parsed).withColumnsRenamed({"host": "run_host", "run": "repeated"})
    same = at["host"].eqNullSafe(runs["run_host"]) & (at["run"] == runs["repeated"])
    covered = at.join(runs, same).groupBy("row").agg(F.collect_set("at").alias("covered"))

    def keep(batch: pa.RecordBatch) -> Iterator[dict]:
        columns = batch.to_pydict()
        texts = []
        for zones, blocks, marks in zip(columns["zones"], columns["texts"], columns["covered"]):
            gone = {p for m in marks or () for p in range(m, m + RUN)}
            kept, place = [], 0
            for zone, block in zip(zones, blocks):
                words = block.split()
                if zone == ARTICLE:
                    kept += words
                    continue
                if zone == OPEN:
                    kept += [w for i, w in enumerate(words, place) if i not in gone]
                place += len(words)
            texts.append(" ".join(kept))
        yield {"page_id": columns["page_id"], "url": columns["url"], "text": texts}

    judged = arrow_map(
        loose.join(covered, "row", "left").select("page_id", "url", "zones", "texts", "covered"),
        keep,
        "page_id long, url string, text string",
    )
    return declared.unionByName(judged).withColumn("n_chars", F.char_length("text").cast("long"))
