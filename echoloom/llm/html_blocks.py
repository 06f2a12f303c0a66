"""Main text of web pages by two passes over their blocks (Pomikalek 2011).

A page is cut into blocks of text.  The first pass classifies each block by its
length, the density of stop words and of text inside links; the second gives
blocks too short to tell the class of their nearest decided neighbours.

Stop words are learned from the pages: of each language, or script where a page
names none, the most widespread words that make up half of its running text.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from echoloom.operators.keyed import first_per_group
from echoloom.workspace import materialize, send_with_tasks

send_with_tasks(__name__)

# Thresholds of the first pass (characters, share of words, share of characters).
SHORT, LONG = 70, 200
STOP_LOW, STOP_HIGH = 0.30, 0.32
MOST_LINKS = 0.2
# Stop words of a language: the most widespread ones up to this share of its words, at most so many.
COVERED, MOST_STOP_WORDS = 0.5, 1000
WORDS_HELD = 300_000  # distinct words a task counts before it passes them on
LONGEST_WORD = 40
# A letter of a script without spaces stands for about so many characters.
WIDE = 3
# Inside a marked article: share of characters, and blocks in a row that make a list of links.
MOST_LINKS_INSIDE = 0.5
LINK_LIST = 2
# Element names by what they do to the text.
HIDDEN = frozenset(
    "script style noscript template head title svg math iframe object embed applet audio video canvas "
    "select option optgroup datalist textarea button".split()
)
RAW = frozenset("script style textarea title noscript iframe template".split())
OUTSIDE = frozenset("nav footer aside form header menu dialog fieldset".split())
INSIDE = frozenset("article main".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rp rt s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose start ends an open element of the same group.
CLOSED_BY_SELF = frozenset("p li dt dd tr td th option".split())
# Elements that such a start does not reach beyond.
CONTAINERS = frozenset("ul ol dl table div".split()) | INSIDE
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words of class and id that mark what surrounds an article.
SURE = re.compile(
    r"ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|popup|modal|overlay|newsletter|subscri\w+"
    r"|signup|login|nav|navbar|navigation|menus?|breadcrumbs?|sidebar|widgets?|footer|masthead|comments?|respond"
    r"|disqus|replies|related|recommend\w*|sharing|social|toolbar|pagination|pager|contentinfo|complementary"
)
# Such words that stand for parts of an article as well.
DOUBTFUL = re.compile(r"notice|side|header|share|search|form|skip|nav\w+|menu\w+|widget\w+|social\w+")
# Words that name no content when they are joined to these.
NEUTRAL = frozenset(
    "site page main top bottom left right global primary secondary user reader post article entry list box bar "
    "area block wrap wrapper container section inner outer links link item items row text body title unit slot".split()
)
ROLES = frozenset("banner navigation contentinfo complementary search form menu dialog".split())
TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.IGNORECASE)
CONCEALED = re.compile(
    r"(?:^|\s)hidden(?=$|[\s=/])|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none|visibility\s*:\s*hidden",
    re.IGNORECASE,
)
NO_SPACES = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
LETTER_WORD = re.compile(rf"[{NO_SPACES}]")
# A word is a run of letters, in scripts without spaces a letter.
PLAIN_WORD = re.compile(r"[^\W\d_]+")
WORD = re.compile(rf"[{NO_SPACES}]|(?:(?![{NO_SPACES}])[^\W\d_])+")
LANGUAGE = re.compile(r"<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z]{2,3})(?![A-Za-z])", re.IGNORECASE)

GOOD, BAD, SHORT_BLOCK, NEAR_GOOD = "good", "bad", "short", "near"


class Open(NamedTuple):
    """An open element, and what it or an element around it is."""

    name: str = ""
    hidden: bool = False
    outside: bool = False
    inside: bool = False
    link: bool = False
    heading: bool = False
    region: int = 0  # number of the innermost element that may be surroundings, 0: none

@dataclass
class Block:
    """Text between block elements, and where it lies."""

    text: str
    linked: int  # characters inside links
    inside: bool  # an article or main element
    outside: bool  # navigation, forms and the like
    heading: bool
    region: int = 0
    verdict: str = field(default="")
    words: list[str] = field(default_factory=list)
    density: float = 0.0  # share of stop words, once these are known
    size: int = 0  # characters, letters of scripts without spaces counted several times

    def __post_init__(self) -> None:
        wide = 0 if self.text.isascii() else len(LETTER_WORD.findall(self.text))
        self.words = (WORD if wide else PLAIN_WORD).findall(self.text.lower())
        self.size = len(self.text) + (WIDE - 1) * wide

    @property
    def links(self) -> float:
        return min(1.0, self.linked / max(1, len(self.text)))


@lru_cache(maxsize=10_000)
def surroundings(names: str) -> str:
    """What class and id words tell: surely surroundings, perhaps, or nothing.

    A name is sure if all its parts mark surroundings or are neutral; a part of
    another name (``promo-story``) or a doubtful word (``long-form``) leaves it open.
    """
    found = ""
    for name in names.lower().split():
        parts = [p for p in re.split(r"[_-]+", name) if p]
        sure = [bool(SURE.fullmatch(p)) for p in parts]
        if any(sure) and all(s or p in NEUTRAL for s, p in zip(sure, parts)):
            return "sure"
        if any(sure) or any(DOUBTFUL.fullmatch(p) for p in parts):
            found = "perhaps"
    return found


def blocks(page: str) -> list[Block]:
    """Blocks of a page in order, without scripts, styles, comments and hidden elements.

    An element knows what lies around it, so the work grows with the page alone,
    however deep its elements are nested.
    """
    found: list[Block] = []
    regions = 0
    parts: list[str] = []
    linked = 0
    stack = [Open()]
    names: Counter[str] = Counter()  # open elements by name

    def end_block() -> None:
        nonlocal linked
        if not parts:
            return
        text = "".join(parts)
        text = " ".join((html.unescape(text) if "&" in text else text).split())
        if text:
            top = stack[-1]
            found.append(Block(text, linked, top.inside, top.outside, top.heading, top.region))
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if stack[-1].hidden:
            return
        parts.append(text)
        if stack[-1].link:
            linked += len(" ".join(text.split()))

    def close(name: str) -> None:
        """End the innermost element called ``name`` and all within it."""
        while True:
            ended = stack.pop().name
            names[ended] -= 1
            if ended == name:
                return

    at, size = 0, len(page)
    while at < size:
        tag = TAG.search(page, at)
        if tag is None:
            add(page[at:])
            break
        if tag.start() > at:
            add(page[at : tag.start()])
        at = tag.end()
        name = (tag.group(2) or "").lower()
        if not name:
            continue
        if name not in INLINE and name != "br":
            end_block()
        elif name == "br":
            add(" ")
        if tag.group(1):
            if names[name]:
                close(name)
            continue
        attributes = tag.group(3) or ""
        if name in EMPTY or attributes.endswith("/") and name in ("svg", "path"):
            continue
        if name in CLOSED_BY_SELF and names[name]:
            # An open one of the same kind ends here, unless a container lies between.
            nearest = next(e.name for e in reversed(stack) if e.name == name or e.name in CONTAINERS)
            if nearest == name:
                close(name)
        around = stack[-1]
        inside, outside = around.inside, around.outside
        region = around.region
        if name in INSIDE and not outside:
            inside = True
        elif name == "header" and inside:
            pass  # the article's own heading
        elif name in OUTSIDE:
            outside = True
        for kind, value in ATTRIBUTE.findall(attributes) if name not in ("html", "body", *INSIDE) else ():
            value = value.strip("\"'")
            told = surroundings(value) if kind.lower() != "role" else "sure" if value.lower() in ROLES else ""
            if told == "sure":
                outside = True
            elif told:
                regions += 1
                region = regions
        hidden = around.hidden or name in HIDDEN or bool(CONCEALED.search(attributes))
        if name in RAW:
            # Its content is not markup; it ends at its own end tag only.
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = end.end() if end else size
            continue
        link, heading = around.link or name == "a", around.heading or name in HEADINGS
        stack.append(Open(name, hidden, outside, inside, link, heading, region))
        names[name] += 1
    end_block()
    return found


StopWords = Mapping[str, tuple[str, ...]]  # word: the languages or scripts it is a stop word of


def running(block: Block) -> bool:
    """Whether stop words are learned from a block: long, with few links, not in surroundings."""
    return not block.outside and block.size >= LONG and block.links <= MOST_LINKS


def group_of(page: str, found: list[Block]) -> str:
    """The language a page names, else the script of most letters in its blocks."""
    named = LANGUAGE.search(page)
    if named:
        return named.group(1).lower()
    scripts: Counter[str] = Counter()
    for block in found:
        for word in block.words:
            scripts[unicodedata.name(word[0], "OTHER").split()[0]] += len(word)
    return max(scripts, key=lambda s: (scripts[s], s)) if scripts else "OTHER"


def most_widespread(spread: Mapping[str, int], uses: Mapping[str, int]) -> list[str]:
    """Words by number of blocks, then by name, until they make up the share of all words."""
    rest, kept = COVERED * sum(uses.values()), []
    for word in sorted(spread, key=lambda w: (-spread[w], w))[:MOST_STOP_WORDS]:
        if rest <= 0:
            break
        kept.append(word)
        rest -= uses[word]
    return kept


def own_stop_words(found: list[Block]) -> StopWords:
    """Stop words of one page alone."""
    spread, uses = Counter(), Counter()
    for block in filter(running, found):
        spread.update(set(block.words))
        uses.update(block.words)
    return dict.fromkeys(most_widespread(spread, uses), ("page",))


def language_words(found: list[Block], stop_words: StopWords) -> frozenset[str]:
    """Stop words of the language that has the most of them in a page's blocks."""
    words: Counter[str] = Counter()
    for block in found:
        if not block.outside and block.links <= MOST_LINKS:
            words.update(block.words)
    hits: Counter[str] = Counter()
    for word, n in words.items():
        for group in stop_words.get(word, ()):
            hits[group] += n
    if not hits:
        return frozenset()
    best = max(hits, key=lambda g: (hits[g], g))
    return frozenset(w for w in words if best in stop_words.get(w, ()))


def classify(block: Block, container: bool) -> str:
    """First pass.  ``container`` tells that the page's article or main element counts as evidence.

    Inside such an element half the density of stop words is enough and a block may
    hold more links.
    """
    if block.outside:
        return BAD
    eased = container and block.inside
    if block.links > (MOST_LINKS_INSIDE if eased else MOST_LINKS):
        return SHORT_BLOCK if eased and block.size < SHORT else BAD
    if not eased and "\N{COPYRIGHT SIGN}" in block.text[:20]:
        return BAD
    if block.size < SHORT:
        return BAD if block.linked and not eased else SHORT_BLOCK
    density = block.density
    ease = 0.5 if eased else 1.0
    if density >= ease * STOP_HIGH and block.links <= MOST_LINKS:
        return GOOD if block.size > LONG or eased else NEAR_GOOD
    return NEAR_GOOD if eased or density >= STOP_LOW else BAD


def trusted(found: list[Block]) -> bool:
    """Whether the marked article holds the main text, or there is only a teaser in it.

    It does unless more good text by the plain rules lies outside of it than there is
    text with few links inside.
    """
    within = [b for b in found if b.inside and not b.outside]
    if not within:
        return False
    own = sum(b.size for b in within if b.links <= MOST_LINKS)
    beyond = sum(b.size for b in found if not b.inside and classify(b, False) == GOOD)
    return own >= beyond


def mark_link_lists(found: list[Block]) -> None:
    """Inside an article, short blocks of links in a row are a list and bad; a single one is undecided."""
    run: list[Block] = []
    for block in [b for b in found if not b.outside] + [Block("", 0, False, False, False)]:
        if block.inside and block.linked > MOST_LINKS_INSIDE * len(block.text):
            run.append(block)
            continue
        if len(run) >= LINK_LIST:
            for linked in run:
                linked.verdict = BAD
        run = []


def neighbours(row: list[Block], edge: str) -> list[tuple[str, str]]:
    """Verdicts of the nearest decided blocks before and after each, at the end of the row ``edge``.

    Without ``edge`` the other side counts for both, and a row of undecided blocks is good.
    """
    sides = []
    for order in (row, row[::-1]):
        last, side = edge, []
        for block in order:
            if block.verdict in (GOOD, BAD):
                last = block.verdict
            side.append(last)
        sides.append(side)
    return [(left or right or GOOD, right or left or GOOD) for left, right in zip(sides[0], sides[1][::-1])]


def decide(found: list[Block], stop_words: StopWords | None = None) -> list[bool]:
    """Second pass: whether each block belongs to the main text.

    An undecided block takes the class of its nearest decided neighbours on
    both sides, within a marked article those inside it; where the two disagree
    a near-good block and a heading before good text are kept, and inside the
    article any text that is neither a heading nor a link.  An element that may be
    surroundings is, unless a good block lies in it.  In a page without good
    blocks the near-good ones are good, and without these the long ones with few links.
    Blocks in surroundings are no neighbours; at the edge of a page without a marked
    article the other side decides.  Without ``stop_words`` those of the page
    itself are taken.
    """
    stops = language_words(found, own_stop_words(found) if stop_words is None else stop_words)
    for block in found:
        block.density = sum(map(stops.__contains__, block.words)) / max(1, len(block.words))
    dense = {b.region for b in found if classify(b, False) == GOOD}
    for block in found:
        block.outside = block.outside or block.region > 0 and block.region not in dense
    container = trusted(found)
    for block in found:
        block.verdict = classify(block, container)
    if container:
        mark_link_lists(found)
    elif all(b.verdict != GOOD for b in found):
        near = any(b.verdict == NEAR_GOOD for b in found)
        for block in found:
            if block.verdict == NEAR_GOOD or not near and running(block):
                block.verdict = GOOD
    within = [b for b in found if container and b.inside and not b.outside]
    beyond = [b for b in found if not (b.outside or container and b.inside)]
    kept: dict[int, bool] = {}
    for row, edge in ((within, GOOD), (beyond, BAD if container else "")):
        for block, (left, right) in zip(row, neighbours(row, edge)):
            if block.verdict in (GOOD, BAD):
                keep = block.verdict == GOOD
            elif left == right:
                keep = left == GOOD
            elif block.heading:
                keep = right == GOOD or block.verdict == NEAR_GOOD
            elif row is within:
                keep = block.linked <= MOST_LINKS_INSIDE * len(block.text)
            else:
                keep = block.verdict == NEAR_GOOD
            kept[id(block)] = keep
    return [kept.get(id(b), False) for b in found]


def main_text(page: str | None, stop_words: StopWords | None = None) -> str:
    """Kept blocks in page order, joined by one space; empty for a page without any."""
    found = blocks(page or "")
    return " ".join(b.text for b, keep in zip(found, decide(found, stop_words)) if keep)


def learn_stop_words(pages: DataFrame, page: str = "html") -> DataFrame:
    """(language, word): stop words of every language or script in the pages.

    Long blocks with few links of all whole pages count, whatever element holds
    them.  Tasks count the blocks and uses of each word and pass sums on, so a
    frequent language is no hot group.  A language has at most MOST_STOP_WORDS
    words; languages are the two or three letters that pages name, or names of scripts.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spread: defaultdict[str, Counter[str]] = defaultdict(Counter)
        uses: defaultdict[str, Counter[str]] = defaultdict(Counter)

        def counted() -> pa.RecordBatch:
            keys = [(g, w) for g, words in spread.items() for w in words if len(w) <= LONGEST_WORD]
            columns = [
                pa.array([g for g, _ in keys], pa.string()),
                pa.array([w for _, w in keys], pa.string()),
                pa.array([spread[g][w] for g, w in keys], pa.int64()),
                pa.array([uses[g][w] for g, w in keys], pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["language", "word", "spread", "uses"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = [b for b in blocks(text or "") if running(b)]
                group = group_of(text, found) if found else ""
                for block in found:
                    uses[group].update(block.words)
                    spread[group].update(set(block.words))
                if sum(map(len, spread.values())) >= WORDS_HELD:
                    yield counted()
                    spread.clear()
                    uses.clear()
        yield counted()

    kinds = "language string, word string, spread bigint, uses bigint"
    counts = materialize(
        pages.select(page)
        .mapInArrow(scan, kinds)
        .groupBy("language", "word")
        .agg(F.sum("spread").alias("spread"), F.sum("uses").alias("uses")),
        "stop_words",
    )
    # One row a language, joined to at most MOST_STOP_WORDS rows each.
    totals = counts.groupBy("language").agg(F.sum("uses").alias("all_uses"))
    first = first_per_group(counts, ["language"], [F.desc("spread"), F.col("word")], MOST_STOP_WORDS)
    before = (
        Window.partitionBy("language")
        .orderBy(F.desc("spread"), "word")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        first.withColumn("before", F.coalesce(F.sum("uses").over(before), F.lit(0)))
        .join(totals, "language")
        .filter(F.col("before") < COVERED * F.col("all_uses"))
        .select("language", "word")
    )


def read_stop_words(learned: DataFrame) -> StopWords:
    """The learned words by word; their number is bounded by that of languages, not by the pages."""
    groups: defaultdict[str, list[str]] = defaultdict(list)
    for row in learned.collect():
        groups[row["word"]].append(row["language"])
    return {word: tuple(sorted(found)) for word, found in groups.items()}


def extract_text(
    pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html"
) -> DataFrame:
    """(key, url, text, n_chars) of every whole page, by stop words learned from all of them.

    Null and empty pages have an empty text.  Repeated rows give equal rows, an
    empty table gives none; very long pages are read whole in time that grows with
    them; other columns are not carried, whatever they are called.
    """
    shared = pages.sparkSession.sparkContext.broadcast(read_stop_words(learn_stop_words(pages, page)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, shared.value) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                [key, url, "text", "n_chars"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return pages.select(key, url, page).mapInArrow(
        scan, f"`{key}` {kinds[key]}, `{url}` {kinds[url]}, text string, n_chars bigint"
    )
