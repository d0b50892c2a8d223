"""HTML extraction by tag-path ratios.

A page is read as a stream of tags; text between block-level tags forms blocks. Each block lies on a
root-to-leaf tag path (steps carry class and id; inline markup does not count). Over a page, every path
gets the length of its text and its punctuation, each divided by its number of blocks. Both ratios are
smoothed over neighbouring blocks and fused: length * (1 + punctuation) * what the markup says (0 for
navigation, footers, asides, hidden parts; little for forms and for names that speak against the
text alone; a little more for article, main and names that speak for it; names that say both say
nothing). Blocks whose fused ratio reaches ``THRESHOLD`` of its mean over the page's letters are
content; blocks that are mostly links never are.

Content is then followed down the tree. Where it lies in one container, that container is looked
into; where it lies in paragraphs of a container, that container is an article and its text stays
whole, short paragraphs, headings, lists and tables included; where it lies in several containers,
each is looked into on its own, so that all articles of a page stay and what stands between them
goes. Where article and main elements hold most of the content, or the page's only title with text under it, only
theirs counts. Inside an article go: what the
markup rules out, names that speak against the text where the ratio does not outweigh them (a paragraph or heading whose own name may
as well say what it is about is content like any other by its ratio), and navigation (two or more mostly linked blocks in a row on one path
that are neither headings nor paragraphs and have a low ratio). Of a header, the headings stay.

Pages are independent: one pass of Arrow batches, no shuffle. Reading is linear in the page: no tag,
quote or comment left open is searched for twice.

Defined results: null html counts as empty; a page without content has an empty text; stray and
unclosed tags are tolerated as browsers do, a tag without its end is text; repeated rows give equal
results; other columns pass through, an older ``text`` is replaced.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lymphoframe.llm.common import small_batches, table

#: Element names of HTML by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
RAW = {name: re.compile(rf"</{name}\b[^>]*+>?", re.I) for name in ("script", "style", "noscript", "iframe", "title", "textarea")}
#: Elements without text of the article that stand in a line of text.
IN_LINE = frozenset("button select".split())
#: Elements that hold sentences: a name that speaks against one of these alone only puts it in doubt.
SENTENCES = frozenset("p blockquote pre figcaption dd dt td h1 h2 h3 h4 h5 h6".split())
NEVER = frozenset("head nav footer aside button select option dialog menu svg math template object canvas audio video".split())
IN_HEAD = frozenset("title meta link style script base noscript template".split())
CONTAINER = frozenset("html body div article main section center form fieldset table tbody thead tfoot tr td".split())
MAIN = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag of the key's group ends an open element of these names (any other block: an open p).
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), **{h: ("p", *HEADINGS) for h in HEADINGS}}
#: An end that is implied looks through these open elements.
THROUGH = frozenset(("p", "td", "th", *HEADINGS))

TAG = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*+)|[!?])")
REST = re.compile(r"(?>=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^>])*+>")
ATTRIBUTE = re.compile(r"""([^\s=/>"']++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++))?+""")
#: Words of class and id names that speak against the text, and for it; camelCase and joined names are split before.
AGAINST = re.compile(
    r"\b(ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alerts?|popup|modal|overlay|nav\w*|menus?|breadcrumbs?|sidebars?|side|aside|widgets?|foot\w*|"
    r"masthead|topbar|toolbar|comments?|commentlist|disqus|repl(?:y|ies)|respond|responses?|threads?|feedback|reactions?|remarks?|discussion|share|sharing|social|related|recommend\w*|newsletter|subscri\w*|signup|login|search|form|pagination|pager|copyright|legal|tags|byline|meta)\b", re.I)
#: Of these, words that also name what a paragraph is about: the paragraph's ratio decides.
DOUBT = re.compile(r"\b(notices?|alerts?|side|repl(?:y|ies)|respond|responses?|threads?|feedback|reactions?|remarks?|discussion|share|sharing|social|related|recommend\w*|search|form|legal|tags|meta|banner)\b", re.I)
FOR = re.compile(r"\b(article|post|entry|story|content|body|main|text)\b", re.I)
HEADER = re.compile(r"\b(header|head)\b", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？]")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])|[_\-]+")
SPACE = re.compile(r"\s+")

#: Share of the page's mean fused ratio from which a block is content.
THRESHOLD = 0.5
#: Factors of the fused ratio.
LITTLE, MORE, MOST = 0.05, 1.25, 2.0
#: Menu items are a few words without punctuation: characters a block times (1 + punctuation marks a block).
NAVIGATION = 40
LINKED = 0.6
#: Content in paragraphs of a container from this share on makes it an article; a container that lacks less than this holds all.
SHARE = 0.05


class _Element:
    __slots__ = ("name", "parent", "path", "inline", "prior", "header", "main", "items", "mass", "doubt", "resume")

    def __init__(self, name: str, attributes: str, parent: _Element | None, paths: dict):
        found: dict[str, str] = {}
        if attributes.strip(" /"):
            for k, v in ATTRIBUTE.findall(attributes):
                found.setdefault(k.lower(), v[1:-1] if v[:1] in "\"'" else v)
        self.name, self.parent, self.inline, self.resume = name, parent, name in INLINE or name in IN_LINE, None
        self.items: list[_Element | _Block] = []
        self.mass = 0
        above = parent is not None
        role = found.get("role", "").lower()
        own_main = name in MAIN or role in ("main", "article") or "articleBody" in found.get("itemprop", "")
        page = name in ("html", "body") or own_main
        names = CAMEL.sub(" ", f"{found.get('class', '')} {found.get('id', '')}").strip() if "class" in found or "id" in found else ""
        against, speaks = bool(names and AGAINST.search(names)), bool(names and FOR.search(names))
        hidden = "hidden" in found and found["hidden"].lower() != "false" or found.get("aria-hidden", "").lower() == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
        doubtful = bool(against and name in SENTENCES and not AGAINST.search(DOUBT.sub(" ", names)))
        self.doubt = bool(above and parent.doubt) or doubtful
        factor = 1.0
        if name in NEVER or role in ROLES or hidden:
            factor = 0.0
        elif name in ("form", "fieldset") or against and not doubtful and not speaks and not page:
            factor = LITTLE
        elif own_main or speaks and not against:
            factor = MORE
        self.prior = min(MOST, (parent.prior if above else 1.0) * factor)
        self.header = bool(above and parent.header) or name == "header" or not page and not speaks and name not in HEADINGS and bool(names and HEADER.search(names))
        self.main = bool(above and parent.main) or own_main
        if self.inline:
            self.path = parent.path if above else 0
        else:
            self.path = paths.setdefault((parent.path if above else 0, f"{name}.{names}"), len(paths) + 1)


class _Block:
    __slots__ = ("element", "parts", "linked", "text", "fused", "ratio", "content", "mass")

    def __init__(self, element: _Element):
        self.element, self.parts, self.linked, self.text, self.content = element, [], 0, "", False


def read(page: str) -> tuple[_Element, list[_Block]]:
    """The root of the page's tree and its blocks in order, each in the block-level element around it."""
    paths: dict = {}
    root = _Element("", "", None, paths)
    stack, below = [root], [0]  # below: of each open element, where the nearest block-level one at or before it stands
    opened: dict[str, int] = defaultdict(int)
    out: list[_Block] = []
    open_block: _Block | None = None
    links = at = 0

    def text(raw: str) -> None:
        nonlocal open_block
        if not raw:
            return
        if open_block is None:
            if not raw.strip():
                return
            element = stack[below[-1]]
            open_block = _Block(element)
            element.items.append(open_block)
            out.append(open_block)
        open_block.parts.append(raw)
        if links:
            open_block.linked += len(raw.strip())

    def close(k: int) -> None:
        """Ends the open elements from place k on."""
        nonlocal open_block, links
        for e in reversed(stack[k:]):
            opened[e.name] -= 1
            links -= e.name == "a"
            if not e.inline:
                open_block = e.resume
        del stack[k:], below[k:]

    search = TAG.search
    while (m := search(page, at)) is not None:
        comment, end, name = m.groups()
        if comment:
            stop = page.find("-->", m.end())
            text(page[at : m.start()])
            at = len(page) if stop < 0 else stop + 3
            continue
        if name is None:
            stop = page.find(">", m.end())
            if stop < 0:
                break
            text(page[at : m.start()])
            at = stop + 1
            continue
        rest = REST.match(page, m.end())
        if rest is None:  # no tag ends from here on
            break
        text(page[at : m.start()])
        at = rest.end()
        name = name.lower()
        if end:
            if opened[name] > 0:
                k = len(stack) - 1
                while stack[k].name != name:
                    k -= 1
                close(k)
            continue
        if name == "br":
            text(" ")
            continue
        inline = name in INLINE or name in IN_LINE
        if opened["head"] > 0 and name not in IN_HEAD and name != "head":
            close(next(k for k, e in enumerate(stack) if e.name == "head"))
        if not inline:
            open_block = None
            ends, k = ENDS.get(name, ("p",)), below[-1]
            while k > 0:
                if stack[k].name in ends:
                    close(k)
                    break
                if stack[k].name not in THROUGH:
                    break
                k = below[k - 1]
        if name in VOID:
            continue
        attributes = page[m.end() : at - 1]
        if name in RAW:
            if not attributes.endswith("/"):
                closing = RAW[name].search(page, at)
                at = len(page) if closing is None else closing.end()
            continue
        element = _Element(name, attributes, stack[-1 if inline else below[-1]], paths)
        if not inline:
            stack[below[-1]].items.append(element)
        elif element.prior == 0:  # hidden inline markup: its text is a block of its own, the line goes on behind it
            element.inline, element.parent, element.resume = False, stack[below[-1]], open_block
            element.parent.items.append(element)
            open_block = None
        stack.append(element)
        below.append(below[-1] if element.inline else len(stack) - 1)
        opened[name] += 1
        links += name == "a"
    text(page[at:])
    for b in out:
        b.text = SPACE.sub(" ", html.unescape("".join(b.parts))).strip()
    return root, [b for b in out if b.text]


def _smooth(values: list[float]) -> list[float]:
    """Weights 1 2 1 over neighbouring blocks."""
    n = len(values)
    return [(values[max(i - 1, 0)] + 2 * v + values[min(i + 1, n - 1)]) / 4 for i, v in enumerate(values)]


def _mostly_links(b: _Block) -> bool:
    return b.linked > LINKED * len(b.text)


def _titled(found: list[_Block]) -> bool:
    """True where article and main elements hold the page's title and text under it, and no other title stands outside:
    what else there is, be it longer (as what readers say), isn't the article."""
    titles = [b.element.main for b in found if b.element.name == "h1" and b.element.prior >= 1 and (b.element.main or not b.element.header)]
    return bool(titles) and all(titles) and any(b.fused and b.element.main and b.element.name not in HEADINGS for b in found)


def mark(found: list[_Block], threshold: float) -> None:
    """Ratios of the blocks' paths, smoothed and fused, and which blocks are content."""
    length, points, number = defaultdict(int), defaultdict(int), defaultdict(int)
    for b in found:
        p = b.element.path
        length[p] += len(b.text)
        points[p] += len(PUNCTUATION.findall(b.text))
        number[p] += 1
    ratios = {p: (length[p] / n, points[p] / n) for p, n in number.items()}
    by_length = _smooth([ratios[b.element.path][0] for b in found])
    by_points = _smooth([ratios[b.element.path][1] for b in found])
    for b, x, y in zip(found, by_length, by_points, strict=True):
        long, marks = ratios[b.element.path]
        b.ratio = long * (1 + marks)
        b.fused = 0.0 if _mostly_links(b) or b.element.header else x * (1 + y) * b.element.prior
    own = [b for b in found if b.element.main] if _titled(found) else found
    # the mean over the page's letters, of blocks that nothing speaks against if there are any
    alive = [b for b in own if b.fused and b.element.prior >= 1] or [b for b in own if b.fused]
    least = sum(b.fused * len(b.text) for b in alive) / max(sum(len(b.text) for b in alive), 1) * threshold
    for b in own:
        b.content = b.fused > 0 and b.fused >= least


def _weigh(root: _Element) -> None:
    """How much content lies in each element (parents before children, so sums run backwards)."""
    order, todo = [], [root]
    while todo:
        e = todo.pop()
        order.append(e)
        todo += [x for x in e.items if isinstance(x, _Element)]
    for e in reversed(order):
        e.mass = sum(x.mass if isinstance(x, _Element) else len(x.text) * x.content for x in e.items)


def articles(root: _Element) -> list[_Element]:
    """The elements whose text is kept whole. Going down into one container may leave ``SHARE`` of the
    content behind in all, however many containers there are."""
    out, todo = [], [(root, root.mass)]
    while todo:
        e, mass = todo.pop()
        holders = [x for x in e.items if isinstance(x, _Element) and x.name in CONTAINER and x.mass]
        largest = max(holders, key=lambda x: x.mass, default=None)
        most = (1 - SHARE) * mass
        if not e.mass:
            continue
        if largest is not None and largest.mass >= most:
            todo.append((largest, mass))
        elif e.main or sum(x.mass for x in holders) < most:
            out.append(e)
        else:
            todo += [(x, x.mass) for x in holders]
            # lists, quotes and headings between the holders are theirs
            places = [k for k, x in enumerate(e.items) if x in holders]
            out += [x for x in e.items[places[0] : places[-1]] if isinstance(x, _Element) and x.name not in CONTAINER]
    return out


def _navigation(found: list[_Block]) -> set[int]:
    """Two or more mostly linked blocks in a row on one path, neither headings nor paragraphs, with a low ratio."""
    out: set[int] = set()
    start = 0
    for k in range(1, len(found) + 1):
        if k < len(found) and found[k].element.path == found[start].element.path and _mostly_links(found[k]) == _mostly_links(found[start]):
            continue
        b = found[start]
        if k - start > 1 and _mostly_links(b) and b.element.name not in HEADINGS and b.element.name != "p" and b.ratio < NAVIGATION:
            out |= set(map(id, found[start:k]))
        start = k
    return out


def content(page: str | None, threshold: float = THRESHOLD) -> list[str]:
    """The main text's blocks in page order."""
    root, found = read(page or "")
    if not found:
        return []
    mark(found, threshold)
    if not any(b.content for b in found):  # links alone: those of an article
        for b in found:
            b.content = b.element.prior > 0 and b.element.main and not b.element.header
    inside, whole = (sum(len(b.text) for b in found if b.content and (b.element.main or every)) for every in (False, True))
    if 2 * inside > whole:  # the page says where its articles are
        for b in found:
            b.content = b.content and b.element.main
    _weigh(root)
    chosen = articles(root)
    if not chosen:
        return []
    home = {id(e): e for e in chosen}
    around: dict[int, _Element | None] = {}  # of each element, the article it lies in

    def article_of(e: _Element) -> _Element | None:
        seen = []
        while e is not None and id(e) not in around:
            if id(e) in home:
                around[id(e)] = e
                break
            seen.append(e)
            e = e.parent
        of = around[id(e)] if e is not None else None
        for x in seen:
            around[id(x)] = of
        return of

    parents = set()  # elements around an article: a title there is its title
    for e in chosen:
        e = e.parent
        while e is not None and id(e) not in parents:
            parents.add(id(e))
            e = e.parent
    links, out, begun = _navigation(found), [], False
    for b in found:
        e = b.element
        of = article_of(e)
        if e.prior == 0 or id(b) in links:
            continue
        if of is None:
            title = not begun and e.name == "h1" and e.prior >= 1 and not e.header and e.parent is not None and id(e.parent) in parents
        elif e.header:
            title = e.name in HEADINGS and (e.main or of.name not in ("", "html", "body"))
        else:
            title = b.content and b.ratio >= NAVIGATION if e.doubt else b.content or e.prior > LITTLE * MOST * of.prior
            begun = begun or title
        if title:
            out.append(b.text)
    return out


def extract(df: DataFrame, column: str = "html") -> DataFrame:
    """Adds ``text``: the page's main text, blocks joined by an empty line."""
    schema = T.StructType([*[f for f in df.schema.fields if f.name != "text"], T.StructField("text", T.StringType())])
    keep = [f.name for f in df.schema.fields if f.name != "text"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ["\n\n".join(content(x)) for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(c)) for c in keep], pa.array(texts, pa.string())], names=schema.fieldNames())

    small_batches(df.sparkSession)
    return df.mapInArrow(work, schema)


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
