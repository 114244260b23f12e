"""Main text of web pages by wrapper induction over the pages of a host.

Three passes, none of which gathers the pages of a host:

1. every page becomes a tree of slots (neighbouring elements of one kind are one
   slot). Pages of a host with the same outer boxes are one layout, and each layout
   takes the tree that most of its different pages have as reference. Layouts of few
   different pages share the reference of their host's largest layout. Pages
   without content take no part;
2. pages are aligned with their reference by simple tree matching; per slot and
   text of the slot the different pages are counted. A text that is on enough
   different pages, and on at least half of those with the slot, is template;
3. pages are aligned again; slots that carry their template text are left out, text of slots
   that vary is content, unless the element says that it is something else:
   menu, header, footer, sidebar, notice, advert, form, script, style or
   reader comment.

Where a layout has enough different pages its slots alone choose the content. Tags
decide only without that evidence: the main part if it has text, else the articles
if one of them holds at least half of the page's content, else the whole page.

Pages are different if their content is: other scripts, attributes or adverts do
not make another page of a copy. References and wrappers are one row a layout; Spark broadcasts them only below its
threshold and otherwise joins by host and layout, where a hot one is split.

Character references are decoded, white space inside a block is one space, and
blocks follow one another in page order with one space between.

Forms, roles and names (whole tokens of class and id) mark no content only if the
part does not hold the page's main part or all of its articles, and not over half
of the page's varying text either. Adverts and reader comments are left out however
long, as long as the page has a main part or an article elsewhere.

Cases: null or empty html has no text; a null URL belongs to the host "".
Repeated pages each get their row. Broken markup (open tags, cut-off pages, stray signs) is read as
far as it goes. Elements nested deeper than ``DEEPEST`` are closed like others but
hang on the last one above that depth, or on a dropped one. A host
with few different pages has no template, so copies keep their text. A page of which
all text is template keeps it. An empty
table gives an empty result. Only page_id, url and html are read.
"""

from __future__ import annotations

import html as references
import json
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyglass.functions.columns import field
from tallyglass.llm.common import by_bytes, landed

DIFFERENT_PAGES = 5
TEMPLATE_SHARE = 0.5
LAYOUT_DEPTH = 3
DEEPEST = 200

# Names of the markup language and words that sites name their parts with. Fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript textarea title template iframe xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul br".split()
)
CLOSES_P = BLOCK - {"br", "body", "html", "td", "th", "tr", "tbody", "thead", "tfoot"}
CLOSED_BY_OWN_KIND = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"),
}
SCOPES = frozenset("table ul ol dl article section main body html div nav aside select menu".split())
NO_CONTENT = frozenset(
    "head script style noscript textarea title template iframe xmp nav footer aside button select "
    "svg canvas object menu dialog".split()
)
NO_CONTENT_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert menu menubar form".split()
)
NO_CONTENT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disqus disclaimer footer header masthead menu nav navbar navigation newsletter "
    "notice notices popup promo promoted promotion related replies respond share sharing sidebar "
    "social sponsor sponsored subscribe toolbar widget".split()
)

# Boxes that make a layout, and those of them whose own boxes count too.
BOXES = frozenset("article aside center div fieldset footer form header main nav section table".split())
OPEN_BOXES = frozenset("center div form main section".split())

# Never the page's own story, however long.
FOREIGN_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising comment comments consent cookie cookies disqus promo "
    "promoted promotion replies respond sponsor sponsored".split()
)
ALWAYS_CONTENT = frozenset("html body main article".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_NAME = re.compile(r"[a-z]+")


class Element:
    """``named`` parts are dropped or not once the whole page is read. ``home``
    is where the children of an open element go if not to itself."""

    __slots__ = ("tag", "kind", "dropped", "named", "foreign", "children", "home")

    def __init__(self, tag: str, attributes: str):
        self.tag = tag
        self.children: list[Element | str] = []
        self.home: Element | None = None
        self.kind, self.dropped, self.named, self.foreign = tag, tag in NO_CONTENT, tag == "form", False
        if attributes:
            found = {m[0].lower(): m[1] or m[2] or m[3] for m in _ATTRIBUTE.findall(attributes)}
            if found:
                names = f"{found.get('class', '')} {found.get('id', '')}".lower()
                self.kind = ".".join([tag, *sorted(set(_NAME.findall(names)))])
                if tag not in ALWAYS_CONTENT:
                    for words in map(_NAME.findall, names.split()):
                        if words and NO_CONTENT_WORDS.issuperset(words):
                            self.named = True
                            self.foreign = self.foreign or not FOREIGN_WORDS.isdisjoint(words)
                    self.named = self.named or found.get("role", "").lower() in NO_CONTENT_ROLES


def settle(root: Element, constant: set[int] = frozenset(), forms: bool = False) -> Element:
    """Decide which named parts are dropped; ``constant`` holds the identities of
    template elements. With ``forms`` form elements stay."""
    order: list[tuple[Element, int]] = []
    waiting = [(root, -1)]
    while waiting:
        now, parent = waiting.pop()
        waiting += [
            (c, len(order))
            for c in now.children
            if not isinstance(c, str) and c.tag not in NO_CONTENT and id(c) not in constant
        ]
        order.append((now, parent))
    if not any(e.named for e, _ in order):
        return root
    letters, mains, articles = ([0] * len(order) for _ in range(3))
    for i in range(len(order) - 1, -1, -1):
        now, parent = order[i]
        letters[i] += sum(len("".join(c.split())) for c in now.children if isinstance(c, str))
        mains[i] += now.tag == "main"
        articles[i] += now.tag == "article"
        if parent >= 0:
            letters[parent] += letters[i]
            mains[parent] += mains[i]
            articles[parent] += articles[i]
    for i, (now, _) in enumerate(order):
        if now.named:
            elsewhere = mains[0] > mains[i] or articles[0] > articles[i]
            holds = mains[i] or articles[i] and articles[i] == articles[0] and not mains[0]
            if forms and now.tag == "form":
                now.dropped = False
            elif now.foreign:
                now.dropped = elsewhere or 2 * letters[i] <= letters[0]
            else:
                now.dropped = not holds and 2 * letters[i] <= letters[0]
    return root


def parse(page: str) -> Element:
    root = Element("html", "")
    stack, place, end = _Open(root), 0, len(page)
    while place < end:
        tag = _TAG.search(page, place)
        stop = tag.start() if tag else end
        if stop > place:
            (stack[-1].home or stack[-1]).children.append(page[place:stop])
        if not tag:
            break
        place = tag.end()
        name = tag.group(2)
        if not name or not tag.group(4):  # a comment or the like, or cut off inside a tag
            continue
        name = name.lower()
        if tag.group(1):
            _close(stack, name)
        elif name != "html":
            place = _open(stack, name, tag.group(3), page, place)
    return root


class _Open(list):
    """Open elements, and where those of a name are, so that no tag searches a deep page."""

    def __init__(self, root: Element):
        super().__init__([root])
        self.places: dict[str, list[int]] = {}

    def push(self, element: Element) -> None:
        self.places.setdefault(element.tag, []).append(len(self))
        self.append(element)

    def cut(self, place: int) -> None:
        while len(self) > place:
            self.places[self.pop().tag].pop()

    def last(self, names: Iterable[str]) -> int:
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=0)


def _close(stack: _Open, name: str) -> None:
    place = stack.last((name,))
    if place:
        stack.cut(place)


def _open(stack: _Open, name: str, attributes: str, page: str, place: int) -> int:
    """Returns where to go on reading."""
    if name in CLOSES_P:
        _close_within(stack, ("p",))
    if name in CLOSED_BY_OWN_KIND:
        _close_within(stack, CLOSED_BY_OWN_KIND[name])
    element = Element(name, attributes)
    home = stack[-1].home or stack[-1]
    home.children.append(element)
    if name in RAW:
        closing = re.compile(f"</{re.escape(name)}(?=[\\s/>]|\\Z)", re.IGNORECASE).search(page, place)
        return closing.start() if closing else len(page)
    if name not in VOID:
        # Below the limit only a part that may be dropped keeps its own children.
        leaves = element.dropped and not home.dropped or element.named and not (home.dropped or home.named)
        if len(stack) >= DEEPEST and not leaves:
            element.home = home
        stack.push(element)
    return place


def _close_within(stack: _Open, names: tuple[str, ...]) -> None:
    """End the innermost open element of these names, unless one that limits
    its reach is open inside."""
    place = stack.last(names)
    if place and place > stack.last(SCOPES):
        stack.cut(place)


# ---------------------------------------------------------------------- slots


class Slot:
    """Neighbouring elements of one kind, and the slots of their children."""

    __slots__ = ("kind", "members", "children", "number")

    def __init__(self, kind: str, members: list[Element]):
        self.kind, self.members = kind, members
        self.children = _slots([c for m in members for c in m.children])
        self.number = -1


def _slots(children: list) -> list[Slot]:
    runs: list[tuple[str, list[Element]]] = []
    for child in children:
        if not isinstance(child, str):
            if runs and runs[-1][0] == child.kind:
                runs[-1][1].append(child)
            else:
                runs.append((child.kind, [child]))
    return [Slot(kind, members) for kind, members in runs]


def skeleton(slot: Slot) -> list:
    return [slot.kind, [skeleton(c) for c in slot.children]]


def layout(page: Slot) -> int:
    """Hash of the outer boxes; stories differ inside of them."""
    return xxhash.xxh64_intdigest(json.dumps(_boxes(page, LAYOUT_DEPTH))) >> 1


def _boxes(slot: Slot, depth: int) -> list:
    boxes: list = []
    for child in slot.children:
        tag = child.kind.split(".")[0]
        if tag in ("html", "body"):
            found = _boxes(child, depth)
        elif tag in BOXES:
            found = [[child.kind, _boxes(child, depth - 1) if depth > 1 and tag in OPEN_BOXES else []]]
        else:
            continue
        boxes += [b for i, b in enumerate(found) if b != (found[i - 1] if i else boxes[-1] if boxes else None)]
    return boxes


def from_skeleton(tree: list) -> Slot:
    slot = Slot(tree[0], [])
    slot.children = [from_skeleton(c) for c in tree[1]]
    return slot


def numbered(slot: Slot) -> Slot:
    """Numbers in document order."""
    waiting, number = [slot], 0
    while waiting:
        now = waiting.pop()
        now.number, number = number, number + 1
        waiting.extend(reversed(now.children))
    return slot


def match(page: Slot, reference: Slot) -> tuple[int, list[tuple[Slot, Slot]]]:
    """Simple tree matching: the most pairs of equal kind that keep order and
    ancestry, for two slots of equal kind."""
    a, b = page.children, reference.children
    inner = {
        (i, j): match(x, y) for i, x in enumerate(a) for j, y in enumerate(b) if x.kind == y.kind
    }
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            found = inner.get((i - 1, j - 1))
            along = best[i - 1][j - 1] + found[0] if found else 0
            best[i][j] = max(best[i - 1][j], best[i][j - 1], along)
    pairs, i, j = [(page, reference)], len(a), len(b)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            pairs += inner[i - 1, j - 1][1]
            i, j = i - 1, j - 1
    return best[-1][-1] + 1, pairs


# ----------------------------------------------------------------------- text


def _all_text(elements: list[Element]) -> str:
    parts: list[str] = []
    waiting: list = list(reversed(elements))
    while waiting:
        now = waiting.pop()
        if isinstance(now, str):
            parts.append(now)
        else:
            waiting.extend(reversed(now.children))
    return " ".join("".join(parts).split())


def _topmost(root: Element, wanted: str) -> list[Element]:
    found, waiting = [], [root]
    while waiting:
        now = waiting.pop()
        if now.tag == wanted and not now.dropped:
            found.append(now)
        elif not now.dropped:
            waiting.extend(c for c in reversed(now.children) if not isinstance(c, str))
    return found


def _main_parts(root: Element) -> list[Element]:
    """Parts by tags alone. Teasers are articles too, hence the bulk."""
    main = _topmost(root, "main")
    if main and _content(main, set()):
        return main
    articles = _topmost(root, "article")
    if articles and 2 * max(map(_letters, articles)) >= _letters(root):
        return articles
    return [root]


def _letters(part: Element) -> int:
    return len(_content([part], set()).replace(" ", ""))


def _content(elements: list[Element], template: set[int]) -> str:
    """``template`` holds the identities of elements to leave out."""
    parts: list[str] = []
    waiting: list = list(reversed(elements))
    while waiting:
        now = waiting.pop()
        if isinstance(now, str):
            parts.append(references.unescape(now) if "&" in now else now)
        elif not now.dropped and id(now) not in template:
            if now.tag in BLOCK:
                parts.append(" ")
                waiting.append(" ")
            waiting.extend(reversed(now.children))
        else:
            parts.append(" " if now.tag in BLOCK else "")
    return " ".join("".join(parts).split())


def _text_hash(slot: Slot) -> int:
    return xxhash.xxh64_intdigest(_all_text(slot.members)) >> 1


def _page_hash(root: Element) -> int | None:
    """Of the content, forms included since they may hold the story; pages without any have none."""
    content = _content([settle(root, forms=True)], set())
    return xxhash.xxh64_intdigest(content) >> 1 if content else None


def main_text(page: str, reference: Slot | None = None, template: dict[int, int] | None = None) -> str:
    """``template`` maps slots of the reference to the hash of their template text;
    without one there are too few pages to tell."""
    root = parse(page)
    constant: set[int] = set()
    if template:
        for slot, aligned in match(Slot("html", [root]), reference)[1]:
            if aligned.number in template and template[aligned.number] == _text_hash(slot):
                constant.update(map(id, slot.members))
    chosen = "" if template is None else _content([settle(root, constant)], constant)
    return chosen or _content(_main_parts(settle(root)), set())


# ---------------------------------------------------------------------- Spark


def _host(url: str) -> F.Column:
    found = F.regexp_extract(F.coalesce(field(url).cast("string"), F.lit("")), r"^(?:[A-Za-z][^:/?#]*:)?//([^/?#]*)", 1)
    return F.lower(found)


def _laid_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """With layout, hash of the content and tree; the latter two null without content."""
    for batch in batches:
        for part in by_bytes(batch, "html"):
            layouts, digests, trees = [], [], []
            for page in part.column("html").to_pylist():
                root = parse(page or "")
                slots, digest = Slot("html", [root]), _page_hash(root)
                layouts.append(layout(slots))
                digests.append(digest)
                trees.append(None if digest is None else json.dumps(skeleton(slots)))
            part = part.append_column("layout", pa.array(layouts, pa.int64()))
            part = part.append_column("page", pa.array(digests, pa.int64()))
            yield part.append_column("own_tree", pa.array(trees, pa.string()))


def _observations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trees: dict[str, Slot] = {}
    for batch in batches:
        for part in by_bytes(batch, "html"):
            keys, slots, texts, digests = [], [], [], []
            rows = zip(*(part.column(c).to_pylist() for c in ("html", "page", "tree")))
            for i, (page, digest, tree) in enumerate(rows):
                found = match(Slot("html", [parse(page)]), _reference(trees, tree))[1]
                keys += [i] * len(found)
                slots += [reference.number for _, reference in found]
                texts += [_text_hash(slot) for slot, _ in found]
                digests += [digest] * len(found)
            places = pa.array(keys, pa.int64())
            columns = [part.column(c).take(places) for c in ("host", "reference")]
            columns += [pa.array(slots, pa.int32()), pa.array(texts, pa.int64()), pa.array(digests, pa.int64())]
            yield pa.record_batch(columns, ["host", "reference", "slot", "text", "page"])


def _reference(trees: dict[str, Slot], tree: str) -> Slot:
    if tree not in trees:
        if len(trees) > 1000:
            trees.clear()
        trees[tree] = numbered(from_skeleton(json.loads(tree)))
    return trees[tree]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trees: dict[str, Slot] = {}
    for batch in batches:
        for part in by_bytes(batch, "html"):
            rows = zip(*(part.column(c).to_pylist() for c in ("html", "tree", "template")))
            texts = [
                main_text(page or "")
                if template is None
                else main_text(page or "", _reference(trees, tree), {t["slot"]: t["text"] for t in template})
                for page, tree, template in rows
            ]
            yield pa.record_batch(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string())],
                ["page_id", "url", "text"],
            )


def wrappers(pages: DataFrame, different_pages: int = DIFFERENT_PAGES, share: float = TEMPLATE_SHARE) -> DataFrame:
    """Per host and layout: its reference tree and the template slots with their
    texts, null if the different pages are too few to tell. Runs jobs. ``pages``
    has host, html and what ``_laid_out`` adds."""
    pages = pages.filter("page IS NOT NULL")
    # Copies under other markup are one page; whichever of their trees will do.
    different = pages.groupBy("host", "layout", "page").agg(F.min("own_tree").alias("tree"))
    best = F.max(F.struct("count", "tree")).alias("best")
    layouts = landed(
        different.groupBy("host", "layout", "tree").count()
        .groupBy("host", "layout").agg(best, F.sum("count").alias("pages"))
        .select("host", "layout", "pages", "best.tree")
    )
    largest = layouts.groupBy("host").agg(F.max(F.struct("pages", "layout", "tree")).alias("largest"))
    enough = F.col("pages") >= different_pages
    chosen = landed(
        layouts.join(largest, "host").select(
            "host",
            "layout",
            "pages",
            F.when(enough, F.col("layout")).otherwise(F.col("largest.layout")).alias("reference"),
            F.when(enough, F.col("tree")).otherwise(F.col("largest.tree")).alias("tree"),
        )
    )
    seen = (
        pages.select("host", "layout", "html", "page")
        .join(chosen.drop("pages"), ["host", "layout"])
        .select("host", "reference", "html", "page", "tree")
        .mapInArrow(_observations, "host string, reference bigint, slot int, text bigint, page bigint")
    )
    # The same texts meet in their task first, so a hot host sends few rows a slot that is constant.
    by_text = seen.distinct().groupBy("host", "reference", "slot", "text").count()
    constant = (
        by_text.groupBy("host", "reference", "slot")
        .agg(F.max(F.struct("count", "text")).alias("most"), F.sum("count").alias("pages"))
        .filter((F.col("most.count") >= different_pages) & (F.col("most.count") >= share * F.col("pages")))
        # One row a slot of the reference.
        .groupBy("host", "reference")
        .agg(F.collect_list(F.struct("slot", "most.text")).alias("slots"))
    )
    known = chosen.groupBy("host", "reference").agg(F.sum("pages").alias("pages"))
    known = known.filter(F.col("pages") >= different_pages).join(constant, ["host", "reference"], "left")
    none = F.expr("CAST(array() AS array<struct<slot:int,text:bigint>>)")
    known = known.select("host", "reference", F.coalesce("slots", none).alias("template"))
    return landed(
        chosen.join(known, ["host", "reference"], "left").select("host", "layout", "tree", "template")
    )


def extract(pages: DataFrame, different_pages: int = DIFFERENT_PAGES) -> DataFrame:
    """page_id, url, text and n_chars of every page. Runs jobs."""
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
        _host("url").alias("host"),
    )
    made = "page_id bigint, url string, html string, host string, layout bigint, page bigint, own_tree string"
    # Landed with its pages, since reading every page once more for its layout takes longer.
    laid_out = landed(rows.mapInArrow(_laid_out, made), compression="zstd")
    joined = laid_out.join(wrappers(laid_out, different_pages), ["host", "layout"], "left")
    found = joined.select("page_id", "url", "html", "tree", "template").mapInArrow(
        _texts, "page_id bigint, url string, text string"
    )
    return found.withColumn("n_chars", F.char_length("text").cast("bigint"))
