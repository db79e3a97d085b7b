"""Main text of web pages by wrapper induction.

Each page is parsed into text blocks, each with its slot: the path of tags and
classes to it, repeated siblings counting as one.  The slots of a page, in
page order, are its skeleton.  The skeletons of a host are grouped into layouts:
its most frequent ones lead, and a skeleton joins the first leader with which
simple tree matching aligns ``LAYOUT_PERCENT`` of the nodes of both.  Slots are
compared among the pages of a layout, among all pages of the host whose slot is
aligned with its most frequent skeleton, and slots without any partner among the
pages that have them so.  A text that nearly all of these pages have in the slot is
template, inside an article too; slots that vary are content.  Where pages mark an article, the content is in it
or outside of it, wherever the pages of the host that do so have more varying
text; on hosts with few such pages, or where nothing varies, the article is the content.
Parts that markup names as menu, header, footer, sidebar, notice, advert, form,
script, style or reader comments are never content: adverts and comments vary,
so alignment cannot tell them from content.

Tree matching runs once per distinct skeleton of a host and leader, texts are counted in
the map tasks first, and what is joined back to pages is bounded by the size of
a template, so a host with a third of all pages is no hot group.  ``LEADERS``
skeletons of a host lead at a time, for ``TURNS`` turns; skeletons that no leader
took are judged by their slots alone, like slots without a partner.

Blocks end where block elements start or end; character references are decoded,
white space inside a block becomes one space, blocks are joined by new lines.
Damaged markup is closed as browsers do; depth beyond ``DEEP`` shares a slot.

Nulls: a null or empty page has the empty text; pages without url share a host;
repeated rows are treated alike, and equal pages of a host count as one page.  Empty tables give no rows; other columns are
ignored.  Texts are never cut.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache, reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sarraf.llm.common import same, stored, table

#: A template text stands on at least this many pages, and on this share of those with the slot.
TEMPLATE_PAGES = 5
TEMPLATE_PERCENT = 90
#: Nodes of two skeletons of one layout that tree matching aligns.
LAYOUT_PERCENT = 70
LEADERS = 32
#: Stands for all layouts of a host, aligned with its most frequent skeleton.
HOST = 0
TURNS = 4
DEEP = 48

# Elements and names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary "
    "table tbody td tfoot th thead title tr ul".split()
)
CLOSES_P = BLOCK - frozenset("html head body caption td th tr tbody thead tfoot option legend title".split())
#: What a start tag closes, and the elements that keep it from looking further.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)), "body": (("head",), ("html",)),
}
P_SCOPE = frozenset("table td th caption button object template html".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code del em font i ins kbd label mark q s samp small span strike strong sub sup tt u var".split()
)
DROPPED = frozenset(
    "nav footer aside form script style noscript template iframe svg math button select textarea head title dialog menu "
    "object audio video canvas noembed noframes".split()
)
ARTICLE = frozenset(("article", "main"))
PLAIN = frozenset(("html", "body", "article", "main"))
DROPPED_NAMES = frozenset(
    "ad ads adbox advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent "
    "gdpr notice notices popup modal overlay subscribe newsletter signup nav navbar navigation menu menubar breadcrumb "
    "breadcrumbs sidebar widget widgets footer masthead topbar toolbar comment comments commentlist disqus respond "
    "replies share sharing social related recommended pagination pager login search skip contentinfo complementary".split()
)
DROPPED_STARTS = ("adsby", "advert", "comment", "cookie", "sidebar", "breadcrumb", "newsletter")
ABOUT_LAYOUT = frozenset("has no with without is".split())
TOP_NAMES = frozenset(("header", "pageheader", "siteheader"))

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S
)
#: For pages that end inside a quoted value.
_LOOSE = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_CLASS = re.compile(r"""\bclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_HIDDEN = re.compile(r"""(?:\s|^)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
_LABEL = re.compile(r"[^\w-]+")


def _named_away(attributes: str, in_article: bool) -> bool:
    if _HIDDEN.search(attributes):
        return True
    for m in _NAMES.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").lower().split():
            words = _SPLIT.split(name)
            if words[0] in ABOUT_LAYOUT:  # says what stands beside the element
                continue
            if any(w in DROPPED_NAMES or w.startswith(DROPPED_STARTS) or (w in TOP_NAMES and not in_article) for w in words):
                return True
    return False


class _Open:
    """An open element; ``block`` is the depth of the nearest block element, itself included."""

    __slots__ = ("tag", "slot", "dropped", "article", "block")

    def __init__(self, tag: str, slot: str, dropped: bool, article: bool, block: int):
        self.tag, self.slot, self.dropped, self.article, self.block = tag, slot, dropped, article, block


def blocks(page: str | None) -> list[tuple[str, str, bool]]:
    """(slot, text, in article) of the text blocks that markup does not drop, in page order."""
    found: list[tuple[str, str, bool]] = []
    if not page:
        return found
    stack = [_Open("", "", False, False, 0)]
    depths: dict[str, list[int]] = {}  # of the open elements of a tag
    token = _TOKEN
    parts: list[str] = []
    owner = stack[0]

    def flush():
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                found.append((owner.slot, text, owner.article))

    def innermost(tags) -> int:
        return max((depths[t][-1] for t in tags if depths.get(t)), default=0)

    def pop_to(at: int):
        for node in stack[at:]:
            depths[node.tag].pop()
        del stack[at:]

    def close(tags, scope):
        k = innermost(tags)
        if k > innermost(scope):
            pop_to(k)

    def say(raw: str):
        nonlocal owner
        if stack[-1].dropped:
            return
        if not parts:
            owner = stack[stack[-1].block]
        parts.append(html.unescape(raw) if "&" in raw else raw)

    at, size = 0, len(page)
    while at < size:
        mark = page.find("<", at)
        if mark < 0:
            say(page[at:])
            break
        m = token.match(page, mark)
        if m is None and token is _TOKEN and (m := _LOOSE.match(page, mark)):
            token = _LOOSE
        if m is None:
            say(page[at : mark + 1])
            at = mark + 1
            continue
        if mark > at:
            say(page[at:mark])
        at = m.end()
        if m[2] is None:
            continue
        tag, attributes = m[2].lower(), m[3] or ""
        if m[1]:
            if tag in BLOCK:
                flush()
            k = innermost((tag,))
            if k and not (tag in INLINE and stack[-1].block > k):
                pop_to(k)
            continue
        if tag in BLOCK:
            flush()
        if tag == "br":
            say(" ")
        if tag in CLOSES_P:
            close(("p",), P_SCOPE)
        if tag in CLOSES:
            close(*CLOSES[tag])
        if tag in VOID:
            continue
        top = stack[-1]
        dropped = top.dropped or tag in DROPPED or (tag == "header" and not top.article)
        if not dropped and attributes and tag not in PLAIN:
            dropped = _named_away(attributes, top.article)
        slot = top.slot
        if len(stack) <= DEEP and tag in BLOCK:
            c = _CLASS.search(attributes)
            kind = _LABEL.sub("-", (c[1] or c[2] or c[3] or ""))[:40] if c else ""
            slot = f"{slot}/{tag}.{kind}" if kind else f"{slot}/{tag}"
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            at = page.find(">", end.end()) + 1 if end else size
            at = at or size
            continue
        depth = len(stack)
        depths.setdefault(tag, []).append(depth)
        stack.append(_Open(tag, slot, dropped, top.article or tag in ARTICLE, depth if tag in BLOCK else stack[-1].block))
    flush()
    return found


# --- simple tree matching ------------------------------------------------------------

def _tree(skeleton: str) -> dict:
    root: dict = {}
    for path in skeleton.split("\n"):
        node = root
        for label in path.split("/")[1:]:
            node = node.setdefault(label, {})
    return root


def _size(tree: dict) -> int:
    return sum(1 + _size(below) for below in tree.values())


def tree_match(a: dict, b: dict) -> tuple[int, list]:
    """Size of the largest order-preserving match below two nodes, and the matched pairs of children with their own.

    Labels are unique among siblings, so a child has one possible partner and
    the match is the heaviest chain of partners with rising places, found with
    a Fenwick tree of prefix maxima: n log n steps, memory for n.
    """
    places = {label: j for j, label in enumerate(b, 1)}
    best = [(0, -1)] * (len(places) + 1)  # heaviest chain that ends in a range of places, and its last link
    links = []  # (label, matches below, link before)
    top = (0, -1)
    for label, below in a.items():
        place = places.get(label)
        if place is None:
            continue
        inner, pairs = tree_match(below, b[label])
        before, j = (0, -1), place - 1
        while j:
            before = max(before, best[j])
            j &= j - 1
        chain = (before[0] + 1 + inner, len(links))
        links.append((label, pairs, before[1]))
        top = max(top, chain)
        j = place
        while j < len(best):
            best[j] = max(best[j], chain)
            j += j & -j
    chosen, at = [], top[1]
    while at >= 0:
        label, pairs, before = links[at]
        chosen.append((label, pairs))
        at = before
    return top[0], chosen


def _partners(skeleton: str, pairs: list) -> list[str]:
    matched: set[str] = set()

    def walk(prefix: str, pairs: list):
        for label, below in pairs:
            matched.add(f"{prefix}/{label}")
            walk(f"{prefix}/{label}", below)

    walk("", pairs)
    return [s for s in skeleton.split("\n") if s in matched]


def aligned(skeleton: str, reference: str) -> list[str]:
    """Slots of ``skeleton`` that have a partner in ``reference``."""
    return _partners(skeleton, tree_match(_tree(skeleton), _tree(reference))[1])


def layout(skeleton: str, references: tuple[str, ...], with_first: bool = True) -> tuple[int | None, list[tuple[int, str]]]:
    """Number of the reference whose layout ``skeleton`` has, and its slots aligned with that; -1: with the first one.

    References that have the layout of an earlier one do not lead.
    """
    tree, size = _measured(skeleton)
    slots: list[tuple[int, str]] = []
    for k in _leaders(references):
        other, other_size = _measured(references[k])
        n, pairs = tree_match(tree, other)
        alike = _alike(n, size, other_size)
        if k == 0 and with_first:
            slots += [(-1, s) for s in _partners(skeleton, pairs)]
        if alike:
            return k, slots + [(k, s) for s in _partners(skeleton, pairs)]
    return None, slots


@lru_cache(maxsize=4)
def _leaders(references: tuple[str, ...]) -> tuple[int, ...]:
    leaders: list[int] = []
    for k, reference in enumerate(references):
        tree, size = _measured(reference)
        others = (_measured(references[i]) for i in leaders)
        if not any(_alike(tree_match(tree, other)[0], size, n) for other, n in others):
            leaders.append(k)
    return tuple(leaders)


@lru_cache(maxsize=4 * LEADERS)
def _measured(skeleton: str) -> tuple[dict, int]:
    tree = _tree(skeleton)
    return tree, _size(tree)


def _alike(matched: int, one: int, other: int) -> bool:
    return 200 * matched >= LAYOUT_PERCENT * (one + other)


# --- Spark --------------------------------------------------------------------------

_BLOCK = pa.struct([("slot", pa.int64()), ("text", pa.string()), ("print", pa.int64()), ("article", pa.bool_())])
_PARSED = (
    "page_id {id}, url string, page long, skeleton string, "
    "blocks array<struct<slot:long,text:string,print:long,article:boolean>>, texts array<struct<slot:long,print:long>>"
)
_TEXT = pa.struct([("slot", pa.int64()), ("print", pa.int64())])
_PAIR = pa.struct([("leader", pa.int64()), ("slot", pa.int64())])


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints, skeletons, rows, texts = [], [], [], []
        for page in batch.column("html").to_pylist():
            own = blocks(page)
            prints.append(_hash("\n".join(f"{slot} {article} {text}" for slot, text, article in own)))
            skeletons.append("\n".join(dict.fromkeys(slot for slot, _, _ in own)))
            rows.append([
                {"slot": _hash(slot), "text": text, "print": _hash(text), "article": article} for slot, text, article in own
            ])
            distinct = dict.fromkeys((b["slot"], b["print"]) for b in rows[-1])
            texts.append([{"slot": slot, "print": text} for slot, text in distinct])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"), batch.column("url"), pa.array(prints, pa.int64()), pa.array(skeletons, pa.string()),
                pa.array(rows, pa.list_(_BLOCK)), pa.array(texts, pa.list_(_TEXT)),
            ],
            ["page_id", "url", "page", "skeleton", "blocks", "texts"],
        )


def _align(first_turn: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, done = [], []
            rows = (batch.column(name).to_pylist() for name in ("skeleton", "pairs", "references"))
            for skeleton, known, references in zip(*rows, strict=True):
                own, slots = layout(skeleton, tuple(r["skeleton"] for r in references), first_turn)
                pairs.append([*known, *({"leader": references[k]["shape"] if k >= 0 else HOST, "slot": _hash(s)} for k, s in slots)])
                done.append(own is not None)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in ("host", "shape", "n", "skeleton")),
                    pa.array(pairs, pa.list_(_PAIR)), pa.array(done, pa.bool_()),
                ],
                ["host", "shape", "n", "skeleton", "pairs", "done"],
            )

    return run


def _partnered(shapes: DataFrame) -> DataFrame:
    """host, shape and (leader, slot) of the slots that are aligned with a leader, for all of ``shapes``."""
    open_ = shapes.withColumn("pairs", F.array().cast("array<struct<leader:bigint,slot:bigint>>"))
    parts = []
    for turn in range(TURNS):
        rank = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("n"), "shape", "skeleton"))
        leaders = open_.withColumn("rank", rank).filter(F.col("rank") <= LEADERS).groupBy(F.col("host").alias("_h")).agg(
            F.sort_array(F.collect_list(F.struct("rank", "shape", "skeleton"))).alias("references")
        )
        turned = stored(
            open_.join(leaders, F.col("host") == F.col("_h"))
            .select("host", "shape", "n", "skeleton", "pairs", "references")
            .mapInArrow(
                _align(turn == 0),
                "host string, shape long, n long, skeleton string, pairs array<struct<leader:long,slot:long>>, done boolean",
            ),
            "page-layouts",
        )
        parts.append(turned.filter("done"))
        open_ = turned.filter("not done").drop("done")
        if open_.isEmpty():
            break
    parts.append(open_.withColumn("done", F.lit(False)))
    return reduce(DataFrame.unionByName, parts).select(
        F.col("host").alias("_host"), F.col("shape").alias("_shape"), F.inline("pairs").alias("leader", "_slot")
    )


def _template(pages: DataFrame, partnered: DataFrame) -> DataFrame:
    """_th and _template, the (slot, print) that are template there, for the hosts of ``pages`` (host, shape, texts)."""
    here = (F.col("host") == F.col("_host")) & (F.col("shape") == F.col("_shape")) & (F.col("slot") == F.col("_slot"))

    def counted(keys: list[str], each) -> DataFrame:
        # Counts first: the join with the alignment then has a row per distinct text, not per page.
        rows = pages.select("host", "shape", F.explode(each).alias("_b"))
        rows = rows.select("host", "shape", *([F.col("_b.slot"), F.col("_b.print")] if "print" in keys else [F.col("_b").alias("slot")]))
        per_shape = rows.groupBy("host", "shape", *keys).agg(F.count("*").alias("n"))
        met = per_shape.join(partnered, here, "left")  # slots without a partner: leader NULL
        return met.groupBy("host", "leader", *keys).agg(F.sum("n").alias("n"))

    texts = counted(["slot", "print"], F.col("texts")).filter(F.col("n") >= TEMPLATE_PAGES)
    held = counted(["slot"], F.array_distinct(F.col("texts.slot"))).select(
        F.col("host").alias("_sh"), F.col("leader").alias("_leader"), F.col("slot").alias("_slot"), F.col("n").alias("_pages")
    )
    of_slot = (F.col("host") == F.col("_sh")) & same(F.col("leader"), F.col("_leader")) & (F.col("slot") == F.col("_slot"))
    constant = texts.join(held, of_slot).filter(F.col("n") * 100 >= TEMPLATE_PERCENT * F.col("_pages"))
    return constant.groupBy(F.col("host").alias("_th")).agg(F.collect_set(F.struct("slot", "print")).alias("_template"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and text of every row of ``pages`` (page_id, url, html)."""
    kind = pages.schema["page_id"].dataType.simpleString()
    parsed = pages.select("page_id", F.col("url").cast("string"), "html").mapInArrow(_parse, _PARSED.format(id=kind))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    parsed = stored(parsed.withColumns({"host": host, "shape": F.xxhash64("skeleton")}), "page-blocks")
    distinct = stored(
        parsed.groupBy("host", "page").agg(F.first("shape").alias("shape"), F.first("texts").alias("texts")).drop("page"), "page-texts"
    )
    shapes = stored(
        parsed.groupBy("host", "shape").agg(F.count_distinct("page").alias("n"), F.first("skeleton").alias("skeleton")), "page-shapes"
    )
    template = stored(_template(distinct, _partnered(shapes)), "page-template")
    marked = F.exists("blocks", lambda b: b["article"])
    fixed = F.coalesce("_template", F.array().cast("array<struct<slot:bigint,print:bigint>>"))
    judged = parsed.join(template, F.col("host") == F.col("_th"), "left").withColumn(
        "_varying", F.filter("blocks", lambda b: ~F.array_contains(fixed, F.struct(b["slot"], b["print"])))
    )

    def chars(inside: bool):
        own = F.filter("_varying", lambda b: b["article"] == F.lit(inside))
        return F.sum(F.aggregate(own, F.lit(0).cast("long"), lambda n, b: n + F.char_length(b["text"])))

    roots = stored(
        judged.filter(marked).groupBy(F.col("host").alias("_rh")).agg(
            chars(True).alias("_inside"), chars(False).alias("_outside"), F.count("*").alias("_n")
        ).filter(F.col("_n") >= TEMPLATE_PAGES).drop("_n"),
        "page-roots",
    )
    judged = judged.join(roots, F.col("host") == F.col("_rh"), "left")
    unclear = F.coalesce(F.col("_inside") + F.col("_outside"), F.lit(0)) == 0
    content = (
        F.when(~marked, F.col("_varying"))
        .when(unclear, F.filter("blocks", lambda b: b["article"]))
        .when(F.col("_inside") >= F.col("_outside"), F.filter("_varying", lambda b: b["article"]))
        .otherwise(F.filter("_varying", lambda b: ~b["article"]))
    )
    return judged.select("page_id", "url", F.array_join(F.transform(content, lambda b: b["text"]), "\n").alias("text"))


def op9_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract(table(spark, sf_dir, "pages"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
