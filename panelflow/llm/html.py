"""Main text of web pages by site style trees (operator 9).

The pages of a host are merged into one tree: an element is known by the
host and the tags, classes and ids on its path. For every element the tree
counts, over the host's pages, the styles its children take (presentation)
and the texts below it (content). Entropy over the number of pages turns
the counts into an importance between 0 and 1: an element that looks the
same and says the same on every page is template, one that varies is not.
The importances are stored as sorted hash arrays, which the second scan of
the pages maps; there every branch of low importance is removed.

Two things are known beforehand: elements that can never be main text (NOISE
tags and names), and the elements that authors mark as main text (MAIN).
A page with a main, or with articles that hold MAIN_SHARE of its text, has its
text there and nowhere else; noise counts for neither. The prior of
the marked element is that it stays; a branch inside it is measured against
it: what a site repeats in articles that differ is template, what it repeats
along with the whole article is not.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelflow.llm import hashstore
from panelflow.llm.common import slices, small_batches
from panelflow.session import staging_path

IMPORTANCE = 0.2                 # branches below it go; inside MAIN, below this part of the marked element's own
DECAY = 0.9                      # weight of content against presentation
LEAST_PAGES = 5                  # a tree of fewer pages tells nothing
SHARD_KEYS = 1 << 20

NOISE = frozenset("head script style noscript template nav header footer aside form button select textarea iframe object svg canvas dialog menu".split())
NOISE_NAMES = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo menu nav navbar navigation breadcrumb breadcrumbs sidebar "
    "footer header masthead cookie cookies consent notice notices popup modal newsletter subscribe comment comments disqus "
    "social share sharing related recommended widget login signup search".split())
# A name's words that say something about a noise word beside it ("has-sidebar"): the name is no noise.
MODIFIERS = frozenset("has with without no non show hide enable enabled disable disabled".split())
# Noise by these names may hold articles of its own; other names are no noise around an article.
BOX_NAMES = frozenset("ad ads advert adverts advertisement sponsor sponsored promo comment comments disqus related recommended".split())
MAIN = frozenset(["article", "main"])
MAIN_SHARE = 0.5                 # articles with less of the page's text are teasers or comments
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th "
    "thead title tr ul".split())
# A start tag that ends an open element of the first set, up to one of the second.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
         "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
_TOKEN = re.compile(r"[A-Za-z]+")


def noise_words(names: str) -> set[str]:
    """The noise words of a class, id and role."""
    found = set()
    if not NOISE_NAMES.isdisjoint(_TOKEN.findall(names)):
        for name in names.split():
            words = set(_TOKEN.findall(name))
            if MODIFIERS.isdisjoint(words):
                found |= words & NOISE_NAMES
    return found


class Page(HTMLParser):
    """Blocks of one page: text, the elements above it, and whether noise or main text surrounds it.

    elements: (key of the path, hash of what the path's last part looks like, number of the parent).
    blocks: (text, element, noise, the outermost main element or -1).
    named: elements that are noise by name alone, as [the one around it, may hold articles, is no noise].
    sure: outermost main elements that are or hold a main tag.
    """

    def __init__(self, host: str, html: str):
        super().__init__(convert_charrefs=True)
        self.elements: list[tuple[int, int, int]] = []
        self.blocks: list[tuple[str, int, bool, int]] = []
        self.named: list[list] = []
        self.sure: set[int] = set()
        self.stack: list[tuple[str, int, bool, int, int]] = [("", -1, False, -1, -1)]
        self.root, self.parts = xxhash.xxh64_intdigest(host.encode(), 1), []
        self.feed(html)
        self.close()
        self.flush()
        for mark in self.named:                                     # those around it come first
            mark[2] = mark[2] and (mark[0] < 0 or self.named[mark[0]][2])
        self.blocks = [(t, e, noise or (mark >= 0 and not self.named[mark][2]), main) for t, e, noise, main, mark in self.blocks]

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        self.parts = []
        if text:
            self.blocks.append((text, *self.stack[-1][1:]))

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCK:
            self.flush()
            inner, outer = _ENDS.get(tag, ({"p"}, {"button"}))
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i][0] in inner or self.stack[i][0] == "p":
                    del self.stack[i:]
                    break
                if self.stack[i][0] in outer or self.stack[i][0] in ("table", "div", "article", "section", "body"):
                    break
        if tag in VOID:
            return
        names = " ".join(v for k, v in attrs if v and k in ("class", "id", "role"))
        _, parent, noise, main, mark = self.stack[-1]
        noise = noise or tag in NOISE
        if tag in MAIN and not noise:
            self.clear(mark, tag)
        elif names and not noise and tag not in ("html", "body") and (words := noise_words(names.lower())):
            self.named.append([mark, not BOX_NAMES.isdisjoint(words), False])
            mark = len(self.named) - 1
        if tag in BLOCK or tag in NOISE:
            look = xxhash.xxh64_intdigest(f"{tag} {names}".encode(), 2)
            above = self.elements[parent][0] if parent >= 0 else self.root
            self.elements.append((xxhash.xxh64_intdigest(b"%d %d" % (above, look)), look, parent))
            parent = len(self.elements) - 1
            if main < 0 and tag in MAIN:
                main = parent
            if tag == "main":
                self.sure.add(main)
        self.stack.append((tag, parent, noise, main, mark))

    def clear(self, mark: int, tag: str) -> None:
        """What surrounds a main, or up to a box of its own an article, is no noise by its name."""
        while mark >= 0 and (tag == "main" or not self.named[mark][1]):
            self.named[mark][2] = True
            mark = self.named[mark][0]

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag in BLOCK:
            self.flush()

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK or tag in NOISE:
            self.flush()
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                return

    def handle_data(self, data: str) -> None:
        self.parts.append(data)

    def unknown_decl(self, data: str) -> None:
        pass


def host_of(url: str | None) -> str:
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://", "", url or "").split("/")[0].split("?")[0].split("#")[0].rpartition("@")[2].lower()


def _observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(element, kind, value): the style of an element's children (0), a text under it (1) or the element alone (2), once per page."""
    for b in slices(batches, "html"):
        seen: dict[tuple[int, int, int], int] = {}
        for url, html in zip(b.column("url").to_pylist(), b.column("html").to_pylist()):
            page = Page(host_of(url), html or "")
            looks: dict[int, list[int]] = {}
            for key, look, parent in page.elements:
                looks.setdefault(parent, []).append(look)
            own = {(page.elements[e][0], 0, xxhash.xxh64_intdigest(np.array(v, np.uint64).tobytes())) for e, v in looks.items() if e >= 0}
            own |= {(page.elements[e][0], 1, xxhash.xxh64_intdigest(t.encode())) for t, e, noise, _ in page.blocks if e >= 0 and not noise}
            own |= {(key, 2, 0) for key, _, _ in page.elements}
            for row in own:
                seen[row] = seen.get(row, 0) + 1
        keys = np.array([k for k, _, _ in seen], np.uint64).view(np.int64)
        values = np.array([v for _, _, v in seen], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array([k for _, k, _ in seen], pa.int32()), pa.array(values), pa.array(list(seen.values()), pa.int64())],
                                         ["element", "kind", "value", "n"])


def importances(pages: DataFrame) -> DataFrame:
    """(element, presentation, content): entropies of the merged trees; null where a kind was never seen."""
    counts = pages.mapInArrow(_observe, "element long, kind int, value long, n long").groupBy("element", "kind", "value").agg(F.sum("n").alias("n"))
    sums = counts.groupBy("element", "kind").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("s"))
    of = lambda kind, c: F.max(F.when(F.col("kind") == kind, F.col(c)))
    sums = sums.groupBy("element").agg(of(0, "m").alias("looks"), of(0, "s").alias("s0"), of(1, "m").alias("texts"), of(1, "s").alias("s1"), of(2, "m").alias("pages"))
    # presentation: -sum p log_m p over styles; content: 1 - mean of log_m(pages that repeat a text), m the pages with the element
    presentation = F.when(F.col("looks") < LEAST_PAGES, F.lit(1.0)).otherwise(1 - F.col("s0") / F.col("looks") / F.log("looks"))
    content = F.when(F.col("pages") < LEAST_PAGES, F.lit(1.0)).otherwise(1 - F.col("s1") / F.col("texts") / F.log("pages"))
    return sums.select("element", presentation.alias("presentation"), F.when(F.col("texts").isNotNull(), content).alias("content"))


def _write(uri: str):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        keys = table.column("element").to_numpy().view(np.uint64)
        order = np.argsort(keys)
        hashstore.write(uri, key[0].as_py(), "keys", keys[order])
        for c in ("presentation", "content"):
            hashstore.write(uri, key[0].as_py(), c, pc.fill_null(table.column(c), -1.0).to_numpy().astype(np.float32)[order])
        return pa.table({"n": pa.array([len(keys)], pa.int64())})
    return run


def _below(page: Page, top: int) -> list[int]:
    """The elements below ``top``; they come after it, parents first."""
    inside = {top}
    for i in range(top + 1, len(page.elements)):
        if page.elements[i][2] in inside:
            inside.add(i)
        elif page.elements[i][2] < top:
            break
    return sorted(inside - {top})


def _main_text(page: Page, store: hashstore.Store) -> str:
    clean = [(t, e, main) for t, e, noise, main in page.blocks if not noise]
    mains = {main for *_, main in clean if main >= 0}
    marked = bool(mains & page.sure) or (
        bool(mains) and sum(len(t) for t, _, main in clean if main >= 0) >= MAIN_SHARE * sum(len(t) for t, *_ in clean))
    left = [(t, e) for t, e, main in clean if main >= 0 or not marked]
    if not left or not page.elements:
        return "\n".join(t for t, _ in left)
    keys, back = np.unique(np.array([k for k, _, _ in page.elements], np.uint64), return_inverse=True)
    shard, at = store.find(keys)
    look, says = (np.where(at >= 0, store.get(shard, at, f, np.float64), -1.0)[back] for f in ("presentation", "content"))
    # a branch's content is the mean of its texts', by length; its own look counts for the rest
    total, weight = np.zeros(len(back)), np.zeros(len(back))
    for t, e in left:
        value, i = (says[e] if e >= 0 and says[e] >= 0 else 1.0), e
        while i >= 0:
            total[i] += value * len(t)
            weight[i] += len(t)
            i = page.elements[i][2]
    content = np.divide(total, weight, out=np.ones(len(back)), where=weight > 0)
    branch = np.where(look >= 0, (1 - DECAY) * look + DECAY * content, content)
    least = np.full(len(back), IMPORTANCE)
    if marked:                                                  # prior: what holds a main element, and the element, stay
        least[:] = 0
        for main in mains:
            inside = _below(page, main)
            least[inside] = IMPORTANCE * branch[main]
    low = branch < least
    for i, (_, _, parent) in enumerate(page.elements):          # parents come first
        low[i] |= parent >= 0 and low[parent]
    return "\n".join(t for t, e in left if e < 0 or not low[e])


def _extract(uri: str, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = hashstore.opened(uri, bits)
        for b in slices(batches, "html"):
            texts = [_main_text(Page(host_of(u), h or ""), store) for u, h in zip(b.column("url").to_pylist(), b.column("html").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])
    return run


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row.

    Character references are decoded, white space inside a block becomes one
    space, blocks are trimmed and joined in page order by one line break; a
    block ends at a block element's tag or a line break element. Null and
    empty pages, and pages without main text, have the empty text. Pages
    with a null url form one host. Broken, cut-off and deeply nested markup
    is read as far as it goes; repeated rows each come back; an empty table
    gives no rows.
    """
    small_batches(pages.sparkSession)
    slim = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"), pages[html_col].alias("html"))
    size = slim.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    bits = hashstore.bits_for(size / 400, SHARD_KEYS)
    uri = staging_path(pages.sparkSession, "style-trees")
    shard = F.expr(f"shiftrightunsigned(element, {64 - bits})" if bits else "0L")
    importances(slim).withColumn("shard", shard).groupBy("shard").applyInArrow(_write(uri), "n long").agg(F.sum("n")).collect()
    return slim.mapInArrow(_extract(uri, bits), "page_id long, url string, text string, n_chars long")
