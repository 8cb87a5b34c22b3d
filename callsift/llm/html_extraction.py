"""Main text of web pages by a tree-structured graphical model over the DOM."""

from __future__ import annotations

import html
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.llm.common import slices, table
from callsift.llm.registry import query

#: Pages (about) that the potentials are counted on, chosen by a hash of their id.
TRAINING_PAGES = 4000

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
NAMED = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
RAW = frozenset("script style noscript template iframe textarea title select option button".split())
#: Of these, a missing end tag leaves the rest of the page hidden; the others without one are left out alone.
HIDING = frozenset("script style noscript template iframe textarea title".split())
#: What an opening tag of these ends them, as their own end tag does.
ENDED_BY = {"button": "button", "select": "select", "option": "option|optgroup|select|datalist"}
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
    "object svg g text tspan defs use path circle ellipse line polygon polyline rect "
    "math mi mn mo ms mtext mspace mrow mstyle mfrac msqrt mroot msub msup msubsup mover munder munderover mfenced semantics annotation".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
GROUPS = {name: i for i, names in enumerate(("p", "h1 h2 h3 h4 h5 h6", "li dd dt", "ul ol dl", "td th tr table tbody thead tfoot caption", "article main", "nav menu", "header", "footer", "aside", "form fieldset", "figure figcaption", "blockquote pre", "body html head")) for name in names.split()}
OTHER_GROUP, TEXT_GROUP, N_GROUPS = 14, 15, 16
#: Kind of child that the pairwise potential depends on: 0 containers, 1 paragraphs and the like, 2 texts.
EDGE_KIND = np.array([1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 1, 1, 0, 0, 2])
#: An opening tag ends open elements of these names, up to the nearest of the second kind.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
GOOD = re.compile(r"article|content|post|entry|story|main|body|prose", re.I)
BAD = re.compile(r"(?:^|[^a-z])ad(?:s|vert\w*)?(?:$|[^a-z])|nav|menu|foot|header|masthead|side|banner|cookie|consent|notice|popup|modal|promo|sponsor|comment|repl(?:y|ies)|discuss|share|social|related|recommend|form|login|subscri|newsletter|breadcrumb|widget|copyright|pagination", re.I)
LABELLED_IN, LABELLED_OUT = frozenset({5}), frozenset({6, 7, 8, 9, 10})
LENGTHS, LINKS, STOPS = np.array([1, 20, 60, 150, 400]), np.array([0.01, 0.34, 0.67]), np.array([1, 3, 8])
#: Sizes of the features' value sets: tag group, name hint, own length, link share, sentence ends.
SIZES = (N_GROUPS, 4, len(LENGTHS) + 1, len(LINKS) + 1, len(STOPS) + 1)
#: What is believed before any page is seen, as counts: groups that are (not) content, hints that say so.
PRIOR = {(0, 5): (0, 20), (0, 6): (40, 0), (0, 7): (40, 0), (0, 8): (40, 0), (0, 9): (40, 0), (0, 10): (40, 0), (1, 1): (0, 10), (1, 2): (60, 0), (2, 4): (2, 10), (2, 5): (2, 20), (3, 3): (20, 1)}


def parse(page: str) -> list[tuple[int, int, int, str | None, int]]:
    """DOM nodes in page order as (parent, tag group, hint, text, linked characters).

    Elements that only mark up a line are folded into the text around them; a text node is an unbroken run of text
    of one block, white space and character references still as written. Hint: 0 none, 1 good, 2 bad, 3 both.
    """
    nodes: list[tuple[int, int, int, str | None, int]] = [(-1, OTHER_GROUP, 0, None, 0)]
    open_at: list[tuple[str, int]] = [("", 0)]
    # Where in ``open_at`` the elements of each name are, so that none is looked for by walking through all.
    places: dict[str, list[int]] = {}
    run: list[str] = []
    linked = in_link = 0
    at, to = 0, len(page)
    endless: set[str] = set()

    def flush() -> None:
        nonlocal linked
        if run:
            text = "".join(run)
            if text.strip():
                nodes.append((open_at[-1][1], TEXT_GROUP, 0, text, linked))
            run.clear()
        linked = 0

    def text(piece: str) -> None:
        nonlocal linked
        run.append(piece)
        if in_link:
            linked += len(piece)

    def close(names, stop=()) -> None:
        """End the innermost open element of these names and all inside it, unless one of ``stop`` lies between."""
        innermost, barrier = (max((places[name][-1] for name in own if places.get(name)), default=0) for own in (names, stop))
        if innermost > barrier:
            flush()
            for name, _ in open_at[innermost:]:
                places[name].pop()
            del open_at[innermost:]

    while at < to:
        tag = TAG.search(page, at)
        if not tag:
            text(page[at:])
            break
        if tag.start() > at:
            text(page[at : tag.start()])
        at = tag.end()
        name = tag[2] or tag[5]
        if not name:
            continue
        name, closing = name.lower(), tag[1] or tag[4]
        if name in RAW:
            if not closing and not tag[0].endswith("/>") and name not in endless:
                end = _end_of(name, page, at)
                if end is None and name not in ENDED_BY:
                    endless.add(name)
                at = at if end is None else end
        elif name in INLINE:
            if name == "a":
                in_link = 0 if closing else 1
            elif name == "br":
                run.append(" ")
        elif closing:
            close({name})
            if name in ("nav", "p", "li", "article", "div"):
                in_link = 0
        else:
            flush()
            if name in CLOSES:
                close(*CLOSES[name])
            elif name not in VOID:
                close({"p"}, {"table", "td", "button", "object"})
            if name in VOID:
                continue
            hint = 0
            if tag[3] or tag[6]:
                marks = " ".join(x.strip("\"'") for x in NAMED.findall(tag[3] or tag[6]))
                hint = bool(GOOD.search(marks)) + 2 * bool(BAD.search(marks)) if marks else 0
            nodes.append((open_at[-1][1], GROUPS.get(name, OTHER_GROUP), hint, None, 0))
            places.setdefault(name, []).append(len(open_at))
            open_at.append((name, len(nodes) - 1))
    flush()
    return nodes


def _end_of(name: str, page: str, at: int) -> int | None:
    """Where an element of ``RAW`` that opened before ``at`` ends, null if it doesn't. An option without an end tag of its own
    is the text up to the next tag."""
    names = ENDED_BY.get(name, name)
    end = re.compile(rf"<(/?)({names})\b[^>]*>" if name in ENDED_BY else rf"<(/)({re.escape(name)})\b[^>]*>", re.I).search(page, at)
    if end and end[1] and end[2].lower() == name:
        return end.end()
    if name == "option" and (tag := TAG.search(page, at)):
        return tag.start()
    return len(page) if name in HIDING else None


def clean(text: str) -> str:
    return " ".join(html.unescape(text).split())


class Forest:
    """The trees of many pages in flat arrays."""

    def __init__(self, pages: list[str]):
        trees = [parse(x) for x in pages]
        counts = np.array([len(x) for x in trees], np.int64)
        first = np.repeat(np.cumsum(counts) - counts, counts)
        flat = [x for tree in trees for x in tree]
        self.page = np.repeat(np.arange(len(pages)), counts)
        parent = np.array([x[0] for x in flat], np.int64)
        self.parent = np.where(parent < 0, -1, parent + first)
        self.group = np.array([x[1] for x in flat], np.int64)
        self.hint = np.array([x[2] for x in flat], np.int64)
        self.texts = {i: clean(x[3]) for i, x in enumerate(flat) if x[3] is not None}
        self.length = np.zeros(len(flat), np.int64)
        self.stops = np.zeros(len(flat), np.int64)
        for i, t in self.texts.items():
            self.length[i] = len(t)
            self.stops[i] = t.count(".") + t.count("!") + t.count("?") + t.count("。")
        share = np.array([x[4] for x in flat], float) / np.maximum(1, np.array([len(x[3] or "") for x in flat]))
        self.features = np.stack(
            [self.group, self.hint, np.searchsorted(LENGTHS, self.length, side="right"), np.searchsorted(LINKS, share, side="right"), np.searchsorted(STOPS, self.stops, side="right")], axis=1
        )
        depth = np.zeros(len(flat), np.int64)
        for i, p in enumerate(self.parent.tolist()):
            if p >= 0:
                depth[i] = depth[p] + 1
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1) if len(flat) else []

    def labels(self) -> np.ndarray:
        """Labels by markup: 1 inside article or main but not inside navigation, headers, footers, asides or forms there;
        -1 on pages that mark no article up."""
        inside = np.zeros(len(self.parent), bool)
        for level in self.levels:
            up = self.parent[level]
            inside[level] = np.where(up >= 0, inside[up], False)
            inside[level] |= np.isin(self.group[level], list(LABELLED_IN))
            inside[level] &= ~(np.isin(self.group[level], list(LABELLED_OUT)) | (self.hint[level] >= 2))
        known = np.bincount(self.page, inside, minlength=self.page.max(initial=0) + 1) > 0
        return np.where(known[self.page], inside.astype(np.int64), -1)


class Potentials:
    """Log potentials: one table for each feature (value, state), one for parent and child state by the child's kind."""

    def __init__(self, counts: dict[tuple[str, int, int, int], float] | None = None):
        self.node = [np.ones((n, 2)) for n in SIZES]
        for (feature, value), (no, yes) in PRIOR.items():
            self.node[feature][value] += (no, yes)
        # Containers may begin or end what is content; paragraphs and texts almost always share their parent's state.
        self.edge = np.array([[[40.0, 10.0], [4.0, 40.0]], [[60.0, 2.0], [2.0, 60.0]], [[40.0, 1.0], [1.0, 40.0]]])
        self.root = np.array([50.0, 1.0])
        for (table, i, j, state), n in (counts or {}).items():
            if table == "node":
                self.node[i][j, state] += n
            elif table == "edge":
                self.edge[i, j, state] += n
        self.node = [np.log(x / x.sum(axis=0)) for x in self.node]
        self.edge = np.log(self.edge / self.edge.sum(axis=2, keepdims=True))
        self.root = np.log(self.root / self.root.sum())

    def marginals(self, forest: Forest) -> np.ndarray:
        """Probability of each node to be content: messages from the leaves up, then from the roots down."""
        own = sum(table[forest.features[:, i]] for i, table in enumerate(self.node))
        below = own.copy()
        up = np.zeros_like(own)
        kind = EDGE_KIND[forest.group]
        for level in forest.levels[:0:-1]:
            joint = self.edge[kind[level]] + below[level][:, None, :]
            up[level] = np.logaddexp(joint[:, :, 0], joint[:, :, 1])
            np.add.at(below, forest.parent[level], up[level])
        belief = below.copy()
        for n, level in enumerate(forest.levels):
            if not n:
                belief[level] += self.root
                continue
            rest = belief[forest.parent[level]] - up[level]
            joint = self.edge[kind[level]] + rest[:, :, None]
            belief[level] += np.logaddexp(joint[:, 0, :], joint[:, 1, :])
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -700, 700)))


def _counted(batches):
    """Sums over labelled pages; each is counted as it is and with its names and element kinds hidden, so
    that lengths, links and sentences carry weight of their own."""
    for batch in slices(batches, "html"):
        forest = Forest([x or "" for x in batch.column("html").to_pylist()])
        label = forest.labels()
        sums: dict[tuple[str, int, int, int], int] = {}
        known = np.flatnonzero(label >= 0)
        hidden = np.where(np.isin(forest.group, (0, 1, 2, TEXT_GROUP)), forest.group, OTHER_GROUP)
        for i in range(len(SIZES)):
            for values in (forest.features[:, i], hidden if i == 0 else np.zeros_like(hidden) if i == 1 else forest.features[:, i]):
                for state in (0, 1):
                    for j, n in enumerate(np.bincount(values[known][label[known] == state], minlength=SIZES[i]).tolist()):
                        sums["node", i, j, state] = sums.get(("node", i, j, state), 0) + n
        child = known[forest.parent[known] >= 0]
        kind = EDGE_KIND[forest.group[child]]
        for code, n in zip(*np.unique(kind * 4 + label[forest.parent[child]] * 2 + label[child], return_counts=True)):
            sums["edge", int(code) // 4, int(code) // 2 % 2, int(code) % 2] = int(n)
        keys = [k for k, n in sums.items() if n]
        yield pa.RecordBatch.from_pandas(pd.DataFrame([(*k, sums[k]) for k in keys], columns=["tab", "i", "j", "state", "n"]).astype({"i": "int32", "j": "int32", "state": "int32", "n": "int64"}), preserve_index=False)


def train(pages: DataFrame, training_pages: int = TRAINING_PAGES) -> Potentials:
    """Potentials from a sample of about ``training_pages`` pages whose markup says what their article is.

    The sums are taken on the executors; the driver gets one number for each table cell.
    """
    total = pages.count()
    share = 1.0 if total <= training_pages else training_pages / total
    sample = pages.where(F.pmod(F.xxhash64("page_id"), F.lit(1 << 20)) < int(share * (1 << 20))).select("html")
    sums = sample.mapInArrow(_counted, "tab string, i int, j int, state int, n long").groupBy("tab", "i", "j", "state").agg(F.sum("n").alias("n"))
    return Potentials({(r.tab, r.i, r.j, r.state): r.n for r in sums.collect()})


def extract(pages: DataFrame, model: Potentials, threshold: float = 0.5) -> DataFrame:
    """``(page_id, url, text, n_chars)``, a row per row of ``pages``: text nodes with a marginal of ``threshold`` or more.

    Blocks come in page order, joined by a newline; white space in a block becomes one space. A null, empty or textless page
    gives an empty text. Repeated pages and null ids pass through; other columns are ignored.
    """

    def run(batches):
        for batch in slices(batches, "html"):
            forest = Forest([x or "" for x in batch.column("html").to_pylist()])
            content = model.marginals(forest) >= threshold
            blocks: list[list[str]] = [[] for _ in range(batch.num_rows)]
            for i, t in forest.texts.items():
                if t and content[i]:
                    blocks[forest.page[i]].append(t)
            texts = ["\n".join(x) for x in blocks]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
            )

    fields = pages.select("page_id", "url", "html")
    kinds = dict(fields.dtypes)
    return fields.mapInArrow(run, f"page_id {kinds['page_id']}, url string, text string, n_chars long")


@query()
def op2_html_extraction(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return extract(pages, train(pages))
