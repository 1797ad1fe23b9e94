"""Main text of web pages by minimum cut.

Every block of text is a node. A linear classifier of its own features gives the cost of calling it content or boilerplate;
the costs are the capacities to the two terminals. Neighbours in page order and blocks that lie close in the
document tree are joined by edges, so that a labelling that parts them pays. The minimum cut is the cheapest
labelling; maximum flow finds it.
"""

from __future__ import annotations

import re
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedweave.llm.html_parts import Block, blocks

#: What elements and their class, id or role say about the text in them.
CONTENT_TAGS = frozenset("article main".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form header menu dialog fieldset figcaption button label head".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 li dd dt td th figcaption".split())
CONTENT_WORDS = re.compile(r"(?:^|[\s_-])(?:article|content|post|entry|story|main|body|text|articlebody)(?=$|[\s_-])")
BOILERPLATE_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|sidebar|side|foot\w*|header|masthead|"
    r"comments?|replies|reply|disqus|respond|discussion|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|"
    r"subscribe|subscription|signup|login|share|sharing|social|related|recommend\w*|more|popular|trending|widget|tags?|meta|pager|"
    r"pagination|copyright|legal|disclaimer|search|form|skip|toolbar|contentinfo|complementary|navigation)(?=$|[\s_-])")

#: Weights of the classifier: log-odds of content.
START = -0.5
IN_CONTENT, IN_BOILERPLATE, MARKED_CONTENT, MARKED_BOILERPLATE, HIDDEN = 4.0, -9.0, 1.5, -7.0, -12.0
PROSE_TAG, HEADING_TAG, WORDS, SENTENCE, LINKS = 1.0, 0.3, 0.35, 0.5, -3.5
#: Capacities of the smoothness edges: neighbours in page order, and more for each element they share.
NEXT, SAME_PARENT, NEAR = 0.25, 0.5, 0.15


#: An element with this share of a page's text, or with the second one and the page's article or first heading in it, is no
#: part of the page but its frame: what it is and is named then says nothing against the text in it.
FRAME, FRAME_OF_ARTICLE = 0.8, 0.5


def frames(found: list[Block]) -> set[int]:
    """Numbers of the elements that hold a page rather than a part of it."""
    chars: dict[int, int] = {}
    holders: set[int] = set()
    headed = False
    for block in found:
        for k, number in enumerate(block.numbers):
            chars[number] = chars.get(number, 0) + len(block.text)
            if block.names[k] in CONTENT_TAGS or block.names[k] == "h1" and not headed:
                holders.update(block.numbers[:k])
        headed |= "h1" in block.names
    every = sum(len(b.text) for b in found)
    return {n for n, c in chars.items() if c >= FRAME * every or n in holders and c >= FRAME_OF_ARTICLE * every}


def log_odds(block: Block, around: set[int] = frozenset()) -> float:
    """How much likelier a block is content than boilerplate, by what it is and stands in; ``around`` are frames."""
    out = START
    inside = False
    for name, marks, number in zip(block.names, block.marks, block.numbers):
        if number in around and name not in CONTENT_TAGS:
            continue
        content = name in CONTENT_TAGS
        if content:
            inside, out = True, out + IN_CONTENT
        elif name in BOILERPLATE_TAGS and not (name == "header" and inside and block.tag in HEADINGS) \
                and not (name == "figcaption"):
            out += IN_BOILERPLATE
        if marks:
            if BOILERPLATE_WORDS.search(marks) and name not in ("body", "html"):
                out += MARKED_BOILERPLATE
            elif CONTENT_WORDS.search(marks) and name not in ("body", "html"):
                out += MARKED_CONTENT
    words = block.text.count(" ") + 1
    out += WORDS * min(words, 20) ** 0.5
    out += PROSE_TAG * (block.tag in PROSE) + HEADING_TAG * (block.tag in HEADINGS)
    out += SENTENCE * (block.text[-1] in ".!?:;\"'»”…")
    out += LINKS * min(block.linked / max(len(block.text), 1), 1.0)
    return out + HIDDEN * block.hidden


def edges(found: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges: (block, later block, capacity)."""
    out = []
    last_of: dict[int, int] = {}
    for i, block in enumerate(found):
        parent = block.path[-2] if len(block.path) > 1 else 0
        if i:
            before = found[i - 1]
            shared = 0
            for x, y in zip(block.path, before.path):
                if x != y:
                    break
                shared += 1
            apart = len(block.path) + len(before.path) - 2 * shared
            out.append((i - 1, i, NEXT + (SAME_PARENT if apart <= 2 else NEAR / apart)))
        # The last block of the same parent, if others lie between.
        if parent in last_of and last_of[parent] != i - 1:
            out.append((last_of[parent], i, NEAR))
        last_of[parent] = i
    return out


def minimum_cut(gains: list[float], joined: list[tuple[int, int, float]]) -> list[bool]:
    """Nodes on the source side of the minimum cut; a node's gain is its capacity from the source or to the sink.

    Dinic's algorithm. What a node's two terminal edges share is left out from the start.
    """
    n = len(gains)
    source, sink = n, n + 1
    heads: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    left: list[float] = []

    def connect(a: int, b: int, there: float, back: float) -> None:
        heads[a].append(len(to))
        to.append(b)
        left.append(there)
        heads[b].append(len(to))
        to.append(a)
        left.append(back)

    for i, gain in enumerate(gains):
        if gain > 0:
            connect(source, i, gain, 0.0)
        elif gain < 0:
            connect(i, sink, -gain, 0.0)
    for a, b, capacity in joined:
        connect(a, b, capacity, capacity)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in heads[a]:
                if left[e] > 1e-12 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        turn = [0] * (n + 2)
        path: list[int] = []
        node = source
        while True:
            if node == sink:
                flow = min(left[e] for e in path)
                for k, e in enumerate(path):
                    left[e] -= flow
                    left[e ^ 1] += flow
                first = next(k for k, e in enumerate(path) if left[e] <= 1e-12)
                node = to[path[first] ^ 1]
                del path[first:]
                continue
            while turn[node] < len(heads[node]):
                e = heads[node][turn[node]]
                if left[e] > 1e-12 and level[to[e]] == level[node] + 1:
                    break
                turn[node] += 1
            else:
                if node == source:
                    break
                e = path.pop()
                node = to[e ^ 1]
                turn[node] += 1
                continue
            path.append(e)
            node = to[e]


def main_text(html: str | None) -> str:
    """The page's content blocks in page order, parted by an empty line; empty if there are none."""
    found = blocks(html) if html else []
    if not found:
        return ""
    around = frames(found)
    keep = minimum_cut([log_odds(b, around) for b in found], edges(found))
    return "\n\n".join(b.text for b, k in zip(found, keep) if k)


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` without ``html_col``, with the main text as ``text_col`` and its code points as ``n_chars``.

    A null or empty page, and one without content, gives an empty text; pages are taken whole and rows stay where they
    are. Other columns are kept, those named as the new ones are replaced. An empty table gives no rows.
    """
    kept = [c for c in pages.columns if c not in (html_col, text_col, "n_chars")]
    rows = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{html_col}`").cast("string"))
    fields = [f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in kept]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                texts = [main_text(x) for x in part.column(len(kept)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(kept)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=[*kept, text_col, "n_chars"])

    return rows.mapInArrow(run, ", ".join([*fields, f"`{text_col}` string", "n_chars long"]))
