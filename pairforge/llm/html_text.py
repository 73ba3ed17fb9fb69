"""Main text of web pages by a linear-chain CRF over their leaf blocks.

A page is cut into blocks of text at block elements.  A block's features are
the tags above it, the groups its ancestors belong to (content containers,
boilerplate by tag or by class and id words), and properties of its text.  A
two-label chain is trained on labelled pages and decoded by Viterbi; the
blocks labelled as content are the main text.

Labelled pages are those with a content container (``article``, ``main``):
their blocks inside it and not in boilerplate are content.  Half of them are
shown to the trainer without the container's features, so that the model also
reads pages that have none.  Training takes at most ``sample`` pages (those
with the smallest hash of page_id); every page is decoded.

Defined cases: null or empty html gives an empty text; a row without page_id
is left out; without labelled pages every block outside boilerplate is
content; repeated rows each get their row; no rows: an empty result.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: labelled pages that training takes at most
SAMPLE = 400
#: blocks that training takes from a page, beginning so many before its container
TRAIN_BLOCKS, TRAIN_LEAD = 200, 40
STEPS = 80
RATE = 0.2
RIDGE = 1e-3

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)
      | <(?P<raw>script|style|noscript|template|svg|iframe)\b(?:[^>"']++|"[^"]*+"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)
      | <(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
      | <[!?/][^>]*> | <[a-zA-Z][^>]*(?:>|\Z) | [^<]+ | <""", re.S | re.I | re.X)
_NAMED = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")

# fixed values: element names by kind
_BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup
    option p pre search section select summary table tbody td textarea tfoot th thead title tr ul""".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ENDS_PARAGRAPH = _BLOCK - {"button", "option", "optgroup", "td", "th", "tr", "title"}
_SAME = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
         "th": {"td", "th"}, "option": {"option"}}
_SCOPE = frozenset("article aside body div footer form header html main nav ol section table td ul".split())
_CONTENT = frozenset("article main".split())
_BOILER = frozenset("aside button dialog fieldset footer form head menu nav search select textarea title".split())
# fixed values: class and id words of boilerplate
_BOILER_WORDS = frozenset("""ad ads advert advertisement adverts aside banner breadcrumb breadcrumbs comment comments
    consent cookie cookies copyright discussion disclaimer footer form header login masthead menu modal nav navbar
    navigation newsletter notice notices pagination popup promo promotion recommended related reply respond search
    share sharing sidebar signup social sponsor sponsored subscribe toolbar widget""".split())
_CONTENT_WORDS = frozenset("article articlebody content entry main post story".split())


def _kinds(tag: str, attrs: str) -> tuple[str, bool, bool]:
    """(tag, content container, boilerplate)."""
    words: set[str] = set()
    if "=" in attrs:
        for m in _NAMED.finditer(attrs):
            words.update(_WORD.findall((m[2] or m[3] or m[4] or "").lower()))
    boiler = tag in _BOILER or bool(words & _BOILER_WORDS) and tag not in ("html", "body")
    return tag, tag in _CONTENT or (not boiler and bool(words & _CONTENT_WORDS) and tag in ("div", "section")), boiler


class Block:
    __slots__ = ("text", "path", "link_chars")

    def __init__(self, text: str, path: tuple, link_chars: int):
        self.text, self.path, self.link_chars = text, path, link_chars


def leaf_blocks(html: str) -> list[Block]:
    """The page's text blocks in order, each with its open elements."""
    blocks: list[Block] = []
    stack: list[tuple[str, bool, bool]] = []
    parts: list[str] = []
    links = [0, 0]  # open anchors, characters inside them

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                blocks.append(Block(text, tuple(stack), links[1]))
            parts.clear()
        links[1] = 0

    def pop_to(names, stop) -> None:
        for i in range(len(stack) - 1, -1, -1):
            name = stack[i][0]
            if name in names:
                links[0] -= sum(x[0] == "a" for x in stack[i:])
                del stack[i:]
                return
            if name in stop:
                return

    for m in _TOKEN.finditer(html):
        tag = m["tag"]
        if tag is None:
            token = m[0]
            if m["raw"] is None and (token[0] != "<" or token == "<"):
                token = unescape(token) if "&" in token else token
                parts.append(token)
                if links[0] > 0:
                    links[1] += len(token)
            continue
        tag = tag.lower()
        if m["close"]:
            if tag in _BLOCK:
                flush()
                pop_to((tag,), ())
            else:
                pop_to((tag,), _BLOCK)
            continue
        if tag in _BLOCK:
            flush()
            if tag in _ENDS_PARAGRAPH:
                pop_to(("p",), _SCOPE)
            if tag in _SAME:
                pop_to(_SAME[tag], _SCOPE - _SAME[tag] if tag in ("li", "dd", "dt", "option") else ("table",))
        elif tag == "br":
            parts.append(" ")
        if tag not in _VOID and not m["attrs"].endswith("/"):
            stack.append(_kinds(tag, m["attrs"]))
            links[0] += tag == "a"
    flush()
    return blocks


def _region(path: tuple) -> tuple[bool, bool]:
    """(in a content container, in boilerplate); a header inside a container is its title."""
    content = boiler = False
    for tag, holds, hides in path:
        content |= holds
        boiler |= hides or (tag == "header" and not content)
    return content, boiler


def block_features(block: Block, place: int, total: int, held: bool) -> list[str]:
    """``held``: the page has a content container."""
    text, path = block.text, block.path
    content, boiler = _region(path)
    size = len(text)
    nearest = next((t for t, _, _ in reversed(path) if t in _BLOCK), "none")
    linked = min(4, 4 * block.link_chars // size)
    found = ["bias", f"near={nearest}", f"size={min(size.bit_length(), 11)}", f"links={linked}",
             f"end={text[-1] if text[-1] in '.!?:,;|' else 'x'}", f"depth={min(len(path), 8)}",
             f"at={4 * place // total}", f"words={min(text.count(' ').bit_length(), 8)}"]
    found += [f"above={t}" for t in {t for t, _, _ in path}]
    if content:
        found.append("content")
    if boiler:
        found.append("boiler")
    if "©" in text:
        found.append("sign=copyright")
    if not content and not boiler:
        found.append("outside" if held else "plain")
    return found


def page_features(blocks: list[Block]) -> list[list[str]]:
    held = any(_region(b.path)[0] for b in blocks)
    return [block_features(b, i, len(blocks), held) for i, b in enumerate(blocks)]


def without_container(features: list[str]) -> list[str]:
    """A block's features as if its page had no content container."""
    kept = [f for f in features if f not in _CONTAINER]
    return kept if "boiler" in kept else [*kept, "plain"]


def page_labels(blocks: list[Block]) -> list[int] | None:
    """Labels of a page with a content container, else None."""
    regions = [_region(b.path) for b in blocks]
    if not any(content for content, _ in regions):
        return None
    return [int(content and not boiler) for content, boiler in regions]


class ChainModel:
    """Two-label chain: a weight per feature for content, start and transition scores."""

    def __init__(self, weights: dict[str, float], start: float, moves: list[list[float]]):
        self.weights, self.start, self.moves = weights, start, moves

    def decode(self, rows: list[list[str]]) -> list[int]:
        """Viterbi path; ties go to content."""
        if not rows:
            return []
        get, back = self.weights.get, []
        (m00, m01), (m10, m11) = self.moves
        zero, one = 0.0, self.start + sum(get(f, 0.0) for f in rows[0])
        for row in rows[1:]:
            gain = sum(get(f, 0.0) for f in row)
            from0 = 0 if zero + m00 > one + m10 else 1
            from1 = 0 if zero + m01 > one + m11 else 1
            back.append((from0, from1))
            zero, one = (zero + m00 if from0 == 0 else one + m10), (zero + m01 if from1 == 0 else one + m11) + gain
        label = int(one >= zero)
        path = [label]
        for pair in reversed(back):
            label = pair[label]
            path.append(label)
        return path[::-1]


#: without labelled pages
DEFAULT = ChainModel({"bias": 1.0, "boiler": -10.0}, 0.0, [[0.0, 0.0], [0.0, 0.0]])


def train_chain(pages: list[tuple[list[list[str]], list[int]]], steps: int = STEPS) -> ChainModel:
    """Maximum-likelihood training (forward-backward, Adam, ridge)."""
    names = {f: i + 1 for i, f in enumerate(sorted({f for rows, _ in pages for r in rows for f in r}))}
    n, length = len(pages), max(len(rows) for rows, _ in pages)
    width = max(len(r) for rows, _ in pages for r in rows)
    grid = np.zeros((n, length, width), dtype=np.int32)
    gold = np.zeros((n, length), dtype=np.int64)
    alive = np.zeros((n, length), dtype=bool)
    for i, (rows, labels) in enumerate(pages):
        gold[i, :len(labels)] = labels
        alive[i, :len(labels)] = True
        for j, r in enumerate(rows):
            grid[i, j, :len(r)] = [names[f] for f in r]
    theta = np.zeros(len(names) + 1 + 5)  # feature weights (0: padding), start, four moves
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    size = len(names) + 1
    pairs = gold[:, :-1] * 2 + gold[:, 1:]
    both = alive[:, 1:]
    seen = np.concatenate([np.zeros(size), [gold[:, 0].sum()], np.bincount(pairs[both], minlength=4)])
    seen[:size] = np.bincount(grid.ravel(), weights=np.repeat((gold * alive).ravel(), width), minlength=size)
    for step in range(1, steps + 1):
        theta[0] = 0.0
        gain = theta[grid].sum(axis=2)
        emit = np.stack([np.zeros_like(gain), gain], axis=2)
        moves = theta[size + 1:].reshape(2, 2)
        forward = np.empty((length, n, 2))
        forward[0] = emit[:, 0] + [0.0, theta[size]]
        for t in range(1, length):
            forward[t] = np.logaddexp(forward[t - 1][:, :1] + moves[0], forward[t - 1][:, 1:] + moves[1]) + emit[:, t]
            forward[t] = np.where(alive[:, t, None], forward[t], forward[t - 1])
        total = np.logaddexp(forward[-1][:, 0], forward[-1][:, 1])
        backward = np.zeros((n, 2))
        expected = np.zeros_like(theta)
        chance = np.empty((n, length))
        for t in range(length - 1, -1, -1):
            chance[:, t] = np.exp(forward[t][:, 1] + backward[:, 1] - total) * alive[:, t]
            if t:
                ahead = emit[:, t] + backward
                joint = np.exp(forward[t - 1][:, :, None] + moves + ahead[:, None, :] - total[:, None, None])
                expected[size + 1:] += (joint * alive[:, t, None, None]).sum(axis=0).ravel()
                new = np.logaddexp(moves[:, 0] + ahead[:, :1], moves[:, 1] + ahead[:, 1:])
                backward = np.where(alive[:, t, None], new, backward)
        expected[size] = chance[:, 0].sum()
        expected[:size] = np.bincount(grid.ravel(), weights=np.repeat(chance.ravel(), width), minlength=size)
        slope = (seen - expected) / n - RIDGE * theta
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope * slope
        theta += RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return ChainModel({f: float(theta[i]) for f, i in names.items()}, float(theta[size]),
                      theta[size + 1:].reshape(2, 2).tolist())


def _teach(batches):
    for batch in batches:
        rows = []
        for page_id, html in zip(batch.column("page_id").to_pylist(), batch.column("html").to_pylist(), strict=True):
            blocks = leaf_blocks(html or "")  # the whole page; a long one teaches by a window
            labels = page_labels(blocks)
            if labels:
                start = max(0, labels.index(1) - TRAIN_LEAD) if 1 in labels else 0
                window = slice(start, start + TRAIN_BLOCKS)
                rows.append({"page_id": page_id, "labels": labels[window],
                             "features": page_features(blocks)[window]})
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
            ("page_id", pa.int64()), ("labels", pa.list_(pa.int32())),
            ("features", pa.list_(pa.list_(pa.string())))]))


_CONTAINER = {"content", "outside", *(f"above={t}" for t in _CONTENT)}


def _with_container(batches):
    for batch in batches:
        yield batch.filter(pa.array([page_labels(leaf_blocks(html or "")) is not None
                                     for html in batch.column("html").to_pylist()], pa.bool_()))


def learn(pages: DataFrame, sample: int = SAMPLE) -> ChainModel:
    """A chain taught by the ``sample`` pages with a content container whose ids have the smallest
    hashes (all of them, if there are fewer); without any, the fixed one."""
    def taught_by(some: DataFrame) -> list:
        drawn = some.orderBy(F.xxhash64("page_id"), "page_id").limit(sample)
        return drawn.mapInArrow(_teach, "page_id bigint, labels array<int>, features array<array<string>>").collect()
    rows = taught_by(pages)
    if len(rows) < sample:  # some of the pages drawn have no container: draw among those that have one
        rows = taught_by(pages.mapInArrow(_with_container, pages.schema))
    rows.sort(key=lambda r: (r["page_id"], r["labels"]))
    taught = []
    for k, r in enumerate(rows):
        features = r["features"] if k % 2 else [without_container(f) for f in r["features"]]
        taught.append((features, r["labels"]))
    return train_chain(taught) if taught else DEFAULT


def _extractor(model: ChainModel):
    def extract(batches):
        for batch in batches:
            texts = []
            for html in batch.column("html").to_pylist():
                blocks = leaf_blocks(html or "")
                labels = model.decode(page_features(blocks))
                texts.append("\n".join(b.text for b, keep in zip(blocks, labels, strict=True) if keep))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
    return extract


def main_text(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    rows = pages.where("page_id is not null").select(F.col("page_id").cast("bigint"), "url", "html")
    return rows.mapInArrow(_extractor(learn(rows, sample)), "page_id bigint, url string, text string, n_chars bigint")
