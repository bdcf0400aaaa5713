"""HTML extraction: a linear-chain conditional random field over the DOM's leaf blocks, decoded by Viterbi.

A page is cut into blocks of text at block-level tags. Each block has binary features of its ancestors (tags, words of class and
id, tags nested in an article or main) and of its text (length, full stop, share inside links, cue words of short blocks). The
field has two labels, weights per feature and label, and weights per pair of neighbouring labels; it is trained by gradient steps
on the conditional likelihood of labelled pages (labelled_pages.py, a few hundred pages, on the driver) and sent to the tasks as
one small table. The weights of a block's ancestors are summed while the stack grows and shrinks, so a page costs time in
proportion to its length, however deep or broken it is.

Defined results: null, empty and text-less html give ''. Script, style, comments, head and template are no text. A script or style
that nothing ends runs to the next end tag; a template that nothing ends, only its tag is passed over; a comment that nothing ends
runs to the next '>'; head ends at its end tag or at the first tag that can't stand in it; title is silent before the body and
text within it. Text of svg, math, object, noscript and iframe is read like text around it. Tags that HTML doesn't name are
inline. A tag that nothing closes is text. Character references are decoded (once); white space within a block becomes one space;
br is white space; pages of any size are read whole; repeated rows give equal results; an empty table gives none; a column named
as the output is replaced.
"""

from __future__ import annotations

import html as entities
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from finloom.llm.common import small_batches
from finloom.llm.labelled_pages import CUES, labelled_pages

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
#: The rest of a tag; quotes count after an equals sign only.
REST = re.compile(r"""(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')|["'=])*+>""")
NAMES = re.compile(r"(?<![\w-])(?:class|id)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORD = re.compile(r"[a-z]+")
RAW = {"script", "style"}
SILENT = {"template", "head", "title"}
IN_HEAD = {"base", "basefont", "bgsound", "head", "html", "link", "meta", "noframes", "noscript", "script", "style", "template", "title"}
#: Elements that start and end a block of text; custom elements (with a hyphen) do as well.
BLOCKS = set(
    "address article aside audio blockquote body button canvas caption center col colgroup dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html iframe legend li main menu nav noframes ol optgroup "
    "option p pre search section select summary table tbody td textarea tfoot th thead tr ul video".split()
)
#: Inline elements that set words apart.
APART = {"br", "mtd", "mtr", "mlabeledtr", "annotation", "annotation-xml", "text", "tspan", "title", "desc", "rt", "rp"}
VOID = {"col", "hr"}
#: A start tag that closes an open one of these, within the nearest of SCOPES.
CLOSES = {"li": ("li",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "dt": ("dt", "dd"), "dd": ("dt", "dd")}
SCOPES = ("ul", "ol", "table", "article", "div", "section", "main", "body", "td", "dl", "select", "aside", "nav", "footer", "header", "form")
NESTED = {"header", "footer", "aside", "nav", "form", "section", "div"}
#: Cue words are looked for in blocks of up to so many words; longer ones are prose whatever they mention.
CUE_WORDS = 40


class Block:
    __slots__ = ("text", "features", "score")

    def __init__(self, text: str, features: list[str], score: tuple[float, float]):
        self.text, self.features, self.score = text, features, score


def text_features(text: str, linked: float) -> list[str]:
    """What a block's own text says; linked is the share of it inside links."""
    words = text.count(" ") + 1
    size = "words:60" if words > 60 else "words:25" if words > 24 else "words:9" if words > 8 else "words:4" if words > 3 else "words:1"
    found = ["bias", size]
    if text[-1] in ".!?…" or text[-1] in "\"'”»)" and text[-2:-1] in tuple(".!?…"):
        found.append("stop")
        found.append(f"stop+{size}")
    found.append("linked" if linked > 0.6 else "unlinked" if linked < 0.1 else "partly linked")
    if "©" in text:
        found.append("copyright sign")
    if words <= CUE_WORDS:
        found.extend(f"cue:{w}" for w in CUES.intersection(WORD.findall(text.lower())))
    return found


def tokens(page: str):
    """('text', string), ('start', tag, attributes) and ('end', tag) in page order, in time linear in the page's length."""
    at, size, last = 0, len(page), page.rfind(">")
    comments = plain = True
    ended = {tag: True for tag in RAW}
    plain = False
    while at < size:
        mark = page.find("<", at)
        if mark < 0 or mark > last:
            yield "text", page[at:], ""
            return
        if mark > at:
            yield "text", page[at:mark], ""
        following = page[mark + 1 : mark + 2]
        if following == "!" or following == "?":
            end = -1
            if comments and page.startswith("!--", mark + 1):
                end = page.find("-->", mark + 2)
                comments = end >= 0
                end += 2 if end >= 0 else 0
            at = (end if end >= 0 else page.find(">", mark)) + 1
            continue
        closing = following == "/"
        name = NAME.match(page, mark + 1 + closing)
        if not name:
            yield "text", "<", ""
            at = mark + 1
            continue
        rest = None if plain else REST.match(page, name.end())
        plain = rest is None
        at = rest.end() if rest else page.find(">", name.end()) + 1
        tag = name[0].lower()
        if closing:
            yield "end", tag, ""
            continue
        yield "start", tag, page[name.end() : at - 1]
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at) if ended[tag] else None
            ended[tag] = end is not None
            if end:
                at = page.find(">", end.end()) + 1 or size
            else:
                end = re.compile(r"(?=</[a-zA-Z])").search(page, at)
                at = end.end() if end else size


class _Frame:
    __slots__ = ("tag", "added", "score", "mark", "held")

    def __init__(self, tag: str, added: list[str], score: tuple[float, float], mark: int = -1, held=None):
        self.tag, self.added, self.score, self.mark, self.held = tag, added, score, mark, held


class _Builder:
    """Blocks from tokens; emission gives the weights of features, where blocks are to be scored."""

    def __init__(self, emission: dict[str, tuple[float, float]]):
        self.emission = emission
        self.out: list[Block | None] = []
        self.stack: list[_Frame] = []
        self.places: dict[str, list[int]] = {}
        self.active: dict[str, int] = {}
        self.parts: list[str] = []
        self.links = self.in_link = 0
        self.begun = False

    def weight(self, features: list[str], score: tuple[float, float]) -> tuple[float, float]:
        a, b = score
        for f in features:
            w = self.emission.get(f)
            if w:
                a, b = a + w[0], b + w[1]
        return a, b

    def block(self, parts: list[str], links: int, depth: int) -> Block | None:
        text = " ".join(entities.unescape("".join(parts)).split())
        if not text:
            return None
        leaf = self.stack[depth - 1] if depth else None
        own = [f"leaf:{leaf.tag if leaf else ''}", *text_features(text, links / max(1, sum(map(len, parts))))]
        features = [] if self.emission else sorted([*self.active, *own])
        return Block(text, features, self.weight(own, leaf.score if leaf else (0.0, 0.0)))

    def flush(self) -> None:
        if self.parts:
            made = self.block(self.parts, self.links, len(self.stack))
            if made:
                self.out.append(made)
            self.parts, self.links = [], 0

    def push(self, tag: str, attributes: str) -> None:
        named = {w for m in NAMES.finditer(attributes) for w in WORD.findall((m[1] or m[2] or m[3] or "").lower())}
        wanted = {f"in:{tag}", *(f"name:{w}" for w in named)}
        if tag in NESTED:
            wanted.update(f"{outer}+{tag}" for outer in ("article", "main") if self.places.get(outer))
        added = sorted(f for f in wanted if f not in self.active)
        score = self.weight(added, self.stack[-1].score if self.stack else (0.0, 0.0))
        for f in added:
            self.active[f] = 1
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append(_Frame(tag, added, score))

    def cut(self, depth: int, ended: bool = False) -> None:
        """Close the elements above depth; ended: the lowest of them by its own end tag, so that a silent one takes its text along."""
        while len(self.stack) > depth:
            frame = self.stack.pop()
            self.places[frame.tag].pop()
            for f in frame.added:
                del self.active[f]
            if frame.mark < 0:
                continue
            if ended and len(self.stack) == depth:
                del self.out[frame.mark :]
                self.parts, self.links = frame.held
            else:
                self.out[frame.mark] = self.block(*frame.held, len(self.stack))

    def nearest(self, tags) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def silence(self, tag: str) -> None:
        """Text from here on goes to blocks of its own, which the end tag throws away."""
        self.push(tag, "")
        self.stack[-1].mark, self.stack[-1].held = len(self.out), (self.parts, self.links)
        self.out.append(None)
        self.parts, self.links = [], 0

    def start(self, tag: str, attributes: str) -> None:
        if tag in RAW:
            return
        if tag not in IN_HEAD:
            if self.places.get("head"):
                self.cut(self.places["head"][-1], ended=True)
            self.begun = True
        if tag == "template" or (tag in SILENT and not self.begun):
            if tag != "head" or not self.places.get("head"):
                self.silence(tag)
            return
        if tag == "a":
            self.in_link += 1
        if tag not in BLOCKS and "-" not in tag:
            if tag in APART:
                self.parts.append(" ")
            return
        self.flush()
        if tag in VOID:
            return
        scope = self.nearest(SCOPES)
        open_at = max(self.nearest(CLOSES.get(tag, ())), self.nearest(("p",)))
        if open_at > scope or open_at >= 0 and self.stack[open_at].tag == tag and open_at == scope:
            self.cut(open_at)
        self.push(tag, attributes)

    def end(self, tag: str) -> None:
        if tag == "a":
            self.in_link = max(0, self.in_link - 1)
        open_at = self.nearest((tag,))
        if open_at >= 0 and self.stack[open_at].mark >= 0:
            self.cut(open_at, ended=True)
        elif tag in BLOCKS or "-" in tag:
            self.flush()
            if open_at >= 0:
                self.cut(open_at)
                self.in_link = 0
        elif tag in APART:
            self.parts.append(" ")

    def finish(self) -> list[Block]:
        self.flush()
        self.cut(0)
        return [b for b in self.out if b]


def blocks(page: str | None, emission: dict[str, tuple[float, float]] | None = None) -> list[Block]:
    """The blocks of a page that have text, in page order: with their features, or scored where emission gives weights."""
    made = _Builder(emission or {})
    for kind, value, attributes in tokens(page or ""):
        if kind == "text":
            made.parts.append(value)
            made.links += len(value) * (made.in_link > 0)
        elif kind == "start":
            made.start(value, attributes)
        else:
            made.end(value)
    return made.finish()


class Crf:
    """Two labels; emission[feature] = (score of 0, score of 1); moves[i][j] = score of label j after i."""

    def __init__(self, emission: dict[str, tuple[float, float]], moves: list[list[float]]):
        self.emission, self.moves = emission, moves

    def decode(self, sequence: list[list[str]]) -> list[int]:
        """The best labels of blocks given by their features."""
        weights = [[self.emission.get(f, (0.0, 0.0)) for f in features] for features in sequence]
        return self.best([(sum(w[0] for w in ws), sum(w[1] for w in ws)) for ws in weights])

    def best(self, scores: list[tuple[float, float]]) -> list[int]:
        """Viterbi over the scores of each block's two labels."""
        if not scores:
            return []
        a, b = self.moves
        back: list[tuple[int, int]] = []
        best0, best1 = scores[0]
        for e0, e1 in scores[1:]:
            from0, from1 = (best0 + a[0], best1 + b[0]), (best0 + a[1], best1 + b[1])
            back.append((int(from0[1] > from0[0]), int(from1[1] > from1[0])))
            best0, best1 = max(from0) + e0, max(from1) + e1
        label = int(best1 > best0)
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]


def train(pages: list[tuple[str, list[int]]], steps: int = 200, ridge: float = 0.05) -> Crf:
    """Maximise the conditional log-likelihood of the labels by Adam steps over all pages at once."""
    sequences = [([b.features for b in blocks(page)], labels) for page, labels in pages]
    sequences = [(s, y) for s, y in sequences if s and len(s) == len(y)]
    index: dict[str, int] = {}
    for s, _ in sequences:
        for features in s:
            for f in features:
                index.setdefault(f, len(index))
    count, longest, n = len(sequences), max(len(s) for s, _ in sequences), len(index)
    # One entry per feature of a block: its number and the block's cell in a table of pages by positions.
    ids = np.array([index[f] for s, _ in sequences for fs in s for f in fs])
    cells = np.array([p * longest + t for p, (s, _) in enumerate(sequences) for t, fs in enumerate(s) for _ in fs])
    truth, there = np.zeros((count, longest), int), np.zeros((count, longest), bool)
    for p, (_, labels) in enumerate(sequences):
        truth[p, : len(labels)], there[p, : len(labels)] = labels, True
    observed = np.zeros((2, 2))
    pairs = there[:, 1:]
    np.add.at(observed, (truth[:, :-1][pairs], truth[:, 1:][pairs]), 1)
    w = np.zeros(2 * n + 4)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        emission, moves = w[: 2 * n].reshape(n, 2), w[2 * n :].reshape(2, 2)
        score = np.stack([np.bincount(cells, emission[ids, y], count * longest).reshape(count, longest) for y in (0, 1)], axis=2)
        fwd, bwd = np.zeros((count, longest, 2)), np.zeros((count, longest, 2))
        fwd[:, 0] = score[:, 0]
        for t in range(1, longest):
            go = score[:, t] + np.logaddexp(fwd[:, t - 1, :1] + moves[0], fwd[:, t - 1, 1:] + moves[1])
            fwd[:, t] = np.where(there[:, t, None], go, fwd[:, t - 1])
        for t in range(longest - 2, -1, -1):
            after = score[:, t + 1] + bwd[:, t + 1]
            go = np.logaddexp(moves[:, 0] + after[:, :1], moves[:, 1] + after[:, 1:])
            bwd[:, t] = np.where(there[:, t + 1, None], go, 0.0)
        total = np.logaddexp(fwd[:, -1, 0], fwd[:, -1, 1])
        marginal = np.where(there[:, :, None], np.exp(fwd + bwd - total[:, None, None]), 0.0)
        miss = np.stack([(truth == y) & there for y in (0, 1)], axis=2) - marginal
        grad_e = np.stack([np.bincount(ids, miss[:, :, y].ravel()[cells], n) for y in (0, 1)], axis=1)
        both = fwd[:, :-1, :, None] + moves + (score + bwd)[:, 1:, None, :] - total[:, None, None, None]
        grad_m = observed - np.where(pairs[:, :, None, None], np.exp(both), 0.0).sum(axis=(0, 1))
        grad = np.concatenate([grad_e.ravel(), grad_m.ravel()]) - ridge * w
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        w = w + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    emission = w[: 2 * n].reshape(n, 2)
    return Crf({f: (float(emission[i, 0]), float(emission[i, 1])) for f, i in index.items()}, w[2 * n :].reshape(2, 2).tolist())


@lru_cache(maxsize=1)
def default_model() -> Crf:
    return train(labelled_pages())


def main_text(page: str | None, model: Crf) -> str:
    found = blocks(page, model.emission)
    return "\n".join(b.text for b, keep in zip(found, model.best([b.score for b in found])) if keep)


def extract(pages: DataFrame, model: Crf | None = None, html: str = "html", text: str = "text") -> DataFrame:
    """pages with the main text of each."""
    small_batches(pages.sparkSession)
    model = model or default_model()

    @arrow_udf("string")
    def extracted(column: pa.Array) -> pa.Array:
        return pa.array((main_text(x.as_py(), model) for x in column), pa.string())

    return pages.withColumn(text, extracted(F.col(html)))


#: For pages whose article stands in one <article> without other elements than h1, p, b and br.
ORACLE_SQL = r"""
with a as (select page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) as body from pages),
b as (select page_id, url, string_split(regexp_replace(replace(body, '<br>', ' '), '</?(h1|p)>', chr(1), 'g'), chr(1)) as parts from a),
c as (
    select page_id, url, list_transform(parts, lambda x: regexp_replace(x, '<[^>]*>', '', 'g')) as bare from b
), d as (
    select page_id, url, list_transform(bare, lambda x: regexp_replace(regexp_replace(regexp_replace(x, '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g')) as plain from c
), e as (
    select page_id, url, list_filter(list_transform(plain, lambda x: trim(regexp_replace(regexp_replace(regexp_replace(x, '&#(x27|39);', chr(39), 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))), lambda x: x <> '') as kept from d
)
select page_id, url, coalesce(array_to_string(kept, chr(10)), '') as text, length(coalesce(array_to_string(kept, chr(10)), '')) as n_chars from e
"""
