"""Main text of HTML pages by a linear-chain conditional random field over leaf blocks.

A page is the sequence of its leaf blocks. A block's label (main text or not) is scored by its features,
the tags and class names of its ancestors and the shape of its text, and by the label before it. Training
maximises the conditional log-likelihood of labelled pages (forward-backward, L2 penalty); Viterbi
finds the best labels of a page. The blocks labelled main, joined in page order, are the text.

The model is fitted on ``n`` made pages (``labelled_pages``), a documented bound; what goes to the
tasks is one weight per feature. Pages are extracted row by row, whole, with no shuffle.

Edge cases: a null or empty page, and one without blocks, has the empty text; unclosed elements
and comments end where a browser would end them or with the page; repeated rows are rows; an
empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .html_blocks import KEPT_NODES, Block, Node, leaf_blocks
from .labelled_pages import labelled_pages


#: Elements that say what a part of a page is for.
LANDMARKS = set("article main nav header aside footer form section head dialog table".split())


def _of(node: Node, above: tuple[tuple[str, ...], str]) -> tuple[tuple[str, ...], str]:
    """The nearest names, and what holds the text, given those of the element around."""
    return node.parts or above[0], node.tag if node.parts or node.tag in LANDMARKS else above[1]


def path_features(path: Node | None) -> list[str]:
    """Tags and names of all elements around a block, once each, and what is special of the nearest."""
    chain = []
    node = path
    while node is not None:
        chain.append(node)
        node = node.parent
    out, near = {"bias"}, ((), "none")
    for node in reversed(chain):
        out.update(node.new)
        near = _of(node, near)
    return sorted(out.union(_own(path, near)))


@lru_cache(maxsize=1 << 14)
def _named_own(tag: str | None, near: tuple[tuple[str, ...], str]) -> tuple[str, ...]:
    parent = () if tag is None else (f"parent {tag}",)
    return (f"held by {near[1]}", *(f"nearest {p}" for p in near[0]), *parent)


def _own(path: Node | None, near: tuple[tuple[str, ...], str]) -> tuple[str, ...]:
    return _named_own(None if path is None else path.tag, near)


def _step(x: float, *edges: float) -> int:
    return sum(x >= e for e in edges)


def text_features(block: Block) -> list[str]:
    text = block.text
    n = len(text)
    return [
        f"words {_step(text.count(' ') + 1, 2, 5, 10, 20, 40, 80)}",
        f"linked {_step(block.linked / n, 0.1, 0.5, 0.9)}",
        f"ends {text[-1] in '.!?'}",
        f"commas {_step(text.count(','), 1, 3)}",
        f"copyright {'©' in text}",
    ]


@dataclass
class Crf:
    weight: dict[str, float]  # score of label 1; label 0 scores 0
    start: tuple[float, float]
    move: tuple[tuple[float, float], tuple[float, float]]
    _known: dict = field(default_factory=dict, repr=False, compare=False)  # scores of paths

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_known": {}}  # tasks begin with a table of their own

    def _path_score(self, path: Node | None, known: dict) -> float:
        """A path's score is that of the path around plus what its last element adds; ``known`` keeps both."""
        chain = []
        node = path
        while node is not None and node not in known:
            chain.append(node)
            node = node.parent
        at, near, _ = known.get(node) or (self.weight.get("bias", 0.0), ((), "none"), None)
        for node in reversed(chain):
            at += sum(self.weight.get(f, 0.0) for f in node.new)
            near = _of(node, near)
            known[node] = (at, near, None)
        if known.setdefault(path, (at, near, None))[2] is None:
            own = sum(self.weight.get(f, 0.0) for f in _own(path, near))
            known[path] = (at, near, at + own)
        return known[path][2]

    def _score(self, block: Block, known: dict | None = None) -> float:
        text = sum(self.weight.get(f, 0.0) for f in text_features(block))
        return self._path_score(block.path, {} if known is None else known) + text

    def decode(self, blocks: list[Block]) -> list[int]:
        """The best labels, by Viterbi."""
        if not blocks:
            return []
        (m00, m01), (m10, m11) = self.move
        known = self._known
        if len(known) > 2 * KEPT_NODES:
            known.clear()
        best0, best1 = self.start[0], self.start[1] + self._score(blocks[0], known)
        back: list[tuple[int, int]] = []
        for block in blocks[1:]:
            s = self._score(block, known)
            a, b = best0 + m00, best1 + m10
            c, d = best0 + m01, best1 + m11
            back.append((int(b > a), int(d > c)))
            best0, best1 = max(a, b), max(c, d) + s
        label = int(best1 > best0)
        out = [label]
        for pair in reversed(back):
            label = pair[label]
            out.append(label)
        return out[::-1]

    def main_text(self, page: str | None) -> str:
        blocks = leaf_blocks(page or "")
        return " ".join(b.text for b, y in zip(blocks, self.decode(blocks)) if y)


def fit(
    pages: list[tuple[str, list[int]]], rounds: int = 150, penalty: float = 0.002, rate: float = 0.3
) -> Crf:
    """Weights by gradient ascent (Adam steps) on the penalised conditional log-likelihood."""
    names: dict[str, int] = {}
    sequences = []
    for page, labels in pages:
        blocks = leaf_blocks(page)
        if len(blocks) != len(labels):
            raise ValueError("a labelled page needs a label for each of its blocks")
        if blocks:
            rows = [
                [names.setdefault(f, len(names)) for f in path_features(b.path) + text_features(b)]
                for b in blocks
            ]
            sequences.append((rows, labels))
    n, longest = len(sequences), max(len(y) for _, y in sequences)
    inside = np.zeros((n, longest), bool)
    truth = np.zeros((n, longest), int)
    at, feature = [], []
    for i, (rows, labels) in enumerate(sequences):
        inside[i, : len(labels)] = True
        truth[i, : len(labels)] = labels
        for t, row in enumerate(rows):
            at += [i * longest + t] * len(row)
            feature += row
    at, feature = np.array(at), np.array(feature)
    k = len(names)
    follows = inside[:, 1:]
    seen = np.zeros(k + 6)
    seen[:k] = np.bincount(feature, truth.ravel()[at], k)
    seen[k : k + 2] = np.bincount(truth[:, 0], minlength=2)
    pairs = (2 * truth[:, :-1] + truth[:, 1:])[follows]
    seen[k + 2 :] = np.bincount(pairs, minlength=4)

    def expected(w: np.ndarray) -> np.ndarray:
        score = np.zeros((n, longest, 2))
        score[:, :, 1] = np.bincount(at, w[feature], n * longest).reshape(n, longest)
        move = w[k + 2 :].reshape(2, 2)
        fore, aft = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        fore[:, 0] = score[:, 0] + w[k : k + 2]
        for t in range(1, longest):
            step = np.logaddexp.reduce(fore[:, t - 1, :, None] + move, axis=1) + score[:, t]
            fore[:, t] = np.where(inside[:, t, None], step, fore[:, t - 1])
        whole = np.logaddexp(fore[:, -1, 0], fore[:, -1, 1])
        for t in range(longest - 2, -1, -1):
            step = np.logaddexp.reduce(move + (score[:, t + 1] + aft[:, t + 1])[:, None], axis=2)
            aft[:, t] = np.where(inside[:, t + 1, None], step, aft[:, t + 1])
        node = np.exp(fore + aft - whole[:, None, None])
        edge = np.exp(
            fore[:, :-1, :, None]
            + move
            + (score[:, 1:] + aft[:, 1:])[:, :, None]
            - whole[:, None, None, None]
        )
        out = np.zeros(k + 6)
        out[:k] = np.bincount(feature, (node[:, :, 1] * inside).ravel()[at], k)
        out[k : k + 2] = node[:, 0].sum(axis=0)
        out[k + 2 :] = (edge * follows[:, :, None, None]).sum(axis=(0, 1)).ravel()
        return out

    w, first, second = (np.zeros(k + 6) for _ in range(3))
    for i in range(1, rounds + 1):
        slope = seen - expected(w) - penalty * n * 0.1 * w
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        w += rate * (first / (1 - 0.9**i)) / (np.sqrt(second / (1 - 0.99**i)) + 1e-8) * 0.5
    move = w[k + 2 :].reshape(2, 2)
    return Crf(
        {f: float(w[i]) for f, i in names.items()},
        (float(w[k]), float(w[k + 1])),
        tuple(tuple(map(float, r)) for r in move),  # type: ignore[arg-type]
    )


def trained(n: int = 1200, seed: int = 7) -> Crf:
    """A model fitted on ``n`` labelled pages."""
    return fit(labelled_pages(n, seed))


def extract(
    pages: DataFrame, model: Crf, id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """(page_id, url, text, n_chars) of each page."""
    rows = pages.select(F.col(id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    schema = rows.drop("html").withColumns({"text": F.lit(""), "n_chars": F.lit(0).cast("long")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [model.main_text(x.as_py()) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    b.column(1),
                    pa.array(texts, pa.string()),
                    pa.array(map(len, texts), pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    return rows.mapInArrow(run, schema)
