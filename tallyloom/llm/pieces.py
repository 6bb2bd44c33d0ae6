"""Encoding of many texts by the tokenizers library, each distinct piece once.

A byte-level tokenizer cuts a text by its pattern and merges within each piece, so ids of the pieces, one
after the other, are the ids of the text. Here all bytes of a portion of texts are cut at once by array
operations, at places where the pattern certainly cuts:

* before white space that follows a letter, digit or sign;
* before the last white space of some, where a character follows that is none, and after it unless it is
  a blank, which belongs to what follows;
* between ASCII letters, digits and signs, but not after an apostrophe, which may begin a contraction.

Elsewhere, as beside characters beyond ASCII, nothing is cut and the library cuts the longer stretch itself.
Stretches of up to 15 bytes are told apart by their bytes as whole numbers, others by a table. Only stretches
that a task does not know yet go to the library. Texts that hold a special token's name, and tokenizers of
other kinds, are left to the library whole.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
from tokenizers import Tokenizer

#: Stretches that a task knows at most from one portion to the next; then it begins anew.
KEPT = 1 << 20
#: Stretches that go to the library as one text.
TOGETHER = 1000
#: Bytes of longer stretches, and ids of all, that are kept likewise.
KEPT_BYTES, KEPT_IDS = 16 << 20, 16 << 20
BLANK = 32
PLAIN = re.compile(r" ?\S+").fullmatch

# Kinds of bytes: letter, digit, other ASCII sign, blank, other white space, beyond ASCII and not
# white space, beyond ASCII.
LETTER, DIGIT, SIGN, SPACE, WHITE, SOLID, UNKNOWN = range(7)


def _kinds() -> np.ndarray:
    kind = np.full(256, UNKNOWN, np.uint8)
    kind[:128] = SIGN
    for a, b, k in (("A", "Z", LETTER), ("a", "z", LETTER), ("0", "9", DIGIT)):
        kind[ord(a) : ord(b) + 1] = k
    kind[[9, 10, 11, 12, 13]] = WHITE
    kind[BLANK] = SPACE
    # First bytes of characters of which none is white space: U+00C0 to U+0FFF and from U+4000 on.
    kind[0xC3:0xE1] = SOLID
    kind[0xE4:0xF5] = SOLID
    return kind


KIND = _kinds()


def _cut_table() -> np.ndarray:
    """[kind before, kind, kind after]: whether the pattern certainly cuts before the middle byte."""
    cut = np.zeros((7, 7, 7), bool)
    plain = [LETTER, DIGIT, SIGN]
    for a in plain:
        cut[a, [SPACE, WHITE], :] = True
        for b in plain:
            cut[a, b, :] = a != b
    for after in [*plain, SOLID]:
        cut[:, [SPACE, WHITE], after] = True
        cut[WHITE, after, :] = True
    return cut


CUT = _cut_table().reshape(-1)


def cuts(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Where stretches begin in the bytes of texts, whose edges are 0 and the ends of all."""
    kind = KIND[data]
    before, after = np.empty_like(kind), np.empty_like(kind)
    before[1:], before[:1] = kind[:-1], UNKNOWN
    after[:-1] = kind[1:]
    after[edges[edges > 0] - 1] = UNKNOWN
    code = before.astype(np.uint16)
    code *= 7
    code += kind
    code *= 7
    code += after
    cut = CUT[code]
    apostrophe = np.flatnonzero(data == ord("'")) + 1
    cut[apostrophe[apostrophe < len(data)]] &= np.isin(
        kind[apostrophe[apostrophe < len(data)]], (SPACE, WHITE)
    )
    cut[edges[edges < len(data)]] = True
    return cut


class Known:
    """Numbers by key, sorted by key."""

    def __init__(self):
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of sorted keys, and which of them are new."""
        place = np.searchsorted(self.keys, keys)
        place[place == len(self.keys)] = 0
        if not len(self.keys):
            return place, np.ones(len(keys), bool)
        return self.at[place], self.keys[place] != keys

    def add(self, keys: np.ndarray, at: np.ndarray) -> None:
        place = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, place, keys)
        self.at = np.insert(self.at, place, at)


def _shown() -> dict[int, int]:
    """The character that stands for each byte in the vocabulary: itself if it is visible, else from U+0100."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in seen]
    return {b: b for b in seen} | {b: 256 + i for i, b in enumerate(rest)}


SHOWN = _shown()
BLANK_SHOWN = chr(SHOWN[BLANK])
#: Letters below this one are letters in every version of Unicode.
SETTLED = "\u0250"


def cuts_as_here(config: dict) -> bool:
    """Whether a tokenizer cuts texts by the pattern that ``cuts`` knows, and does nothing else to them."""
    cutter = config.get("pre_tokenizer") or {}
    return (
        config.get("normalizer") is None
        and config.get("truncation") is None
        and config.get("padding") is None
        and cutter.get("type") == "ByteLevel"
        and cutter.get("use_regex", True)
        and not cutter.get("add_prefix_space")
        and config["model"]["type"] == "BPE"
        and not config["model"].get("dropout")
        and not any(t["normalized"] or t["lstrip"] or t["rstrip"] for t in config["added_tokens"])
    )


class Pieces:
    """Encodes portions of texts. ``text`` is the tokenizer's JSON.

    What it knows it keeps within bounds, also from one task of a Python worker to the next.
    """

    def __init__(self, text: str):
        config = json.loads(text)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core already
        self.library = Tokenizer.from_str(text)
        self.special = [t["content"] for t in config.get("added_tokens", [])]
        self.in_pieces = cuts_as_here(config)
        line = self.library.encode("\n", add_special_tokens=False).ids
        self.line = line[0] if len(line) == 1 else None
        self.forget()

    def forget(self) -> None:
        # Ids of stretch i are flat[begin[i] : begin[i + 1]].
        self.flat, self.begin = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.short, self.middle, self.firsts, self.seconds = Known(), Known(), Known(), Known()
        self.long: dict[bytes, int] = {}

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, by the library alone."""
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, np.uint32) for x in found]

    def learn(self, stretches: list[bytes]) -> np.ndarray:
        """Encode new stretches; their numbers."""
        texts = [s.decode("utf-8", "surrogatepass") for s in stretches]
        ids: list = [None] * len(texts)
        plain, merges = [], self.library.model.tokenize
        for i, t in enumerate(texts):
            word = t.removeprefix(" ")
            if word.isalpha() and (word.isascii() or max(word) < SETTLED):
                # Letters alone are one piece: its bytes go to the library's merges as they are.
                if word.isascii():
                    shown = word if len(word) == len(t) else BLANK_SHOWN + word
                else:
                    shown = stretches[i].decode("latin-1").translate(SHOWN)
                ids[i] = [x.id for x in merges(shown)]
            elif self.line is not None and PLAIN(t):
                plain.append(i)
        # Stretches without white space but a leading blank are cut off each other by line ends.
        groups = [plain[a : a + TOGETHER] for a in range(0, len(plain), TOGETHER)]
        lines = ["".join([texts[i] + "\n" for i in group]) for group in groups]
        for group, found in zip(groups, self.whole(lines)):
            ends = np.flatnonzero(found == self.line)
            if len(ends) == len(group):
                for i, a, b in zip(group, np.append(0, ends[:-1] + 1).tolist(), ends.tolist()):
                    ids[i] = found[a:b].tolist()
        rest = [i for i, x in enumerate(ids) if x is None]
        for i, x in zip(rest, self.whole([texts[i] for i in rest])):
            ids[i] = x.tolist()
        first = len(self.begin) - 1
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(sizes)])
        new = np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum()))
        self.flat = np.concatenate([self.flat, new])
        return np.arange(first, first + len(ids))

    def _numbers(self, known: Known, keys: np.ndarray, cut) -> np.ndarray:
        """Numbers of the stretches with these keys; ``cut`` gives the bytes of some of them."""
        distinct, of = np.unique(keys, return_inverse=True)
        number, new = known.find(distinct)
        if new.any():
            first = np.empty(len(distinct), np.int64)
            first[of] = np.arange(len(keys))  # any place of each key will do
            number[new] = self.learn(cut(first[new]))
            known.add(distinct[new], number[new])
        return number[of]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each text has."""
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if not self.in_pieces or any(s in t for s in self.special for t in texts):
            ids = self.whole(texts)
            return np.concatenate(ids), np.fromiter(map(len, ids), np.int64, len(ids))
        too_long = sum(map(len, self.long)) > KEPT_BYTES
        if len(self.begin) > KEPT or len(self.flat) > KEPT_IDS or too_long:
            self.forget()
        return self._encode([t.encode("utf-8", "surrogatepass") for t in texts])

    def _encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(size)
        joined = b"".join(texts) + bytes(16)
        n = int(ends[-1])
        edges = np.append(0, ends)
        cut = cuts(np.frombuffer(joined, np.uint8, n), edges)
        begin = np.flatnonzero(cut)
        length = np.diff(begin, append=n)
        words = np.ndarray((len(joined) - 7,), "<u8", joined, strides=(1,))
        low = (np.uint64(1) << (8 * np.arange(8)).astype(np.uint64)) - np.uint64(1)
        number = np.empty(len(begin), np.int64)

        def stretches(places):
            def of(some):
                at = places[some]
                return [joined[a : a + m] for a, m in zip(begin[at].tolist(), length[at].tolist())]

            return of

        short = np.flatnonzero(length < 8)
        m = length[short]
        keys = (words[begin[short]] & low[m]) | (m.astype(np.uint64) << np.uint64(56))
        number[short] = self._numbers(self.short, keys, stretches(short))

        middle = np.flatnonzero((length >= 8) & (length < 16))
        m = length[middle] - 8
        a = words[begin[middle]]
        b = (words[begin[middle] + 8] & low[m]) | (m.astype(np.uint64) << np.uint64(56))
        both = (_places(self.firsts, a) << 32 | _places(self.seconds, b)).astype(np.uint64)
        number[middle] = self._numbers(self.middle, both, stretches(middle))

        long = np.flatnonzero(length >= 16)
        if len(long):
            found = stretches(long)(np.arange(len(long)))
            new = list(set(found) - self.long.keys())
            self.long.update(zip(new, self.learn(new).tolist()))
            number[long] = [self.long[x] for x in found]

        first, count = self.begin[number], np.diff(self.begin)[number]
        stop = np.cumsum(count)
        ids = self.flat[np.repeat(first - (stop - count), count) + np.arange(stop[-1] if n else 0)]
        upto = np.append(0, stop)[np.searchsorted(begin, edges)]
        return ids, np.diff(upto)


def _places(known: Known, keys: np.ndarray) -> np.ndarray:
    """A number for each distinct key, in the order in which they are first seen."""
    distinct, of = np.unique(keys, return_inverse=True)
    place, new = known.find(distinct)
    place[new] = len(known.keys) + np.arange(new.sum())
    known.add(distinct[new], place[new])
    return place[of]


@lru_cache(maxsize=2)
def pieces_of(text: str) -> Pieces:
    return Pieces(text)
