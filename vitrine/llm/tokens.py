"""Byte-level BPE ids of whole texts by the tokenizers library, with a cache of pieces.

A text is cut before each single space that stands between non-space
characters.  The tokenizer's own pattern always has a boundary there, so the
ids of a text are the ids of its pieces in a row, and a piece that came before
is not encoded again.  A text where the rule can't be seen to hold (runs of
white space, control separators) goes to the tokenizer as a whole, and so does
a text that holds the string of an added token, which the library gives its own id.
"""

from __future__ import annotations

import re
import sys
import types
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

END = 0
#: Words that a worker remembers in each of two generations; the older one goes when the younger is full.
WORDS = 500_000
MARKS = frozenset(",.;:?!")
#: Text handed to the encoder at a time, in bytes.
SLICE = 14 << 20


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level BPE writes for each byte: itself if printable, else the next one from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class _Recent:
    """A bounded cache of two generations: what is asked for again moves to the younger one."""

    def __init__(self, make, most: int = WORDS):
        self.make, self.most, self.young, self.old = make, most, {}, {}

    def __call__(self, key):
        got = self.young.get(key)
        if got is None:
            got = self.old.get(key)
            if got is None:
                got = self.make(key)
            if len(self.young) >= self.most:
                self.old, self.young = self.young, {}
            self.young[key] = got
        return got


class Encoder:
    """Ids of texts, each with the end id appended."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.added = "|".join(sorted(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()))
        self.letters = _byte_letters()
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.odd = regex.compile(r"^\s(?:\s|$)|[\x1c-\x1f\x85\xa0]").search
        self.far = regex.compile(r"[^\x00-\u024f]").search
        self.word, self.other = _Recent(self._word), _Recent(self._other, WORDS // 4)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        letters = word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()

    def piece(self, piece: str) -> bytes | bool:
        """Ids of a piece; False: only the whole text can tell."""
        body = piece[1:] if piece[:1] == " " else piece
        try:
            piece.encode("latin-1")
        except UnicodeEncodeError:  # beyond, Unicode versions may class letters differently
            return self.other(piece)
        if body.isalpha():  # letters alone are one word, and so are letters before a mark
            return self.word(piece)
        if body[:-1].isalpha() and body[-1] in MARKS:
            return self.word(piece[:-1]) + self.word(body[-1])
        head, feed, tail = piece.partition("\n")
        if feed and head and tail and not head[-1].isspace() and not tail[0].isspace():  # one line feed between two words
            parts = self.piece(head), self.word(feed), self.piece(tail)
            return False if False in parts else b"".join(parts)
        return self.other(piece)

    def _other(self, piece: str) -> bytes | bool:
        if self.odd(piece):
            return False
        if self.far(piece):
            return self.whole(piece)
        return b"".join(map(self.word, self.split(piece)))

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, ids of each text) for an array of texts (null: empty).

        Arrow cuts the texts and numbers the distinct pieces; Python sees each
        distinct piece once, and numpy lays the ids of all pieces out.
        """
        texts = texts.fill_null("")
        parts = pc.split_pattern(texts, " ")
        offsets = parts.offsets.to_numpy()
        coded = parts.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        offsets = offsets - offsets[0]
        index, distinct = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        # first pieces of texts have no space before them: their numbers come after the others'
        first = np.unique(index[offsets[:-1]])
        place = np.zeros(len(distinct), np.int64)
        place[first] = np.arange(len(first)) + len(distinct)
        index = index.astype(np.int64)
        index[offsets[:-1]] = place[index[offsets[:-1]]]
        used = np.zeros(len(distinct) + len(first), bool)
        used[index] = True
        ids = [self.piece(f" {d}") if u else b"" for d, u in zip(distinct, used.tolist(), strict=False)]
        ids += [self.piece(distinct[k]) for k in first.tolist()]
        bad = np.array([x is False for x in ids])
        again = np.add.reduceat(bad[index], offsets[:-1]) > 0 if len(texts) else np.zeros(0, bool)
        if self.added:
            again |= pc.match_substring_regex(texts, self.added).to_numpy(zero_copy_only=False)
        # each text ends with a piece of its own: the end id, or all of its ids
        end = np.array([END], "<u4").tobytes()
        ends = np.full(len(texts), len(ids))
        ids.append(end)
        for k in np.nonzero(again)[0].tolist():
            ends[k] = len(ids)
            ids.append(self.whole(texts[k].as_py()) + end)
        length = np.array([len(x) // 4 if x else 0 for x in ids], np.int64)
        flat = np.frombuffer(b"".join(x for x in ids if x), "<u4")
        start = np.cumsum(length) - length
        keep = ~np.repeat(again, np.diff(offsets))
        order = np.insert(np.where(keep, index, -1), offsets[1:], ends)
        order = order[order >= 0]
        n = length[order]
        at = np.cumsum(n) - n
        out = flat[np.repeat(start[order] - at, n) + np.arange(int(n.sum()))]
        size = np.where(again, 0, np.add.reduceat(length[index], offsets[:-1])) + length[ends] if len(texts) else n
        return out, size

    def __call__(self, text: str | None) -> bytes:
        return self.batch(pa.array([text], pa.string()))[0].tobytes()


def encoder(path: str) -> Encoder:
    """This worker's encoder; it and its cache outlive a task, in a module that only holds them."""
    held = sys.modules.setdefault("_held_encoders", types.ModuleType("_held_encoders"))
    if path not in vars(held):
        vars(held)[path] = Encoder(path)
    return vars(held)[path]
