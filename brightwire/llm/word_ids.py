"""Token ids by the tokenizers library, encoded once per distinct white-space-bounded piece.

Splitting at ASCII white space is exact for vocabularies whose pre-tokenizer drops white space and whose normalizer lower-
cases: no match, composition or special token reaches over it. Plain words (Latin letters, perhaps a run of ASCII
punctuation without apostrophes after them) are two pre-tokens at most; those that a block lacks are encoded by one call,
as one text, and cut where a token ends a word. Other pieces are encoded one by one. Pieces stay in a bounded cache, most
of which is for words, as a word's punctuation costs little to add; pieces of more than ``LONGEST`` bytes stay only while
their block lasts. A block's many small objects hold no cycles, so the cycle collector rests meanwhile.
"""

from __future__ import annotations

import gc
import os
import re
from itertools import chain, pairwise

import numpy as np

from brightwire.llm.common import Bounded

#: A line's plain word and the punctuation after it; both empty where the line is something else. The only lead byte of the
#: class is C3, so its letters are ASCII's and those of Latin-1 in UTF-8, without the signs for times and divided by.
PLAIN = re.compile(rb"^(?:([a-z\xc3\x80-\x96\x98-\xb6\xb8-\xbf]+)([!-&(-/:-@\[-`{-~]*)|[^\n]+)$", re.MULTILINE).findall
END_OF_WORD = "</w>"
#: Bytes of the longest piece that stays in a cache, so that the caches' memory is bounded with their entries.
LONGEST = 64


class WordEncoder:
    """Texts (UTF-8) to ids as little-endian 32-bit integers. ``words``, ``pieces``: most plain words and others that stay."""

    def __init__(self, path: str, pieces: int = 100_000, words: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.room, self.known = Tokenizer.from_file(path), {"words": words, "pieces": pieces}, {}
        self.passing: list[bytes] = []
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith(END_OF_WORD)
        self.marks = Bounded(lambda mark: self._each([mark])[0], 10_000)
        self.marks[b""] = b""

    def _each(self, pieces: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _plain(self, words: list[bytes]) -> list[bytes]:
        """Ids of words that are one pre-token each."""
        ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(words).decode()], add_special_tokens=False)[0].ids, "<u4")
        cuts = (np.flatnonzero(self.ends[ids]) * 4 + 4).tolist()
        if len(cuts) != len(words):  # a vocabulary without word ends
            return self._each(words)
        data = ids.tobytes()
        return [data[a:b] for a, b in pairwise([0, *cuts])]

    def _learn(self, need: list[bytes]) -> None:
        """Pieces to ``known``, with the words that had to be encoded for them; what is beyond the room left goes to ``passing``."""
        known, marks = self.known, self.marks
        rest = [p for p in need if not (p.isalpha() and p.islower())]
        words, marked, other = set(need).difference(rest), [], []
        for piece, (word, mark) in zip(rest, PLAIN(b"\n".join(rest).lower()), strict=True):
            if word:
                marked.append((piece, word, mark))
                if word not in known:
                    words.add(word)
            else:
                other.append(piece)
        new = list(words)
        if new:
            known.update(zip(new, self._plain(new), strict=True))
        for piece, word, mark in marked:
            known[piece] = known[word] + marks[mark] if mark else known[word]
        if other:
            known.update(zip(other, self._each(other), strict=True))
        self.passing = self._beyond("words", new) + self._beyond("pieces", [p for p in rest if p not in words])

    def _beyond(self, kind: str, new: list[bytes]) -> list[bytes]:
        """Those of ``new`` that don't stay: too long, or beyond the room for their kind."""
        long = [p for p in new if len(p) > LONGEST]
        short = [p for p in new if len(p) <= LONGEST] if long else new
        stay = min(len(short), self.room[kind])
        self.room[kind] -= stay
        return short[stay:] + long

    def encode(self, texts: list[bytes]) -> list[bytes]:
        collects = gc.isenabled()
        gc.disable()
        try:
            known = self.known
            parts = [t.split() for t in texts]
            need = list(set(chain.from_iterable(parts)).difference(known))
            if need:
                self._learn(need)
            out = [b"".join(map(known.__getitem__, p)) for p in parts]
            if need:
                for p in self.passing:
                    del known[p]
                self.passing = []
            return out
        finally:
            if collects:
                gc.enable()


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """This worker's encoder; it outlives the task."""
    return _encoders.get(path) or _encoders.setdefault(path, WordEncoder(path))


def in_blocks(column, block: int = 3_000_000):
    """(first row, texts as bytes) of a string column, in blocks of about ``block`` bytes."""
    first, texts, size = 0, [], 0
    for i in range(len(column)):
        texts.append(column[i].as_buffer().to_pybytes())
        size += len(texts[-1])
        if size >= block:
            yield first, texts
            first, texts, size = i + 1, [], 0
    if texts:
        yield first, texts
