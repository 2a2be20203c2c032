"""Byte-level BPE ids of whole texts, shared by the packing and the binary output.

The tokenizer library encodes; texts are cut only where its own pre-tokenizer always
cuts (before a single space between two non-blank characters), so the ids are those of
the whole text. Pieces repeat a lot, so each worker process keeps a bounded table of
the first words it met (mostly the frequent ones) and hands the library only the others,
each once per group of texts. Ids are those of ``encode(text, add_special_tokens=False)`` with
the file's own settings: the literal of an added token in a text becomes that token's id.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np

DEFAULT_TOKENIZER = "byte_bpe_50k.json"
MAX_CACHED_WORDS = 1_000_000
MAX_WORD_CHARS = 64

_SAFE_CUT = re.compile(r"(?<=\S)(?= \S)")
_BLANK_BESIDE_SPACE = re.compile(r" (?:\s|$)|\s |^ ")
_RARE_BLANK = re.compile("[\t\v\f\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_SPACE_BYTE = "\u0120"  # fixed value: how byte-level vocabularies write byte 0x20
_TAIL = ".,;:!?"


def default_path(name: str = DEFAULT_TOKENIZER) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


class PieceEncoder:
    """``encode_many(texts)`` gives each text's ids as little-endian 32-bit bytes."""

    def __init__(self, path: str, max_words: int = MAX_CACHED_WORDS):
        self.max_words = max_words
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        # Literals the library cuts out of a text before anything else (fixed by the file).
        self.literals = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.vocab_size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.opens = np.zeros(self.vocab_size, dtype=bool)  # ids that begin with a space
        self.opens[[i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items()
                    if t.startswith(_SPACE_BYTE)]] = True
        self.words: dict[str, bytes] = {}  # ids of a space and the key
        self.tails: dict[str, bytes] = {}
        self.missed = 0

    def _direct(self, pieces: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    def _letters(self, words: list[str]) -> dict[str, bytes]:
        """Ids of a space and the letters of each word: one pre-token each, so they go to
        the library as one text and are told apart by its word index."""
        out: dict[str, bytes] = {}
        for i in range(0, len(words), 8192):
            part = words[i:i + 8192]
            got = self.tokenizer.encode(" " + " ".join(part), add_special_tokens=False)
            raw = np.array(got.ids, dtype="<u4").tobytes()
            ends = (4 * np.searchsorted(np.array(got.word_ids, dtype=np.int64),
                                        np.arange(len(part) + 1))).tolist()
            out.update(zip(part, [raw[a:b] for a, b in zip(ends, ends[1:])]))
        return out

    def _joined(self, words: list[str]) -> dict[str, bytes]:
        """Ids of a space and each word. Words without a blank at either end and without a
        space inside go to the library as one text: each space in it opens a pre-token, so
        the ids that begin with a space tell the words apart."""
        out: dict[str, bytes] = {}
        whole, apart = [], []
        for w in words:
            blank = not w or " " in w or w[0].isspace() or w[-1].isspace()
            (apart if blank else whole).append(w)
        for i in range(0, len(whole), 8192):
            part = whole[i:i + 8192]
            got = self.tokenizer.encode_batch_fast([" " + " ".join(part)], add_special_tokens=False)
            ids = np.array(got[0].ids, dtype="<u4")
            starts = np.flatnonzero(self.opens[ids])
            if len(starts) != len(part):  # not a byte-level vocabulary
                apart += part
                continue
            raw = ids.tobytes()
            ends = (4 * starts).tolist() + [len(raw)]
            out.update(zip(part, [raw[a:b] for a, b in zip(ends, ends[1:])]))
        out.update(zip(apart, self._direct([" " + w for w in apart])))
        return out

    def _learn(self, new: set[str]) -> dict[str, bytes]:
        """Ids of words not held, each with the space before it. Stop and comma signs
        after letters start the next pre-token, so such a word is encoded in two parts."""
        letters = [w for w in new if w.isalpha()]
        closed, odd = [], []
        for w in new.difference(letters):
            head = w.rstrip(_TAIL)
            if head.isalpha():
                closed.append((w, head, w[len(head):]))
            else:
                odd.append(w)
        out = self._letters(letters)
        held = self.words
        heads = self._letters(list({h for _, h, _ in closed if h not in held and h not in out}))
        tails = {t for _, _, t in closed}.difference(self.tails)
        self.tails.update(zip(tails, self._direct(list(tails))))
        tail = self.tails
        for w, h, t in closed:
            out[w] = (held.get(h) or out.get(h) or heads[h]) + tail[t]
        out.update(self._joined(odd))
        return out

    @staticmethod
    def _regular(text: str, words: list[str]) -> bool:
        """Is each space of the text between two non-blank characters?"""
        if "" in words:
            return False
        if _RARE_BLANK.search(text) is None:
            return "\n " not in text and " \n" not in text
        return _BLANK_BESIDE_SPACE.search(text) is None

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as the plain library call gives them. A text that holds the
        literal of an added token goes to the library whole."""
        held = [any(x in t for x in self.literals) for t in texts]
        if not any(held):
            return self._by_words(texts)
        plain = iter(self._by_words([t for t, h in zip(texts, held) if not h]))
        direct = iter(self._direct([t for t, h in zip(texts, held) if h]))
        return [next(direct if h else plain) for h in held]

    def _by_words(self, texts: list[str]) -> list[bytes]:
        first: list[str] = []
        later: list[list[str]] = []
        for t in texts:
            words = t.split(" ")
            if not self._regular(t, words):
                words = _SAFE_CUT.split(t)
                words = words[:1] + [w[1:] for w in words[1:]]
            first.append(words[0])
            later.append(words[1:])
        if self.missed > max(16 * self.max_words, 4_000_000):  # the texts have changed: start anew
            self.words, self.tails, self.missed = {}, {}, 0
        table = self.words
        new: set[str] = set()
        found: list[list] = []  # each word is looked up once
        open_texts: list[bool] = []
        for ws in later:
            got = list(map(table.get, ws))
            found.append(got)
            open_texts.append(None in got)
            if open_texts[-1]:
                new.update([w for w, x in zip(ws, got) if x is None])
        learnt = self._learn(new)
        out = [a + b"".join([learnt[w] if x is None else x for w, x in zip(ws, got)] if missing else got)
               for a, ws, got, missing in zip(self._direct(first), later, found, open_texts)]
        if len(table) >= self.max_words:  # only so many, and only short ones, stay
            self.missed += len(new)
        else:
            table.update((w, x) for w, x in learnt.items() if len(w) <= MAX_WORD_CHARS)
        return out


@functools.lru_cache(maxsize=1)
def encoder(path: str, max_words: int = MAX_CACHED_WORDS) -> PieceEncoder:
    """One encoder per worker process."""
    return PieceEncoder(path, max_words)


def text_groups(rows: Iterable[tuple], size: int = 2_000_000) -> Iterator[list[tuple]]:
    """Rows ``(..., text)`` in runs of about ``size`` characters (one row at least)."""
    group, chars = [], 0
    for row in rows:
        group.append(row)
        chars += len(row[-1]) + 64
        if chars >= size:
            yield group
            group, chars = [], 0
    if group:
        yield group
