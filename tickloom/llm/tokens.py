"""Token ids of whole texts by a public tokenizer, with every distinct piece of text encoded once.

The byte-level tokenizer first splits a text by a pattern, left to right and without memory; only its rule for
runs of white space looks ahead. A split in front of white space that follows a character which is none
therefore changes nothing: the parts are encoded as they are in the whole text. The same holds between an
ASCII letter and ASCII punctuation other than the apostrophe. Such parts ("units", mostly a blank and a word)
repeat a lot, so a task encodes each distinct one once and looks up the rest.

The vocabulary is read with ``tokenizers``; its ids are also the order of its merges, so distinct units are
encoded by ``tiktoken`` with the ids as ranks, which is faster for short strings. Tests hold the ids against
those that ``tokenizers`` gives for the whole texts.

A text may hold the mark of an added token, such as ``<|endoftext|>``, literally. With ``added`` its id is emitted and
the parts before and after it are split on their own, as ``tokenizers`` does unless told otherwise; without, the mark
is spelled out like any other text (``encode_special_tokens``). A unit never begins within a mark.
"""

import itertools
import re

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from tickloom.llm import vec

VOCABULARY = "byte_bpe_50k.json"
END_ID = 1
CACHE_UNITS = 300_000
SLICE_BYTES = 1 << 20

LETTERS, PUNCTUATION = np.zeros(256, bool), np.zeros(256, bool)
LETTERS[[*range(65, 91), *range(97, 123)]] = True
PUNCTUATION[[*range(33, 39), *range(40, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True

_encoders = {}


def byte_alphabet() -> dict:
    """The printable character by which a byte-level vocabulary writes each byte: bytes that are printable in
    Latin-1 stand for themselves, the others get the code points from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def read_ranks(path: str) -> dict:
    """``bytes -> id`` of a byte-level vocabulary, without its special tokens."""
    tokenizer, byte_of = Tokenizer.from_file(path), byte_alphabet()
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    return {bytes(byte_of[c] for c in token): i for token, i in tokenizer.get_vocab().items() if token not in special}


def read_added(path: str) -> dict:
    """``mark -> id`` of the added tokens. Marks that overlap, or that match by more than their letters, are an error."""
    added = Tokenizer.from_file(path).get_added_tokens_decoder()
    marks = {t.content: i for i, t in added.items()}
    if any(t.lstrip or t.rstrip or t.single_word for t in added.values()):
        raise ValueError("added tokens that take in blanks or need word borders are not supported")
    pairs = [(a, b) for a in marks for b in marks]
    if any(a != b and a in b or any(a[-n:] == b[:n] for n in range(1, min(len(a), len(b)))) for a, b in pairs):
        raise ValueError("added tokens that overlap are not supported")
    return marks


def encoder(vocabulary: str = VOCABULARY, added: bool = False) -> "UnitEncoder":
    """The encoder of this Python worker; a vocabulary is a file's path or the name of a public one."""
    if (vocabulary, added) not in _encoders:
        path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
        _encoders[vocabulary, added] = UnitEncoder(path, added)
    return _encoders[vocabulary, added]


def safe_cuts(data: np.ndarray) -> np.ndarray:
    """Mask of the byte positions where a unit may begin: white space right after a character that is certainly none,
    or a punctuation mark after a letter.

    After the lead bytes of the blocks which hold wide blanks, and after control characters, nothing is cut;
    that only makes a unit longer.
    """
    at = np.flatnonzero(vec.SPACES[data[1:]]) + 1
    marks = np.flatnonzero(PUNCTUATION[data[1:]] & LETTERS[data[:-1]]) + 1
    one, two, three = data[at - 1], data[np.maximum(at - 2, 0)], data[np.maximum(at - 3, 0)]
    blank = (one <= 32) | (one == 127)
    blank |= (two == 0xC2) & ((one == 0x85) | (one == 0xA0))
    blank |= (three == 0xE1) & (two == 0x9A) | (three == 0xE2) & ((two == 0x80) | (two == 0x81)) | (three == 0xE3) & (two == 0x80)
    cut = np.zeros(len(data), bool)
    cut[at[~blank]] = True
    cut[marks] = True
    return cut


def units(data: np.ndarray, offsets: np.ndarray, marks: re.Pattern | None = None):
    """``(start, end, first)``: the units of all texts, and the number of each text's first unit."""
    cut = safe_cuts(data)
    for mark in marks.finditer(data) if marks else ():
        cut[mark.start() + 1:mark.end()] = False
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    start = np.flatnonzero(cut)
    return start, np.append(start[1:], len(data))[:len(start)], np.searchsorted(start, offsets)


class UnitEncoder:
    """Encodes byte spans; keeps the ids of at most ``CACHE_UNITS`` distinct spans and then starts afresh."""

    def __init__(self, path: str, added: bool = False):
        self.encode_plain = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(path),
                                              special_tokens={}).encode_ordinary
        self.added = {m.encode(): i for m, i in read_added(path).items()} if added else {}
        self.marks = re.compile(b"|".join(map(re.escape, self.added))) if self.added else None
        self.reach = max([1, *(len(m.decode()) - 1 for m in self.added)])  # how far a border must be from a change
        self._clear()

    def encode_unit(self, span: bytes) -> list:
        """The ids of a span; its parts around added tokens are encoded on their own."""
        ids, at = [], 0
        for mark in self.marks.finditer(span) if self.marks else ():
            ids += self.encode_plain(span[at:mark.start()].decode())
            ids.append(self.added[mark.group()])
            at = mark.end()
        return ids + self.encode_plain(span[at:].decode()) if at else self.encode_plain(span.decode())

    def _clear(self):
        self.known, self.used = {}, 0
        self.ids, self.begin, self.count = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32)

    def _learn(self, spans: list):
        if len(self.known) + len(spans) > CACHE_UNITS and self.known:
            return False
        lists = [self.encode_unit(s) for s in spans]
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        new = np.fromiter((i for ids in lists for i in ids), np.uint32, int(lengths.sum()))
        n, stop = len(self.known), self.used + len(new)
        while stop > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + len(spans) > len(self.begin):
            self.begin, self.count = (np.concatenate([a, np.zeros_like(a)]) for a in (self.begin, self.count))
        self.ids[self.used:stop] = new
        self.begin[n:n + len(spans)] = self.used + np.cumsum(lengths) - lengths
        self.count[n:n + len(spans)] = lengths
        self.known.update(zip(spans, range(n, n + len(spans))))
        self.used = stop
        return True

    def unit_numbers(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number under which each span's ids are kept, valid until the next call."""
        _, first, inverse = np.unique(vec.span_hashes(data, start, end), return_index=True, return_inverse=True)
        raw = data.tobytes()
        spans = [raw[a:b] for a, b in zip(start[first].tolist(), end[first].tolist())]
        numbers = np.fromiter(map(self.known.get, spans, itertools.repeat(-1)), np.int64, len(spans))
        new = np.flatnonzero(numbers < 0)
        if len(new) and self._learn([spans[i] for i in new.tolist()]):
            numbers[new] = np.arange(len(self.known) - len(new), len(self.known))
        elif len(new):
            self._clear()
            self._learn(spans)
            numbers = np.arange(len(spans))
        return numbers[inverse]

    def counts(self, data, start, end) -> np.ndarray:
        """Tokens of each span."""
        number = self.unit_numbers(data, start, end)
        return self.count[number].astype(np.int64)

    def encode(self, data: np.ndarray, offsets: np.ndarray, end_id: int | None = END_ID):
        """``(ids, offsets)`` of all texts, with ``end_id`` after each."""
        start, end, first = units(data, offsets, self.marks)
        number = self.unit_numbers(data, start, end)
        lengths = self.count[number].astype(np.int64)
        before = np.concatenate([[0], np.cumsum(lengths)])
        extra = 0 if end_id is None else 1
        texts = len(offsets) - 1
        bounds = before[first] + extra * np.arange(texts + 1)
        shift = extra * np.repeat(np.arange(texts), np.diff(first))
        ids = np.full(int(bounds[-1]), end_id or 0, np.uint32)
        step = np.arange(int(before[-1]))
        source = np.repeat(self.begin[number] - before[:-1], lengths) + step
        ids[np.repeat(shift, lengths) + step] = self.ids[source]
        return ids, bounds
