"""Token ids of whole texts under public vocabularies, by a memo of chunks.

A text is cut before every single space that a visible character follows (and
no space precedes).  Both kinds of vocabulary used here begin a token there
whatever stands around: the byte-level one starts a word at such a space, the
sentence-piece one has no piece with a space mark after another character.  So
the ids of the text are those of its chunks, joined.  Chunks repeat, and each
is encoded once as long as the memo of the task (``MEMO`` chunks) has room.
"""

from __future__ import annotations

import re
import sys
import types
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks a task remembers; those beyond are encoded anew.
MEMO = 600_000
#: Longer chunks and words are not remembered.
LONG = 200
_CUT = re.compile(r"(?<! ) (?=\S)")
# a space at an end or before white space: such texts are cut by ``_CUT``, the others at every space
_ODD = r"^ | \z| [\pZ\x09-\x0D\x1C-\x1F\x{85}]"


def kept(key: tuple, make):
    """``make()``, once for each Python worker: for what is slow to load and
    never changes.  Task functions are sent by value and share no module state,
    so it is kept under a module name of its own."""
    home = sys.modules.setdefault("pixelframe_worker_state", types.ModuleType("pixelframe_worker_state"))
    state = home.__dict__.setdefault("state", {})
    if key not in state:
        state[key] = make()
    return state[key]


def byte_level_bytes() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: visible
    characters of Latin-1 stand for themselves, the others follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Memo(dict):
    """Chunk -> its ids as unsigned 32-bit integers (little-endian, as every executor's machine is)."""

    def __init__(self, room: int):
        super().__init__()
        self.room = room

    def __missing__(self, chunk: str) -> bytes:
        ids = self.encode(chunk)
        if len(self) < self.room and len(chunk) <= LONG:
            self[chunk] = ids
        return ids

    def all(self, chunks: list[str]) -> list[bytes]:
        return list(map(self.__getitem__, chunks))


class ByteBPE(Memo):
    """A byte-level BPE of ``tokenizers``; special strings keep their ids or,
    with ``plain``, are text like any other.

    A chunk without a special string is cut into words by the tokenizer's
    pattern, which go to its model one by one: that skips the bookkeeping of
    offsets.  The pattern is applied here for Latin text only, where classes of
    characters are the same in any library; else the tokenizer itself applies it."""

    #: Fixed value: the pattern of the vocabulary file's byte-level pre-tokenizer.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str, plain: bool = False, memo: int = MEMO):
        super().__init__(memo)
        import regex
        from tokenizers import Tokenizer

        self.whole = kept(("byte-level", path, plain), lambda: Tokenizer.from_file(path))
        self.whole.encode_special_tokens = plain
        self.special = [] if plain else [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.words = regex.compile(self.PATTERN, regex.V1).findall
        self.far = re.compile("[\x1C-\x1F\x85\u0250-\U0010FFFF]").search
        self.model = self.whole.model
        self.mapped = {b: c for c, b in byte_level_bytes().items()}
        self.known: dict[str, bytes] = {}

    def _word(self, word: str, marked: str | None = None) -> bytes:
        marked = marked or word.encode().decode("latin-1").translate(self.mapped)
        ids = array("I", [t.id for t in self.model.tokenize(marked)]).tobytes()
        if len(self.known) < self.room and len(word) <= LONG:
            self.known[word] = ids
        return ids

    def encode(self, chunk: str) -> bytes:
        if self.special and any(s in chunk for s in self.special):
            return array("I", self.whole.encode(chunk, add_special_tokens=False).ids).tobytes()
        if self.far(chunk):
            words = self.whole.pre_tokenizer.pre_tokenize_str(chunk)
            return b"".join([self.known.get(chunk[a:b]) or self._word(chunk[a:b], marked) for marked, (a, b) in words])
        known = self.known.get
        return b"".join([known(word) or self._word(word) for word in self.words(chunk)])

    def token_bytes(self) -> list[bytes]:
        """The bytes of every id; special tokens do not occur in plain text."""
        back, added = byte_level_bytes(), self.whole.get_added_tokens_decoder()
        return [b"" if i in added else bytes(map(back.__getitem__, self.whole.id_to_token(i)))
                for i in range(self.whole.get_vocab_size())]


class PieceBPE(Memo):
    """A sentence-piece model that puts a space before the text; the chunks it
    is given have that space."""

    def __init__(self, path: str, memo: int = MEMO):
        super().__init__(memo)
        import sentencepiece

        self.model = kept(("pieces", path), lambda: sentencepiece.SentencePieceProcessor(model_file=path))

    def encode(self, chunk: str) -> bytes:
        return self.encode_all([chunk])[0]

    def encode_all(self, chunks: list[str]) -> list[bytes]:
        return [array("I", ids).tobytes() for ids in self.model.encode([c[1:] for c in chunks], num_threads=1)]

    def token_bytes(self) -> list[bytes]:
        m = self.model
        return [bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else
                m.id_to_piece(i).replace("▁", " ").encode() for i in range(m.vocab_size())]


def slices(batch: pa.RecordBatch, column: int, size: int):
    """``batch`` in parts of about ``size`` bytes of text in ``column``, or one row."""
    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy()
    part = (np.cumsum(lengths, dtype=np.int64) - lengths) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def cut(text: str, spaced: bool) -> list[str]:
    """Chunks of ``text``, or of a space and ``text``."""
    first, *rest = _CUT.split(" " + text if spaced else text)
    return ([first] if first else []) + [" " + p for p in rest]


def chunked(texts: pa.Array, spaced: bool) -> tuple[list[str], list[np.ndarray]]:
    """The different chunks of a batch of texts (none null) and, for every text,
    their numbers in order."""
    texts = texts.cast(pa.large_string())
    odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
    parts = pc.split_pattern(texts, " ")
    ends = np.asarray(parts.offsets)
    coded = parts.flatten().dictionary_encode()
    codes = np.asarray(coded.indices)
    chunks = [" " + p for p in coded.dictionary.to_pylist()]
    more: dict[str, int] = {}

    def number(chunk: str) -> int:
        return more.setdefault(chunk, len(chunks) + len(more))

    out = []
    for k in range(len(texts)):
        if odd[k]:
            own = np.fromiter(map(number, cut(texts[k].as_py(), spaced)), np.int64)
        else:
            own = codes[ends[k] - ends[0]:ends[k + 1] - ends[0]]
            if len(own) == 1 and chunks[own[0]] == " ":  # empty text
                own = own[:0]
            elif not spaced:
                own = own.astype(np.int64)
                own[0] = number(chunks[own[0]][1:])
        out.append(own)
    used = np.zeros(len(chunks) + len(more), bool)
    for own in out:
        used[own] = True
    new = np.cumsum(used) - 1
    every = chunks + list(more)
    return [every[i] for i in np.flatnonzero(used)], [new[own] for own in out]
