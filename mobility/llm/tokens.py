r"""Encoding with public tokenizers, with a bounded chunk cache per worker process.

A byte-level BPE (tokenizers library) merges within pre-tokens only.  A text is
cut at places where its pre-tokenizer starts a new pre-token whatever the rest
of the text is, so the ids of a text are the ids of its chunks in order,
exactly.  Chunks recur, so their ids are cached.  The places, with letters,
digits and marks of fixed ranges (which every Unicode version classes alike):

* before a space that a visible character follows;
* after a run of letters, or of digits, that an ASCII character follows;
* after a run of ASCII marks (no apostrophe) before a letter, digit, space or
  line break;
* after a line break between visible characters.

A new chunk that is one pre-token goes straight to the library's BPE model;
others (and vocabularies of another kind) go through its whole encoder.  An
added token's string (such as ``<|endoftext|>``) is matched before the
pre-tokenizer and ends the text before it, so a text that holds one is one
chunk; with ``plain`` such strings are ordinary text.

A sentencepiece BPE merges wherever a piece allows it.  ``PieceEncoder`` uses
the same places (but no cut between two spaces) if the vocabulary has no piece
that spans one, which it checks, and whole texts otherwise.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Callable
from functools import lru_cache

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism

import sentencepiece  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

#: Bytes of chunks and ids that a worker keeps.
CACHE_BYTES = 240 << 20
#: Little-endian unsigned 32-bit ids.
ID = np.dtype("<u4")

LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
MARKS = r"!-&(-/:-@\[-`{-~"
VISIBLE = f"!-~{LETTERS}"
#: One pre-token.
SINGLE = re.compile(f" ?(?:[{LETTERS}]+|[0-9]+|[{MARKS}]+)")
_RUNS = (
    rf" ?[{LETTERS}]++(?![^\x00-\x7F])| ?[0-9]++(?![^\x00-\x7F])"
    rf"| ?[{MARKS}]++(?=[{LETTERS}0-9 \n]|\Z)|\n(?=[{VISIBLE}])"
)
#: Tiles a text; what is none of the runs goes on to the next space before a visible character.
CHUNK = re.compile(rf"{_RUNS}|(?s:.)+?(?= [{VISIBLE}]|\Z)")
#: ``CHUNK`` without a cut between two spaces.
PIECE_CHUNK = re.compile(rf"{_RUNS}|(?s:.)+?(?=(?<! ) [{VISIBLE}]|\Z)")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public vocabulary file (a parameter of every operator)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones themselves, others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(256 + others.index(b)) for b in range(256)]


_BYTE_CHARACTERS = dict(enumerate(byte_characters()))


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class ChunkEncoder(dict):
    """A mapping that answers for every chunk with its ids as bytes, and a bounded cache of them.

    It holds two generations.  The younger one (the mapping itself) takes new
    chunks and those found in the older one; when it has its share of
    ``cache_bytes`` it becomes the older one, so what recurs stays.
    """

    def __init__(self, cache_bytes: int):
        super().__init__()
        self.old: dict[str, bytes] = {}
        self.half, self.used = cache_bytes // 2, 0

    def chunks(self, text: str) -> list[str]:
        """The chunks of a text, which concatenate to it."""
        raise NotImplementedError

    def fresh(self, chunk: str) -> bytes:
        """The ids of a chunk that is not cached."""
        raise NotImplementedError

    def cost(self, chunk: str, ids: bytes) -> int:
        """About the bytes of a cached chunk."""
        return 170 + 3 * len(chunk) + len(ids)

    def __missing__(self, chunk: str) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            ids = self.fresh(chunk)
        cost = self.cost(chunk, ids)
        if self.used + cost > self.half:
            self.old, self.used = dict(self), 0
            self.clear()
        if cost <= self.half:
            self[chunk] = ids
            self.used += cost
        return ids

    def encoded(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, little-endian unsigned 32-bit."""
        return [b"".join(map(self.__getitem__, self.chunks(t))) for t in texts]


class Encoder(ChunkEncoder):
    """A byte-level BPE of the tokenizers library."""

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES, plain: bool = False):
        super().__init__(cache_bytes)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        tokens = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content for t in tokens if not (plain and t.special)]
        self.spaced = any(" " in a for a in self.added)
        parts = json.loads(self.tokenizer.to_str())
        before, model = parts["pre_tokenizer"] or {}, parts["model"]
        #: Whether the places above are this tokenizer's.
        self.cuts = (
            parts["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
            and not before.get("add_prefix_space") and model["type"] == "BPE" and not model.get("dropout")
            and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
        )
        self.model = self.tokenizer.model

    def holds(self, text: str) -> bool:
        """Whether an added token's string is in ``text``."""
        return any(a in text for a in self.added)

    def chunks(self, text: str) -> list[str]:
        if not self.cuts or self.holds(text):
            return [text]
        return CHUNK.findall(text)

    def fresh(self, chunk: str) -> bytes:
        if not (self.cuts and SINGLE.fullmatch(chunk)):
            return _packed(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
        if not chunk.isascii():
            chunk = chunk.encode().decode("latin-1").translate(_BYTE_CHARACTERS)
        elif chunk[0] == " ":
            chunk = _BYTE_CHARACTERS[32] + chunk[1:]
        return _packed([t.id for t in self.model.tokenize(chunk)])

    def token_bytes(self) -> list[bytes]:
        """The bytes of every id of a byte-level vocabulary."""
        byte = {c: b for b, c in _BYTE_CHARACTERS.items()}
        tokens = [self.tokenizer.id_to_token(i) for i in range(self.tokenizer.get_vocab_size())]
        return [bytes(byte[c] for c in t) if t and all(c in byte for c in t) else (t or "").encode() for t in tokens]


def _spans_a_cut(piece: str) -> bool:
    """Whether a piece (with spaces) could reach over a place of ``PIECE_CHUNK``."""
    letter, mark = f"[{LETTERS}]", f"[{MARKS}]"
    over = rf"[^ ] |{letter}[^{LETTERS}\x80-\U0010FFFF]|[0-9][^0-9\x80-\U0010FFFF]|{mark}[{LETTERS}0-9\n]|\n"
    return re.search(over, piece) is not None


class PieceEncoder(ChunkEncoder):
    """A sentencepiece BPE, which adds a space to a text; here texts come with that space."""

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        super().__init__(cache_bytes)
        self.processor = p = sentencepiece.SentencePieceProcessor(model_file=path)
        ordinary = [i for i in range(p.get_piece_size()) if not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i))]
        pieces = [p.id_to_piece(i).replace("▁", " ") for i in ordinary]
        self.lead = p.encode("\n")  # what a chunk without its space is given, and loses again
        self.cuts = not any(map(_spans_a_cut, pieces)) and p.encode("\n ") == [*self.lead, p.piece_to_id("▁")]

    def chunks(self, text: str) -> list[str]:
        return PIECE_CHUNK.findall(text) if self.cuts else [text]

    def fresh(self, chunk: str) -> bytes:
        if chunk[:1] == " " and len(chunk) > 1:
            return _packed(self.processor.encode(chunk[1:]))
        return _packed(self.processor.encode("\n" + chunk)[len(self.lead) :])

    def token_bytes(self) -> list[bytes]:
        """The bytes of every id: a byte piece's byte, otherwise its characters with U+2581 as space."""
        p = self.processor
        return [
            bytes([int(p.id_to_piece(i)[1:-1], 16)]) if p.is_byte(i) else p.id_to_piece(i).replace("▁", " ").encode()
            for i in range(p.get_piece_size())
        ]


@lru_cache(maxsize=2)
def encoder(path: str, plain: bool = False) -> Encoder:
    """The worker process's encoder of a vocabulary file."""
    return Encoder(path, plain=plain)
