"""Whole-text encoding with the ``tokenizers`` library, once for each distinct chunk.

A text is cut where the tokenizer's own pre-tokenizer always cuts, and each
distinct chunk is encoded once per worker (a bounded cache). Joining the ids
of the chunks gives the ids of the whole text:

* word tokenizers (white space dropped): cut at spaces and line feeds. Tokens
  and special tokens never span one.
* byte-level tokenizers: cut before a space or line feed between two
  non-spaces. Runs of white space are grouped by look-ahead, so texts with
  such a run, or with other white space, or with a special token's string, go
  to the library whole. A chunk stands for itself after a space; after a line
  feed it has ``BREAK`` before it.

In a chunk of Latin letters with marks after them the letters are a pre-token
whatever the tokenizer: they go to the library's model as they are, without
the general normalizer and pre-tokenizer before it, and the marks to the
library by themselves.

``tests/llm`` holds all this against the library on whole texts.
"""

from __future__ import annotations

import os
import re
import string
from array import array

import numpy as np

#: Chunks kept per Python worker, in a new and an old half: a full new half
#: becomes the old one, and what is asked for again moves back.
CACHE_CHUNKS = 160_000
#: Letters that Unicode normal form C leaves alone and that lower-case one to one.
PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: Marks that are pre-tokens apart from letters before them (an apostrophe is not always).
MARKS = string.punctuation.replace("'", "")
BREAK = "\0"


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: itself if printable, else the next of U+0100 upward."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class ChunkEncoder(dict):
    """chunk -> ids as little-endian unsigned bytes of ``width`` each, filled as chunks are asked for."""

    def __init__(self, path: str, width: int = 4, chunks: int | None = None):
        super().__init__()
        self.chunks = chunks or CACHE_CHUNKS
        self.code, self.dtype = {2: "H", 4: "I"}[width], f"<u{width}"
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.model = self.tok.model
        self.specials = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.words = self.tok.normalizer is not None  # this kind lower-cases and drops white space
        alphabet = byte_alphabet()
        self.shown = {i: "".join(alphabet[b] for b in chr(i).encode()) for i in range(256)}
        self.line_feed = b"" if self.words else self.whole("\n")
        self.marks: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        ids = self.tok.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, dtype=self.dtype).tobytes()

    def __missing__(self, chunk: str) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            if chunk.isascii() and chunk.isalpha():
                ids = self._letters(chunk)
            elif not self.words and chunk[:1] == BREAK:
                ids = self.line_feed + self._start(chunk[1:])
            else:
                letters = chunk.rstrip(MARKS)
                if not PLAIN.fullmatch(letters):
                    ids = self.whole(chunk if self.words else " " + chunk)
                elif len(letters) < len(chunk):
                    ids = self[letters] + self._after(chunk[len(letters):])
                else:
                    ids = self._letters(letters)
        self[chunk] = ids
        return ids

    def _letters(self, word: str) -> bytes:
        """Ids of a chunk of letters alone."""
        if self.words:
            low = word.lower()
            return self._model(low) if low == word else self[low]
        return self._model(word, self.shown[32])

    def _model(self, word: str, before: str = "") -> bytes:
        shown = before + (word if word.isascii() else word.translate(self.shown))
        return array(self.code, [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _after(self, marks: str) -> bytes:
        ids = self.marks.get(marks)
        if ids is None:
            ids = self.marks[marks] = self.whole(marks)
        return ids

    def _start(self, chunk: str) -> bytes:
        """Ids of a chunk without a space before it."""
        letters = chunk.rstrip(MARKS)
        if not PLAIN.fullmatch(letters):
            return self.whole(chunk)
        return self._model(letters) + (self._after(chunk[len(letters):]) if len(letters) < len(chunk) else b"")

    def ids(self, text: str | None) -> bytes:
        """Ids of a whole text; null is empty."""
        if not text:
            return b""
        if 2 * len(self) > self.chunks:
            self.old = dict(self)
            self.clear()
            self.marks = {}
        get = self.__getitem__
        if self.words:
            return b"".join(map(get, text.replace("\n", " ").split(" ")))
        flat = text.replace("\n", " ")
        # Equal only if all white space is single spaces and line feeds between words.
        if " ".join(flat.split()) != flat or BREAK in text or any(s in text for s in self.specials):
            return self.whole(text)
        chunks = text.replace("\n", " " + BREAK).split(" ")
        return self._start(chunks[0]) + b"".join(map(get, chunks[1:]))

    def batch(self, texts: list[str | None]) -> list[bytes]:
        return [self.ids(t) for t in texts]


_ENCODERS: dict[tuple[str, int], ChunkEncoder] = {}


def encoder(path: str, width: int = 4, chunks: int | None = None) -> ChunkEncoder:
    """The worker's encoder for a vocabulary file; ``chunks``: how many it may keep."""
    if (path, width) not in _ENCODERS:
        _ENCODERS[path, width] = ChunkEncoder(path, width, chunks)
    return _ENCODERS[path, width]


def id_width(path: str) -> int:
    """Bytes that every id of a vocabulary file fits: 2 or 4."""
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else 4


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
