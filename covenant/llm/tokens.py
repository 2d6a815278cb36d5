"""Token ids of whole texts by a public byte-level BPE, with a cache of space-led words.

The vocabulary's pattern never lets a token cross from a non-space into a space
that a non-space follows, so a text can be cut before every such space and the
pieces encoded, and remembered, on their own.  Texts with a space before other
white space, or with a special token's mark, go to the tokenizer whole.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cached_property

import numpy as np

VOCABULARY = "byte_bpe_50k"
CACHE = 300_000

#: Characters on whose classes the two libraries cannot differ.
_PLAIN = re.compile(r"[\x00-\x7fÀ-ɏ]*")
_MADE: dict[str, Encoder] = {}


class Encoder(dict):
    """Word -> ids of " " + word as little-endian 32-bit bytes; None where the word cannot be encoded alone."""

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        import tiktoken

        super().__init__()
        self.json_path = json_path
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.quick = tiktoken.Encoding(ranks_path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def whole(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.json_path)

    @cached_property
    def literal(self):
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(self.json_path)
        made.encode_special_tokens = True
        return made

    def slow(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _alone(self, text: str) -> bytes:
        if _PLAIN.fullmatch(text):
            return np.array(self.quick.encode_ordinary(text), "<u4").tobytes()
        return self.slow(text)

    def __missing__(self, word: str) -> bytes | None:
        if len(self) >= CACHE:
            self.clear()
        self[word] = ids = None if not word or word[0].isspace() else self._alone(" " + word)
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a text, as `tokenizers` gives them without added special tokens."""
        if "<|" in text:
            return self.slow(text)
        first, *rest = text.split(" ")
        try:
            return (self._alone(first) if first else b"") + b"".join(map(self.__getitem__, rest))
        except TypeError:  # a None among them
            return self.slow(text)

    def ordinary(self, text: str) -> bytes:
        """Ids of a text in which a special token's mark is text like any other."""
        return np.array(self.literal.encode(text, add_special_tokens=False).ids, "<u4").tobytes() if "<|" in text else self.encode(text)


def encoder(vocabulary: str = VOCABULARY) -> Encoder:
    """The encoder of this worker process, made at first use from the machine's installed files."""
    if vocabulary not in _MADE:
        import public_tokenizers as files

        _MADE[vocabulary] = Encoder(files.path(f"{vocabulary}.json"), files.path(f"{vocabulary}.tiktoken"), files.PATTERN)
    return _MADE[vocabulary]


@contextmanager
def encoding(vocabulary: str = VOCABULARY) -> Iterator[Encoder]:
    """The encoder for the time of one task; the worker process lives on without it."""
    try:
        yield encoder(vocabulary)
    finally:
        _MADE.pop(vocabulary, None)
