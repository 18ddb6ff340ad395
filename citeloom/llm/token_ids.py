"""Token ids of whole texts inside tasks, as the ``tokenizers`` library gives them.

The tokenizer file defines the ids. Its library encodes some 2 MB of text a second,
most of it spent on splitting; the same vocabulary as ranks, in the file beside it,
gives the same ids through ``tiktoken`` several times as fast. Both split by one
pattern over the classes letter, number and white space, so they can differ only where
their Unicode tables do: a test compares them on every code point and finds no
difference. Texts that hold the string of a special token, and all texts where there
is no rank file, are encoded by ``tokenizers`` itself.
"""

from __future__ import annotations

import base64
import functools
import os
from pathlib import Path

import numpy as np

#: How a byte-level vocabulary splits a text before its merges; fixed with the vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class TokenIds:
    """Encodes texts by a tokenizer file, and by the rank file of the same name beside it."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.fast, ranks = None, Path(path).with_suffix(".tiktoken")
        if ranks.exists():
            import tiktoken

            pairs = (line.split() for line in ranks.read_bytes().splitlines() if line)
            self.fast = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})

    def by_library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def by_ranks(self, text: str) -> bytes:
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        slow = [self.fast is None or any(s in t for s in self.special) for t in texts]
        rest = iter(self.by_library([t for t, s in zip(texts, slow, strict=True) if s]))
        return [next(rest) if s else self.by_ranks(t) for t, s in zip(texts, slow, strict=True)]


@functools.cache
def token_ids(path: str) -> TokenIds:
    """One encoder for each worker and file."""
    return TokenIds(path)
