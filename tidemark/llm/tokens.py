"""Byte-level token ids of texts, made by a public tokenizer file named by its path.

The ids are those of ``tokenizers`` for the file. Texts are encoded by ``tiktoken`` from
the same vocabulary, several times faster, wherever both are known to agree: no special
token's text, no character from U+3000 on (where the libraries' Unicode tables may
differ) and no run of over 1,000 characters without a blank. Other texts go through
``tokenizers`` itself.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np

_APART = re.compile("[　-\U0010ffff]")
LONG_RUN = 1_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(b): b for b in plain}
    for i, b in enumerate(b for b in range(256) if b not in set(plain)):
        table[chr(256 + i)] = b
    return table


class Encoder:
    """``ids`` of a text, and the number of bytes each id stands for."""

    def __init__(self, path: str) -> None:
        import public_tokenizers
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as f:
            content = json.load(f)
        byte_of, vocab = _byte_of(), content["model"]["vocab"]
        special = {t["content"]: t["id"] for t in content["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in piece): i for piece, i in vocab.items() if piece not in special}
        self._fast = tiktoken.Encoding("given", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._special = tuple(special)
        self.lengths = np.zeros(max([*ranks.values(), *special.values()]) + 1, dtype="int64")
        for piece, i in [*ranks.items(), *((s.encode(), i) for s, i in special.items())]:
            self.lengths[i] = len(piece)
        self._slow = None

    def ids(self, text: str) -> np.ndarray:
        if not (
            any(s in text for s in self._special) or (not text.isascii() and _APART.search(text))
            or (len(text) > LONG_RUN and max(map(len, text.split()), default=0) > LONG_RUN)
            or (len(text) > LONG_RUN and " " * LONG_RUN in text)
        ):
            return np.array(self._fast.encode_ordinary(text), dtype="<u4")
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.path)
        return np.array(self._slow.encode(text, add_special_tokens=False).ids, dtype="<u4")


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path)
