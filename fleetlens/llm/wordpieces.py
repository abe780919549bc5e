"""Token ids of the lower-casing, word-end byte-pair vocabulary.

The tokenizer never makes a token across white space, so a text may be cut at any space. Parts made
of plain Latin letters, digits, signs and white space are cut into words here and encoded from the
same file's merges by the faster encoder (a word's end is one more byte, a space, which is merged
before anything else); chunks with any other character, or that spell a special token, go to the
tokenizer itself. Tests compare all of it with the tokenizer.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np

WORD_END = "</w>"
PART = 1 << 20
#: Characters whose class and lower case are the same in both encoders and that no normal form changes.
PLAIN = r"[\x00-\x1b\x20-\x7eÀ-ÖØ-öø-ÿ‐-‧€]*"
#: Words of the tokenizer's own pattern, for lower-cased plain text.
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ\s]+").findall
_SPACE = re.compile(r"[ \n]")


def byte_signs() -> dict[str, int]:
    """The sign that byte-level vocabularies write for each byte: printable Latin-1 as it is, the rest from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def parts(text: str, size: int = PART) -> Iterator[str]:
    """A text in parts of about ``size`` characters, cut at spaces (a part without any is longer)."""
    at = 0
    while len(text) - at > size and (cut := text.find(" ", at + size)) >= 0:
        yield text[at:cut]
        at = cut + 1
    yield text[at:]


class WordEncoder:
    """Ids of texts as uint16 arrays, equal to those of the tokenizer file at ``path``."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer
        whole = Tokenizer.from_file(path)
        if whole.get_vocab_size() > 1 << 16:
            raise ValueError("ids must fit in 16 bits")
        self.exact = lambda text: whole.encode(text, add_special_tokens=False).ids
        special = [t.content for t in whole.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)) if special else r"(?!)").search
        self.plain = re.compile(PLAIN).fullmatch
        signs = byte_signs()
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        ranks = {bytes(signs[c] for c in token.removesuffix(WORD_END)) + b" " * token.endswith(WORD_END): i
                 for token, i in vocabulary.items() if token not in special}
        self.merges = tiktoken.Encoding("words", pat_str=r"[^ ]+ ", mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def _usual(self, text: str) -> bool:
        return self.plain(text) is not None and not self.special(text)

    def _fast(self, text: str) -> list[int]:
        words = _WORDS(text.lower())
        return self.merges(" ".join(words) + " ") if words else []

    def _part(self, text: str) -> list[int]:
        if self._usual(text):
            return self._fast(text)
        out: list[int] = []
        for usual, chunks in groupby(_SPACE.split(text), self._usual):
            out += (self._fast if usual else self.exact)(" ".join(chunks))
        return out

    def ids(self, text: str | None) -> np.ndarray:
        """Ids of a whole text (null: none)."""
        return np.concatenate([np.array(self._part(p), dtype="<u2") for p in parts(text or "")])
