"""Tokens of a byte-level BPE vocabulary, word by word with a bounded cache.

The pre-tokenizer of the vocabulary puts a boundary before a single space that stands between two visible characters,
and merges never cross it. So a text can be cut there, and each piece encoded alone gives the same ids as in its text.
Pieces repeat much more than texts, and their ids are kept as bytes, so a text is a lookup per piece and one join.
The cache only saves work: when it is full it starts anew.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
CACHED = 400_000
#: Between two visible characters; Python counts at least what the vocabulary's pre-tokenizer counts as white space.
_GAP = re.compile(r"(?<=\S) (?=\S)")
_WHITE = re.compile(r"\s\s")
#: Letters that every Unicode version classes alike: what else occurs goes to the tokenizer itself.
_PLAIN = re.compile("[\x20-\x7e\nÀ-ÖØ-öø-ſ]*")


def pieces(text: str) -> list[str]:
    """The text cut at every single space between visible characters; those spaces are left out."""
    if _WHITE.search(text) is None and text[:1] != " " and text[-1:] != " ":
        return text.split(" ")
    return _GAP.split(text)


class Encoder:
    """``ids(text)`` as little-endian unsigned 32-bit integers, as the tokenizer of ``vocabulary`` gives them."""

    def __init__(self, vocabulary: str = VOCABULARY, ranks: str = RANKS, cached: int = CACHED) -> None:
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(public_tokenizers.path(ranks), "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.merge = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.first: dict[str, bytes] = {}
        self.rest: dict[str, bytes] = {}
        self.cached = cached

    def encode(self, text: str) -> list[int]:
        """The ranks are the same vocabulary; they merge faster and know no special strings."""
        if _PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return self.merge.encode_ordinary(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _piece(self, table: dict[str, bytes], piece: str, before: str) -> bytes:
        out = table.get(piece)
        if out is None:
            if len(table) >= self.cached:
                table.clear()
            out = np.array(self.encode(before + piece), "<u4").tobytes()
            if len(piece) < 64:
                table[piece] = out
        return out

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        parts = pieces(text)
        head = self._piece(self.first, parts[0], "")
        del parts[0]
        try:
            return head + b"".join(map(self.rest.__getitem__, parts))
        except KeyError:
            return head + b"".join([self._piece(self.rest, p, " ") for p in parts])


@lru_cache(maxsize=2)
def encoder(vocabulary: str = VOCABULARY, ranks: str = RANKS) -> Encoder:
    """One per Python worker."""
    return Encoder(vocabulary, ranks)


@lru_cache(maxsize=2)
def whole_tokens(vocabulary: str = VOCABULARY) -> frozenset[str]:
    """Vocabulary strings proven to encode alone as one token: each is decoded and encoded again, once per worker."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    strings = [tokenizer.decode([i], skip_special_tokens=False) for i in range(tokenizer.get_vocab_size())]
    strings = [s for s in strings if "�" not in s and s not in special]
    return frozenset(s for s, e in zip(strings, tokenizer.encode_batch(strings, add_special_tokens=False), strict=True) if len(e.ids) == 1)


def count_with(count_rest: Callable[[str], int], whole: frozenset[str], cached: int = CACHED) -> Callable[[str], int]:
    """Count tokens: pieces that are whole tokens count one, all others are merged by ``count_rest`` and remembered."""
    ones = {s[1:]: 1 for s in whole if s[:1] == " " and len(s) > 1 and not _WHITE.search(s) and " " not in s[1:]}
    known = dict(ones)
    firsts: dict[str, int] = {}

    def other(piece: str) -> int:
        nonlocal known
        n = known.get(piece)
        if n is None:
            n = count_rest(" " + piece)
            if len(known) >= cached + len(ones):
                known = dict(ones)
            if len(piece) < 64:
                known[piece] = n
        return n

    def count(text: str) -> int:
        if not text:
            return 0
        parts = pieces(text)
        first = parts.pop(0)
        if first not in firsts:
            if len(firsts) >= cached:
                firsts.clear()
            firsts[first] = 1 if first in whole else count_rest(first)
        n = firsts[first]
        try:
            return n + sum(map(known.__getitem__, parts))
        except KeyError:
            return n + sum(map(other, parts))

    return count
