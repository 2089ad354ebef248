"""Word-end BPE ids of white-space chunks, equal to the ``tokenizers`` library.

No match of the vocabulary's split pattern holds white space, so a text's ids
are the ids of its white-space chunks in order, and each distinct chunk needs
encoding once.  Chunks of common Latin characters go through the byte-pair
core of ``tiktoken`` (the word end ``</w>`` written as byte 0xFF, which UTF-8
never holds; ranks are the vocabulary's ids, which follow the merge order);
every other chunk goes through ``tokenizers`` itself.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

MEMO = 400_000  # distinct chunks remembered per worker; the memo is emptied beyond
_SAFE = re.compile("[!-~À-ÖØ-öø-ſ]*")
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class WordBpe:
    """Encoder of one vocabulary file (its JSON text)."""

    def __init__(self, vocabulary: str):
        byte_of = _byte_of_char()
        ranks = {}
        for token, i in json.loads(vocabulary)["model"]["vocab"].items():
            last = token.endswith("</w>")
            body = token[:-4] if last else token
            ranks[bytes(byte_of[c] for c in body) + (b"\xff" if last else b"")] = i
        self.core = tiktoken.Encoding("word", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.full = Tokenizer.from_str(vocabulary)
        self.full.encode_special_tokens = True
        self.memo: dict[bytes, bytes] = {}

    def chunk(self, chunk: bytes) -> bytes:
        """Ids of one chunk, as little-endian unsigned 32-bit integers."""
        text = chunk.decode("utf-8")
        if not _SAFE.fullmatch(text):
            return np.array(self.full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        ids: list[int] = []
        for part in _SPLIT.findall(unicodedata.normalize("NFC", text).lower()):
            ids += self.core.encode_single_piece(part.encode() + b"\xff")
        return np.array(ids, "<u4").tobytes()

    def chunks(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of distinct chunks."""
        memo, out = self.memo, []
        for c in chunks:
            ids = memo.get(c)
            if ids is None:
                if len(memo) >= MEMO:
                    memo.clear()
                ids = memo[c] = self.chunk(c)
            out.append(ids)
        return out


@lru_cache(maxsize=2)
def word_bpe(vocabulary: str) -> WordBpe:
    """One encoder per worker process and vocabulary."""
    return WordBpe(vocabulary)
