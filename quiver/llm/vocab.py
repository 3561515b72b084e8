"""Tokenizers of given vocabulary files, inside tasks.

The driver reads a file once and sends its bytes (one to two megabytes); a
Python worker builds the tokenizer once and keeps it for its later tasks.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"

#: Fixed value: the word pattern that byte-level pre-tokenisation stands for.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The pattern's matcher gives up within very long white space; runs of this
#: length go to the slower library.
LONG_GAP = 4000
_GAP = re.compile(r"\s{%d}" % LONG_GAP)

_built: dict[tuple, object] = {}


def file_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def cached(kind, raw: bytes, *args):
    """The tokenizer of these bytes, built once a worker."""
    key = (kind, raw, *args)
    if key not in _built:
        _built[key] = kind(raw, *args)
    return _built[key]


def byte_alphabet() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def has_long_gap(text: str) -> bool:
    """Whether the text has ``LONG_GAP`` white-space characters in a row (of
    which at least two stand at sampled places)."""
    return len(text) >= LONG_GAP and any(c.isspace() for c in text[::LONG_GAP // 2]) and _GAP.search(text) is not None


class ByteBpe:
    """A byte-level BPE vocabulary (``tokenizers`` JSON).

    ``plain`` reads the strings of special tokens as ordinary text.  Where ids
    follow the order of the merges (which is checked), the ranks alone give the
    same ids, and a faster encoder is used.
    """

    def __init__(self, raw: bytes, plain: bool = False):
        from tokenizers import Tokenizer

        self.plain = plain
        self.slow = Tokenizer.from_str(raw.decode())
        self.slow.encode_special_tokens = plain
        spec = json.loads(raw)
        model, alphabet = spec["model"], byte_alphabet()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*model["vocab"].values(), *special.values()]) + 1
        self.spelt = [b""] * self.size
        for token, i in model["vocab"].items():
            self.spelt[i] = token.encode() if token in special else bytes(alphabet[c] for c in token)
        for token, i in special.items():
            self.spelt[i] = token.encode()
        self.fast = None
        merged = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
        first = 256
        ordered = all(model["vocab"].get(m.replace(" ", "")) == first + k for k, m in enumerate(merged))
        pre = spec.get("pre_tokenizer") or {}
        if ordered and spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex"):
            import tiktoken
            self.fast = tiktoken.Encoding("given", pat_str=WORDS, special_tokens=special,
                                          mergeable_ranks={self.spelt[i]: i for t, i in model["vocab"].items() if t not in special})

    def encode(self, text: str) -> np.ndarray:
        if self.fast is None or has_long_gap(text):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        if self.plain:
            return self.fast.encode_to_numpy(text, disallowed_special=())
        return self.fast.encode_to_numpy(text, allowed_special="all")


class PieceBpe:
    """A SentencePiece model and the bytes its ids spell."""

    def __init__(self, raw: bytes):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=raw)
        self.size = self.sp.get_piece_size()
        self.spelt = [bytes([int(p[3:-1], 16)]) if self.sp.is_byte(i) else p.replace("▁", " ").encode()
                      for i in range(self.size) for p in [self.sp.id_to_piece(i)]]

    def encode(self, texts: list[str]) -> pa.ListArray:
        return pa.array(self.sp.encode(texts, num_threads=1), pa.list_(pa.int32()))
