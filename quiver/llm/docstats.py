"""Per-document counts over a slice of texts, shared by the quality operators."""

from __future__ import annotations

import numpy as np

from .common import BYTE_VALUE, Prefix, Slice, mix64, per_doc_sum

_U = np.uint64
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True


def _repeats(key: np.ndarray) -> np.ndarray:
    """Whether each key occurs at least twice in the array."""
    if not len(key):
        return np.zeros(0, bool)
    order = np.argsort(key, kind="stable")
    k = key[order]
    same = np.zeros(len(k), bool)
    eq = k[1:] == k[:-1]
    same[1:] |= eq
    same[:-1] |= eq
    out = np.empty(len(k), bool)
    out[order] = same
    return out


def distinct_per_doc(key: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Distinct keys of each row; keys must already depend on the row."""
    if not len(key):
        return np.zeros(n, np.int64)
    _, first = np.unique(key, return_index=True)
    return np.bincount(row[first], minlength=n)


def base_counts(s: Slice) -> dict[str, np.ndarray]:
    """n_words, word_chars (code points in words), n_symbols, n_lines (with a
    word), n_dup_lines (equal to an earlier line with a word), n_repeat_words
    (words inside a 3-word window found twice or more) and the arrays they
    come from."""
    data, n = s.data, s.n
    ws, we, wrow = s.words()
    hash_of = Prefix(BYTE_VALUE[data])
    starts_char = (data & 0xC0) != 0x80
    chars = np.concatenate([[0], np.cumsum(starts_char, dtype=np.int64)])
    out = {"n_words": np.bincount(wrow, minlength=n).astype(np.int64)}
    out["word_chars"] = np.bincount(wrow, weights=chars[we] - chars[ws], minlength=n).astype(np.int64)
    out["n_symbols"] = per_doc_sum(SYMBOL[data], s.start)
    # lines with a word
    lo, hi, lrow = s.lines()
    w_before = np.searchsorted(ws, lo)
    with_word = w_before < np.searchsorted(ws, hi)
    lo, hi, lrow = lo[with_word], hi[with_word], lrow[with_word]
    salt = mix64(np.arange(1, n + 1, dtype=np.uint64))
    line_key = mix64(hash_of(lo, hi) ^ salt[lrow])
    out["n_lines"] = np.bincount(lrow, minlength=n).astype(np.int64)
    out["n_dup_lines"] = out["n_lines"] - distinct_per_doc(line_key, lrow, n)
    # words in repeated 3-word windows
    wh = hash_of(ws, we)
    hit = np.zeros(len(ws), bool)
    if len(ws) >= 3:
        k = mix64(wh[:-2] + salt[wrow[:-2]] * _U(3))
        k = mix64(k * _U(0x9E3779B97F4A7C15) + wh[1:-1])
        k = mix64(k * _U(0x9E3779B97F4A7C15) + wh[2:])
        at = np.flatnonzero(wrow[:-2] == wrow[2:])
        at = at[_repeats(k[at])]
        hit[at] = True
        hit[at + 1] = True
        hit[at + 2] = True
    out["n_repeat_words"] = np.bincount(wrow[hit], minlength=n).astype(np.int64)
    out["_word"], out["_wrow"], out["_salt"] = wh, wrow, salt
    out["_wlen"] = chars[we] - chars[ws]
    return out
