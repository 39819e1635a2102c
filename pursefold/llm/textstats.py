"""Counts over one whole text, shared by the rules and the quality model."""

from __future__ import annotations

import numpy as np

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"
UPPER = bytes(range(65, 91))


def word_ids(words: list[bytes]) -> np.ndarray:
    """Numbers equal exactly where the words are equal."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def repeated_words(ids: np.ndarray, window: int = 3) -> int:
    """Words inside windows of so many words that occur twice or more."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    keys = ids[:n]
    for k in range(1, window):
        if len(ids) >= 1 << 20 and k > 1:  # else the product fits into 63 bits
            keys = np.unique(keys, return_inverse=True)[1]
        keys = keys * np.int64(len(ids)) + ids[k : n + k]
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(ids), bool)
    for k in range(window):
        covered[k : n + k] |= twice
    return int(covered.sum())


def counts(text: bytes) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (with a word), n_upper (A-Z)."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    spaces = sum(map(text.count, (SPACES[i : i + 1] for i in range(6))))
    chars = len(text.decode()) - spaces if words else 0
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    upper = len(text) - len(text.translate(None, UPPER))
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(word_ids(words)), len(lines), upper
