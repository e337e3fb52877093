"""Counts of one text that the quality operators vote and learn on."""

from __future__ import annotations

import numpy as np

# The characters counted as symbols, and ASCII white space.
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"
_START = np.array([(i & 0xC0) != 0x80 for i in range(256)])
_SPACE = np.isin(np.arange(256), list(SPACE))
# bytes of words with letters: ASCII letters and the bytes of all other scripts
_LETTER = np.array([i > 127 or chr(i).isalpha() for i in range(256)]).astype(np.int32)
ENDS = (b".", b"!", b"?", b'"', b":")

FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_letter_words", "n_ended_lines")


def repeated_words(ids: np.ndarray, n_ids: int, window: int = 3) -> int:
    """Words that lie in a window found twice or more."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    key = ids[:n]
    top = n_ids
    for i in range(1, window):
        if top * n_ids >= 2**62:
            key = np.unique(key, return_inverse=True)[1]
            top = len(ids)
        key = key * n_ids + ids[i: n + i]
        top *= n_ids
    _, inv, cnt = np.unique(key, return_inverse=True, return_counts=True)
    hit = np.zeros(len(ids), dtype=bool)
    twice = cnt[inv] > 1
    for i in range(window):
        hit[i: n + i] |= twice
    return int(hit.sum())


def stats(text: str | None) -> tuple[int, ...]:
    """The ``FIELDS`` of a text; a null text counts as empty."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return (0, 0, sum(raw.count(bytes([c])) for c in SYMBOLS), *[0] * 6)
    byte = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    chars = int(byte[_START].sum() - sum(byte[c] for c in SPACE))
    ids: dict[bytes, int] = {}
    seq = np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int64)
    at = np.frombuffer(raw, dtype=np.uint8)
    inside = ~_SPACE[at]
    first = np.flatnonzero(inside & np.r_[True, ~inside[:-1]])
    letters = np.add.reduceat(_LETTER[at], first)
    seen: set[bytes] = set()
    lines = dup = ended = 0
    for line in raw.split(b"\n"):
        s = line.strip(SPACE)
        if s:
            lines += 1
            ended += s.endswith(ENDS)
            if line in seen:
                dup += 1
            seen.add(line)
    return (len(words), chars, int(sum(byte[c] for c in SYMBOLS)), dup, repeated_words(seq, len(ids)), lines, len(ids), int((letters > 0).sum()), ended)
