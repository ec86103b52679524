"""Words of letters and digits, for the operators that compare with a target or a benchmark.

A word is a maximal run outside ``\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F`` after A-Z are lowered: ASCII letters,
digits and every code point beyond ASCII. ``plain`` maps all other bytes to a space, byte by byte,
so that ``textkit.Words`` finds these words; offsets stay as they are.
"""

from __future__ import annotations

import numpy as np

_KEEP = np.zeros(256, bool)
_KEEP[48:58] = _KEEP[65:91] = _KEEP[97:123] = _KEEP[128:] = True
PLAIN = np.where(_KEEP, np.arange(256), 0x20).astype(np.uint8)
PLAIN[65:91] += 32

#: the same words in DuckDB, from a column ``text``
SQL_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


def plain(data: np.ndarray) -> np.ndarray:
    return PLAIN[data]
