"""Character classes the tokenizers' split patterns rely on."""

from __future__ import annotations

import re

# Fixed value: white space as Unicode defines it.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

#: Ranges whose letters and digits are older than the tokenizers' character tables.
_SETTLED = re.compile("[\0-\u05ff\u0900-\u1c7f\u1d00-\u2bff\u3000-\u9fff\uac00-\ud7ff\uf900-\uffff]*")


def is_settled(text: str) -> bool:
    """True if all characters belong to blocks that every Unicode version classifies alike.

    Texts with others (newer scripts, symbols beyond the basic plane) are split by the library itself.
    """
    return text.isascii() or _SETTLED.fullmatch(text) is not None
