"""Words of texts as UTF-8 bytes: runs of digits, letters and characters above ASCII, A-Z lower-cased."""

from __future__ import annotations

import numpy as np

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: np.ndarray) -> list[bytes]:
    """Words of a text that is given as its UTF-8 bytes, in order. Every other byte has become a blank."""
    return text.tobytes().translate(_FOLD).split()
