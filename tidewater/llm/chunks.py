"""Cut a text where a byte-level BPE pre-tokenizer always cuts.

The split pattern of these vocabularies never lets a piece run from a visible
character into white space. In a text without two adjacent white-space
characters a piece therefore always starts at each space and stands around
each line feed, whatever else the text holds, so the parts between can be
encoded one by one and remembered. Other texts are left whole."""

from __future__ import annotations

import re

_ADJACENT = re.compile(r"\s\s")


def chunks(text: str) -> list[str]:
    """Parts whose encodings, joined, are the encoding of ``text``."""
    if not text:
        return []
    if text[-1].isspace() or text[0].isspace() or "\0" in text or _ADJACENT.search(text):
        return [text]
    return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
