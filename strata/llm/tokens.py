"""Token ids through the `tokenizers` library, cached by part of a text.

With a tokenizer that drops white space and splits by SPLIT, no token, merge or
normalisation reaches over ASCII white space: a text's ids are those of its
chunks between such spaces.  Other tokenizers get whole texts.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import SparkSession

from strata.llm.common import kept

CACHE = 250_000          # parts that a worker remembers for certain, at most twice that in all
# Fixed value: the split pattern for which the shortcuts below hold.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# The same split for ASCII and Latin-1 letters, which no normalisation changes but for case.
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zà-öø-ÿß]+|[0-9]|[^ \t\n\r\x0b\x0ca-zà-öø-ÿß0-9]+")
_OTHER = re.compile(r"[^\x00-\x7fÀ-ÖØ-öø-ÿ]|<\|")
_CHUNK = re.compile(r"[^ \t\n\r\x0b\x0c]+")


class WordIds:
    """The tokenizer file, read on the driver and broadcast (a vocabulary's size
    does not depend on the data)."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, encoding="utf-8") as f:
            self.json = spark.sparkContext.broadcast(f.read())
        self.key = uuid.uuid4().hex

    def encoder(self) -> Callable[[str], bytes]:
        """text -> ids as little-endian unsigned 32-bit, without special tokens added."""
        return kept(self.key, lambda: _encoder(self.json.value))


def _encoder(json_text: str) -> Callable[[str], bytes]:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(json_text)

    def ids(text: str) -> bytes:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    split = (json.loads(json_text).get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
    if (split.get("pattern"), split.get("behavior"), split.get("invert")) != ({"Regex": SPLIT}, "Removed", True):
        return ids
    part = _Recent(ids).__getitem__

    def encode(text: str) -> bytes:
        if _OTHER.search(text) is None:
            return b"".join(map(part, _PARTS.findall(text.lower())))
        return b"".join([b"".join(map(part, _PARTS.findall(c.lower()))) if _OTHER.search(c) is None else ids(c)
                         for c in _CHUNK.findall(text)])

    return encode


class _Recent(dict):
    """Values of a function, those not asked for lately forgotten."""

    def __init__(self, make):
        super().__init__()
        self.make, self.before = make, {}

    def __missing__(self, key: str) -> bytes:
        found = self.before.get(key)
        if found is None:
            found = self.make(key)
        if len(key) <= 64:
            if len(self) >= CACHE:
                self.before = dict(self)
                self.clear()
            self[key] = found
        return found
