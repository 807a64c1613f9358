"""Token ids of a byte-level BPE vocabulary file, fast enough for whole corpora.

The ids are those of the ``tokenizers`` library for the same file. ``tiktoken`` computes them, since
it needs a fifth of the time; texts that could hold a very long unbroken run go through ``tokenizers``,
whose merge does not grow with the square of a run's length. Tests hold both against each other.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Callable

import numpy as np

VOCABULARY = "byte_bpe_50k.json"
#: texts up to this length cannot hold a run that is slow to merge
SHORT = 20_000
_LONG_RUN = re.compile(r"\S{4000}|\s{4000}")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def _byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves, the others as letters from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.lru_cache(maxsize=2)
def encoder(path: str | None = None) -> Callable[[str], np.ndarray]:
    """``text -> ids`` (uint32); strings of special tokens in a text become these tokens."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    path = path or default_path()
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {x["content"]: x["id"] for x in spec["added_tokens"]}
    letters = _byte_of_letter()
    ranks = {bytes(map(letters.__getitem__, token)): i for token, i in spec["model"]["vocab"].items() if token not in special}
    fast = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    slow = Tokenizer.from_file(path)

    def encode(text: str) -> np.ndarray:
        if len(text) > SHORT and _LONG_RUN.search(text):
            return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return fast.encode_to_numpy(text, allowed_special="all")

    return encode
