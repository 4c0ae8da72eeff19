"""Public byte-level BPE in worker processes."""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np

SPECIAL = "<|endoftext|>"  # fixed value: the vocabulary's one special token


def default_paths() -> tuple[str, str]:
    """The vocabulary as ``tokenizers`` JSON and as ``tiktoken`` ranks."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def _full(json_path: str):
    """Loaded only by a worker that meets the special token: it is a second vocabulary in memory."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(json_path)


@lru_cache(maxsize=2)
def byte_pairs(ranks_path: str) -> frozenset:
    """Pairs of bytes that follow one another in any token: elsewhere no merge can happen."""
    with open(ranks_path, "rb") as f:
        tokens = (base64.b64decode(line.split()[0]) for line in f)
        return frozenset(pair for t in tokens for pair in zip(t, t[1:]))


@lru_cache(maxsize=2)
def encoder(json_path: str, ranks_path: str):
    """``text -> ids`` (uint32 array), the ids that ``tokenizers`` gives for the JSON
    vocabulary without added special tokens.

    The ranks file holds the same vocabulary and encodes several times
    faster; a text that spells the special token, which only the JSON file
    defines, goes through ``tokenizers`` itself.
    """
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})

    def encode(text: str) -> np.ndarray:
        if SPECIAL in text:
            return np.array(_full(json_path).encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(fast.encode_ordinary(text), np.uint32)

    return encode
