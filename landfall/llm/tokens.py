"""Token ids of whole texts with a public byte-level BPE vocabulary, inside tasks."""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np

#: Files of the public vocabulary: the tokenizer itself, and the same merges as ranks.
TOKENIZER_FILE = "byte_bpe_50k.json"
RANK_FILE = "byte_bpe_50k.tiktoken"
#: The id that the vocabulary keeps for the end of a document, and its string.
END_OF_TEXT = 50256
END_STRING = "<|endoftext|>"


@lru_cache(maxsize=4)
def _ranked(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
    return tiktoken.Encoding(
        "byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
    )


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def encoder(ordinary: bool = False):
    """A function from a text to its ids (uint32).

    Both libraries give the same ids for this vocabulary, the ranked form several times
    faster. They differ only where a text holds the end-of-text string: the tokenizer file
    reads it as that special id, unless `ordinary` is set, which makes it plain text.
    Lone surrogates, which UTF-8 cannot hold, do not reach Python from Spark.
    """
    import public_tokenizers

    ranked = _ranked(public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)
    path = public_tokenizers.path(TOKENIZER_FILE)

    def encode(text: str) -> np.ndarray:
        if not ordinary and END_STRING in text:
            return np.array(_tokenizer(path).encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(ranked.encode_ordinary(text), np.uint32)

    return encode
