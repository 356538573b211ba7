"""Exact token counts under an existing public tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

#: Where the vocabulary files lie on every machine, and the one that is used unless another is named.
TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Fixed value: the published pattern that splits text before the merges of a byte-level rank file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def encoding(folder: str, vocabulary: str):
    """The tokenizer of a rank file, loaded once per worker process."""
    import tiktoken

    with open(os.path.join(folder, vocabulary), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}
    return tiktoken.Encoding(vocabulary, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(text: Column, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> Column:
    """Tokens of the whole text. Null and empty texts have 0; strings of special tokens are ordinary text."""

    @F.pandas_udf(LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoding(folder, vocabulary).encode_ordinary
        for texts in batches:
            yield pd.Series([len(encode(t)) if t else 0 for t in texts], dtype="int64")

    return count(text)
