"""Sizes of texts in tokens of a public tokenizer, whose files lie in a folder given as a parameter."""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The folder of the vocabulary files, on every executor.
FOLDER = os.environ.get("FERRULE_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
# Fixed value: how byte-level BPE parts a text into words.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def encoder(folder: str, vocabulary: str):
    """The tokenizer, loaded once in a Python worker."""
    import tiktoken

    with open(os.path.join(folder, vocabulary), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
    return tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def n_tokens(column: str | Column, folder: str = FOLDER, vocabulary: str = VOCABULARY) -> Column:
    """Tokens of a whole text; 0 for null and empty ones. Strings of special tokens count as ordinary text."""

    def count(texts: pd.Series) -> pd.Series:
        e = encoder(folder, vocabulary)
        return texts.map(lambda t: len(e.encode_ordinary(t)) if isinstance(t, str) and t else 0).astype("int64")

    return F.pandas_udf(count, "bigint")(column)


def sized(texts: DataFrame, key: str = "doc_id", column: str = "text", keep: tuple[str, ...] = (), folder: str = FOLDER) -> DataFrame:
    """(key, keep, n_tokens), a row for each text; rows repeated with their key count once."""
    once = texts.select(key, column, *keep).dropDuplicates([key])
    return once.select(key, *keep, n_tokens(column, folder).alias("n_tokens"))
