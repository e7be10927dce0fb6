"""Numbers of tokens of a public tokenizer, whole texts at a time in Arrow batches."""

from __future__ import annotations

import os
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"  # where the vocabulary file lies on driver and executors


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    return tokenizer


def count_tokens(texts: list[str], path: str = TOKENIZER) -> list[int]:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return [len(x.ids) for x in _tokenizer(path).encode_batch(texts, add_special_tokens=False)]


def token_count(text: Column, path: str = TOKENIZER) -> Column:
    """Tokens of a text; 0 for null and empty text. Equal texts of a batch are counted once."""

    @F.pandas_udf(T.LongType())
    def counted(texts: pd.Series) -> pd.Series:
        codes, distinct = pd.factorize(texts, use_na_sentinel=True)
        counts: list[int] = []
        for start in range(0, len(distinct), 64):  # long texts must not all be held as tokens at once
            counts += count_tokens(list(distinct[start : start + 64]), path)
        return pd.Series([0 if c < 0 else counts[c] for c in codes], dtype="int64")

    return counted(text)
