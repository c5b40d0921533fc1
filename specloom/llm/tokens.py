"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specloom.session import spread

#: A rank file of a byte-level BPE; any other of the same kind may be named instead.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"

# Fixed value: the public pattern by which byte-level BPE splits text before merging.
_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@cache
def encoder(vocabulary: str):
    """The tokenizer of a rank file, once per process."""
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("specloom", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_sizes(documents: DataFrame, columns: dict, vocabulary: str = VOCABULARY) -> DataFrame:
    """``columns`` (name -> column of ``documents``) and ``tokens`` (int) of each document with text; null and empty texts are left out."""
    kept = documents.where("text IS NOT NULL AND text <> ''").select(*(c.alias(n) for n, c in columns.items()), F.col("text").alias("__text"))
    kept = spread(kept)
    fields = [f for f in kept.schema.fields if f.name != "__text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", tokens int"

    def size(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary).encode_ordinary
        for batch in batches:
            yield batch.drop(columns="__text").assign(tokens=[len(encode(t)) for t in batch["__text"]])

    return kept.mapInPandas(size, schema)
