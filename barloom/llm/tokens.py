"""Encoded lengths of texts under a public byte-level vocabulary."""

from __future__ import annotations

import base64
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.scratch import ship_package

#: A ranks file that every executor can read at this path.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How that vocabulary cuts a text before merging; a fixed value of the public vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def encoder(vocabulary: str = VOCABULARY, pattern: str = PATTERN):
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_count(text: str | None, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> int:
    return len(encoder(vocabulary, pattern).encode_ordinary(text)) if text else 0


def token_counts(documents: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """(doc_id, n_tokens) of every row; whole texts, null and empty ones have 0. Nothing is shuffled."""

    ship_package(documents.sparkSession)

    def batches(stream):
        for batch in stream:
            counts = [token_count(text.as_py(), vocabulary, pattern) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["doc_id", "n_tokens"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", F.col("text").cast("string")).mapInArrow(batches, f"doc_id {kind}, n_tokens bigint")
