"""Token counts of texts by a public tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Where the vocabulary is, if the caller names no other file: ranks of a byte-level BPE.
DEFAULT_TOKENIZER = os.environ.get("ENTILAKE_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: How this family of vocabularies cuts a text before merging (fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def _made(ranks: bytes):
    import tiktoken

    lines = (line.split() for line in ranks.splitlines() if line.strip())
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in lines}, special_tokens={})


def _ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encoder(path: str):
    """The tokenizer of a rank file."""
    return _made(_ranks(path))


def token_counts(df: DataFrame, keys: list[str], text: str = "text", tokenizer: str = DEFAULT_TOKENIZER) -> DataFrame:
    """`keys` and n_tokens INT, the number of tokens of the whole text. NULL and empty texts have 0. Strings that look
    like special tokens are ordinary text. Other columns never reach Python; no shuffle. Only the driver needs the file of
    the vocabulary, which goes to the workers once each."""
    source = df.select(*keys, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    out = T.StructType([*[source.schema[k] for k in keys], T.StructField("n_tokens", T.IntegerType())])
    shared = df.sparkSession.sparkContext.broadcast(_ranks(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _made(shared.value).encode_ordinary
        for batch in batches:
            counts = pa.array([len(encode(t)) for t in batch.column(len(keys)).to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], counts], names=[*keys, "n_tokens"])

    return source.mapInArrow(run, out)
