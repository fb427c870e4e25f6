"""Sizes of texts in tokens of a public tokenizer, whose vocabulary file is a parameter."""

from __future__ import annotations

import base64
import importlib.util
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Fixed value: the pattern that goes with the byte-level vocabularies
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_vocabulary() -> str:
    """byte_bpe_multi_50k.tiktoken of the public tokenizers: in /opt/tokenizers, or where TOKENIZER_FILE says."""
    return os.environ.get("TOKENIZER_FILE", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")


def _vocabulary(path: str) -> str:
    if os.path.exists(path):
        return path
    spec = importlib.util.find_spec("public_tokenizers")
    return os.path.join(os.path.dirname(spec.origin), os.path.basename(path)) if spec and spec.origin else path


def encoder(path: str):
    """A byte-level BPE encoder; special strings in a text are ordinary text."""
    import tiktoken

    with open(_vocabulary(path), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_token_counts(docs: DataFrame, text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """docs with n_tokens in place of the text; a null or empty text has none, a long one is counted whole."""
    path = vocabulary or default_vocabulary()
    kept = [c for c in docs.columns if c not in (text, "n_tokens")]
    schema = ", ".join([*[f"`{c}` {t}" for c, t in docs.dtypes if c in kept], "n_tokens bigint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            sizes = [len(enc.encode_ordinary(x)) if x else 0 for x in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sizes, pa.int64())], names=[*kept, "n_tokens"])

    return docs.select(*[f"`{c}`" for c in kept], text).mapInArrow(run, schema)
