"""Sizes of texts in tokens of a public tokenizer (its vocabulary file is a parameter, never part of the library)."""

from __future__ import annotations

import base64

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
_cache: dict[str, object] = {}


def load(path: str | None = None):
    """The tokenizer of a rank file; by default the public multilingual one."""
    import public_tokenizers
    import tiktoken

    path = path or public_tokenizers.path(VOCABULARY)
    if path not in _cache:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _cache[path] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _cache[path]


def token_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), path: str | None = None) -> DataFrame:
    """id, n_tokens and the columns to keep; null texts count 0.  Whole texts are encoded."""
    types = dict(docs.dtypes)

    def run(batches):
        enc = load(path)
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(n, pa.int64())], names=[*b.schema.names[1:], "n_tokens"])

    cols = [id_col, *keep]
    schema = ", ".join(f"`{c}` {types[c]}" for c in cols) + ", n_tokens bigint"
    return docs.select(F.col(text).alias("text_"), *cols).mapInArrow(run, schema)
