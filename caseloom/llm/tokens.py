"""Token counts of whole texts with a public tokenizer, in Arrow batches."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A tokenizer file that every executor can read; a parameter of the operators. Ranks (``.tiktoken``) are the fastest.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: Fixed value: how the byte-level vocabularies split a text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_loaded: dict = {}


def _counter(path: str):
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path.endswith(".tiktoken"):
            import tiktoken

            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            encoding = tiktoken.Encoding(os.path.basename(path), pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
            _loaded[path] = lambda texts: [len(encoding.encode_ordinary(t)) for t in texts]
        elif path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _loaded[path] = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer

            t = Tokenizer.from_file(path)
            t.encode_special_tokens = True
            _loaded[path] = lambda texts: [len(x.ids) for x in t.encode_batch(texts, add_special_tokens=False)]
    return _loaded[path]


def spread(df: DataFrame, least_bytes: int = 1 << 18) -> DataFrame:
    """A table too small to fill the cores (below ``least_bytes`` each, by its size estimate) is dealt out over them; any other is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * least_bytes else df


def with_tokens(df: DataFrame, keep: list[str], text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """``keep`` and ``tokens``, the tokens of the whole text. NULL and empty texts have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(tokenizer)
        for b in batches:
            counts = count([t or "" for t in b.column(len(keep)).to_pylist()])
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(counts, pa.int64())], [*keep, "tokens"])

    source = spread(df.select(*keep, F.col(text).alias("_text")))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[: len(keep)])
    return source.mapInArrow(run, schema + ", tokens bigint")
