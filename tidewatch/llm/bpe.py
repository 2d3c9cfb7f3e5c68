"""Operator 3: BPE encoding and decoding over a prefix-sharing trie.

`encode` turns a text column into ids, `decode` ids into text. Each task keeps
the encodings of the distinct words it has met (bounded, see wordbpe.MAX_WORDS)
and encodes only new ones, through the trie; texts are then joined from words.
Nothing is shuffled: a text of any length, a hot source or a word in every
document costs its task the reading of its own rows.

Null texts count as empty (no ids); null ids decode to an empty text. Repeated
rows are encoded each; columns besides the text pass through, and a column with
the output's name is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm import common
from tidewatch.llm.wordbpe import encoder


#: Rows that are worked on at a time, of those that Spark sends together.
ROWS = 1000


def _with(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name != name] + [T.StructField(name, kind)])


def _put(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    keep = [i for i, n in enumerate(batch.schema.names) if n != name]
    return pa.RecordBatch.from_arrays(
        [*(batch.column(i) for i in keep), values], names=[*(batch.schema.names[i] for i in keep), name]
    )


def ids_array(packed: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(p) // 4 for p in packed)])
    flat = np.frombuffer(b"".join(packed), np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def encode(df: DataFrame, path: str, *, text: str = "text", ids: str = "ids") -> DataFrame:
    """df with the column ids: array<int>, the tokens of the whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = [t or "" for t in part.column(text).to_pylist()]
                yield _put(part, ids, ids_array(bpe.packed(texts)))

    return df.mapInArrow(run, _with(df, ids, T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, path: str, *, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """df with the column decoded: the tokens' own strings joined by spaces,
    special tokens kept. An id outside the vocabulary has no string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(encoder(path).names)
        for batch in batches:
            lists = pc.fill_null(batch.column(ids), pa.scalar([], batch.column(ids).type))
            lengths = pc.list_value_length(lists)
            ends = np.concatenate([[0], np.cumsum(lengths.to_numpy(zero_copy_only=False))])
            flat = names.take(lists.flatten())
            yield _put(batch, decoded, pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat), " "))

    return df.mapInArrow(run, _with(df, decoded, T.StringType()))


def op3_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode(docs, path).drop("text")
    coded = coded.select("doc_id", "ids", F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"))
    back = decode(coded, path)
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids_sha256",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
