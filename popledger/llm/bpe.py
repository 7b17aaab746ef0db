"""BPE encoding and decoding of whole texts with a streaming transducer.

Texts are split at the tokenizer's pattern (``pretokens``); every different piece goes through the transducer of ``transducer``
once per task and cache period, and the ids are put together with array operations. Decoding maps ids to bytes and runs
them through an incremental byte-to-text machine.

Defined results: a null or empty text has no ids and decodes to an empty text; strings of special tokens in a text
become their id; repeated rows are encoded each; ids below 0 or unknown decode to nothing. Other columns are not read. Memory of a task
follows its longest text (ids of one text are one value), not the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from popledger.llm.common import keyed, lean, prepare
from popledger.llm.pretokens import BatchEncoder
from popledger.llm.transducer import decoder, transducer


@lru_cache(maxsize=2)
def encoder(path: str) -> BatchEncoder:
    t = transducer(path)
    return BatchEncoder(lambda pieces: [t.encode(p.encode("utf-8", errors="replace")) for p in pieces], t.m.special)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit integers) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            ids = enc([x or "" for x in batch.column(1).to_pylist()])
            yield pa.record_batch(
                [batch.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())],
                names=["doc_id", "n_tokens", "ids"],
            )

    prepare(docs.sparkSession)
    return keyed(docs, key, text).mapInArrow(lean(run), "doc_id bigint, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with the text of its ids as ``decoded``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dec = decoder(path)
        for batch in batches:
            texts = [dec.text(np.frombuffer(x or b"", dtype="<u4")) for x in batch.column(2).to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], names=["doc_id", "n_tokens", "ids", "decoded"])

    prepare(encoded.sparkSession)
    return encoded.select("doc_id", "n_tokens", F.col("ids")).mapInArrow(lean(run), "doc_id bigint, n_tokens bigint, ids binary, decoded string")
