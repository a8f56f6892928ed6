"""Documents coded in blocks: one row per about ``BLOCK_TOKENS`` tokens, with the
block's distinct words and the texts as numbers of these words.

What must be known of a word (its corpus count, its pieces) is then asked once
for each block and not for each occurrence, which keeps frequent words small.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged
from .packing import pack

BLOCK_TOKENS = 2_000_000

_SCHEMA = "block long, ids array<bigint>, flags array<boolean>, lengths binary, codes binary, words array<binary>"


class _Block:
    def __init__(self):
        self.known, self.ids, self.flags, self.codes, self.lengths, self.n = {}, [], [], [], [], 0

    def row(self, number: int) -> pa.RecordBatch:
        codes = np.concatenate(self.codes) if self.codes else np.empty(0, np.int32)
        # frequent words have small numbers, which pack well
        order = np.argsort(-np.bincount(codes, minlength=len(self.known)), kind="stable")
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        codes, known = place[codes], list(self.known)
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([self.ids], pa.list_(pa.int64())),
             pa.array([self.flags], pa.list_(pa.bool_())),
             pa.array([pack(np.array(self.lengths, np.int32))], pa.binary()),
             pa.array([pack(codes)], pa.binary()), pa.array([[known[k] for k in order]], pa.list_(pa.binary()))],
            ["block", "ids", "flags", "lengths", "codes", "words"])


def _coder(make_tokens: Callable, most: int):
    def run(batches):
        from pyspark import TaskContext

        tokens = make_tokens()
        number, b = TaskContext.get().partitionId() << 32, _Block()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for i, flag, text in zip(*(part.column(k).to_pylist() for k in range(3))):
                    words = tokens(text)
                    known = b.known
                    codes = np.array([known.setdefault(w, len(known)) for w in words], np.int32)
                    b.ids.append(i)
                    b.flags.append(flag)
                    b.codes.append(codes)
                    b.lengths.append(len(codes))
                    b.n += len(codes)
                    if b.n >= most:
                        yield b.row(number)
                        number, b = number + 1, _Block()
        if b.ids:
            yield b.row(number)
    return run


def code_blocks(docs: DataFrame, make_tokens: Callable, flag=None, most: int = BLOCK_TOKENS) -> DataFrame:
    """Written table of the blocks of ``doc_id, text`` rows; ``flag``: a boolean
    column that goes with each document; ``most``: the tokens that fill a block.
    ``make_tokens()`` is called in each
    task and gives the function from a text (or null) to its tokens (bytes)."""
    flag = F.lit(False) if flag is None else flag
    return staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), flag.alias("flag"), "text")
                  .mapInArrow(_coder(make_tokens, most), _SCHEMA))


def block_words(blocks: DataFrame, *more: str) -> DataFrame:
    """``block, i, word``: the distinct words of each block with their numbers."""
    return blocks.select("block", *more, F.posexplode("words").alias("i", "word"))
