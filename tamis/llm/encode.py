"""Problem 8: token ids of a whole corpus."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame

from tamis.llm import bpe
from tamis.session import spread


def corpus_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "byte_bpe_50k.tiktoken", folder: str = bpe.TOKENIZERS) -> DataFrame:
    """``id_col`` and ``ids``: the token ids of each text, one row for each row of ``docs``.

    Null and empty texts give an empty list; repeated rows come out as often as they stand; an
    empty table gives no rows. Other columns, whatever their names, are left out. Nothing is
    shuffled: the texts are encoded where they are read, in Arrow batches.
    """
    kind = dict(docs.dtypes)[id_col]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        enc = bpe.encoder(tokenizer, folder)
        for b in batches:
            offsets = np.zeros(b.num_rows + 1, np.int32)
            flat, at = [], 0
            for i, text in enumerate(b.column(1).to_pylist()):
                if text:
                    parts = list(enc.parts(text))
                    at += sum(map(len, parts))
                    flat.append(np.fromiter(chain.from_iterable(parts), np.int32))
                offsets[i + 1] = at
            values = np.concatenate(flat) if flat else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], names=[id_col, "ids"])

    return spread(docs.select(id_col, text_col)).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")
