"""Token counts of whole texts with the whole-token shortcut.

The vocabulary strings that encode alone as one token are proven once per worker. A pre-token among them counts one
without any merging; only the rest is merged.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from callwise.llm.common import map_texts, texts
from callwise.llm.tokens import count_with, encoder, VOCABULARY, whole_tokens


@lru_cache(maxsize=2)
def _counter(vocabulary: str):
    return count_with(lambda piece: len(encoder(vocabulary).encode(piece)), whole_tokens(vocabulary))


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens)`` for every row, repeated ones and those without an id too.

    The count is that of the tokenizer itself without begin, end or added tokens; special strings inside a text count as
    the one token the tokenizer makes of them. Null and empty texts have none. No shuffle; other columns are not read.
    """

    def each(ids: list, raws: list) -> dict:
        count = _counter(vocabulary)
        return {
            "doc_id": pa.array(ids, pa.int64()),
            "n_bytes": pa.array([len(r) for r in raws], pa.int64()),
            "n_tokens": pa.array([count(r.decode()) for r in raws], pa.int64()),
        }

    return map_texts(texts(docs, id_col, text_col), each, "doc_id bigint, n_bytes bigint, n_tokens bigint")
