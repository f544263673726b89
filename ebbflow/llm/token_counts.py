"""Token counts by the whole-token shortcut (operator 10).

Once a worker, the vocabulary strings that encode alone as one token are proved with
the library (``word_tokens.prove_whole_tokens``). Per text, pre-tokens among
them count one; only the others are merged, once per distinct word.

Results by case: null or empty text: 0 bytes, 0 tokens. A text of any length
is counted whole, within one task. Repeated rows: one result row each. A null
id stays null. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from ebbflow.llm.common import id_and_text, prepare, record
from ebbflow.llm.word_tokens import token_ids

SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 2048,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` per row; a narrow job without a shuffle."""
    prepare(docs.sparkSession)

    def run(batches):
        ids = token_ids(tokenizer_path)
        for b in batches:
            texts = b.column("text").to_pylist()
            n = [ids.count(t) for t in texts]
            yield record(SCHEMA, doc_id=b.column("doc_id"), n_bytes=[len(t.encode()) for t in texts],
                         n_tokens=n, over_limit=[x > limit for x in n])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
