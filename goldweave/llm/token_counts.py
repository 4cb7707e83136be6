"""Number of tokens of each text."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from goldweave.llm.chunks import library_encoder, slices
from goldweave.llm.tables import id_type, schema, texts


def count_tokens(rows: DataFrame, tokenizer: str, spaces: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = 1024) -> DataFrame:
    """One row per input row: the id, ``n_bytes``, ``n_tokens`` and ``over_limit``.

    Arrow batches are taken in slices of about equal bytes. Texts of any length are cut at
    spaces no token crosses, so a long text is many small encodings; the encoder returns
    lengths only. How white space is treated is read from the file; ``spaces="whole"`` cuts nothing.

    A null or empty text has 0 bytes and 0 tokens. Null ids, equal ids and repeated rows are
    counted like any other row; an empty table gives an empty one; other columns are left out.
    """
    out = schema(id_type(rows, id_col), "n_bytes long, n_tokens long, over_limit boolean", id_col)

    def run(batches):
        encoder = library_encoder(tokenizer, spaces)
        for batch in batches:
            for start, column in slices(batch.column(1)):
                n = encoder.counts(column)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(column)),
                     pc.binary_length(column).cast(pa.int64()), pa.array(n, pa.int64()),
                     pa.array(n > limit)],
                    names=out.names,
                )

    return texts(rows, id_col, text_col).mapInArrow(run, out)
