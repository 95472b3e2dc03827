"""Exact token counts with a two-tier lookup inside the map tasks.

The model never merges across the start of a run of spaces, nor across bytes that no piece
contains, so a text's count is the sum over its pre-tokens (a run of spaces and the non-space run
after it; checked against the model's vocabulary when a worker loads it).  Tier one is a broadcast
table of the lengths of frequent pre-tokens, found by Spark's bounded frequent-items sketch over all
rows; tier two is a cache of each Python worker, which encodes a miss once.  Pre-tokens are never
shuffled: only the sketches (of a fixed size per task) are.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.session import ship

# Entries of the broadcast table, and items that each sketch tracks.
FREQUENT = 4096
TRACKED = 16384
# Longest pre-token that is kept in the table or cached (bytes); longer ones are encoded each time.
LONGEST = 64
# Entries of a worker's cache; when it is full it starts anew from the broadcast table.
CACHE = 400_000

_SPACE_RUN = re.compile(" *[^ ]+| +")


def frequent_words(docs: DataFrame, text: str, k: int = FREQUENT) -> list[str]:
    """At most ``k`` of the commonest space-separated words of all rows."""
    words = docs.select(F.explode(F.split(F.col(text), " ")).alias("w")).where((F.col("w") != "") & (F.octet_length("w") <= LONGEST))
    # Two levels, so that no task merges the sketches of all partitions.
    part = words.groupBy((F.spark_partition_id() % 64).alias("p")).agg(F.expr(f"approx_top_k_accumulate(w, {TRACKED})").alias("s"))
    # Grouped by a constant: without rows there is no group, and so no table.
    top = part.groupBy((F.col("p") * 0).alias("all")).agg(F.expr("approx_top_k_combine(s)").alias("s")).select(F.expr(f"approx_top_k_estimate(s, {k})").alias("top")).first()
    return [row["item"] for row in (top["top"] if top and top["top"] else [])]


def load_model(path: str):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    inner = [p for p in (model.id_to_piece(i) for i in range(model.get_piece_size())) if "▁" in p.lstrip("▁")]
    if inner:
        raise ValueError(f"pieces that cross a space, e.g. {inner[0]!r}: counts are not additive over pre-tokens")
    return model


class Counter(dict):
    """Pre-token -> tokens.  A key is what follows the space that the model puts before a text."""

    def __init__(self, model, frequent: dict[str, int]):
        super().__init__(frequent)
        self.model, self.frequent = model, frequent

    def __missing__(self, key: str) -> int:
        n = len(self.model.encode(key))
        if len(key) <= LONGEST:
            if len(self) >= CACHE:
                self.clear()
                self.update(self.frequent)
            self[key] = n
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        if "▁" in text:  # the model's own mark for a space
            text = text.replace("▁", " ")
        if "  " in text or text[0] == " " or text[-1] == " ":
            return sum(self[run[1:]] if run != " " else self._space() for run in _SPACE_RUN.findall(" " + text))
        return sum(map(self.__getitem__, text.split(" ")))

    def _space(self) -> int:
        """A single space at the end of a text."""
        return len(self.model.encode("a ")) - len(self.model.encode("a"))


def _count(path: str, frequent, text: str, names: list[str]):
    def run(batches):
        counter = Counter(load_model(path), frequent.value)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            cols = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([counter.count(t) for t in texts], pa.int64())], names=[*names, "_n_tokens"])

    return run


def count_tokens(docs: DataFrame, model_path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``_n_tokens`` to the columns ``keep`` (default: all): what the sentencepiece model at
    ``model_path`` (present on every worker) gives for the whole text, without special tokens.

    Null and empty texts have none.  Repeated rows are counted each; an empty table gives no rows.
    """
    names = list(keep if keep is not None else docs.columns)
    if "_n_tokens" in names:
        raise ValueError("reserved column name in the input: _n_tokens")
    ship(docs.sparkSession)
    model = load_model(model_path)
    frequent = {w: len(model.encode(w)) for w in frequent_words(docs, text) if "▁" not in w}
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    schema = T.StructType([*[docs.schema[n] for n in names], T.StructField("_n_tokens", T.LongType())])
    return docs.select(*dict.fromkeys([*names, text])).mapInArrow(_count(model_path, shared, text, names), schema)
