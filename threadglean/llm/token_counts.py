"""Token counts (5): whole-token shortcut for a sentencepiece BPE model.

A vocabulary string that the model, asked once per worker, encodes alone as
one token is counted as one wherever it stands as a pre-token; only other
pre-tokens are merged by the model, once each while they stay in the worker's
table. A pre-token is a run of spaces with the characters up to the next space.
That cut is right because no piece of the vocabulary holds a space after another
character, so no merge crosses it; a model of another kind is refused.
"""

import re

import pyarrow as pa
import sentencepiece
from pyspark.sql import functions as F

SPACE = "▁"
_UNIT = re.compile(" +[^ ]*")


class UnitCounts(dict):
    """Pre-token (without its first space) -> number of tokens."""

    def __init__(self, model_file, keep):
        super().__init__()
        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.keep = keep
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece crosses a space: pre-tokens can't be counted apart")
        if self.model.encode("  a ", out_type=str)[0][0] != SPACE:
            raise ValueError("the model drops or moves spaces")
        words = [p[1:] for p in pieces if p.startswith(SPACE) and len(p) > 1]
        words = [w for w in words if not w.startswith(SPACE)]
        # The proof: encoded alone, the string is that one piece.
        self.whole = {w: 1 for w, ids in zip(words, self.model.encode(words, out_type=str))
                      if ids == [SPACE + w]}
        self.update(self.whole)

    def __missing__(self, unit):
        n = self[unit] = len(self.model.encode(unit)) if unit else 1
        return n

    def count(self, text):
        if not text:
            return 0
        if len(self) > self.keep:
            self.clear()
            self.update(self.whole)
        text = text.replace(SPACE, " ")
        if "  " in text or text[0] == " " or text[-1] == " ":
            return sum(self[unit[1:]] for unit in _UNIT.findall(" " + text))
        return sum(map(self.__getitem__, text.split(" ")))


_tables = {}


def _table(model_file, keep):
    key = (model_file, keep)
    if key not in _tables:
        _tables[key] = UnitCounts(model_file, keep)
    return _tables[key]


def count_tokens(docs, model_file, *, limit=4096, id_col="doc_id", text_col="text", keep=500_000):
    """doc_id, n_bytes, n_tokens, over_limit of every row of `docs`.

    Null and empty texts have 0 bytes and tokens. Rows that repeat, and null
    ids, are kept as they are; other columns are not read. Each text is counted
    whole, so the longest text bounds memory with the `keep` pre-tokens of the
    worker's table. An empty table gives an empty one.
    """

    def run(batches):
        table = _table(model_file, keep)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            counts = [table.count(t) for t in texts]
            sizes = [len(t.encode("utf-8")) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()),
                 pa.array([c > limit for c in counts], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
