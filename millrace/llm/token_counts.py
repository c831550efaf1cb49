"""Exact token counts of a sentencepiece BPE model with a whole-token shortcut.

Spaces become the mark U+2581, and no piece of the model has a mark after another character or holds a character that
the vocabulary lacks.  So no merge crosses from a word into the marks of the next one, nor a character outside the
vocabulary (such as a line feed), and a text falls into pre-tokens whose counts add up.  `whole_tokens` proves offline
which vocabulary strings encode alone as one token; pre-tokens among them count 1 by a look-up, and the rest are
merged by the library, once per worker and word.  A pre-token that opens a text or follows a line feed without a space
has no mark; the model's rule of putting a mark before a text is undone by encoding such pre-tokens after a line feed.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import raw, settle, worker_memo

MEMO_WORDS = 400_000
LIMIT = 4096
_MARK = "▁"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def load_model(path: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path)


def provable(model) -> bool:
    """Whether the cut into pre-tokens is sound for this model: marks only at the start of a piece, no line feed in
    any piece, white space kept as it is, and a mark put before every text."""
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    inside = any(_MARK in p.lstrip(_MARK) or "\n" in p for p in pieces)
    probe = "a  b \n c "
    kept = model.decode(model.encode(probe)) == probe
    return not inside and kept and model.id_to_piece(model.encode("a")[0])[0] == _MARK


def whole_tokens(model) -> set[bytes]:
    """Pre-tokens, with their spaces, that the model gives as exactly one token."""
    found = set()
    line_feed = len(model.encode("\n"))
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
            continue
        piece = model.id_to_piece(i)
        text = piece.replace(_MARK, " ")
        ids = model.encode("\n" + text)
        if len(ids) == line_feed + 1 and ids[-1] == i:
            found.add(text.encode())
    return found


class Counts(dict):
    """Pre-token (with its leading spaces) to its number of tokens."""

    def __init__(self, path: str):
        self.model = load_model(path)
        if not provable(self.model):
            raise ValueError(f"the pre-token cut is not proved for {path}")
        self.line_feed = len(self.model.encode("\n"))
        self.whole = dict.fromkeys(whole_tokens(self.model), 1)
        super().__init__(self.whole)

    def __missing__(self, token: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
            self.update(self.whole)
        count = self[token] = len(self.model.encode("\n" + token.decode())) - self.line_feed
        return count

    def text_tokens(self, text: bytes) -> int:
        """Tokens of a text: the mark before it, then pre-tokens of each line; a line feed is `line_feed` - 1 more."""
        if not text:
            return 0
        text = b" " + text.replace(b"\xe2\x96\x81", b" ")
        total = 0
        for number, line in enumerate(text.split(b"\n")):
            if number:
                total += self.line_feed - 1
            if not line:
                continue
            words = line.split(b" ")
            if words[0]:
                total += self[words[0]]
            if b"" in words[1:]:
                spaces = b" "
                for word in words[1:]:
                    if word:
                        total += self[spaces + word]
                        spaces = b" "
                    else:
                        spaces += b" "
                if len(spaces) > 1:
                    total += self[spaces[:-1]]
            else:
                total += sum(map(self.__getitem__, [b" " + w for w in words[1:]]))
        return total


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """Tokens of every whole text: doc_id, n_bytes, n_tokens, over_limit.  Null and empty texts have none."""
    settle(docs.sparkSession)
    path = path or default_path()

    def run(batches):
        counts = worker_memo(f"piece_counts:{path}", lambda: Counts(path))
        for batch in batches:
            texts = [t or b"" for t in raw(batch.column("text"))]
            n = [counts.text_tokens(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
