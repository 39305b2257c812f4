"""Token counts of whole texts by batch encoding; only lengths leave the functions.

Texts are cut at safe boundaries, where no piece of the vocabulary can lie across, so
counts of the parts add up to the count of the whole text. Parts are encoded once while
their counts are kept; batches hold about equal bytes whatever the lengths of the texts.
"""

import re

import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of text that make a batch; longer texts are read in runs of this length.
BATCH_CHARS = 1 << 20
#: Distinct parts whose counts a task keeps, ...
KEPT_PARTS = 1_000_000
#: ... none of them longer than this.
KEPT_CHARS = 64
TOKEN_LIMIT = 4_096

#: The blank of a piece; the encoder reads it and U+0020 as the same.
_BLANK = "▁"
_RUNS = re.compile("\n[^ \n]*| +[^ \n]*")
_WORDS_AROUND = re.compile(f"[^ \n{_BLANK}] [^ \n{_BLANK}]")


def check_pieces(encoder: sentencepiece.SentencePieceProcessor) -> None:
    """Raise unless a blank only begins pieces and no piece holds a line feed.

    This is what makes the place before a blank, and both sides of a line feed, safe.
    """
    for i in range(encoder.get_piece_size()):
        piece = encoder.id_to_piece(i)
        if _BLANK in piece.lstrip(_BLANK) or "\n" in piece:
            raise ValueError(f"piece {i} lies across a boundary")


class Tokens:
    """Token counts of parts. Those of short parts are kept, so each is encoded once."""

    def __init__(self, path: str):
        self.encoder = sentencepiece.SentencePieceProcessor(model_file=path)
        check_pieces(self.encoder)
        self.kept: dict[str, int] = {"": 1}

    def _lengths(self, parts: list[str]) -> list[int]:
        # the encoder puts a blank before each text, which is one more token before a line feed
        ids = self.encoder.encode(parts, num_threads=1)
        return [len(i) - p.startswith("\n") for p, i in zip(parts, ids)]

    def counts(self, texts: list[list[str]]) -> list[int]:
        """One count per list of parts."""
        new = list({p for parts in texts for p in parts if p not in self.kept})
        known = dict(zip(new, self._lengths(new)))
        if len(self.kept) + len(new) > KEPT_PARTS:
            self.kept = {"": 1}
            new = list({p for parts in texts for p in parts if p})
            known = dict(zip(new, self._lengths(new)))
        self.kept.update(known)
        totals = [sum(map(self.kept.__getitem__, parts)) for parts in texts]
        for part in new:
            if len(part) > KEPT_CHARS:
                del self.kept[part]
        return totals


def parts_of(text: str) -> list[str]:
    """The text cut before blanks and line feeds.

    A part stands for itself after one blank (the first one's is the encoder's own), or
    begins with a line feed and stands for itself.
    """
    text = text.replace(_BLANK, " ")
    if "  " in text or " \n" in text or text.startswith(" ") or text.endswith(" "):
        # a run of blanks stays with the word after it
        return [p if p[0] == "\n" else p[1:] for p in _RUNS.findall(" " + text)]
    return text.replace("\n", " \n").split(" ")


def runs(text: str, limit: int):
    """The text in runs of about ``limit`` characters that begin with a blank."""
    at = 0
    while len(text) - at > limit:
        cut = text.find(" ", at + limit)
        while cut > 0 and not _WORDS_AROUND.match(text, cut - 1):
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut + 1
    yield text[at:]


def batches_of(texts, limit: int):
    """(row, parts) of all texts in lists of about equally many characters."""
    batch, size = [], 0
    for row, text in enumerate(texts):
        for run in runs(text, limit) if text else ():
            batch.append((row, parts_of(run)))
            size += len(run)
            if size >= limit:
                yield batch
                batch, size = [], 0
    if batch:
        yield batch


def _count(path: str, limit: int):
    def count(batches):
        known = Tokens(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            tokens = [0] * len(texts)
            for part in batches_of(texts, BATCH_CHARS):
                for (row, _), n in zip(part, known.counts([parts for _, parts in part])):
                    tokens[row] += n
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).cast(pa.int64())
            over = [n > limit for n in tokens]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), sizes, pa.array(tokens, pa.int64()),
                 pa.array(over, pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return count


def token_counts(docs: DataFrame, path: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_tokens, over_limit.

    ``path`` is a sentencepiece model that every executor can read. No begin, end or
    other token is added. A NULL or empty text has no token. Rows that repeat are
    counted like all others, other columns are ignored, and no row gives no result.
    """
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(
        _count(path, limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
