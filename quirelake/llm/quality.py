"""Quality rules: counts of a text by itself, and lines that too many documents of a host share.

Normalised lines are hashed and counted by distinct documents per host. Lines on
enough of them are boilerplate: they are removed, and documents that they made up for the
most part are rejected.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelake.llm.words import LineHashes, WordHashes, shingles, word_hashes
from quirelake.llm.workspace import written

BLANKS = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
#: Words of the windows whose repeats are counted.
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: A line is boilerplate on so many distinct documents of its host, however large the host is.
LINE_DOCUMENTS = 20
#: A document is depleted when more than so many percent of its words are boilerplate.
DEPLETED_PERCENT = 50
#: Parts that a common line or a group of copies is joined in.
SALTS = 16
#: Documents that a task takes out of Arrow at a time.
SLICE = 1000

_DIGITS = re.compile(rb"[0-9]+")


def normalised(line: bytes) -> bytes:
    """Lower case, single blanks, every number as 0."""
    return _DIGITS.sub(b"0", b" ".join(line.lower().split()))


def repeated_words(words: np.ndarray) -> int:
    """Words covered by windows that occur twice or more in the text, the first included."""
    if len(words) <= WINDOW:
        return 0
    windows = shingles(words, WINDOW)
    _, inverse, count = np.unique(windows, return_inverse=True, return_counts=True)
    again = (count[inverse] > 1).astype(np.int32)
    if not again.any():
        return 0
    edges = np.zeros(len(words) + 1, np.int32)
    edges[: len(again)] += again
    edges[WINDOW : WINDOW + len(again)] -= again
    return int((np.cumsum(edges)[: len(words)] > 0).sum())


def base_counts(text: bytes, table: WordHashes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    bare = text.translate(None, BLANKS)
    lines = [line for line in text.split(b"\n") if line.strip(BLANKS)]
    words = word_hashes(text, table, lower=False)
    return (
        len(words),
        len(bare.decode("utf-8", "replace")),
        len(bare) - len(bare.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def line_words(text: bytes, table: WordHashes) -> dict[int, int]:
    """Words by hash of the normalised line; lines without a word are left out."""
    found: dict[int, int] = {}
    for line in text.split(b"\n"):
        bare = normalised(line)
        if bare:
            key = table[bare]
            found[key] = found.get(key, 0) + bare.count(b" ") + 1
    return found


def _measure(batches):
    table, lines = WordHashes(), LineHashes()
    for batch in batches:
        counts, hashes, sizes = [], [], []
        for text in batch.column("text").to_pylist():
            text = text or b""
            counts.append(base_counts(text, table))
            held = line_words(text, lines)
            found = np.fromiter(held, np.uint64, len(held))
            hashes.append(found.view(np.int64))
            sizes.append(np.fromiter(held.values(), np.int64, len(held)))
        arrays = [batch.column("doc_id"), batch.column("host"), batch.column("page")]
        arrays += [pa.array(c, pa.int64()) for c in zip(*counts)] or [pa.array([], pa.int64())] * 5
        arrays += [
            pa.array(hashes, pa.list_(pa.int64())),
            pa.array(sizes, pa.list_(pa.int64())),
        ]
        yield pa.RecordBatch.from_arrays(arrays, _COLUMNS)


_COLUMNS = ["doc_id", "host", "page", "n_words", "word_chars", "n_symbols", "n_dup_lines",
            "n_repeat_words", "lines", "sizes"]
_SCHEMA = (
    "doc_id long, host string, page binary, n_words long, word_chars long, n_symbols long, n_dup_lines long,"
    " n_repeat_words long, lines array<long>, sizes array<long>"
)


def _page(host: F.Column, text: F.Column) -> F.Column:
    """The same for rows of one host with exactly the same text; a NULL text is an empty one."""
    of = F.coalesce(F.md5(host.cast("string")), F.lit("-" * 32)).cast("binary")
    return F.unhex(F.md5(F.concat(of, F.coalesce(text.cast("binary"), F.lit(b"")))))


def _measured(docs: DataFrame, host: str) -> DataFrame:
    return docs.select(
        "doc_id", F.col(host).cast("string").alias("host"), _page(F.col(host), F.col("text")).alias("page"),
        F.col("text").cast("binary").alias("text"),
    ).mapInArrow(_measure, _SCHEMA)


def boilerplate(measured: DataFrame) -> DataFrame:
    """(page, gone, common): pages that hold boilerplate, how many of their words it is, and
    its lines. Rows with exactly the same text are one document of their host.

    Pages meet the counted lines line by line; a line that very many pages hold is dealt
    out by page.
    """
    distinct = written(
        measured.groupBy("page").agg(F.struct(F.first("host").alias("host"), F.first("lines").alias("lines"),
                                              F.first("sizes").alias("sizes")).alias("one"))
        .select("page", "one.*")
    )
    common = written(
        distinct.select("host", F.explode("lines").alias("line"))
        .groupBy("host", "line").agg(F.count("*").alias("n"))
        .where(F.col("n") >= LINE_DOCUMENTS).select(F.col("host").alias("of"), "line")
    )
    held = distinct.select(
        "page", "host", F.explode(F.arrays_zip("lines", "sizes")).alias("x")
    ).select("page", "host", F.col("x.lines").alias("held"), F.col("x.sizes").alias("size"),
             F.pmod(F.xxhash64("page"), F.lit(SALTS)).cast("int").alias("salt"))
    common = common.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return (
        held.join(common, held.host.eqNullSafe(common["of"]) & (held.held == common.line)
                  & (held.salt == common.part))
        .groupBy("page").agg(F.sum("size").alias("gone"), F.collect_list("line").alias("common"))
    )


def _beside(rows: DataFrame, depleting: DataFrame) -> DataFrame:
    """``rows`` (page, salt, ...) with what ``boilerplate`` says of their pages, or NULL;
    copies of a page are dealt out by salt."""
    parts = depleting.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    parts = parts.withColumnRenamed("page", "__of")
    on = (rows["__page"] == parts["__of"]) & (rows["__salt"] == parts["__part"])
    return rows.join(parts, on, "left").drop("__of", "__part")


def _salt(*columns: str) -> F.Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int").alias("__salt")


def judged(measured: DataFrame, common: DataFrame) -> DataFrame:
    """The measured rows with n_boilerplate_words, base_failed and kept; ``common`` is
    what ``boilerplate`` gives."""
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    rows = measured.withColumnRenamed("page", "__page").select("*", _salt("doc_id"))
    return (
        _beside(rows, common.select("page", "gone"))
        .withColumn("n_boilerplate_words", F.coalesce("gone", F.lit(0)).cast("long"))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (100 * F.col("n_boilerplate_words")
                                       <= DEPLETED_PERCENT * F.col("n_words")))
    )


def quality_rules(docs: DataFrame, host: str = "source") -> DataFrame:
    """Per row of ``docs`` (doc_id, text, host): counts and verdict.

    A NULL or empty text has no words and fails; a NULL host is a host of its own.
    Rows of a host with exactly the same text count as one document. Other columns are ignored. No row, no result.
    """
    measured = written(_measured(docs, host))
    rows = judged(measured, written(boilerplate(measured)))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words", "base_failed", "kept", "n_boilerplate_words")


def kept_documents(docs: DataFrame, host: str = "source") -> DataFrame:
    """The documents that stay, all columns, without their boilerplate lines.

    The verdict is found beside the text again, so documents without an id or with a
    repeated one are treated like all others. n_chars, where there is one, follows the text.
    """
    measured = written(_measured(docs, host))
    # the text moves once, not also within the row
    others = [docs[c] for c in docs.columns if c != "text"]
    rows = docs.select(
        _page(F.col(host), F.col("text")).alias("__page"), _salt("doc_id"),
        F.col("text").cast("binary").alias("text"), F.struct(*others).alias("row"),
    )
    body = _beside(rows, written(boilerplate(measured)).select("page", "common")).select(
        "text", F.coalesce("common", F.array().cast("array<long>")).alias("common"), "row"
    )
    schema = f"row {body.schema['row'].dataType.simpleString()}, text binary, kept boolean"
    rows = body.mapInArrow(_verdicts, schema).where("kept").select("row.*", F.col("text").alias("__text"))
    text = F.col("__text").cast("string")
    rows = rows.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.char_length(text).cast(kind))
    return rows.select(*docs.columns)


def _verdicts(batches):
    table = WordHashes()
    lines = LineHashes()
    for batch in (b.slice(i, SLICE) for b in batches for i in range(0, len(b), SLICE)):
        texts, kept = [], []
        for text, common in zip(batch.column("text").to_pylist(), batch.column("common").to_pylist()):
            body = text or b""
            n, _, _, _, again = base_counts(body, table)
            good = n >= MIN_WORDS and 100 * again <= MAX_REPEAT_PERCENT * n
            if good and common:
                drop = {c % 2**64 for c in common}
                stay, gone = [], 0
                for line in body.split(b"\n"):
                    bare = normalised(line)
                    if bare and lines[bare] in drop:
                        gone += bare.count(b" ") + 1
                    else:
                        stay.append(line)
                good = 100 * gone <= DEPLETED_PERCENT * n
                text = b"\n".join(stay)
            texts.append(text)
            kept.append(good)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(texts, pa.binary()), pa.array(kept, pa.bool_())],
            ["row", "text", "kept"],
        )
