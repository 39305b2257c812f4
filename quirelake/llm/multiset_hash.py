"""Homomorphic fingerprints of texts: sums of wide vectors hashed from paragraphs.

A paragraph is a line that holds a word. Its vector has three kinds of lanes, each summed
modulo a power of two:

* one that is 1 (modulo 2**64): the sum counts the paragraphs;
* ``LANES`` of 64 bits hashed from the paragraph as it stands (modulo 2**64). Texts whose
  sums agree hold the same paragraphs equally often, in whatever order;
* ``SIGNS`` that sum +1 or -1 of each of the paragraph's shingles of five words (modulo
  2**32). They make likeness readable from two sums: the cosine of these lanes
  estimates that of the texts' shingle counts, to about 1 / sqrt(SIGNS).

As vectors are only added, a paragraph put in or taken out is one addition or
subtraction, and fingerprints of parts add up to that of the whole.
"""

import base64
import bisect
import re
from hashlib import sha256, shake_128

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType

from quirelake.llm.words import WordHashes, mixed, multipliers

LANES = 16
SIGNS = 256
WIDTH = 5
#: Characters of text whose paragraphs are hashed at a time.
RUN_CHARS = 1 << 20
#: Bytes of one paragraph whose words are hashed at a time.
RUN_BYTES = 1 << 22

_WIDE_BYTES = 8 * (LANES + 1)
_EACH_BYTE = np.uint64(0x0101010101010101)
_BLANK = re.compile(rb"[\x20\x09-\x0d]")


def paragraphs(text: str | None) -> list[str]:
    """The lines of a text that hold a word."""
    return [line for line in (text or "").split("\n") if line.strip(" \t\n\v\f\r")]


class Vectors:
    """A table of vectors: row i is of paragraph i or of a sum."""

    def __init__(self, wide: np.ndarray, signs: np.ndarray):
        self.wide, self.signs = wide, signs  # uint64 (n, LANES + 1), uint32 (n, SIGNS)

    def sums(self, groups: list[list[int]]) -> "Vectors":
        """One row per group: the sum of its rows, zero for an empty group."""
        filled = [i for i, g in enumerate(groups) if len(g)]
        out = Vectors(np.zeros((len(groups), LANES + 1), np.uint64),
                      np.zeros((len(groups), SIGNS), np.uint32))
        if filled:
            rows = np.concatenate([np.asarray(groups[i], np.int64) for i in filled])
            starts = np.cumsum([0] + [len(groups[i]) for i in filled[:-1]])
            out.wide[filled] = np.add.reduceat(self.wide[rows], starts, axis=0)
            out.signs[filled] = np.add.reduceat(self.signs[rows], starts, axis=0)
        return out

    def __add__(self, other: "Vectors") -> "Vectors":
        return Vectors(self.wide + other.wide, self.signs + other.signs)

    def __sub__(self, other: "Vectors") -> "Vectors":
        return Vectors(self.wide - other.wide, self.signs - other.signs)

    def texts(self) -> list[str]:
        """The rows as fingerprints."""
        rows = np.hstack([self.wide.astype("<u8").view(np.uint8).reshape(len(self.wide), -1),
                          self.signs.astype("<u4").view(np.uint8).reshape(len(self.wide), -1)])
        return [base64.b64encode(row.tobytes()).decode() for row in rows]

    @classmethod
    def read(cls, fingerprints: list[str]) -> "Vectors":
        raw = b"".join(map(base64.b64decode, fingerprints))
        rows = np.frombuffer(raw, np.uint8).reshape(len(fingerprints), _WIDE_BYTES + 4 * SIGNS)
        return cls(np.ascontiguousarray(rows[:, :_WIDE_BYTES]).view("<u8").astype(np.uint64),
                   np.ascontiguousarray(rows[:, _WIDE_BYTES:]).view("<u4").astype(np.uint32))


def likeness(a: Vectors, b: Vectors) -> np.ndarray:
    """Row by row, 0 to 1: the estimated cosine of the shingle counts; 1 for equal sums.

    Texts without a word are alike only to each other.
    """
    x, y = (v.signs.view(np.int32).astype(np.float64) for v in (a, b))
    scale = np.sqrt((x * x).sum(1) * (y * y).sum(1))
    with np.errstate(invalid="ignore", divide="ignore"):
        cosine = np.where(scale > 0, (x * y).sum(1) / scale, 0.0)
    same = (a.wide == b.wide).all(1) & (a.signs == b.signs).all(1)
    return np.where(same, 1.0, np.clip(cosine, 0.0, 1.0))


def bit_sums(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(len(starts), 64): per group of rows, how many hashes have each bit set.

    Eight bits at a time are added as the bytes of one word, in runs too short to overflow.
    ``starts`` begins with 0 and rises.
    """
    ends = np.append(starts[1:], len(hashes))
    runs = -(-(ends - starts) // 255)
    first = np.cumsum(runs) - runs
    cuts = np.repeat(starts - 255 * first, runs) + 255 * np.arange(runs.sum())
    out = np.empty((len(starts), 64), np.int64)
    for k in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(k)) & _EACH_BYTE, cuts)
        by_byte = sums.astype("<u8").view(np.uint8).reshape(-1, 8)
        out[:, k::8] = np.add.reduceat(by_byte, first, axis=0, dtype=np.int64)
    return out


def _byte_runs(line: bytes):
    """A paragraph in runs of about RUN_BYTES that end before a blank."""
    at = 0
    while len(line) - at > RUN_BYTES:
        blank = _BLANK.search(line, at + RUN_BYTES)
        if not blank:
            break
        yield line[at : blank.start()]
        at = blank.start()
    yield line[at:]


def _shingle_hashes(words: np.ndarray) -> np.ndarray:
    """One hash per run of WIDTH words; 0 words fill up what is shorter."""
    spread, factors = mixed(words), multipliers(WIDTH)
    total = np.zeros(len(words) - WIDTH + 1, np.uint64)
    for i in range(WIDTH):
        total += spread[i : len(words) - WIDTH + 1 + i] * factors[i]
    return mixed(total)


def _sign_sums(hashes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per group, the sums of +1 and -1 of its shingles in SIGNS lanes."""
    lanes = []
    for i in range(SIGNS // 64):
        lanes.append(bit_sums(mixed(hashes + np.uint64(i)), starts))
    return (2 * np.hstack(lanes) - sizes[:, None]).astype(np.uint32)


def vectors(lines: list[str], table: WordHashes) -> Vectors:
    """The vector of each paragraph."""
    wide = np.ones((len(lines), LANES + 1), np.uint64)
    signs = np.zeros((len(lines), SIGNS), np.uint32)
    short, of, counts = [], [], []
    for i, line in enumerate(lines):
        raw = line.encode("utf-8", "surrogatepass")
        wide[i, 1:] = np.frombuffer(shake_128(raw).digest(8 * LANES), "<u8")
        if len(raw) > RUN_BYTES:
            signs[i] = _long_signs(raw, table)
            continue
        words = list(map(table.__getitem__, raw.split()))
        if words:
            words += [0] * (WIDTH - len(words))
            short.append(np.array(words, np.uint64))
            of.append(i)
            counts.append(len(words))
    if of:
        sizes = np.array(counts)
        ends = np.cumsum(sizes)
        # a shingle that starts in the last words of a paragraph would reach into the next
        inside = np.ones(ends[-1], bool)
        for back in range(1, WIDTH):
            inside[ends - back] = False
        sizes = sizes - (WIDTH - 1)
        hashes = _shingle_hashes(np.concatenate(short))[inside[: ends[-1] - WIDTH + 1]]
        signs[of] = _sign_sums(hashes, np.cumsum(sizes) - sizes, sizes)
    return Vectors(wide, signs)


def _long_signs(raw: bytes, table: WordHashes) -> np.ndarray:
    total, carried, whole = np.zeros(SIGNS, np.uint32), np.empty(0, np.uint64), False
    for run in _byte_runs(raw):
        found = run.split()
        words = np.fromiter(map(table.__getitem__, found), np.uint64, len(found))
        words = np.concatenate([carried, words])
        if len(words) >= WIDTH:
            hashes = _shingle_hashes(words)
            total += _sign_sums(hashes, np.zeros(1, np.int64), np.array([len(hashes)]))[0]
            carried, whole = words[1 - WIDTH :], True
        else:
            carried = words
    if not whole and len(carried):
        padded = np.append(carried, np.zeros(WIDTH - len(carried), np.uint64))
        total += _sign_sums(_shingle_hashes(padded), np.zeros(1, np.int64), np.ones(1, int))[0]
    return total


class Hasher:
    """Sums over lists of paragraphs; each distinct paragraph of a call is hashed once."""

    def __init__(self):
        self.table = WordHashes()

    def sums(self, *lists: list[list[str]]) -> list[Vectors]:
        """For each list of paragraph lists, one row per paragraph list."""
        number: dict[str, int] = {}
        for groups in lists:
            for group in groups:
                for line in group:
                    number.setdefault(line, len(number))
        every = vectors(list(number), self.table)
        return [every.sums([[number[p] for p in group] for group in groups]) for groups in lists]


def _runs_of(rows, size):
    """Rows in lists of about RUN_CHARS characters."""
    run, held = [], 0
    for row in rows:
        run.append(row)
        held += size(row)
        if held >= RUN_CHARS:
            yield run
            run, held = [], 0
    if run:
        yield run


def _fingerprints(batches):
    hasher = Hasher()
    for batch in batches:
        ids, texts = batch.column("row"), batch.column("text").to_pylist()
        out = []
        for run in _runs_of(texts, lambda t: len(t or "")):
            (sums,) = hasher.sums([paragraphs(t) for t in run])
            out += sums.texts()
        yield pa.RecordBatch.from_arrays([ids, pa.array(out, pa.string())], ["row", "fingerprint"])


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` with the fingerprint of ``text`` (NULL: empty) in ``fingerprint``."""
    body = docs.select(
        F.struct(*[c for c in docs.columns if c != "fingerprint"]).alias("row"),
        F.col("text").cast("string").alias("text"),
    )
    schema = f"row {body.schema['row'].dataType.simpleString()}, fingerprint string"
    return body.mapInArrow(_fingerprints, schema).select("row.*", "fingerprint")


@F.pandas_udf(StringType())
def revised(fingerprint: pd.Series, deleted: pd.Series, inserted: pd.Series) -> pd.Series:
    """The fingerprint after the paragraphs of the text ``deleted`` were taken out and those
    of ``inserted`` put in, wherever they stood; the rest of the text is not needed."""
    out, less = Hasher().sums([paragraphs(t) for t in inserted], [paragraphs(t) for t in deleted])
    known = [f is not None for f in fingerprint]
    base = Vectors.read([f for f in fingerprint if f is not None])
    change = out - less
    change = Vectors(change.wide[known], change.signs[known])
    result = pd.Series([None] * len(fingerprint), dtype=object)
    result[np.flatnonzero(known)] = (base + change).texts()
    return result


@F.pandas_udf(DoubleType())
def alike(a: pd.Series, b: pd.Series) -> pd.Series:
    """The likeness of two fingerprints; NULL where one is missing."""
    known = np.flatnonzero(a.notna() & b.notna())
    out = pd.Series([None] * len(a), dtype="float64")
    if len(known):
        out[known] = likeness(Vectors.read(list(a.iloc[known])), Vectors.read(list(b.iloc[known])))
    return out


def _summed(batches):
    total = None
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            rows = Vectors.read(batch.column("fingerprint").slice(at, 4096).to_pylist())
            part = rows.sums([list(range(len(rows.wide)))])
            total = part if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array(total.texts())], ["fingerprint"])


def of_whole_table(fingerprints: DataFrame, fan_in: int = 64) -> DataFrame:
    """One row: the sum of all non-NULL fingerprints, that of all paragraphs of the table.

    Tables with equal rows hold the same paragraphs, however these are dealt to documents
    and files. Each task hands on one row; they meet in steps, ``fan_in`` tasks at a time.
    """
    rows = fingerprints.select("fingerprint").where("fingerprint IS NOT NULL")
    tasks = rows.rdd.getNumPartitions()
    sums = rows.mapInArrow(_summed, "fingerprint string")
    while tasks > fan_in:
        tasks = -(-tasks // fan_in)
        sums = sums.coalesce(tasks).mapInArrow(_summed, "fingerprint string")
    return sums.coalesce(1).mapInArrow(_summed, "fingerprint string")


def _edited(text: str, after: str) -> tuple[str, list[str], list[str]]:
    """The edited text, and the paragraphs that the edit takes out of ``text`` and puts in."""
    half = len(text) // 2
    kept = text[: len(text) - half]
    edited = kept + after[:half]
    same = kept.rfind("\n") + 1  # lines that end before the cut stay
    return edited, paragraphs(text[same:]), paragraphs(edited[same:])


_RESULT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
           "near_edited", "near_next"]


def _compare(hasher: Hasher, pairs: list[tuple]) -> pa.RecordBatch:
    """Result rows of (doc_id, text, next text)."""
    edits = [_edited(text, after) for _, text, after in pairs]
    own, after, deleted, inserted = hasher.sums(
        [paragraphs(p[1]) for p in pairs], [paragraphs(p[2]) for p in pairs],
        [e[1] for e in edits], [e[2] for e in edits],
    )
    changed = own - deleted + inserted
    digests = [sha256(e[0].encode("utf-8", "surrogatepass")).hexdigest() for e in edits]
    return pa.RecordBatch.from_arrays(
        [pa.array([p[0] for p in pairs], pa.int64()),
         pa.array([len(p[1]) for p in pairs], pa.int64()), pa.array(digests, pa.string()),
         pa.array(own.texts(), pa.string()), pa.array(changed.texts(), pa.string()),
         pa.array(likeness(own, changed)), pa.array(likeness(own, after))],
        _RESULT,
    )


def _compared(batches):
    """Rows come by bucket, each bucket in descending order and its guests last: the first
    guest is what follows the bucket's last row."""

    def pairs():
        held, bucket, closed = None, None, False
        for batch in batches:
            for of, guest, doc_id, text in zip(*(batch.column(c).to_pylist()
                                                 for c in ("bucket", "guest", "doc_id", "text"))):
                if of != bucket:
                    held, bucket, closed = None, of, False
                if held is not None and not closed:
                    yield (*held, text)
                closed = closed or guest
                held = (doc_id, text)

    hasher = Hasher()
    for run in _runs_of(pairs(), lambda p: len(p[1])):
        yield _compare(hasher, run)


def _bucket_of(splits: list[int]):
    @F.pandas_udf(IntegerType())
    def bucket(keys: pd.Series) -> pd.Series:
        places = np.searchsorted(np.array(splits, np.int64), keys.to_numpy(np.int64), "left")
        return pd.Series((len(splits) - places).astype(np.int32))

    return bucket


def compared_to_edits(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; NULL: empty): doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited and near_next.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as
    many (or all) of the next document in descending doc_id; after the last comes the
    first. Rows of one doc_id follow each other by a hash of their text, rows without one come
    last, in that order among themselves; a lone row follows itself. doc_id is a key: rows
    that share one all meet in one task. No row gives no result, other columns are ignored.

    Documents are dealt to buckets of adjoining ids, so whole texts move once; a bucket's
    first document is also dealt to the bucket before, as a guest. What the driver holds is
    the buckets' bounds.
    """
    spark = docs.sparkSession
    body = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).select("*", F.xxhash64("text").alias("tie"))
    body = body.withColumn("last", F.col("doc_id").isNull()).withColumn(
        "key", F.coalesce("doc_id", "tie")
    )
    count = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = [i / count for i in range(1, count)]
    quantiles = F.percentile_approx("key", F.array(*map(F.lit, cuts)), 10 * count)
    splits = sorted(set(body.where("NOT last").agg(quantiles).first()[0] or []))
    even = [int(-(2**63) + 2**64 * i // count) for i in range(1, count)]
    # buckets are numbered in the order asked for, those of rows without doc_id after all others
    bucket = F.when(F.col("last"), F.lit(len(splits) + 1) + _bucket_of(even)("key")).otherwise(
        _bucket_of(splits)("key")
    )
    tops = body.select(bucket.alias("bucket"), "key").groupBy("bucket").agg(F.max("key"))
    tops = sorted(map(tuple, tops.collect()))
    before = [(key, tops[i - 1][0], number > len(splits)) for i, (number, key) in enumerate(tops)]
    heads = spark.createDataFrame(before, "key long, guest_of int, last boolean")
    dealt = (
        body.withColumn("own", bucket)
        .join(F.broadcast(heads), ["key", "last"], "left")
        .select("doc_id", "text", "key", "tie", F.explode(F.expr(
            "filter(array(named_struct('bucket', own, 'guest', false),"
            " named_struct('bucket', guest_of, 'guest', true)), b -> b.bucket IS NOT NULL)"
        )).alias("b"))
        .select("doc_id", "text", "key", "tie", "b.bucket", "b.guest")
    )
    ordered = dealt.repartition("bucket").sortWithinPartitions(
        "bucket", "guest", F.desc("key"), "tie"
    )
    return ordered.select("doc_id", "text", "bucket", "guest").mapInArrow(
        _compared,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double",
    )
