"""Byte pair encoding as a streaming transducer with bounded lookahead, and its decoder.

The encoder reads a piece unit by unit. For every prefix it keeps the last token of the
prefix's own encoding and where that token begins; a token can follow another one only
if the merges never join across their boundary, and exactly one choice fits. No token is
longer than the merge list's lookahead, so whatever comes next, the encoding has a
boundary among the last units within it. Tokens that all of these boundaries descend
from are final and leave the memory.
"""

import codecs
import hashlib
import json
import re
import sys
import types
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a text that are read at once, up to the next blank.
RUN_CHARS = 1 << 16
#: Distinct pieces whose tokens a worker keeps, ...
KEPT_PIECES = 600_000
#: ... none of them longer than this; longer ones are streamed each time. With their ids that
#: is 400 MB at the very most, and a quarter of it in ordinary text.
KEPT_CHARS = 64
#: Units after which a stream looks for tokens that have become final.
EMIT_EVERY = 256
#: Pairs of tokens for which the encoder remembers whether they can stand side by side.
KEPT_PAIRS = 500_000
#: Token ids that are handed on at a time.
BATCH_IDS = 1 << 18

_NEVER = 1 << 60
_SPACE = "\t-\r \x85\xa0  -     　"
_BLANK = re.compile(f"[{_SPACE}]")

# The split pattern of CLIP-like files, and the same for texts of ASCII and Latin letters only.
_PLAIN_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTERS = "a-zA-ZÀ-ÖØ-öø-ɏ"
_PLAIN = re.compile(f"[\x00-\x7f{_LETTERS}]*")
_PLAIN_PIECES = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\t-\r 0-9{_LETTERS}]+"
)


def unit_table() -> dict[int, str]:
    """The printable character that stands for each byte in vocabularies of this kind:
    visible characters of Latin-1 stand for themselves, the others follow from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Vocabulary:
    """A word-end BPE vocabulary file, read for encoding and decoding."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in (self.ids | self.special).items()}
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(split.replace(r"[^\s", f"[^{_SPACE}"))
        self.plain = _PLAIN_PIECES if split == _PLAIN_SPLIT else None
        self.specials = regex.compile("|".join(map(regex.escape, self.special)))
        self.units = unit_table()
        self.hidden = {b: c for b, c in self.units.items() if chr(b) != c}
        self.bytes_of = {c: b for b, c in self.units.items()}
        self.joins: dict[tuple[int, int], int] = {}
        halves: dict[int, tuple[int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            whole = self.ids[a + b]
            self.joins[self.ids[a], self.ids[b]] = rank
            halves.setdefault(whole, (self.ids[a], self.ids[b]))
        self._spines(halves)
        self._apart: dict[int, bool] = {}
        usable = {i for t, i in self.ids.items() if i not in halves} | {
            i for i, (a, b) in halves.items() if self._free(a, b, self.joins[a, b])
        }
        self.inner = {t: i for t, i in self.ids.items() if i in usable and not t.endswith(self.end)}
        self.inner |= {t: i for t, i in self.ids.items() if i in usable and t == self.end}
        self.last = {
            t.removesuffix(self.end): i
            for t, i in self.ids.items()
            if i in usable and t.endswith(self.end) and t != self.end
        }
        #: The length of the longest token by its last two units.
        self.reach: dict[str, int] = {}
        for name in [*self.inner, *self.last]:
            self.reach[name[-2:]] = max(len(name), self.reach.get(name[-2:], 1))
        #: The sufficient lookahead of the merge list, in units.
        self.lookahead = max(map(len, [*self.inner, *self.last]))

    def _spines(self, halves: dict) -> None:
        """Per token, what lies at its left and right edge while it is being merged, each
        with the rank of the merge that takes it away."""
        self.left, self.right = {}, {}
        for side, spines in ((0, self.left), (1, self.right)):
            for i in self.ids.values():
                spine, until = [], _NEVER
                at = i
                while at in halves:
                    spine.append((at, until))
                    until = self.joins[halves[at]]
                    at = halves[at][side]
                spine.append((at, until))
                spines[i] = spine

    def _free(self, a: int, b: int, before: int) -> bool:
        """Whether no merge earlier than ``before`` joins the tokens across their boundary.

        Of merges of equal rank the left one comes first, hence < on one side and <= on
        the other.
        """
        joins = self.joins
        for x, x_until in self.right[a]:
            for y, y_until in self.left[b]:
                rank = joins.get((x, y))
                if rank is not None and rank < x_until and rank <= y_until and rank < before:
                    return False
        return True

    def apart(self, a: int, b: int) -> bool:
        """Whether b can follow a."""
        key = a << 24 | b
        known = self._apart.get(key)
        if known is None:
            if len(self._apart) >= KEPT_PAIRS:
                self._apart.clear()
            known = self._apart[key] = self._free(a, b, _NEVER)
        return known

    def split(self, text: str) -> list[str]:
        if self.plain and _PLAIN.fullmatch(text):
            return self.plain.findall(text)
        return self.pieces.findall(text)

    def units_of(self, piece: str) -> str:
        if piece.isascii() and piece.isprintable():
            return piece
        return piece.encode().decode("latin-1").translate(self.hidden)


class Stream:
    """Encodes one piece, fed in parts."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.text = ""  # units from the first boundary that is not final
        self.token = [-1]  # last token of each prefix of it; -1 or the last final one at 0
        self.back = [0]  # where it begins
        self.held = ""

    def _choose(self, end: int, known: dict[str, int]) -> tuple[int, int]:
        text, token, apart = self.text, self.token, self.v.apart
        reach = self.v.reach.get(text[max(0, end - 2) : end], 1)
        for begin in range(max(0, end - reach), end):
            new = known.get(text[begin:end])
            if new is not None and (token[begin] < 0 or apart(token[begin], new)):
                return begin, new
        raise ValueError("the vocabulary lacks a unit")

    def push(self, units: str) -> list[int]:
        """Reads on and returns the tokens that have become final."""
        units = self.held + units
        if not units:
            return []
        self.held, units = units[-1], units[:-1]
        out: list[int] = []
        for at in range(0, len(units), EMIT_EVERY):
            self._extend(units[at : at + EMIT_EVERY])
            if len(self.token) > self.v.lookahead:
                out += self._final()
        return out

    def _extend(self, units: str) -> None:
        # _choose for every unit, written out: this is where the time goes
        start = len(self.text)
        self.text += units
        text, token, back, v = self.text, self.token, self.back, self.v
        known, reach, remembered = v.inner, v.reach, v._apart
        for end in range(start + 1, len(text) + 1):
            for begin in range(max(0, end - reach.get(text[max(0, end - 2) : end], 1)), end):
                new = known.get(text[begin:end])
                if new is None:
                    continue
                last = token[begin]
                if last < 0:
                    break
                free = remembered.get(last << 24 | new)
                if free or free is None and v.apart(last, new):
                    break
            else:
                raise ValueError("the vocabulary lacks a unit")
            back.append(begin)
            token.append(new)

    def _final(self) -> list[int]:
        n = len(self.text)
        live = set(range(n - self.v.lookahead + 1, n + 1))
        while len(live) > 1:
            furthest = max(live)
            live.discard(furthest)
            live.add(self.back[furthest])
        (base,) = live
        out = self._path(base)
        if base:
            self.text = self.text[base:]
            self.token = self.token[base:]
            self.back = [0, *(b - base for b in self.back[base + 1 :])]
        return out

    def _path(self, end: int) -> list[int]:
        out = []
        while end:
            out.append(self.token[end])
            end = self.back[end]
        return out[::-1]

    def finish(self) -> list[int]:
        """The remaining tokens; the last one carries the word end."""
        if not self.held:
            return []
        self.text += self.held
        begin, new = self._choose(len(self.text), self.v.last)
        return [*self._path(begin), new]


class Decoder:
    """Turns tokens into text, one after the other.

    ``joined`` puts a blank between tokens and leaves word ends as they are, which is what
    the library does for a file that names no decoder. Otherwise bytes become characters
    as soon as they are complete, and a word end becomes a blank.
    """

    def __init__(self, vocabulary: Vocabulary, joined: bool = True):
        self.v, self.joined, self.begun = vocabulary, joined, False
        if not joined:
            self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        names = [self.v.names[i] for i in ids]
        if self.joined:
            text = " ".join(names)
            if self.begun and names:
                text = " " + text
            self.begun |= bool(names)
            return text
        out = []
        for i, name in zip(ids, names):
            if self.v.special.get(name) == i:
                out.append(self.utf8.decode(b"", True) + name)
                continue
            body = name.removesuffix(self.v.end)
            out.append(self.utf8.decode(bytes(self.v.bytes_of[c] for c in body)))
            if body != name:
                out.append(" ")
        return "".join(out)

    def finish(self) -> str:
        return "" if self.joined else self.utf8.decode(b"", True)


class Kept(dict):
    """piece -> its ids as text, encoded when first asked for."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, piece: str) -> str:
        ids = " ".join(map(str, self.encode(piece)))
        if len(self) >= KEPT_PIECES:
            self.clear()
        if len(piece) <= KEPT_CHARS:
            self[piece] = ids
        return ids


class Decoded(dict):
    """ids as text -> the library's text for them; tokens are joined, so parts add up."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary

    def __missing__(self, ids: str) -> str:
        text = Decoder(self.v).feed(list(map(int, ids.split())))
        if len(self) >= KEPT_PIECES:
            self.clear()
        if len(ids) <= 4 * KEPT_CHARS:
            self[ids] = text
        return text


class Encoder:
    """Texts to tokens. The tokens of short pieces are kept."""

    def __init__(self, path: str):
        self.v = Vocabulary(path)
        self.kept = Kept(self.piece)
        self.decoded = Decoded(self.v)

    def piece(self, piece: str) -> list[int]:
        if piece in self.v.special:
            return [self.v.special[piece]]
        stream = Stream(self.v)
        return stream.push(self.v.units_of(piece)) + stream.finish()

    def runs(self, text: str):
        """Lists of pieces in text order, a bounded run of text at a time; a special token
        is a piece of its own.

        Runs end before a blank as the file knows blanks, which no piece holds. Special
        tokens are found in the text as it is, before anything else. Single letters
        are lowered one by one: there is no final form at the end of a word.
        """
        at = 0
        while at < len(text):
            found = self.v.specials.search(text, at)
            upto = found.start() if found else len(text)
            while at < upto:
                blank = _BLANK.search(text, at + RUN_CHARS, upto)
                cut = blank.start() if blank else upto
                run = unicodedata.normalize("NFC", text[at:cut]).replace("Σ", "σ").lower()
                yield self.v.split(run)
                at = cut
            if found:
                yield [found.group()]
                at = found.end()

    def texts(self, text: str):
        """(ids as text, decoded text) run by run."""
        for pieces in self.runs(text):
            if pieces:
                ids = list(map(self.kept.__getitem__, pieces))
                yield " ".join(ids), " ".join(map(self.decoded.__getitem__, ids))

    def ids(self, text: str):
        """Arrays of token ids run by run."""
        for pieces in self.runs(text):
            if pieces:
                joined = " ".join(map(self.kept.__getitem__, pieces))
                yield np.fromstring(joined, np.int32, sep=" ")

    def encode(self, text: str) -> list[int]:
        return [int(i) for ids in self.ids(text) for i in ids]


def held_encoder(path: str) -> Encoder:
    """One encoder per worker process and file: a worker that Spark uses again for another
    task still knows the pieces it has met. This module travels by value, so what is to
    outlive a task hangs on a module of the worker itself."""
    held = sys.modules.setdefault("quirelake_held_encoders", types.ModuleType("held"))
    if path not in vars(held):
        vars(held)[path] = Encoder(path)
    return vars(held)[path]


def _digests(path: str):
    def digest(batches):
        encoder = held_encoder(path)
        for batch in batches:
            counts, ids, decoded = [], [], []
            for text in batch.column("text").to_pylist():
                total, glue = 0, ""
                one, two = hashlib.sha256(), hashlib.sha256()
                for of_run, text_of_run in encoder.texts(text or ""):
                    one.update((glue + of_run).encode())
                    two.update((glue + text_of_run).encode())
                    total += of_run.count(" ") + 1
                    glue = " "
                counts.append(total)
                ids.append(one.hexdigest())
                decoded.append(two.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()),
                 pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return digest


def round_trips(docs: DataFrame, path: str) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_tokens and digests of both directions.

    ``path`` is a vocabulary file that every executor can read. ids_sha256 is of the
    decimal ids joined by one blank, decoded_sha256 of the text decoded from them. Texts
    of any length are read in runs. A NULL
    text is an empty one, with no tokens. Rows that repeat are encoded like all others,
    other columns are ignored, and no row gives no result.
    """
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(
        _digests(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def _lists(batch: pa.RecordBatch, begin: int, end: int, parts: list, sizes: list) -> pa.RecordBatch:
    values = pa.array(np.concatenate(parts) if parts else np.empty(0, np.int32))
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    rows = batch.column("row").slice(begin, end - begin)
    return pa.RecordBatch.from_arrays([rows, pa.ListArray.from_arrays(offsets, values)], ["row", "ids"])


def _id_lists(path: str):
    def encode(batches):
        encoder = held_encoder(path)
        for batch in batches:
            texts = batch.column("row").field("text").cast(pa.string())
            begin, parts, sizes, held = 0, [], [], 0
            for row in range(batch.num_rows):
                ids = list(encoder.ids(texts[row].as_py() or ""))
                parts += ids
                sizes.append(sum(map(len, ids)))
                held += sizes[-1]
                if held >= BATCH_IDS:
                    yield _lists(batch, begin, row + 1, parts, sizes)
                    begin, parts, sizes, held = row + 1, [], [], 0
            if sizes:
                yield _lists(batch, begin, batch.num_rows, parts, sizes)

    return encode


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with its token ids in ``ids``; a NULL text has none.

    All columns but an earlier ``ids`` stay. Rows that repeat are encoded like all others,
    long texts run by run, and no row gives no result. A task holds one batch of rows and the
    ids of about ``BATCH_IDS`` tokens or one text.
    """
    kept = docs.withColumn("text", F.col("text").cast("string"))
    body = kept.select(F.struct(*[c for c in docs.columns if c != "ids"]).alias("row"))
    schema = f"row {body.schema['row'].dataType.simpleString()}, ids array<int>"
    return body.mapInArrow(_id_lists(path), schema).select("row.*", "ids")
