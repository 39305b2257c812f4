"""Toxicity by a weighted lexicon, matched in one pass over folded text.

Look-alike letters and digits that stand for letters are folded first. The lexicon's
weights are log-odds learned from labelled documents; hits inside exception phrases do
not count. The sum of weights, by itself and by length, becomes a probability.
"""

import math
import re
import unicodedata
from collections import Counter
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelake.llm.workspace import written

# Letters that look like Latin ones, and signs written for letters.
LOOK_ALIKES = str.maketrans(
    "абвгеёзікмнорстухјѕԁһԛԝαβεικνορτυχ" + "0134578@$!|",
    "abbreezikmhopctyxjsdhqwabeikvoptux" + "oieastbasil",
)

#: Terms or phrases of one automaton; a larger lexicon is split into several, none is left out.
PART_PATTERNS = 250_000
#: Toxic documents that must hold a term, and its least weight: the log-odds less so
#: many standard errors.
TERM_DOCUMENTS = 4
TERM_WEIGHT = 2.0
DOUBT = 1.64
#: Letters of a word start that is tried as a term of its own.
STEM = 5
#: Clean documents that make a phrase around a term an exception, if no toxic one has it.
EXCEPTION_DOCUMENTS = 3
#: Words added to a text's length, so that one hit in a few words is not everything.
LENGTH_PRIOR = 20
#: Marked documents that lexicon, exceptions and calibration are fitted on, at most about.
LABELLED_ROWS = 100_000
SAMPLE_SEED = 3
#: Intercept and slopes used where labels do not have both values.
UNTRAINED = (-4.0, 1.0, 1.0)

_NOT_LETTERS = re.compile(r"[\W\d_]+")
_ACCENTS = re.compile("[̀-ͯ]+")


def folded(text: str) -> str:
    """Words of a text between single blanks, with one blank on either side."""
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).lower()
    # a sign at the end of a word is punctuation
    text = re.sub(r"[!|]+(?=\s|$)", " ", text)
    text = re.sub(r"(?<![^\W\d_])[\d!|$@]+(?![^\W\d_])", " ", text).translate(LOOK_ALIKES)
    return " " + " ".join(_NOT_LETTERS.split(text)).strip() + " "


def _terms(words: set[str]) -> set[str]:
    return words | {w[:STEM] + "*" for w in words if len(w) > STEM}


class Lexicon:
    """An automaton over terms and exception phrases."""

    def __init__(self, weights: dict[str, float], exceptions: list[str] = ()):
        self.automaton = ahocorasick.Automaton()
        for term, weight in weights.items():
            pattern = " " + term[:-1] if term.endswith("*") else f" {term} "
            self.automaton.add_word(pattern, (len(pattern), weight))
        for phrase in exceptions:
            pattern = f" {phrase} "
            self.automaton.add_word(pattern, (len(pattern), None))
        self.any = len(self.automaton) > 0
        if self.any:
            self.automaton.make_automaton()

    def add(self, text: str, found: dict[int, float], spared: list[int]) -> None:
        """Adds to found the weight by place of the words that are hit, where terms overlap
        the heaviest, and to spared begin and end of each exception phrase."""
        if not self.any:
            return
        for end, (length, weight) in self.automaton.iter(text):
            begin = end - length + 1
            if weight is None:
                spared += (begin, end)
            else:
                found[begin] = max(weight, found.get(begin, weight))


def _left(found: dict[int, float], spared: list[int]) -> dict[int, float]:
    """The hits outside of exceptions."""
    covered = list(zip(spared[::2], spared[1::2]))
    return {b: w for b, w in found.items() if not any(x <= b < y for x, y in covered)}


def _bounded(marks: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` of the marks at most, by the hash of their doc_id: the same ones each time."""
    share = rows / max(1, marks.count())
    if share >= 1:
        return marks
    place = F.pmod(F.xxhash64(F.lit(SAMPLE_SEED), "doc_id"), F.lit(1 << 31))
    return marks.where(place < int(share * (1 << 31)))


def _labelled(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """Texts with their marks, which are of bounded number: texts stay where they are."""
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(marks), "doc_id")


def _tally(batches):
    for batch in batches:
        counts = (Counter(), Counter())
        for text, toxic in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic"))):
            counts[bool(toxic)].update(_terms(set(folded(text or "").split())))
            counts[bool(toxic)][""] += 1
        yield _pairs(counts)


def _pairs(counts) -> pa.RecordBatch:
    clean, toxic = counts
    terms = list(clean.keys() | toxic.keys())
    return pa.RecordBatch.from_arrays(
        [pa.array(terms, pa.string()), pa.array([toxic[t] for t in terms], pa.int64()),
         pa.array([clean[t] for t in terms], pa.int64())],
        ["term", "toxic", "clean"],
    )


def _weights(labelled: DataFrame) -> DataFrame | None:
    """(pattern, weight): log-odds of all terms above the thresholds; counted over all
    labelled documents. None without labels of both kinds."""
    tally = written(
        labelled.mapInArrow(_tally, "term string, toxic long, clean long")
        .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(f"toxic >= {TERM_DOCUMENTS} OR term = ''")
    )
    total = tally.where("term = ''").first()
    if not total or not total.toxic or not total.clean:
        return None
    toxic, clean = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(toxic / (total.toxic + 1.0)) - F.log(clean / (total.clean + 1.0))
    weight = odds - DOUBT * F.sqrt(1 / toxic + 1 / clean)
    heavy = tally.where("term <> ''").withColumn("weight", weight)
    return written(
        heavy.where(F.col("weight") >= TERM_WEIGHT)
        .select(F.col("term").alias("pattern"), F.round("weight", 6).alias("weight"))
    )


def _parts(patterns: DataFrame) -> list[DataFrame]:
    """Parts of (pattern, weight), each of about PART_PATTERNS rows at most."""
    n = -(-patterns.count() // PART_PATTERNS)
    part = F.pmod(F.xxhash64("pattern"), F.lit(max(n, 1)))
    return [patterns.where(part == i) for i in range(n)]


def _matched(rows: DataFrame, patterns: list[DataFrame]) -> DataFrame:
    """``rows`` (text and others) with begins, weights and spared (what ``Lexicon.add`` finds
    of all patterns) and blanks, those of the folded text or NULL. A part of them is held at a time, and the rows carry its hits on."""
    rows = rows.withColumns({
        "begins": F.array().cast("array<int>"), "weights": F.array().cast("array<double>"),
        "spared": F.array().cast("array<int>"), "blanks": F.lit(None).cast("long"),
    })
    parts = _parts(reduce(DataFrame.unionByName, patterns)) if patterns else []
    for i, part in enumerate(parts):
        fetched = part.collect()
        lexicon = rows.sparkSession.sparkContext.broadcast((
            {r.pattern: r.weight for r in fetched if r.weight is not None},
            [r.pattern for r in fetched if r.weight is None],
        ))
        rows = rows.mapInArrow(_adding(lexicon), rows.schema)
        if i + 1 < len(parts):
            rows = written(rows)
            lexicon.unpersist()
    return rows


def _adding(lexicon):
    def add(batches):
        matcher = Lexicon(*lexicon.value)
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("text", "begins", "weights", "spared"))
            out = {"begins": [], "weights": [], "spared": [], "blanks": []}
            for text, begins, weights, spared in zip(*columns):
                found = dict(zip(begins, weights))
                text = folded(text or "")
                matcher.add(text, found, spared)
                held = (list(found), list(found.values()), spared, text.count(" "))
                for name, values in zip(out, held):
                    out[name].append(values)
            for name, values in out.items():
                at = batch.schema.get_field_index(name)
                batch = batch.set_column(at, name, pa.array(values, batch.schema.field(at).type))
            yield batch

    return add


def _phrases(batches):
    for batch in batches:
        counts = (Counter(), Counter())
        for text, toxic, begins in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "begins"))):
            text, seen = folded(text or ""), set()
            for begin in begins:
                end = text.index(" ", begin + 1)
                before = text[:begin].rpartition(" ")[2] if begin else ""
                after = text[end + 1 :].partition(" ")[0] if end + 1 < len(text) else ""
                word = text[begin + 1 : end]
                seen |= {f"{before} {word}"} if before else set()
                seen |= {f"{word} {after}"} if after else set()
            counts[bool(toxic)].update(seen)
        yield _pairs(counts)


def _exceptions(labelled: DataFrame, weights: DataFrame) -> DataFrame:
    """(pattern, weight): all phrases above the threshold, with no weight."""
    return written(
        _matched(labelled, [weights]).mapInArrow(_phrases, "term string, toxic long, clean long")
        .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(f"toxic = 0 AND clean >= {EXCEPTION_DOCUMENTS}")
        .select(F.col("term").alias("pattern"), F.lit(None).cast("double").alias("weight"))
    )


def _measure(batches):
    for batch in batches:
        sums, rates = [], []
        columns = (batch.column(c).to_pylist() for c in ("text", "begins", "weights", "spared", "blanks"))
        for text, begins, weights, spared, blanks in zip(*columns):
            total = sum(_left(dict(zip(begins, weights)), spared).values())
            blanks = folded(text or "").count(" ") if blanks is None else blanks
            sums.append(math.log1p(total))
            rates.append(math.log1p(100 * total / (blanks - 1 + LENGTH_PRIOR)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sums, pa.float64()), pa.array(rates, pa.float64())],
            ["doc_id", "weight_sum", "weight_rate"],
        )


def _calibrated(features: DataFrame) -> tuple[float, float, float]:
    kinds = {r.toxic for r in features.groupBy("toxic").count().collect()}
    if len(kinds) < 2:
        return UNTRAINED
    rows = VectorAssembler(inputCols=["weight_sum", "weight_rate"], outputCol="x").transform(features)
    model = LogisticRegression(
        featuresCol="x", labelCol="toxic", regParam=1e-3, maxIter=40
    ).fit(rows)
    return (float(model.intercept), *map(float, model.coefficients))


def toxicity(
    docs: DataFrame, labels: DataFrame, training: str = "true", labelled_rows: int = LABELLED_ROWS
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id and score, 0 to 1.

    ``labels`` has doc_id and toxic (0 or 1); of several marks the highest counts, NULL
    marks are ignored. ``training`` is a condition on doc_id: only labels of documents
    that meet it are learned from, about ``labelled_rows`` of them at most, chosen by a hash of
    the id. A NULL or empty text scores as one without hits. Rows
    that repeat score like each other, other columns are ignored, no row gives no result.
    Without marks of both kinds the lexicon is empty and all scores are equal.
    """
    marked = labels.where(training).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    marks = marked.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic")
    )
    marks = written(_bounded(marks, labelled_rows))
    labelled = _labelled(docs, marks)
    weights = _weights(labelled)
    patterns = [] if weights is None else [weights, _exceptions(labelled, weights)]
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    measured = written(_matched(texts, patterns).mapInArrow(_measure, "doc_id long, weight_sum double, weight_rate double"))
    intercept, by_sum, by_rate = _calibrated(measured.join(F.broadcast(marks), "doc_id"))
    margin = intercept + by_sum * F.col("weight_sum") + by_rate * F.col("weight_rate")
    return measured.select("doc_id", (1 / (1 + F.exp(-margin))).alias("score"))
