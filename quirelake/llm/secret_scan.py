"""Secret scan: candidates by shape or announcement, false positives removed by a random forest.

The forest looks at a candidate's length, the changes between kinds of characters in it,
how much of it words of the corpus cover, the path of its document and the words next to
it. It is trained from labelled findings. Everything here is DataFrame functions.
"""

from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelake.llm.judged_findings import judged_texts
from quirelake.llm.workspace import written

#: What a candidate that nothing announces is made of; it also holds a digit or is a known shape.
CORE = r"[A-Za-z0-9+/_\-]{12,}={0,2}"
BLANKS = r"[\x20\x09-\x0D]+"
#: Labelled findings of either kind that the forest is fitted on at most, by hash order.
SAMPLE = 4_000
TREES, DEPTH, SEED = 40, 10, 17
#: A word takes part in the dictionary if the corpus holds it so often.
DICTIONARY_COUNT = 20
#: Words of the dictionary that hard negatives are made with at most, by hash order.
PROSE_WORDS = 500
GRAM = 4
MASK = "[SECRET]"

# Shapes of well-known keys, words that announce secrets, telling paths.
KNOWN_SHAPES = (
    r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^xox[abprs]-[0-9A-Za-z\-]{10,}$"
    r"|^sk_live_[0-9A-Za-z]{16,}$|^AIza[0-9A-Za-z_\-]{35}$"
)
ANNOUNCING = r"(?i)(token|secret|passw(or)?d|pwd|api_?key|access_?key|credential|auth)"
#: What may follow in the same name: token_id and secretKey announce, author and secretary do not.
NAMED = ANNOUNCING + (
    r"(s|orization|entication)?([_\-0-9][\w\-]{0,64}|(?-i:[A-Z][a-z])[\w\-]{0,64})?['\"\])]*"
)
#: A name, a sign that assigns, and the value: a quoted one up to its quote, else one word. A name
#: with a sign is no value.
TOLD = (
    "(" + NAMED + r"\s*[=:]+>?\s*)(?!" + NAMED + r"\s*[=:])"
    r"""("[^"]++"(?!\w)|'[^']++'(?!\w)|[^\x20\x09-\x0D]+)"""
)
TOLD_VALUE = 10
#: Noncharacters that mark where a value begins, goes on in a further word, and ends.
BEGIN, MORE, END = "\ufdd0", "\ufdd1", "\ufdd2"
#: Signs around a value that do not belong to it.
AROUND = r"^['\"`(\[{<]+|['\"`)\]}>,;]+$"
ASSIGNED = r"[=:]>?\s*['\"]*$"
EQUALS = r"=>?\s*['\"]*$"
SAMPLE_PATHS = r"(?i)(test|example|sample|demo|doc|fixture)"

FEATURES = [
    "length", "changes", "digit_share", "upper_share", "symbol_share", "distinct_share", "hex_only",
    "dictionary", "path_sample", "path_depth", "announced", "announced_near", "assigned", "equals",
    "quoted", "known",
]


def _key(docs: DataFrame, path: str) -> F.Column:
    """Documents with the same text and path have the same findings."""
    return F.md5(F.concat_ws("\x01", F.col(path).cast("string"), F.col("text").cast("string")))


def _unmarked(text: F.Column) -> F.Column:
    return F.translate(text, BEGIN + MORE + END, "\ufffd" * 3)


def _marked(text: F.Column) -> F.Column:
    """The text with marks in every word of an announced value, in one pass over it."""
    told = F.regexp_replace(_unmarked(text), TOLD, f"$1{BEGIN}${TOLD_VALUE}{END}")
    parts = F.split(told, BEGIN)

    def value_first(part):
        value = F.regexp_replace(F.substring_index(part, END, 1), f"({BLANKS})(?=\\S)", f"$1{MORE}")
        return F.concat(F.lit(BEGIN), value, F.lit(END), F.substring_index(part, END, -1))

    marked = F.transform(parts, lambda part, i: F.when(i == 0, part).otherwise(value_first(part)))
    return F.when(text.rlike(ANNOUNCING), F.array_join(marked, "")).otherwise(_unmarked(text))


def candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """(key, doc_id, path, word_no, part_no, candidate, announced, quoted, lead, before, after):
    every value that an announcing word with = or : assigns, whole, and else every run of
    candidate characters with a digit or of a known shape, in any word, with its neighbours.

    A quoted value of several words is one candidate per word. Each text is gone through
    once, whatever the number of its values.
    """
    text = F.col("text").cast("string")
    split = docs.select("doc_id", F.col(path).cast("string").alias("path"), _key(docs, path).alias("key"),
                        F.split(_marked(text), BLANKS).alias("words"))

    def plain(word):
        return F.translate(F.coalesce(word, F.lit("")), BEGIN + MORE + END, "")

    def before_first(word, part):
        return F.call_function("substring_index", word, part, F.lit(1))

    asks = F.transform("words", lambda w, i: F.when(
        w.rlike(f"[{BEGIN}{MORE}]") | ((F.length(w) >= 12) & w.rlike(CORE)),
        F.struct(i.alias("word_no"), w.alias("word"), F.get("words", i - 2).alias("w2"),
                 F.get("words", i - 1).alias("w1"), F.get("words", i + 1).alias("after")),
    ))
    found = split.select("doc_id", "path", "key", F.explode(F.filter(asks, lambda x: x.isNotNull())).alias("x"))
    near = found.select(
        "doc_id", "path", "key", "x.word_no", "x.word", plain(F.col("x.word")).alias("bare"),
        F.concat_ws(" ", plain(F.col("x.w2")), plain(F.col("x.w1"))).alias("before"),
        plain(F.col("x.after")).alias("after"),
    )
    # what stands between a mark and the end of the value or of the word
    values = F.transform(
        F.regexp_extract_all("word", F.lit(f"([{BEGIN}{MORE}])([^{BEGIN}{MORE}{END}]*)"), 0),
        lambda v: F.struct(
            F.regexp_replace(F.substring(v, F.lit(2), F.length(v)), AROUND, "").alias("candidate"),
            F.lit(True).alias("announced"),
            v.rlike(f"^{MORE}|^{BEGIN}['\"]").alias("quoted"),
        ),
    )
    outside = F.regexp_replace("word", f"[{BEGIN}{MORE}][^{BEGIN}{MORE}{END}]*", END)
    runs = F.transform(
        F.filter(F.regexp_extract_all(outside, F.lit(CORE), 0), lambda c: c.rlike("[0-9]") | c.rlike(KNOWN_SHAPES)),
        lambda c: F.struct(
            c.alias("candidate"), F.lit(False).alias("announced"),
            before_first(F.col("bare"), c).rlike("['\"]$").alias("quoted"),
        ),
    )
    all_ = F.concat(F.filter(values, lambda v: v["candidate"] != ""), runs)
    parts = near.select("*", F.posexplode(all_).alias("part_no", "found"))
    lead = F.when(F.col("found.announced"), F.regexp_extract("word", f"^([^{BEGIN}{MORE}{END}]*)", 1)).otherwise(
        before_first(F.col("bare"), F.col("found.candidate"))
    )
    return parts.select(
        "key", "doc_id", "path", "word_no", "part_no", "found.*", lead.alias("lead"), "before", "after"
    )


def dictionary(docs: DataFrame) -> DataFrame:
    """(word): words of letters that the corpus holds often."""
    words = docs.select(
        F.explode(F.split(F.lower(F.col("text").cast("string")), r"[^a-z]+")).alias("word")
    )
    return (
        words.where(F.length("word").between(GRAM, 24)).groupBy("word")
        .agg(F.count("*").alias("n")).where(F.col("n") >= DICTIONARY_COUNT).select("word")
    )


def dictionary_grams(words: DataFrame) -> DataFrame:
    """(gram): runs of GRAM letters in the words."""
    return words.select(F.explode(_grams(F.col("word"))).alias("gram")).distinct()


def _grams(text: F.Column) -> F.Column:
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - GRAM + 1, F.lit(1)))
    return F.transform(starts, lambda i: F.substring(text, i, F.lit(GRAM)))


def _covered(found: DataFrame, grams: DataFrame) -> DataFrame:
    """(candidate, dictionary): the share of a candidate's letter runs that words hold."""
    distinct = found.select("candidate").distinct()
    held = distinct.select(
        "candidate", F.explode(_grams(F.lower("candidate"))).alias("gram")
    ).join(grams.withColumn("known", F.lit(1)), "gram", "left")
    return held.groupBy("candidate").agg(F.avg(F.coalesce("known", F.lit(0))).alias("dictionary"))


def features(found: DataFrame, grams: DataFrame) -> DataFrame:
    size = F.length("candidate")

    def share(pattern):
        return F.regexp_count("candidate", F.lit(pattern)) / size

    def flag(column, pattern):
        return F.coalesce(F.col(column), F.lit("")).rlike(pattern).cast("double")

    kinds = ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]", "[aeiou]")
    change = "|".join(f"(?={a}(?!{a}))." for a in kinds)
    held = found.withColumns({
        "length": size.cast("double"),
        "changes": F.regexp_count("candidate", F.lit(change)) / size,
        "digit_share": share("[0-9]"),
        "upper_share": share("[A-Z]"),
        "symbol_share": share("[^A-Za-z0-9]"),
        "distinct_share": F.size(F.array_distinct(F.split("candidate", ""))) / size,
        "hex_only": flag("candidate", "^[0-9a-f]+$"),
        "path_sample": flag("path", SAMPLE_PATHS),
        "path_depth": F.regexp_count(F.coalesce("path", F.lit("")), F.lit("/")).cast("double"),
        "announced_near": F.concat_ws(" ", "before", "lead").rlike(ANNOUNCING).cast("double"),
        "assigned": F.concat_ws(" ", "before", "lead").rlike(ASSIGNED).cast("double"),
        "equals": F.concat_ws(" ", "before", "lead").rlike(EQUALS).cast("double"),
        "known": flag("candidate", KNOWN_SHAPES),
        "announced": F.col("announced").cast("double"),
        "quoted": F.col("quoted").cast("double"),
    })
    return held.join(_covered(found, grams), "candidate")


def judged_findings(words: DataFrame, salt: int = 0) -> DataFrame:
    """The candidates of ``judged_texts`` with their label: the labelled findings to train from
    where nobody has judged any. Words of the corpus make up the prose that secrets are told from.
    """
    prose = [r.word for r in words.orderBy(F.xxhash64("word"), "word").limit(PROSE_WORDS).collect()]
    texts = written(judged_texts(words.sparkSession, prose, salt))
    labels = texts.select(F.col("doc_id").alias("of"), "label")
    found = candidates(texts, "path")
    return written(found.join(labels, found.doc_id == labels["of"]).drop("of"))


def _fitted(labelled: DataFrame):
    """The forest, or None when the labelled findings are not of both kinds."""
    one = labelled.select("label", *FEATURES).where("label IS NOT NULL").distinct()
    ranked = [
        one.where(F.col("label") == kind).orderBy(F.xxhash64(*FEATURES), *FEATURES).limit(SAMPLE)
        for kind in (0, 1)
    ]
    sample = written(reduce(DataFrame.unionByName, ranked))
    if sample.select("label").distinct().count() < 2:
        return None
    rows = VectorAssembler(inputCols=FEATURES, outputCol="x").transform(
        sample.coalesce(1).sortWithinPartitions("label", *FEATURES)
    )
    return RandomForestClassifier(
        featuresCol="x", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED
    ).fit(rows)


def secret_scan(docs: DataFrame, path: str = "source", labelled: DataFrame | None = None) -> DataFrame:
    """One row per candidate in ``docs`` (doc_id, text, path): key, doc_id, word_no, part_no,
    candidate, score and is_secret (score of 0.5 or more).

    ``labelled`` are judged findings with the columns of ``candidates`` and label; without
    them, ``judged_findings`` are taken. Without both kinds of labels no forest can be
    fitted, and every score is 0.5: nothing is dismissed unseen. A NULL or empty text has no
    candidates, a NULL path is an empty one, rows that repeat have findings of their own,
    very long texts are gone through once like all others, other columns are ignored. The
    noncharacters U+FDD0 to U+FDD2 are read as U+FFFD.
    """
    found = written(candidates(docs, path))
    words = written(dictionary(docs))
    grams = written(dictionary_grams(words))
    held = written(features(found, grams))
    marked = written(features(judged_findings(words) if labelled is None else labelled, grams))
    forest = _fitted(marked)
    if forest is None:
        scored = held.withColumn("score", F.lit(0.5))
    else:
        rows = VectorAssembler(inputCols=FEATURES, outputCol="x").transform(held)
        scored = forest.transform(rows).withColumn("score", vector_to_array("probability")[1])
    return scored.select("key", "doc_id", "word_no", "part_no", "candidate", "score",
                         (F.col("score") >= 0.5).alias("is_secret"))


def redacted(docs: DataFrame, path: str = "source") -> DataFrame:
    """``docs``, all rows and columns, with every found secret replaced by MASK.

    A secret of 12 characters or more is replaced wherever its text holds it. n_chars, where
    there is one, follows the text. NULL and empty texts stay; rows that repeat are all kept.
    """
    secrets = written(
        secret_scan(docs, path).where("is_secret").groupBy(F.col("key").alias("__key"), "word_no")
        .agg(F.sort_array(F.collect_set("candidate"), False).alias("parts")).groupBy("__key")
        .agg(F.sort_array(F.collect_list(F.struct("word_no", "parts"))).alias("__secrets"))
    )
    text = F.col("text").cast("string")
    rows = docs.withColumn("__mine", _key(docs, path))
    rows = rows.join(secrets, rows["__mine"] == secrets["__key"], "left")
    # words and blanks in turn, each its own entry; __ahead is 1 where blanks come first
    rows = rows.withColumns({
        "__tokens": F.when(F.col("__secrets").isNotNull(),
                           F.regexp_extract_all(text, F.lit(BLANKS + r"|[^\x20\x09-\x0D]+"), 0)),
        "__ahead": F.when(text.rlike("^" + BLANKS), 1).otherwise(0),
    })

    def place(secret):
        return secret["word_no"] * 2 - F.col("__ahead")

    def masked_word(secret):
        word = _unmarked(F.get("__tokens", place(secret)))
        return F.aggregate(secret["parts"], word, lambda t, c: F.replace(t, c, F.lit(MASK)))

    def with_what_precedes(secret, i):
        begin = F.when(i == 0, 0).otherwise(place(F.get("__secrets", i - 1)) + 1)
        ahead = F.array_join(F.slice("__tokens", begin + 1, place(secret) - begin), "")
        return F.concat(ahead, masked_word(secret))

    end = place(F.element_at("__secrets", -1)) + 1
    tail = F.array_join(F.slice("__tokens", end + 1, F.size("__tokens") - end), "")
    # the place of a secret counts: a short one may be part of other words
    in_place = F.concat(F.array_join(F.transform("__secrets", with_what_precedes), ""), tail)
    everywhere = F.expr(
        "array_sort(array_distinct(filter(flatten(transform(__secrets, s -> s.parts)), c -> length(c) >= 12)),"
        " (a, b) -> length(b) - length(a))"
    )
    masked = F.aggregate(everywhere, in_place, lambda t, s: F.replace(t, s, F.lit(MASK)))
    rows = rows.withColumn("text", F.when(F.col("__secrets").isNull(), text).otherwise(masked))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = F.when(F.col("__secrets").isNull(), F.col("n_chars"))
        rows = rows.withColumn("n_chars", changed.otherwise(F.char_length("text").cast(kind)))
    return rows.select(*docs.columns)
