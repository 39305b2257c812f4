"""Labelled findings to train the secret scan from: planted secrets and hard negatives.

Every text holds candidates of one label. Values are drawn by hash, so all of it is the same
in each run. What decides a label is what kind of value was planted, not the features that
the forest sees: announcing words, signs and quotes stand around values of either label.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts that are made; a bound on the training data.
TEXTS = 4_000

# Names that announce, common words of prose, paths, placeholders.
NAMES = ["token", "secret", "password", "passwd", "pwd", "api_key", "apiKey", "access_key",
         "credential", "auth_token", "DB_PASSWORD", "secretKey", "auth_key"]
SIGNS = ["=", " = ", ": ", ":", " =", " : "]
PROSE = ["should", "required", "ingredients", "changed", "never", "optional", "always", "please",
         "none", "disabled", "basic", "bearer", "missing", "invalid", "expired", "the", "see",
         "contact", "forgotten", "must", "according", "because", "garden", "history", "society",
         "between", "recipes", "agents", "gardens", "ring", "number", "holder"]
HEADINGS = ["The password", "auth", "Secret", "Password", "the token", "Credentials", "access_key", "secret"]
DIGEST_WORDS = ["commit", "sha1", "md5", "checksum", "digest", "revision", "etag", "blob"]
PATHS = ["src/app/main.py", "src1", "web/page", "config/prod.yml", "tests/data", "example/readme", ""]
PLACEHOLDERS = ["changeme", "YOUR_API_KEY", "your-password-here", "xxxxxxxxxxxxxxxx", "<token>", "${TOKEN}",
                "{{ secret }}", "********", "REPLACE_ME_12345", "None", "null", "true"]

_LOWER = "abcdefghijklmnopqrstuvwxyz"
_DIGITS = "0123456789"
_HEX = _DIGITS + "abcdef"
_UPPER = _LOWER.upper()
_ALL = _LOWER + _UPPER + _DIGITS
_SIGNS = ".!@#%&*?-_"


def judged_texts(spark: SparkSession, prose: list[str], salt: int = 0) -> DataFrame:
    """(doc_id, text, path, label): TEXTS texts, half of either label; ``prose`` are further
    words for the negatives, other salts give other texts."""
    row = spark.range(TEXTS).withColumnRenamed("id", "doc_id")
    turn = iter(range(1, 10_000))

    def number(below, *more):
        return F.pmod(F.xxhash64("doc_id", F.lit(salt), F.lit(next(turn)), *more), F.lit(below)).cast("int")

    def one_of(choices):
        # one literal, not one per choice: plans stay small
        return F.get(F.split(F.lit("\x01".join(choices)), "\x01"), number(len(choices)))

    def drawn(alphabet, low, high=None):
        length = number(high - low + 1) + low if high else F.lit(low)
        at = F.transform(F.sequence(F.lit(1), length), lambda i: F.substring(
            F.lit(alphabet), number(len(alphabet), i) + 1, F.lit(1)))
        return F.array_join(at, "")

    words = PROSE + prose

    def word():
        return F.when(number(2) == 0, one_of(PROSE)).otherwise(one_of(words))

    def told(value, quotes=("", "", '"', "'"), names=tuple(NAMES)):
        quote = one_of(quotes)
        return F.concat(one_of(names), one_of(SIGNS), quote, value, quote)

    secret = [
        told(drawn(_HEX, 16, 64)),
        told(drawn(_HEX, 40), ('"',)),
        told(drawn(_ALL, 12, 48)),
        told(drawn(_ALL + _SIGNS, 8, 40)),
        told(F.concat(drawn(_LOWER, 3, 8), drawn(_DIGITS, 1, 4))),
        told(F.concat(word(), drawn(_DIGITS, 1, 4)), ("", "")),
        told(F.concat(drawn(_UPPER, 1), drawn(_LOWER + _DIGITS + _SIGNS, 5, 12), drawn(_DIGITS, 1))),
        told(F.concat(drawn(_LOWER, 1, 3), drawn(_DIGITS, 1, 3))),
        told(F.concat_ws(".", drawn(_LOWER, 1, 4), drawn(_LOWER + _SIGNS, 6, 14))),
        told(F.concat_ws("-", word(), word(), word()), ('"', "'")),
        told(F.concat_ws(" ", word(), word(), word()), ('"', "'")),
        F.concat(F.lit("AKIA"), drawn(_UPPER + _DIGITS, 16)),
        F.concat(F.lit("AKIA"), drawn(_UPPER, 16)),
        F.concat(F.lit("ghp_"), drawn(_ALL, 36)),
        F.concat(F.lit("sk_live_"), drawn(_ALL, 24)),
        F.concat(F.lit('"AIza'), drawn(_ALL, 35), F.lit('"')),
        F.concat(F.lit("xoxb-"), drawn(_DIGITS, 12), F.lit("-"), drawn(_ALL, 24)),
    ]
    groups = [drawn(_HEX, n) for n in (8, 4, 4, 4, 12)]
    plain = [
        F.concat(one_of(HEADINGS), one_of([": ", ": ", " : ", " = "]), word()),
        F.concat(one_of(HEADINGS), one_of([": ", ": ", " : ", ":"]), word(), one_of([",", ".", ""])),
        F.concat(one_of(HEADINGS), F.lit(": "), F.initcap(word())),
        F.concat(one_of(["tokens: ", "tokens = ", "max_tokens="]), drawn(_DIGITS, 1, 5)),
        told(one_of(PLACEHOLDERS)),
        drawn(_DIGITS, 12, 20),
        F.concat_ws(" ", F.lit("order"), F.concat_ws("-", F.lit("2024"), drawn(_DIGITS, 6), drawn(_DIGITS, 2))),
        F.concat(one_of(["ORD-", "INV-", "No-"]), drawn(_DIGITS, 9, 14)),
        F.concat_ws("-", *groups),
        F.concat(one_of(["id: ", "request=", "uuid "]), F.concat_ws("-", *groups)),
        F.concat(one_of(DIGEST_WORDS), one_of([" ", ": ", "="]), drawn(_HEX, 40)),
        F.concat(one_of(DIGEST_WORDS), one_of([" ", ": ", "="]), drawn(_HEX, 32, 64)),
        drawn(_HEX, 32, 64),
        F.upper(drawn(_HEX, 32, 64)),
        F.concat(one_of(DIGEST_WORDS), one_of([" ", ": ", "="]), F.upper(drawn(_HEX, 40))),
        F.concat(F.concat_ws("-", word(), word(), word()), drawn(_DIGITS, 1, 4)),
        F.concat(F.concat_ws("_", word(), word(), word()), F.lit("_"), drawn(_DIGITS, 1, 4)),
        F.concat(F.lit("get"), F.initcap(word()), F.initcap(word()), drawn(_DIGITS, 1, 2), F.lit("Value")),
        F.concat(F.lit("/"), F.concat_ws("/", word(), word(), word()), drawn(_DIGITS, 1, 2)),
    ]
    label = F.pmod("doc_id", F.lit(2)).cast("int")

    def by_turn(kinds):
        kind = F.pmod(F.floor(F.col("doc_id") / 2), F.lit(len(kinds))).cast("int")
        chosen = F.lit(None).cast("string")
        for i, text in enumerate(kinds):
            chosen = F.when(kind == i, text).otherwise(chosen)
        return chosen

    planted = F.when(label == 1, by_turn(secret)).otherwise(by_turn(plain))
    text = F.concat_ws(" ", word(), word(), planted, word(), word())
    return row.select("doc_id", text.alias("text"), one_of(PATHS).alias("path"), label.alias("label"))
