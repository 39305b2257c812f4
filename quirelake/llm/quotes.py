"""Quotation linking: conversations in reply order, without the quotes.

Leading quote marks give a line its level. Lines of one level that follow each other are a
run; runs are normalised and hashed by word shingles, so neither new line breaks nor the
place of a quote in its original matter. What a message quotes at level n, the one that it
answers holds at level n - 1. Everything here is DataFrame functions.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirelake.llm.workspace import written

#: Marks before a line, each with a blank or not.
MARKS = r"^[ \t]*((?:>[ \t]?)+)"
#: Words that are looked for together; a quote of fewer is looked for as a whole.
WIDTH = 4


def _normalised(line: F.Column) -> F.Column:
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "))


def _parsed(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, own (text without quotes), quotes and runs (level, words)."""
    lines = F.transform(
        F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\r?\n"),
        lambda s: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(s, MARKS, 1), "[ \t]", "")).alias("level"),
            F.regexp_replace(s, MARKS, "").alias("body"),
        ),
    )
    parsed = messages.select(
        F.col("conv_id"), F.col("turn").cast("long").alias("turn"), "role", lines.alias("lines")
    )
    own = F.transform(F.filter("lines", lambda x: x.level == 0), lambda x: x.body)
    starts = F.filter(
        F.sequence(F.lit(0), F.size("lines") - 1),
        lambda i: (i == 0) | (F.get("lines", i)["level"] != F.get("lines", i - 1)["level"]),
    )
    parsed = parsed.withColumn("starts", starts)
    runs = F.transform("starts", lambda at, i: F.struct(
        F.get("lines", at)["level"].alias("level"),
        _normalised(F.array_join(F.transform(
            F.slice("lines", at + 1, F.coalesce(F.get("starts", i + 1), F.size("lines")) - at),
            lambda x: x.body), " ")).alias("words"),
    ))
    return parsed.select(
        "conv_id", "turn", "role", F.trim(F.array_join(own, "\n")).alias("own"),
        F.exists("lines", lambda x: x.level > 0).alias("quotes"),
        F.filter(runs, lambda x: x.words != "").alias("runs"),
    )


def _shingles(words: F.Column, width) -> F.Column:
    starts = F.sequence(F.lit(1), F.size(words) - width + 1)
    return F.transform(starts, lambda i: F.xxhash64(F.array_join(F.slice(words, i, width), " ")))


def _answered(parsed: DataFrame) -> DataFrame:
    """(conv_id, turn, parent): the earlier message that most quotes of the lowest level with
    an origin come from, the later of two.

    The origin of a shingle at level n is the latest earlier message that holds it at level
    n - 1, or else the latest that wrote it. Messages meet their quotes in turn order by
    shingle, so one that many messages hold makes no pairs of them.
    """
    quoting = parsed.where("quotes").select("conv_id").distinct()
    runs = parsed.join(quoting, "conv_id", "left_semi").select(
        "conv_id", "turn", F.explode("runs").alias("run")
    ).select("conv_id", "turn", "run.level", F.split("run.words", " ").alias("words"))
    held = F.flatten(F.transform(
        F.sequence(F.lit(1), F.least(F.size("words"), F.lit(WIDTH))), lambda n: _shingles(F.col("words"), n)
    ))
    asked = _shingles(F.col("words"), F.least(F.size("words"), F.lit(WIDTH)))
    holds = runs.select(
        "conv_id", "turn", "level", F.explode(F.array_distinct(held)).alias("hash"), F.lit(False).alias("asks")
    )
    asks = runs.where("level > 0").select(
        "conv_id", "turn", "level", F.explode(F.array_distinct(asked)).alias("hash"), F.lit(True).alias("asks")
    )
    # a message that holds something at one level is met by those that quote it at the next
    met = holds.withColumn("level", F.col("level") + 1).unionByName(asks).distinct()
    before = Window.partitionBy("conv_id", "hash", "level").orderBy("turn").rangeBetween(
        Window.unboundedPreceding, -1
    )
    wrote = Window.partitionBy("conv_id", "hash").orderBy("turn").rangeBetween(
        Window.unboundedPreceding, -1
    )
    origin = F.coalesce(
        F.max(F.when(~F.col("asks"), F.col("turn"))).over(before),
        F.max(F.when(~F.col("asks") & (F.col("level") == 1), F.col("turn"))).over(wrote),
    )
    counted = (
        met.withColumn("source", origin).where("asks AND source IS NOT NULL")
        .groupBy("conv_id", "turn", "level", "source").agg(F.count("*").alias("n"))
    )
    return counted.groupBy("conv_id", "turn").agg(
        F.max(F.struct(-F.col("level"), "n", "source")).getField("source").alias("parent")
    )


def linked(messages: DataFrame) -> DataFrame:
    """Per row of ``messages`` (conv_id, turn, role, text): conv_id, turn, role, message (the
    text without quotes), quotes (whether it had some), parent_turn, by_quote, root_turn
    and depth. Sorted by conv_id, root_turn and turn, conversations are in reply order.

    A message answers the earlier message of its conversation that most of its first-level
    quotes come from; without such, that which holds most of its second-level quotes at the first
    level, or else wrote them, and so on; without any, the message one turn before it, if there is
    one; else it begins a thread. Words are compared by their letters and digits only. A NULL text is an empty
    message. Rows without conv_id or turn answer nothing and begin threads of their own;
    rows that repeat have the same place. Of rows with the same conv_id and turn each is
    given back, and all of them are what an answer refers to. Other columns are ignored.
    """
    parsed = written(_parsed(messages))
    turns = parsed.where("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn").distinct()
    answers = _answered(parsed)
    earlier = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("turn").alias("prior"))
    links = (
        turns.join(answers, ["conv_id", "turn"], "left").join(earlier, ["conv_id", "turn"], "left")
        .select("conv_id", "turn", F.coalesce("parent", "prior").alias("parent_turn"),
                F.col("parent").isNotNull().alias("by_quote"))
    )
    links = written(links)
    placed = _placed(links)
    return parsed.select(
        "conv_id", "turn", "role", F.col("own").alias("message"), "quotes"
    ).join(links.join(placed, ["conv_id", "turn"]), ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "message", "quotes", "parent_turn",
        F.coalesce("by_quote", F.lit(False)).alias("by_quote"),
        F.coalesce("root_turn", "turn").alias("root_turn"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
    )


def _placed(links: DataFrame) -> DataFrame:
    """(conv_id, turn, root_turn, depth); every turn doubles how far each message looks up."""
    up = links.select("conv_id", "turn", F.coalesce("parent_turn", "turn").alias("top"),
                      F.col("parent_turn").isNotNull().cast("long").alias("depth"))
    while True:
        above = up.select("conv_id", F.col("turn").alias("top"), F.col("top").alias("higher"),
                          F.col("depth").alias("more"))
        step = written(
            up.join(above, ["conv_id", "top"]).selectExpr(
                "conv_id", "turn", "higher AS top", "depth + more AS depth", "higher <> top AS moved"
            )
        )
        up = step.drop("moved")
        if step.where("moved").isEmpty():
            return up.select("conv_id", "turn", F.col("top").alias("root_turn"), "depth")


def chat_text(rows: DataFrame) -> DataFrame:
    """``linked`` rows with chat: the message after its role."""
    role = F.coalesce(F.col("role").cast("string"), F.lit("user"))
    return rows.withColumn("chat", F.concat(F.lit("<|"), role, F.lit("|>\n"), "message", F.lit("\n")))
