"""Reading landed JSON documents."""

from collections.abc import Iterable
from datetime import date
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.functions import first_date, landing_date, path_title
from quirelake.schemas import (
    CORRUPT_COLUMN,
    LANDING,
    LISTED,
    LISTED_FIELDS,
    LISTED_SECTIONS,
    OPAQUE,
    VARIANT_COLUMN,
)
from quirelake.sources.layout import FILE_PATTERN, depth, landing_path


INVENTORY = (
    "path string, length bigint, modified timestamp, filename string, landing_date date"
)


def _options(platform: str, target: str, multiline: bool, files: str) -> dict[str, str]:
    options = {
        "multiLine": str(multiline).lower(),
        "recursiveFileLookup": "true",
        "pathGlobFilter": files,
        "columnNameOfCorruptRecord": CORRUPT_COLUMN,
    }
    if (platform, target) in OPAQUE:
        options["singleVariantColumn"] = VARIANT_COLUMN
    return options


def with_provenance(docs: DataFrame) -> DataFrame:
    """The source file of each row, and the landing date in its path."""
    tagged = docs.select("*", F.col("_metadata.file_path").alias("filename"))
    return tagged.withColumn("landing_date", landing_date("filename"))


def at_depth(docs: DataFrame, target: str) -> DataFrame:
    """Only documents that lie where the layout puts those of the target.

    There the landing date is found by counting names from the end of the path, which is
    several times cheaper for each row than to search the whole path for it.
    """
    tail = F.substring_index("filename", "/", -depth(target))
    return docs.where(tail.rlike(FILE_PATTERN)).withColumn("landing_date", first_date(tail))


def landing_reader(
    reader,
    platform: str,
    target: str,
    schema: str | None = None,
    multiline: bool = True,
    report: bool = False,
    files: str = "*.json",
):
    """Settings shared by the batch reader and the stream reader."""
    reader = reader.options(**_options(platform, target, multiline, files))
    if (platform, target) in OPAQUE:
        return reader
    pinned = schema or LISTED.get((platform, target)) or LANDING[platform, target]
    return reader.schema(f"{pinned}, {CORRUPT_COLUMN} string" if report else pinned)


def _is_object(item: Column) -> Column:
    return F.try_variant_get(item, "$", "struct<>").isNotNull()


def _known(items: Column) -> Column:
    return F.filter(items, lambda item: item.isNotNull())


def _listed(items: Column) -> Column:
    """Items that are objects, each read once; a field of another kind is NULL."""
    fields = ", ".join(f"{name}: {kind}" for name, kind in LISTED_FIELDS.items())
    return _known(F.transform(items, lambda item: F.try_variant_get(item, "$", f"struct<{fields}>")))


def _has_odd(items: Column) -> Column:
    return F.coalesce(F.exists(items, lambda item: ~_is_object(item)), F.lit(False))


def _items(parent: Column, name: str) -> Column:
    """The list under a name; NULL where there is none."""
    return F.try_variant_get(parent, f"$.{name}", "array<variant>")


def _content_odd(content: Column) -> Column:
    missing = content.isNull() | F.is_variant_null(content)
    return F.coalesce(~missing & ~_is_object(content), F.lit(False))


#: A section down to its cards, read as one; what is no object at its level is NULL.
_SECTION = "struct<title: string, cardGroups: array<struct<cards: array<struct<content: variant>>>>>"
_CONTENT = (
    "struct<id: bigint, title: string, authors: array<struct<name: string>>,"
    " featuredCharacterImageA: string, seoKeywords: array<string>>"
)


def _sections(items: Column) -> Column:
    """Sections of card groups of cards, whatever is no object at its level left out."""

    def card(c: Column) -> Column:
        fields = F.try_variant_get(c["content"], "$", _CONTENT)
        return F.struct(fields.withField("authors", _known(fields["authors"])).alias("content"))

    def group(g: Column) -> Column:
        cards = F.filter(g["cards"], lambda c: c.isNotNull() & ~_content_odd(c["content"]))
        return F.struct(F.transform(cards, card).alias("cards"))

    def section(s: Column) -> Column:
        groups = F.transform(_known(s["cardGroups"]), group)
        return F.struct(s["title"].alias("title"), groups.alias("cardGroups"))

    read = _known(F.transform(items, lambda item: F.try_variant_get(item, "$", _SECTION)))
    return F.transform(read, section).cast(LISTED_SECTIONS)


def _sections_odd(items: Column) -> Column:
    """Whether something at any level of the sections is no object."""

    def below(items: Column, test) -> Column:
        inside = F.exists(F.filter(items, _is_object), test)
        return _has_odd(items) | F.coalesce(inside, F.lit(False))

    def odd_card(card: Column) -> Column:
        return _content_odd(F.try_variant_get(card, "$.content", "variant"))

    return below(items, lambda s: below(_items(s, "cardGroups"), lambda g: below(
        _items(g, "cards"), odd_card)))


def by_item(docs: DataFrame, itemwise: bool, report: bool = False) -> DataFrame:
    """Listings read item by item: an item that is no object goes, the others stay; a field
    of another kind than expected is NULL. Nested lists are read so at each of their levels.

    ``report`` adds ``odd_items``, documents that hold such an item or a field that does
    not parse, and ``unreadable``, those of which nothing parses.
    """
    odd, listed = F.lit(False), {}
    if itemwise and "titleListMap" in docs.columns:
        odd = F.exists(F.map_values("titleListMap"), _has_odd)
        listed["titleListMap"] = F.transform_values("titleListMap", lambda _, items: _listed(items))
    if itemwise and "titleList" in docs.columns:
        odd = _has_odd(F.col("titleList"))
        listed["titleList"] = _listed(F.col("titleList"))
    if itemwise and "data" in docs.columns:
        odd = _sections_odd(F.col("data"))
        listed["data"] = _sections(F.col("data"))
    if report:
        fields = [c for c in docs.columns if c not in (CORRUPT_COLUMN, "filename", "landing_date")]
        nothing = reduce(and_, [F.col(c).isNull() for c in fields])
        # a document kept as VARIANT has no such column, and is NULL when it does not parse
        broken = F.col(CORRUPT_COLUMN).isNotNull() if CORRUPT_COLUMN in docs.columns else nothing
        listed["odd_items"] = F.coalesce(odd, F.lit(False)) | (broken & ~nothing)
        listed["unreadable"] = broken & nothing
    return docs.withColumns(listed).drop(CORRUPT_COLUMN) if listed else docs


def read_files(
    spark: SparkSession,
    paths: str | list[str],
    platform: str,
    target: str,
    schema: str | None = None,
    multiline: bool = True,
    report: bool = False,
    files: str = "*.json",
) -> DataFrame:
    """S3: documents of the given files or globs.

    ``schema`` pins more fields than the default, and has listings read as a whole;
    ``multiline=False`` reads files that hold one document per line, which Spark can
    split. ``report`` adds the columns ``odd_items`` and ``unreadable``, see ``by_item``.
    ``files`` is the pattern of file names.
    """
    reader = landing_reader(spark.read, platform, target, schema, multiline, report, files)
    docs = with_provenance(reader.json(paths))
    return by_item(docs, not schema and (platform, target) in LISTED, report)


def no_documents(
    spark: SparkSession, platform: str, target: str, report: bool = False
) -> DataFrame:
    ddl = f"{LANDING[platform, target]}, filename string, landing_date date"
    flags = ", odd_items boolean, unreadable boolean" if report else ""
    return spark.createDataFrame([], ddl + flags)


def read_landing(
    spark: SparkSession,
    root: str,
    platform: str,
    target: str,
    dates: Iterable[date] | None = None,
    folders: Iterable[str] | None = None,
    schema: str | None = None,
    multiline: bool = True,
    report: bool = False,
) -> DataFrame:
    """Documents of a target, in one scan over all given dates.

    Nothing landed for the dates gives an empty frame, not an error. ``report`` adds
    the columns ``odd_items`` and ``unreadable``, see ``by_item``.
    """
    path = landing_path(root, platform, target, dates, folders)
    try:
        docs = read_files(spark, path, platform, target, schema, multiline, report)
        return at_depth(docs, target)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return no_documents(spark, platform, target, report)


#: Bytes of landed files that go into one file of the compacted layer.
PACKED_BYTES = 256 << 20


def read_packed(
    spark: SparkSession,
    root: str,
    platform: str,
    target: str,
    dates: Iterable[date],
    multiline: bool = True,
    report: bool = False,
) -> DataFrame:
    """K1: documents of some dates, each task's rows of one date and about ``PACKED_BYTES``.

    The listing alone says how many tasks a date needs; scan splits are joined to so many
    without a shuffle, so what each task writes is one file of a fitting size.
    """
    dates = list(dates)
    sizes = inventory(spark, root, platform, target, dates).groupBy("landing_date").agg(
        F.ceil(F.sum("length") / PACKED_BYTES)
    )
    tasks = dict(sizes.collect())  # one row per date
    frames = [
        read_landing(spark, root, platform, target, [day], multiline=multiline, report=report)
        .coalesce(max(1, tasks[day]))
        for day in dates if day in tasks
    ]
    return reduce(DataFrame.unionByName, frames, no_documents(spark, platform, target, report).coalesce(1))


def of_titles(docs: DataFrame, titles: DataFrame) -> DataFrame:
    """Documents in the folders of the titles in ``titles.title_id``.

    A semi join, so the selection may be of any size.
    """
    wanted = titles.select(F.col("title_id").cast("string").alias("__folder")).distinct()
    tagged = docs.withColumn("__folder", path_title("filename"))
    return tagged.join(wanted, "__folder", "left_semi").drop("__folder")


def inventory(
    spark: SparkSession,
    root: str,
    platform: str,
    target: str,
    dates: Iterable[date] | None = None,
) -> DataFrame:
    """Path, length and modification time of every landed file of a target, its
    ``filename`` as documents carry it, and its landing date (NULL outside date folders).

    Only the folders of the given dates are listed. The content column is pruned, so no
    file is opened.
    """
    reader = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.json")
    )
    try:
        files = reader.load(landing_path(root, platform, target, dates))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], INVENTORY)
    listed = files.select("path", "length", F.col("modificationTime").alias("modified"),
                          F.col("_metadata.file_path").alias("filename"))
    return at_depth(listed.withColumn("landing_date", landing_date("filename")), target)


def inventory_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """What happened to landed files between two inventories.

    One row per file that is ``added``, ``gone``, ``grown`` or ``changed`` (another length
    or time stamp, but not longer), with both lengths. ``landing_date`` is that of the file.
    """
    old = before.select("path", F.col("length").alias("length_before"),
                        F.col("modified").alias("__before"), F.col("landing_date").alias("__date"))
    new = after.select("path", F.col("length").alias("length_after"),
                       F.col("modified").alias("__after"), "landing_date")
    change = F.expr("""
        CASE WHEN __before IS NULL THEN 'added' WHEN __after IS NULL THEN 'gone'
             WHEN length_after > length_before THEN 'grown'
             WHEN length_after < length_before OR __before <> __after THEN 'changed' END""")
    met = old.join(new, "path", "full").withColumn("change", change)
    return met.where("change IS NOT NULL").select(
        "path", F.coalesce("landing_date", "__date").alias("landing_date"), "change",
        "length_before", "length_after",
    )
