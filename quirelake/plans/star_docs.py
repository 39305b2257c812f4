"""Landing documents derived from a star schema of orders and line items.

The registered queries need nested documents in the shape the platforms
deliver.  These functions build them from whole tables, one document per row,
so every array inside stays small whatever the data looks like:

    customer, supplier   ongoing and finished titles, title info
    orders               episodes (title = customer)
    lineitem             likes responses and comment counts per episode
    part                 title lists per weekday
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _struct(**fields):
    return F.struct(*[c.alias(name) for name, c in fields.items()])


# --- episodes, likes, comments ----------------------------------------------


def naver_episode_docs(
    orders: DataFrame, keep: tuple[str, ...] | list[str] = ()
) -> DataFrame:
    """One article list per order; pending orders have no readable date."""
    date = F.when(F.col("o_orderstatus") == "P", F.lit("soon")).otherwise(
        F.date_format("o_orderdate", "yy.MM.dd")
    )
    article = _struct(
        no=F.col("o_orderkey"),
        subtitle=F.col("o_orderpriority"),
        thumbnailUrl=F.concat(F.lit("/"), "o_orderstatus"),
        serviceDateDescription=date,
    )
    return orders.select(
        F.col("o_custkey").alias("titleId"),
        F.array(article).alias("articleList"),
        *keep,
    )


def _episode_key():
    return F.concat_ws("_", "o_custkey", "o_orderkey")


def naver_likes_docs(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """One response per line item; only returned items ('A') have reactions."""
    reaction = "array<struct<count: bigint>>"
    reactions = F.when(
        F.col("l_returnflag") == "A",
        F.array(
            _struct(count=F.col("l_quantity").cast("bigint")),
            _struct(count=F.col("l_linenumber").cast("bigint")),
        ),
    ).otherwise(F.array().cast(reaction))
    owner = orders.select("o_orderkey", "o_custkey")
    return lineitem.join(owner, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.array(_struct(contentsId=_episode_key(), reactions=reactions)).alias(
            "contents"
        ),
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("timestamp"),
    )


def naver_comments_docs(
    lineitem: DataFrame, orders: DataFrame, keep: tuple[str, ...] | list[str] = ()
) -> DataFrame:
    """One response per order with line items; the total counts returns ('R')."""
    totals = lineitem.groupBy("l_orderkey").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("total")
    )
    listed = F.when(
        F.col("total") > 0, F.array(_struct(objectId=_episode_key()))
    ).otherwise(F.array().cast("array<struct<objectId: string>>"))
    owner = orders.select("o_orderkey", "o_custkey")
    return totals.join(owner, F.col("l_orderkey") == F.col("o_orderkey")).select(
        _struct(commentList=listed, count=_struct(total=F.col("total"))).alias(
            "result"
        ),
        *keep,
    )


def kakao_episode_docs(orders: DataFrame) -> DataFrame:
    """One episode list per order, dated by two ISO texts."""
    start = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    use_start = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(
        F.date_format(
            F.col("o_orderdate") + F.expr("INTERVAL 12 HOURS"), "yyyy-MM-dd HH:mm:ss"
        )
    )
    use_type = F.when(F.col("o_orderstatus") == "F", F.lit("FREE")).otherwise(
        F.lit("WAIT")
    )
    episode = _struct(
        contentId=F.col("o_custkey"),
        id=F.col("o_orderkey"),
        title=F.col("o_orderpriority"),
        asset=_struct(thumbnailImage=F.concat(F.lit("/"), "o_orderstatus")),
        serialStartDateTime=start,
        useStartDateTime=use_start,
        useType=use_type,
    )
    return orders.select(_struct(episodes=F.array(episode)).alias("data"))


def _landing_path(target: str, day, *names):
    folder = F.date_format(day, "yyyy/MM/dd")
    head = F.concat(F.lit(f"s3a://lake/raw/kakao/{target}/"), folder)
    return F.concat(F.concat_ws("/", head, *names), F.lit(".json"))


def kakao_likes_docs(orders: DataFrame) -> DataFrame:
    """One response per order; the folder of a pending one names no title."""
    data = _struct(
        episodeId=F.col("o_orderkey"),
        likeCount=F.col("o_totalprice").cast("bigint"),
    )
    title = F.when(F.col("o_orderstatus") == "P", F.lit("unsorted")).otherwise(
        F.col("o_custkey").cast("string")
    )
    path = _landing_path("episode_likes", "o_orderdate", title, "o_orderkey")
    return orders.select(data.alias("data"), path.alias("filename"))


def kakao_comments_docs(orders: DataFrame) -> DataFrame:
    """One response per order; open ones have a file name with two dots."""
    total = F.length("o_orderpriority").cast("bigint")
    stem = F.when(
        F.col("o_orderstatus") == "O", F.concat("o_orderkey", F.lit(".part"))
    ).otherwise(F.col("o_orderkey").cast("string"))
    path = _landing_path("comments", "o_orderdate", "o_custkey", stem)
    meta = _struct(pagination=_struct(totalCount=total))
    return orders.select(meta.alias("meta"), path.alias("filename"))


# --- titles -------------------------------------------------------------------


def _segment_weekday(segment):
    return (
        F.when(segment == "AUTOMOBILE", F.lit("월"))
        .when(segment == "BUILDING", F.lit("수"))
        .when(segment == "FURNITURE", F.lit("금"))
        .when(segment == "HOUSEHOLD", F.lit("일"))
        .otherwise(F.lit("완결"))
    )


def _kakao_page(weekday, content):
    """A page of one section and two groups; the second group has no keywords."""
    promoted = content.withField("id", -content["id"] - 1).withField(
        "seoKeywords", F.lit(None).cast("array<string>")
    )
    groups = [_struct(cards=F.array(_struct(content=c))) for c in (content, promoted)]
    return F.array(_struct(title=weekday, cardGroups=F.array(*groups)))


def kakao_title_docs(customer: DataFrame) -> DataFrame:
    """One title page per customer; debtors have no keywords."""
    segment = F.col("c_mktsegment")
    content = _struct(
        id=F.col("c_custkey"),
        title=F.col("c_name"),
        authors=F.array(
            _struct(name=F.col("c_name")),
            _struct(name=F.lit(None).cast("string")),
            _struct(name=segment),
        ),
        featuredCharacterImageA=F.concat(F.lit("/"), "c_nationkey"),
        seoKeywords=F.when(F.col("c_acctbal") < 0, F.array().cast("array<string>"))
        .otherwise(F.array(F.concat(F.lit("#"), segment), F.lit("#all"))),
    )
    return customer.select(_kakao_page(_segment_weekday(segment), content).alias("data"))


def kakao_finished_docs(supplier: DataFrame) -> DataFrame:
    """One finished-title page per supplier."""
    content = _struct(
        id=F.col("s_suppkey"),
        title=F.col("s_name"),
        authors=F.array(_struct(name=F.col("s_name"))),
        featuredCharacterImageA=F.concat(F.lit("/"), "s_nationkey"),
        seoKeywords=F.array(F.lit("#finished")),
    )
    return supplier.select(_kakao_page(F.lit("완결"), content).alias("data"))


def kakao_view_docs(supplier: DataFrame) -> DataFrame:
    """One info document per supplier: view counts without badges."""
    views = F.col("s_acctbal").cast("bigint")
    data = _struct(id=F.col("s_suppkey"), statistics=_struct(viewCount=views))
    return supplier.select(data.alias("data"))


def kakao_info_docs(customer: DataFrame) -> DataFrame:
    """One info document per customer; machinery has no weekday badge."""
    segment = F.col("c_mktsegment")
    badge = lambda kind, title: _struct(type=F.lit(kind), title=F.lit(title))
    badges = (
        F.when(segment == "MACHINERY", F.array(badge("ADULT", "19")))
        .when(
            segment == "BUILDING",
            F.array(badge("WEEKDAYS", "mon"), badge("WEEKDAYS", "thu")),
        )
        .otherwise(F.array(badge("ADULT", "19"), badge("WEEKDAYS", "sun")))
    )
    data = _struct(
        id=F.col("c_custkey"),
        statistics=_struct(viewCount=F.col("c_acctbal").cast("bigint")),
        badges=badges,
    )
    return customer.select(data.alias("data"))


def _naver_title(key, name, author, views):
    return _struct(
        titleId=key,
        titleName=name,
        author=author,
        viewCount=views.cast("bigint"),
        thumbnailUrl=F.concat(F.lit("/"), name),
    )


def naver_title_docs(part: DataFrame) -> DataFrame:
    """One weekday map per part: listed on two days, on a third for large parts."""
    title = _naver_title(
        F.col("p_partkey"), F.col("p_name"), F.col("p_brand"), F.col("p_retailprice")
    )
    none = F.array().cast(
        "array<struct<titleId: bigint, titleName: string, author: string,"
        " viewCount: bigint, thumbnailUrl: string>>"
    )
    large = F.when(F.col("p_size") > 25, F.array(title)).otherwise(none)
    by_day = F.create_map(
        F.lit("MONDAY"), F.array(title),
        F.lit("THURSDAY"), F.array(title, title),
        F.lit("SUNDAY"), large,
    )
    return part.select(by_day.alias("titleListMap"))


def naver_day_docs(orders: DataFrame) -> DataFrame:
    """One weekday map per order, landed on the order date; three days listed."""
    title = _naver_title(
        F.col("o_custkey"),
        F.col("o_orderpriority"),
        F.col("o_orderstatus"),
        F.col("o_orderkey"),
    )
    by_day = F.create_map(
        F.lit("TUESDAY"), F.array(title),
        F.lit("FRIDAY"), F.array(title),
        F.lit("SATURDAY"), F.array(title, title),
    )
    return orders.select(
        by_day.alias("titleListMap"),
        F.col("o_orderdate").cast("date").alias("landing_date"),
    )


def naver_finished_docs(supplier: DataFrame) -> DataFrame:
    """One finished list per supplier."""
    title = _naver_title(
        F.col("s_suppkey"), F.col("s_name"), F.lit("staff"), F.col("s_acctbal")
    )
    return supplier.select(F.array(title).alias("titleList"))


def naver_info_docs(part: DataFrame) -> DataFrame:
    """One info document per part: tags from brand and type, weekdays by size."""
    size = F.col("p_size")
    tags = F.when(size < 5, F.array().cast("array<string>")).otherwise(
        F.array("p_brand", "p_type")
    )
    weekdays = (
        F.when(size > 40, F.lit(None).cast("array<string>"))
        .when(size > 30, F.array().cast("array<string>"))
        .when(size > 20, F.array(F.lit("월"), F.lit("토")))
        .otherwise(F.array(F.lit("화")))
    )
    info = _struct(titleId=F.col("p_partkey"), tags=tags, weekdays=weekdays)
    return part.select(info.alias("gfpAdCustomParam"))
