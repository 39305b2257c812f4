"""Pinned schemas, as DDL text.

Reading with a pinned schema saves the inference pass over the landing files,
turns a missing field into NULL instead of an analysis error (an all-empty
array would otherwise infer as ``array<string>``), and lets Spark skip the
fields that nothing reads.
"""

from quirelake.conventions import KAKAO, NAVER

_NAVER_TITLE = (
    "struct<titleId: bigint, titleName: string, author: string,"
    " viewCount: bigint, thumbnailUrl: string>"
)
_NAVER_ARTICLE = (
    "struct<no: bigint, subtitle: string, thumbnailUrl: string,"
    " serviceDateDescription: string>"
)
_KAKAO_CONTENT = (
    "struct<id: bigint, title: string, authors: array<struct<name: string>>,"
    " featuredCharacterImageA: string, seoKeywords: array<string>>"
)
_KAKAO_SECTION = (
    "struct<title: string,"
    f" cardGroups: array<struct<cards: array<struct<content: {_KAKAO_CONTENT}>>>>>"
)
_KAKAO_EPISODE = (
    "struct<contentId: bigint, id: bigint, title: string,"
    " asset: struct<thumbnailImage: string>,"
    " serialStartDateTime: string, useStartDateTime: string, useType: string>"
)

_NAVER_INFO = (
    "gfpAdCustomParam struct<titleId: bigint, tags: array<string>,"
    " weekdays: array<string>>"
)
_NAVER_LIKES = (
    "contents array<struct<contentsId: string,"
    " reactions: array<struct<count: bigint>>,"
    " reactionMap: map<string, string>>>, timestamp bigint"
)
_NAVER_COMMENTS = (
    "result struct<commentList: array<struct<objectId: string>>,"
    " count: struct<total: bigint>>"
)
_KAKAO_INFO = (
    "data struct<id: bigint, statistics: struct<viewCount: bigint>,"
    " badges: array<struct<type: string, title: string>>>"
)

# Targets whose documents nothing downstream looks into are kept as VARIANT.
OPAQUE = {(NAVER, "episode_info")}
VARIANT_COLUMN = "document"

LANDING = {
    (NAVER, "titles"): f"titleListMap map<string, array<{_NAVER_TITLE}>>",
    (NAVER, "finished_titles"): (
        f"titleList array<{_NAVER_TITLE}>, pageInfo struct<totalPages: bigint>"
    ),
    (NAVER, "title_info"): _NAVER_INFO,
    (NAVER, "episodes"): (
        f"titleId bigint, totalCount bigint, articleList array<{_NAVER_ARTICLE}>,"
        " pageInfo struct<totalPages: bigint>"
    ),
    (NAVER, "episode_info"): f"{VARIANT_COLUMN} variant",
    (NAVER, "episode_likes"): _NAVER_LIKES,
    (NAVER, "comments"): _NAVER_COMMENTS,
    (KAKAO, "titles"): f"data array<{_KAKAO_SECTION}>",
    (KAKAO, "finished_titles"): f"data array<{_KAKAO_SECTION}>",
    (KAKAO, "title_info"): _KAKAO_INFO,
    (KAKAO, "episodes"): f"data struct<episodes: array<{_KAKAO_EPISODE}>>",
    (KAKAO, "episode_likes"): "data struct<episodeId: bigint, likeCount: bigint>",
    (KAKAO, "comments"): "meta struct<pagination: struct<totalCount: bigint>>",
}

# Listings whose items are read one by one, so that an odd item costs only itself.
LISTED = {
    (NAVER, "titles"): "titleListMap map<string, array<variant>>",
    (NAVER, "finished_titles"): "titleList array<variant>, pageInfo struct<totalPages: bigint>",
    (KAKAO, "titles"): "data array<variant>",
    (KAKAO, "finished_titles"): "data array<variant>",
}
LISTED_FIELDS = {
    "titleId": "bigint",
    "titleName": "string",
    "author": "string",
    "viewCount": "bigint",
    "thumbnailUrl": "string",
}
LISTED_SECTIONS = f"array<{_KAKAO_SECTION}>"
CORRUPT_COLUMN = "_corrupt_record"

# Landed documents that a run could not take as a whole: where, and what is wrong.
QUARANTINE = "filename string, problem string, year int, month int, day int, platform string, target string"

_PROVENANCE = ", filename string"
_PARTITIONS = ", year int, month int, day int, platform string"

# The compacted layer: one row per document, or per element where the
# compaction already flattens the outermost list.
OPTIMIZED = {
    (NAVER, "titles"): f"title {_NAVER_TITLE}, weekday_str string",
    (NAVER, "finished_titles"): f"title {_NAVER_TITLE}, weekday_str string",
    (NAVER, "title_info"): _NAVER_INFO,
    (NAVER, "episodes"): f"article {_NAVER_ARTICLE}, title_id bigint",
    (NAVER, "episode_info"): f"{VARIANT_COLUMN} variant",
    (NAVER, "episode_likes"): _NAVER_LIKES,
    (NAVER, "comments"): _NAVER_COMMENTS,
    (KAKAO, "titles"): f"data {_KAKAO_SECTION}",
    (KAKAO, "finished_titles"): f"data {_KAKAO_SECTION}",
    (KAKAO, "title_info"): _KAKAO_INFO,
    (KAKAO, "episodes"): f"episodes {_KAKAO_EPISODE}",
    (KAKAO, "episode_likes"): "data struct<episodeId: bigint, likeCount: bigint>",
    (KAKAO, "comments"): (
        "meta struct<pagination: struct<totalCount: bigint>>,"
        " title_id string, episode_id string"
    ),
}
OPTIMIZED = {
    key: ddl + _PROVENANCE + _PARTITIONS for key, ddl in OPTIMIZED.items()
}

CURATED = {
    "titles": (
        "id bigint, title string, author string, views bigint,"
        " image_url string, release_day int, is_completed boolean"
    ),
    "genres": "title_id bigint, genre_name string",
    "episodes": (
        "title_id bigint, id bigint, title string, likes bigint,"
        " comments bigint, image_url string, updated_date date"
    ),
}
CURATED = {table: ddl + _PARTITIONS for table, ddl in CURATED.items()}
