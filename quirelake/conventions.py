"""Values fixed by the landed data and by the curated contract.

Everything in this module has to match what the platforms deliver or what
readers of the curated tables expect, so it is stated here once, as text.
"""

# --- fixed values: platforms and landing targets ---------------------------
NAVER = "naver"
KAKAO = "kakao"
PLATFORMS = (NAVER, KAKAO)

# one document per file directly under the date folder
FLAT_TARGETS = ("titles", "finished_titles", "title_info")
# one folder per title under the date folder
FOLDER_TARGETS = ("episodes", "episode_info", "episode_likes", "comments")

TARGETS = {
    NAVER: (
        "titles",
        "finished_titles",
        "title_info",
        "episodes",
        "episode_info",
        "episode_likes",
        "comments",
    ),
    KAKAO: (
        "titles",
        "finished_titles",
        "title_info",
        "episodes",
        "episode_likes",
        "comments",
    ),
}

# --- fixed values: weekday spellings and their release_day codes -----------
WEEKDAY_KEYS = (
    "MONDAY",
    "TUESDAY",
    "WEDNESDAY",
    "THURSDAY",
    "FRIDAY",
    "SATURDAY",
    "SUNDAY",
)
WEEKDAY_SPELLINGS = {
    0: ("MONDAY", "월", "mon"),
    1: ("TUESDAY", "화", "tue"),
    2: ("WEDNESDAY", "수", "wed"),
    3: ("THURSDAY", "목", "thu"),
    4: ("FRIDAY", "금", "fri"),
    5: ("SATURDAY", "토", "sat"),
    6: ("SUNDAY", "일", "sun"),
}
OTHER_RELEASE_DAY = 7
FINISHED_WEEKDAY = "FINISHED"
MISSING_WEEKDAY = "day"
WEEKDAY_BADGE = "WEEKDAYS"

# --- fixed values: text conventions ----------------------------------------
AUTHOR_SEPARATOR = " / "
KEY_SEPARATOR = "_"
SHORT_DATE_PATTERN = "yy.MM.dd"
FREE_USE_TYPE = "FREE"

# --- fixed values: request sizes of the daily mode --------------------------
KAKAO_LATEST_EPISODES = 10
NAVER_LATEST_EPISODES = 1
TOP_COMMENTS = 10

# --- fixed values: file counts and preview sizes ----------------------------
OPTIMIZED_FILES = 10
MERGED_FILES_PER_BATCH = 2
BACKUP_FILES = 50
READER_PREVIEW_ROWS = 25
JOB_PREVIEW_ROWS = 50

# --- fixed values: curated contract -----------------------------------------
TITLE_COLUMNS = (
    "platform",
    "id",
    "title",
    "author",
    "views",
    "image_url",
    "release_day",
    "is_completed",
)
GENRE_COLUMNS = ("platform", "title_id", "genre_name")
EPISODE_COLUMNS = (
    "platform",
    "title_id",
    "id",
    "title",
    "likes",
    "comments",
    "image_url",
    "updated_date",
)
CURATED = {
    "titles": TITLE_COLUMNS,
    "genres": GENRE_COLUMNS,
    "episodes": EPISODE_COLUMNS,
}
PARTITION_COLUMNS = ("year", "month", "day", "platform")
