"""The curated tables by plain loops over the documents of one landing date."""

from datetime import datetime, timezone

from tests.landed import WEEKDAYS, Docs

_KOREAN = dict(zip("월화수목금토일", range(7)))
_SHORT = dict(zip("mon tue wed thu fri sat sun".split(), range(7)))
_KEYS = dict(zip(WEEKDAYS, range(7)))


def _number(text):
    try:
        return int(text)
    except (TypeError, ValueError):
        return None


def _short_date(text):
    try:
        y, m, d = (int(p) for p in text.split("."))
        return datetime(2000 + y, m, d).date()
    except (AttributeError, ValueError):
        return None


def _iso_date(text):
    try:
        parsed = datetime.fromisoformat(text)
    except (TypeError, ValueError):
        return None
    if parsed.tzinfo:
        parsed = parsed.astimezone(timezone.utc)
    return parsed.date()


def _ms_date(millis):
    return datetime.fromtimestamp(millis / 1000, timezone.utc).date()


def _join_episodes(episodes, likes, comments, require_date):
    """episodes: (title, id, name, image, date); likes: (title, id, n, date or None)."""
    out = set()
    for title, i, name, image, own_date in episodes:
        liked = [r for r in likes if None not in r[:2] and r[:2] == (title, i)]
        for row in liked or [(None, None, None, None)]:
            told = [c for t, e, c in comments if None not in (t, e) and (t, e) == row[:2]]
            for total in told or [None]:
                day = own_date if own_date != "by likes" else row[3]
                if day is not None or not require_date:
                    out.add((title, i, name, row[2], total, image, day))
    return out


def naver(docs: Docs, day, variant) -> dict[str, set]:
    files = {t: list(f.values()) for (p, t, d), f in docs.items() if (p, d) == ("naver", day)}
    listed = []
    for doc in files.get("titles", []):
        for key, titles in doc["titleListMap"].items():
            if variant.all_weekdays or _KEYS[key] == day.weekday():
                listed += [(t, _KEYS[key], False) for t in titles]
    if variant.finished:
        for doc in files.get("finished_titles", []):
            listed += [(t, 7, True) for t in doc["titleList"]]
    infos = [doc["gfpAdCustomParam"] for doc in files.get("title_info", [])]
    days_of = {}
    for info in infos:
        if info.get("tags"):
            codes = {_KOREAN.get(w, 7) for w in info.get("weekdays") or ["day"]}
            days_of.setdefault(info["titleId"], set()).update(codes)
    titles = set()
    for t, code, completed in listed:
        codes = days_of.get(t["titleId"], {None}) if variant.day_from_info else {code}
        for c in codes:
            titles.add((t["titleId"], t["titleName"], t["author"], t["viewCount"],
                        t["thumbnailUrl"], c, completed))
    genres = {(i["titleId"], tag) for i in infos for tag in i.get("tags") or []}

    episodes = [
        (doc["titleId"], a["no"], a["subtitle"], a["thumbnailUrl"],
         "by likes" if variant.date_by_likes else _short_date(a["serviceDateDescription"]))
        for doc in files.get("episodes", []) for a in doc["articleList"]
    ]
    part = lambda key, n: _number((key.split("_") + [None])[n])
    likes = [
        (part(c["contentsId"], 0), part(c["contentsId"], 1), r["count"], _ms_date(doc["timestamp"]))
        for doc in files.get("episode_likes", []) for c in doc["contents"][:1]
        for r in c["reactions"]
    ]
    comments = [
        (part(c["objectId"], 0), part(c["objectId"], 1), doc["result"]["count"]["total"])
        for doc in files.get("comments", []) for c in doc["result"]["commentList"][:1]
    ]
    rows = _join_episodes(episodes, likes, comments, variant.require_date)
    return {"titles": titles, "genres": genres, "episodes": rows}


def kakao(docs: Docs, day, variant) -> dict[str, set]:
    named = {t: f for (p, t, d), f in docs.items() if (p, d) == ("kakao", day)}
    files = {t: list(f.values()) for t, f in named.items()}
    cards = []
    for target, completed in (("titles", False), ("finished_titles", True)):
        if completed and not variant.finished:
            continue
        for doc in files.get(target, []):
            for section in doc["data"]:
                for group in section["cardGroups"]:
                    cards += [(c["content"], section["title"], completed) for c in group["cards"]]
    infos = [doc["data"] for doc in files.get("title_info", [])]
    titles, genres = set(), set()
    for c, weekday, completed in cards:
        words = c["seoKeywords"] or []
        genres |= {(c["id"], w[1:]) for w in words}
        if not words:
            continue
        if variant.day_from_info:
            found = {
                (i["statistics"]["viewCount"], _SHORT.get(b["title"], 7))
                for i in infos if i["id"] == c["id"]
                for b in i.get("badges") or [] if b["type"] == "WEEKDAYS"
            } or {(None, None)}
        else:
            code = _KOREAN.get(weekday, 7)
            found = {
                (i["statistics"]["viewCount"], code) for i in infos if i["id"] == c["id"]
            } or {(None, code)}
        author = " / ".join(a["name"] for a in c["authors"] if a["name"] is not None)
        for views, code in found:
            titles.add((c["id"], c["title"], author, views, c["featuredCharacterImageA"],
                        code, completed))
    episodes = [
        (e["contentId"], e["id"], e["title"], e["asset"]["thumbnailImage"],
         _iso_date(e[variant.date_field]))
        for doc in files.get("episodes", []) for e in doc["data"]["episodes"]
    ]
    likes = [
        (_number(name.split("/")[0]), doc["data"]["episodeId"], doc["data"]["likeCount"], None)
        for name, doc in named.get("episode_likes", {}).items()
    ]
    comments = [
        (_number(name.split("/")[0]), _number(name.split("/")[1]),
         doc["meta"]["pagination"]["totalCount"])
        for name, doc in named.get("comments", {}).items()
    ]
    rows = _join_episodes(episodes, likes, comments, variant.require_date)
    return {"titles": titles, "genres": genres, "episodes": rows}


COLUMNS = {
    "titles": ["id", "title", "author", "views", "image_url", "release_day", "is_completed"],
    "genres": ["title_id", "genre_name"],
    "episodes": ["title_id", "id", "title", "likes", "comments", "image_url", "updated_date"],
}


def curated(docs: Docs, days, variant) -> dict[str, list[tuple]]:
    """All curated rows, each led by (year, month, day, platform)."""
    out = {table: [] for table in COLUMNS}
    for day in days:
        for name, rules in (("naver", naver), ("kakao", kakao)):
            for table, found in rules(docs, day, variant).items():
                out[table] += [(day.year, day.month, day.day, name, *row) for row in found]
    return out
