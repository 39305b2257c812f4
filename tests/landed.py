"""Landed documents for tests: hand-made edge cases and random ones."""

import json
import random
from datetime import date
from pathlib import Path

DAY1 = date(2025, 2, 27)  # a Thursday
DAY2 = date(2025, 2, 28)  # a Friday

WEEKDAYS = "MONDAY TUESDAY WEDNESDAY THURSDAY FRIDAY SATURDAY SUNDAY".split()

# {(platform, target, date): {name below the date folder: document}}
Docs = dict


def write(root: Path, docs: Docs) -> None:
    for (platform, target, day), files in docs.items():
        folder = root / "raw" / platform / target / f"{day:%Y/%m/%d}"
        for name, document in files.items():
            path = folder / f"{name}.json"
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text(json.dumps(document, ensure_ascii=False, indent=4))


def _naver_title(i, views=10):
    return {
        "titleId": i,
        "titleName": f"t{i}",
        "author": f"a{i}",
        "viewCount": views,
        "thumbnailUrl": f"/t{i}.jpg",
        "unread": {"x": 1},
    }


def _article(no, text):
    return {
        "no": no,
        "subtitle": f"ep {no}",
        "thumbnailUrl": f"/e{no}.jpg",
        "serviceDateDescription": text,
    }


def _content(i, keywords, authors=("A", "B")):
    return {
        "id": i,
        "title": f"k{i}",
        "authors": [{"name": a} for a in authors],
        "featuredCharacterImageA": f"/k{i}.png",
        "seoKeywords": keywords,
    }


def _page(weekday, *groups):
    return {
        "data": [
            {
                "title": weekday,
                "cardGroups": [{"cards": [{"content": c} for c in g]} for g in groups],
            }
        ]
    }


def _kakao_episode(title, i, serial, use, use_type="FREE"):
    return {
        "contentId": title,
        "id": i,
        "title": f"e{i}",
        "asset": {"thumbnailImage": f"/e{i}.png"},
        "serialStartDateTime": serial,
        "useStartDateTime": use,
        "useType": use_type,
    }


def _likes(key, counts, stamp=1740700800000):
    return {
        "contents": [{"contentsId": key, "reactions": [{"count": c} for c in counts]}],
        "timestamp": stamp,
    }


def _comments(keys, total):
    return {
        "result": {
            "commentList": [{"objectId": k} for k in keys],
            "count": {"total": total},
        }
    }


def edge_cases() -> Docs:
    """Every case the rules of the curated tables turn on."""
    naver = {
        ("naver", "titles", DAY1): {
            "titles": {
                "titleListMap": {
                    "MONDAY": [_naver_title(1), _naver_title(2)],
                    "THURSDAY": [_naver_title(2), _naver_title(2), _naver_title(3)],
                    "SUNDAY": [],
                }
            }
        },
        ("naver", "titles", DAY2): {
            "titles": {
                "titleListMap": {
                    "THURSDAY": [_naver_title(3)],
                    "FRIDAY": [_naver_title(4, views=7)],
                }
            }
        },
        ("naver", "finished_titles", DAY1): {
            "finished_titles_1": {
                "titleList": [_naver_title(8), _naver_title(9)],
                "pageInfo": {"totalPages": 2},
            },
            "finished_titles_2": {"titleList": []},
        },
        ("naver", "title_info", DAY1): {
            "2": {
                "gfpAdCustomParam": {
                    "titleId": 2,
                    "tags": ["drama", "drama", "school"],
                    "weekdays": ["월", "목"],
                }
            },
            "3": {"gfpAdCustomParam": {"titleId": 3, "tags": [], "weekdays": ["수"]}},
            "8": {"gfpAdCustomParam": {"titleId": 8, "tags": ["gag"], "weekdays": []}},
            "9": {"gfpAdCustomParam": {"titleId": 9, "tags": ["gag"]}},
        },
        ("naver", "title_info", DAY2): {
            "4": {"gfpAdCustomParam": {"titleId": 4, "tags": ["action"]}}
        },
        ("naver", "episodes", DAY1): {
            "2/episodes_1": {
                "titleId": 2,
                "totalCount": 6,
                "articleList": [
                    _article(1, "25.02.01"),
                    _article(2, "25.02.08"),
                    _article(3, "soon"),
                    _article(4, None),
                    _article(5, "25.02.29"),
                    _article(6, "25.02.22"),
                ],
            },
            "3/episodes_1": {
                "titleId": 3,
                "totalCount": 2,
                "articleList": [_article(1, "24.12.31"), _article(2, "95.01.02")],
            },
            "9/episodes_1": {"titleId": 9, "totalCount": 0, "articleList": []},
        },
        ("naver", "episodes", DAY2): {
            "2/episodes_1": {"titleId": 2, "articleList": [_article(1, "25.02.01")]}
        },
        ("naver", "episode_info", DAY1): {
            "2/1": {"anything": [1, {"deep": "x"}]},
            "2/2": {"other": "shape"},
        },
        ("naver", "episode_likes", DAY1): {
            "2/1": _likes("2_1", [5]),
            "2/2": _likes("2_2", [7, 9]),
            "2/6": _likes("2_6", []),
            "3/1": _likes("3_1", [4], stamp=1740614400000),
            "3/2": _likes("broken", [3]),
        },
        ("naver", "episode_likes", DAY2): {"2/1": _likes("2_1", [6])},
        ("naver", "comments", DAY1): {
            "2/1": _comments(["2_1", "2_1"], 11),
            "2/2": _comments([], 0),
            "2/6": _comments(["2_6"], 3),
            "3/1": _comments(["3_1"], 8),
        },
        # an empty comment list alone in its batch
        ("naver", "comments", DAY2): {"2/1": _comments([], 0)},
    }
    kakao = {
        ("kakao", "titles", DAY1): {
            "titles_0": _page(
                "월",
                [_content(51, ["#love", "#school"]), _content(52, [])],
                [_content(53, ["#gag"], authors=("A", None, "C"))],
            ),
            "titles_3": _page("목", [_content(51, ["#love"]), _content(54, None)]),
        },
        ("kakao", "titles", DAY2): {
            "titles_4": _page("금", [_content(55, ["#x"], authors=())])
        },
        ("kakao", "finished_titles", DAY1): {
            "finished_titles": _page("완결", [_content(58, ["#old"])])
        },
        ("kakao", "title_info", DAY1): {
            "51": {
                "data": {
                    "id": 51,
                    "statistics": {"viewCount": 1000},
                    "badges": [
                        {"type": "WEEKDAYS", "title": "mon"},
                        {"type": "ADULT", "title": "19"},
                        {"type": "WEEKDAYS", "title": "thu"},
                    ],
                }
            },
            "53": {
                "data": {
                    "id": 53,
                    "statistics": {"viewCount": 30},
                    "badges": [{"type": "ADULT", "title": "19"}],
                }
            },
            "58": {
                "data": {
                    "id": 58,
                    "statistics": {"viewCount": 80},
                    "badges": [{"type": "WEEKDAYS", "title": "sat"}],
                }
            },
        },
        ("kakao", "title_info", DAY2): {
            "55": {"data": {"id": 55, "statistics": {"viewCount": 5}}}
        },
        ("kakao", "episodes", DAY1): {
            "51/episodes": {
                "data": {
                    "episodes": [
                        _kakao_episode(51, 501, "2025-02-01T10:00:00", "2025-02-03"),
                        _kakao_episode(51, 502, "2025-02-08T23:30:00-02:00", None),
                        _kakao_episode(51, 503, "n/a", "2025-02-05", "WAIT"),
                        _kakao_episode(51, 504, "2025-02-15T10:00:00Z", "bad"),
                    ]
                }
            }
        },
        ("kakao", "episodes", DAY2): {"55/episodes": {"data": {"episodes": []}}},
        ("kakao", "episode_likes", DAY1): {
            "51/501": {"data": {"episodeId": 501, "likeCount": 21}},
            "51/502": {"data": {"episodeId": 502, "likeCount": 22}},
            "51/503": {"data": {"episodeId": 503, "likeCount": 23}},
            "x1/504": {"data": {"episodeId": 504, "likeCount": 24}},
        },
        ("kakao", "comments", DAY1): {
            "51/501": {"meta": {"pagination": {"totalCount": 31}}},
            "51/503": {"meta": {"pagination": {"totalCount": 33}}},
            "51/504": {"meta": {"pagination": {"totalCount": 34}}},
        },
    }
    return naver | kakao


def random_docs(seed: int) -> Docs:
    """Random documents over few ids, so that keys meet, repeat and miss."""
    rng = random.Random(seed)
    ids = range(1, 7)
    some = lambda low, high: range(rng.randint(low, high))
    pick = lambda *options: rng.choice(options)
    out: Docs = {}
    for day in (DAY1, DAY2):
        lists = {
            d: [_naver_title(rng.choice(ids), rng.randint(1, 2)) for _ in some(0, 3)]
            for d in rng.sample(WEEKDAYS, 5)
        }
        out["naver", "titles", day] = {"titles": {"titleListMap": lists}}
        out["naver", "finished_titles", day] = {
            f"finished_titles_{p}": {
                "titleList": [_naver_title(rng.choice(ids)) for _ in some(0, 3)]
            }
            for p in (1, 2)
        }
        out["naver", "title_info", day] = {
            str(i): {
                "gfpAdCustomParam": {
                    "titleId": i,
                    "tags": pick(None, [], ["a"], ["a", "b", "a"]),
                    "weekdays": pick(None, [], ["월"], ["화", "일"], ["?"]),
                }
            }
            for i in ids
        }
        out["naver", "episodes", day] = {
            f"{i}/episodes_{p}": {
                "titleId": i,
                "articleList": [
                    _article(rng.randint(1, 4), pick("25.02.01", "x", None, "24.02.29"))
                    for _ in some(0, 4)
                ],
            }
            for i in ids
            for p in (1, 2)
        }
        out["naver", "episode_likes", day] = {
            f"{i}/{e}": _likes(
                pick(f"{i}_{e}", f"{i}_{e}", "bad", f"{i}"),
                [rng.randint(1, 3) for _ in some(0, 3)],
                rng.choice((1740614400000, 1740700799999)),
            )
            for i in ids
            for e in range(1, 5)
            if rng.random() < 0.7
        }
        out["naver", "comments", day] = {
            f"{i}/{e}": _comments([f"{i}_{e}"] * rng.randint(0, 2), rng.randint(0, 5))
            for i in ids
            for e in range(1, 5)
            if rng.random() < 0.7
        }
        card = lambda: _content(
            rng.choice(ids),
            pick(None, [], ["#a"], ["#a", "#b", "#a"], ["x", ""]),
            pick((), ("A",), ("A", None, "B")),
        )
        page = lambda w: _page(
            w, *[[card() for _ in some(0, 3)] for _ in some(0, 2)]
        )
        out["kakao", "titles", day] = {
            f"titles_{n}": page(w) for n, w in enumerate(("월", "수", "일"))
        }
        out["kakao", "finished_titles", day] = {"finished_titles": page("완결")}
        badge = lambda: {
            "type": pick("WEEKDAYS", "WEEKDAYS", "ADULT"),
            "title": pick("mon", "sun", "19"),
        }
        out["kakao", "title_info", day] = {
            str(i): {
                "data": {
                    "id": i,
                    "statistics": {"viewCount": rng.randint(1, 9)},
                    "badges": pick(None, [badge() for _ in some(0, 3)]),
                }
            }
            for i in ids
            if rng.random() < 0.8
        }
        out["kakao", "episodes", day] = {
            f"{i}/episodes": {
                "data": {
                    "episodes": [
                        _kakao_episode(
                            i,
                            rng.randint(1, 4),
                            pick("2025-02-01T10:00:00", "bad", None),
                            pick("2025-01-01 23:00:00", "bad", None),
                        )
                        for _ in some(0, 4)
                    ]
                }
            }
            for i in ids
        }
        out["kakao", "episode_likes", day] = {
            f"{pick(i, i, i, 'x')}/{e}": {
                "data": {"episodeId": e, "likeCount": rng.randint(1, 3)}
            }
            for i in ids
            for e in range(1, 5)
            if rng.random() < 0.7
        }
        out["kakao", "comments", day] = {
            f"{i}/{e}": {"meta": {"pagination": {"totalCount": rng.randint(0, 5)}}}
            for i in ids
            for e in range(1, 5)
            if rng.random() < 0.7
        }
    return out
