"""The filter audit against applying every order of the filters one by one."""

import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quirelake.llm import filter_audit
from tests.conftest import rows

WORDS = re.compile("[^\x20\x09-\x0d]+")


@given(st.lists(st.integers(0, 2**32 - 1), max_size=300))
@settings(max_examples=60, deadline=None)
def test_positional_counts(values):
    words = np.array(values, np.uint32)
    want = [sum(v >> i & 1 for v in values) for i in range(32)]
    assert filter_audit.positional_counts(words).tolist() == want


def failures(docs):
    smallest = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            text = text or ""
            smallest[text] = min(smallest.get(text, doc_id), doc_id)
    out = []
    for doc_id, text, lang in docs:
        text = text or ""
        words = WORDS.findall(text)
        bad = ""
        bad += "A" if len(words) < 100 else ""
        bad += "B" if 100 * len(set(words)) < 80 * len(words) else ""
        bad += "C" if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text) else ""
        bad += "D" if re.search("[#$%&*|]", text) else ""
        bad += "E" if doc_id is not None and smallest[text] < doc_id else ""
        out.append((doc_id, lang or "", bad))
    return out


def brute(docs, labels):
    good = {i for i, quality, _ in labels if i is not None and quality == 1}
    toxic = {i for i, _, mark in labels if i is not None and mark == 1}
    failed = failures(docs)
    found, shapley = [], Counter()
    for part in {p for _, p, _ in failed}:
        for order in permutations("ABCDE"):
            left = [f for f in failed if f[1] == part]
            everyone = left
            for step, x in enumerate(order, 1):
                out = [f for f in left if x in f[2]]
                left = [f for f in left if x not in f[2]]
                shapley[part, x] += len(out)
                failing = sum(x in f[2] for f in everyone)
                found.append((part, "".join(order), step, len(left), len(out), failing - len(out),
                              sum(f[2] == x for f in everyone), sum(f[0] in good for f in out),
                              sum(f[0] in toxic for f in out)))
    return [(*f, shapley[f[0], f[1][f[2] - 1]]) for f in found]


COLUMNS = ("part filter_order step kept removed redundant unique_fails good_lost toxic_lost"
           " shapley").split()  # fmt: skip


def fixture():
    rng = random.Random(13)
    words = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(400)]
    docs = []
    for i in range(160):
        pool = words if i % 3 else words[:40]
        text = " ".join(rng.choices(pool, k=rng.choice([0, 5, 99, 100, 130])))
        if i % 5 == 0:
            text = text.upper()
        if i % 7 == 0:
            text += rng.choice(" \t\n") + rng.choice("#$%&*|")
        docs.append((i, text, rng.choice(["en", "de", "", None])))
    docs += [(500 + i, docs[i % 9][1], "en") for i in range(60)]  # copies
    docs += [docs[3], docs[3], docs[20]]  # repeated rows
    docs += [(None, docs[4][1], "de"), (None, None, None), (701, None, "xx"), (702, "", "xx")]
    docs += [(703, "Été 中 " * 20_000, "en"), (704, "x" * 300_000, "en")]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 160, 2)]
    labels += [(4, None, None), (6, 0, 1), (6, 1, 0), (None, 1, 1), (501, 1, 1), (9999, 1, 1)]
    return docs, labels


def test_audit_against_applying_all_orders(spark):
    docs, labels = fixture()
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(filter_audit.marked(table.repartition(5), marks))
    assert got.columns == COLUMNS
    assert rows(got) == sorted(brute(docs, labels), key=lambda t: tuple(map(str, t)))


def test_clashing_columns_and_empty_tables(spark):
    docs, labels = fixture()
    plain = spark.createDataFrame(docs[:30], "doc_id long, text string, lang string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    names = ["part", "mask", "digest", "words", "failed", "label", "spread", "is_first", "n", "s"]
    want = rows(filter_audit.audit(filter_audit.marked(plain, marks)))
    clash = plain.selectExpr("*", *[f"'z' AS {n}" for n in names])
    clash_marks = marks.selectExpr("*", "'z' AS label", "'z' AS spread", "'z' AS text")
    assert rows(filter_audit.audit(filter_audit.marked(clash, clash_marks))) == want
    assert filter_audit.audit(filter_audit.marked(plain.limit(0), marks)).count() == 0
    unlabelled = filter_audit.audit(filter_audit.marked(plain, marks.limit(0)))
    assert unlabelled.selectExpr("sum(good_lost) + sum(toxic_lost)").first()[0] == 0
