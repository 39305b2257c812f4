"""Fingerprints against plain sums over paragraphs, and the edit query against plain loops."""

import base64
import random
from collections import Counter
from hashlib import blake2b, sha256, shake_128

import numpy as np
import pytest
from pyspark.sql import functions as F

from quirelake.llm import multiset_hash as mh
from quirelake.llm.words import WordHashes, shingles, word_hashes
from tests.conftest import rows


def plain_fingerprint(text):
    """Lane by lane, paragraph by paragraph, with Python's numbers."""
    wide, signs = [0] * (mh.LANES + 1), [0] * mh.SIGNS
    for line in (text or "").split("\n"):
        words = [int.from_bytes(blake2b(w, digest_size=8).digest(), "little")
                 for w in line.encode().split()]
        if not words:
            continue
        raw = shake_128(line.encode()).digest(8 * mh.LANES)
        hashed = [int.from_bytes(raw[8 * i : 8 * i + 8], "little") for i in range(mh.LANES)]
        wide = [(a + b) % 2**64 for a, b in zip(wide, [1, *hashed])]
        words += [0] * (mh.WIDTH - len(words))
        for h in shingles(np.array(words, np.uint64), mh.WIDTH):
            for block in range(mh.SIGNS // 64):
                bits = int(mh.mixed(np.array([h + np.uint64(block)], np.uint64))[0])
                for i in range(64):
                    signs[64 * block + i] += 1 if bits >> i & 1 else -1
    raw = b"".join(v.to_bytes(8, "little") for v in wide)
    return base64.b64encode(raw + b"".join((s % 2**32).to_bytes(4, "little") for s in signs)).decode()


def texts():
    rng = random.Random(12)
    words = ["".join(rng.choices("abcdeé中", k=rng.randint(1, 6))) for _ in range(150)]
    lines = [" ".join(rng.choices(words, k=rng.randint(1, 30))) for _ in range(60)]
    out = ["\n".join(rng.choices(lines, k=rng.randint(1, 8))) for _ in range(40)]
    return out + ["", "one", "\n\n one \n", "a b c d e\r\nf", " \t\n", "x" * 5_000, "a b\x0bc d e"]


def test_fingerprints_are_plain_sums(spark):
    docs = [(i, t, "z", "z") for i, t in enumerate([*texts(), None])]
    frame = spark.createDataFrame(docs, "doc_id long, text string, row string, fingerprint string")
    got = mh.with_fingerprints(frame.repartition(3))
    assert got.columns == ["doc_id", "text", "row", "fingerprint"]
    for r in got.collect():
        assert r.fingerprint == plain_fingerprint(r.text), r.text
    assert mh.with_fingerprints(frame.limit(0)).count() == 0


def test_order_does_not_matter_and_edits_are_sums(spark):
    lines = [t for t in texts() if "\n" not in t]
    several = "\n".join(texts()[:5])
    turned = "\n".join(reversed(several.split("\n")))
    frame = spark.createDataFrame(
        [(several, turned, several.split("\n")[0], "new line\nof a text"), (several, turned, "", None)],
        "text string, turned string, gone string, put string",
    )
    marked = mh.with_fingerprints(frame)
    rest = F.expr("concat(substring(text, length(gone) + 1), '\n', coalesce(put, ''))")
    edited = mh.with_fingerprints(
        marked.select(rest.alias("text"), mh.revised("fingerprint", "gone", "put").alias("known"))
    )
    assert edited.where("fingerprint = known").count() == 2
    assert mh.with_fingerprints(frame.selectExpr("turned AS text")).distinct().count() == 1
    got = marked.select(mh.alike("fingerprint", mh.revised("fingerprint", F.lit(""), "put")), 
                        mh.alike(F.lit(None).cast("string"), "fingerprint")).collect()
    assert 0.9 < got[0][0] < 1 and got[1][0] == 1 and got[0][1] is None
    assert lines


def test_tables_of_the_same_paragraphs_agree(spark):
    one = spark.createDataFrame([(t,) for t in texts()], "text string").repartition(9)
    lines = [line for t in texts() for line in t.split("\n")]
    other = spark.createDataFrame([(t,) for t in sorted(lines)], "text string").repartition(3)
    sums = [mh.of_whole_table(mh.with_fingerprints(f), fan_in=2).collect() for f in (one, other)]
    assert sums[0] == sums[1] and len(sums[0]) == 1
    assert mh.of_whole_table(mh.with_fingerprints(one.limit(0))).count() == 0


def test_long_paragraphs_are_read_in_runs(monkeypatch):
    rng = random.Random(5)
    lines = [" ".join("w%d" % rng.randrange(40) for _ in range(n)) for n in (3, 4, 5, 6, 50, 900)]
    lines += ["x" * 400, "x" * 300 + " y", "  a   b  " + " " * 200 + "c"]
    whole = mh.vectors(lines, WordHashes())
    monkeypatch.setattr(mh, "RUN_BYTES", 7)
    cut = mh.vectors(lines, WordHashes())
    assert (whole.wide == cut.wide).all() and (whole.signs == cut.signs).all()


@pytest.mark.parametrize("size", [1, 254, 255, 256, 2_000])
def test_bit_sums(size):
    rng = np.random.default_rng(size)
    hashes = rng.integers(0, 2**64, size, np.uint64)
    starts = np.unique(np.append(0, rng.integers(0, size, 5)))
    ends = np.append(starts[1:], size)
    want = [[sum(int(h) >> b & 1 for h in hashes[s:e]) for b in range(64)]
            for s, e in zip(starts, ends)]
    assert mh.bit_sums(hashes, starts).tolist() == want


def cosine(a, b):
    one, two = (Counter(h for line in mh.paragraphs(t) for h in shingles(
        word_hashes(line.encode(), WordHashes(), lower=False), mh.WIDTH).tolist()) for t in (a, b))
    dot = sum(n * two[h] for h, n in one.items())
    scale = sum(n * n for n in one.values()) * sum(n * n for n in two.values())
    return dot / scale**0.5 if scale else float(a == b)


def test_edit_query_against_loops(spark):
    found = [(7 * i - 60, t) for i, t in enumerate(texts())]
    found += [(10_000, None), (2**62, texts()[0]), (-(2**62), "last of all\nwith lines")]
    frame = spark.createDataFrame(found, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in mh.compared_to_edits(frame).collect()}
    assert len(got) == len(found)
    order = sorted(found, reverse=True)
    for (doc_id, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after, r = text or "", after or "", got[doc_id]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == sha256(edited.encode()).hexdigest()
        assert r.fingerprint == plain_fingerprint(text)
        assert r.edited_fingerprint == plain_fingerprint(edited)
        assert r.near_edited == pytest.approx(cosine(text, edited), abs=0.3)
        assert r.near_next == pytest.approx(cosine(text, after), abs=0.3)
        assert text != after or r.near_next == 1


def test_edit_query_with_odd_tables(spark):
    kinds = "doc_id long, text string, key string, bucket string, last string"
    some = [(3, "c\nd", "z", "z", "z"), (1, "a", "z", "z", "z"), (2, "b b b b b b", "z", "z", "z")]
    frame = spark.createDataFrame(some, kinds)
    assert rows(mh.compared_to_edits(frame)) == rows(mh.compared_to_edits(frame["doc_id", "text"]))
    lone = mh.compared_to_edits(frame.limit(1)).collect()
    assert len(lone) == 1 and lone[0].near_next == 1
    assert mh.compared_to_edits(frame.limit(0)).count() == 0
    # repeated rows and rows without an id are documents of their own
    more = frame.union(frame).union(spark.createDataFrame([(None, t, "", "", "") for t in texts()], kinds))
    got = mh.compared_to_edits(more).collect()
    assert len(got) == 6 + len(texts())
    assert Counter(r.doc_id for r in got) == {3: 2, 1: 2, 2: 2, None: len(texts())}
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
