"""Text operators against brute force, on small tables with every odd case."""

import os
import random
import re
import time
from collections import Counter, defaultdict
from itertools import combinations, product

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quirelake.llm import bpe, mixing, ngram_join, quality, token_counts
from quirelake.llm import compact_windows as compact
from quirelake.llm.compact_windows import compact_windows, repeated_passages
from quirelake.llm.components import components
from quirelake.llm.ngram_join import ngram_groups
from quirelake.llm.workspace import dropped, shared_root, written

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, row string"


def base_rows():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choices(vocabulary, k=n))

    texts = [prose(rng.randint(1, 120)) for _ in range(30)]
    texts += [None, "", " \n ", "one", "One", "two words", "a b c d e", "x " * 60]
    texts += [texts[0], texts[0].upper(), texts[1] + " tail", prose(3000)]
    for base in texts[2:8]:
        words = base.split()
        for _ in range(3):
            changed = list(words)
            if changed:
                changed[rng.randrange(len(changed))] = "other"
            texts.append(" ".join(changed))
    passage = prose(60)
    texts += [prose(30) + " " + passage + " " + prose(20), passage + "\n" + prose(10), passage]
    rows = [(i, t, "en", f"src{i % 4}", len(t or ""), 7, "r") for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[4], None, None, None, None, None)]
    rows += [(None, None, None, None, None, None, None), (900, texts[5], "de", None, 1, 1, "z")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return base_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def shingle_set(text, width=5):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute_groups(rows):
    sets = [shingle_set(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                parent[top(i)] = top(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[top(i)].append(i)
    return sets, groups


def test_ngram_groups(docs, rows):
    sets, groups = brute_groups(rows)
    want = Counter()
    for members in groups.values():
        named = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            want[rows[i][0], len(sets[i]), min(named, default=None)] += 1
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in
                  ngram_join.ngram_groups(docs).collect())
    assert got == want


def test_one_per_group(docs, rows):
    sets, groups = brute_groups(rows)
    stay = ngram_join.one_per_group(docs)
    assert stay.columns == docs.columns
    with_words = sum(1 for m in groups.values() if sets[m[0]])
    kept = [r.text for r in stay.collect()]
    assert sum(bool(shingle_set(t)) for t in kept) == with_words
    assert sum(not shingle_set(t) for t in kept) == sum(not s for s in sets)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    path = public_tokenizers.path("piece_bpe_32k.model")
    assert ngram_join.ngram_groups(empty).count() == 0
    assert quality.quality_rules(empty).count() == 0
    assert mixing.mix(empty).count() == 0
    assert repeated_passages(empty).count() == 0
    assert token_counts.token_counts(empty, path).count() == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]
    parent = list(range(60))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        parent[y] = x
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: top(n) for e in edges for n in e if e[0] != e[1]} | {
        n: r for n, r in got.items() if top(n) == r
    }
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")) is None


def brute_quality(text):
    words, lines = WORD.findall(text or ""), [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    again = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1
             for j in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(again) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(again), failed)


def test_quality_counts(docs, rows):
    got = Counter(tuple(r)[:7] for r in quality.quality_rules(docs).collect())
    assert got == Counter((r[0], *brute_quality(r[1])) for r in rows)


def test_boilerplate_goes_and_depleted_documents_are_rejected(spark):
    rng = random.Random(1)
    line = "all rights are reserved by the owner of this site 2024"
    rows = []
    for i in range(60):
        body = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(40))
        rows.append((i, body + "\n" + (line.upper() if i % 2 else line.replace("2024", str(i))), "h"))
    rows.append((100, line + "\nbut ten words of its own stand below the line", "h"))
    rows.append((101, line + "\n" + " ".join("v" + chr(97 + i) for i in range(24)), None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in quality.quality_rules(docs).collect()}
    assert got[0].kept and got[0].n_boilerplate_words == 11
    assert not got[100].base_failed and not got[100].kept
    assert got[101].kept and got[101].n_boilerplate_words == 0
    stay = {r.doc_id: r.text for r in quality.kept_documents(docs).collect()}
    assert set(stay) == {i for i in got if got[i].kept}
    assert "RESERVED" not in stay[1] and stay[101] == rows[-1][1]


def test_boilerplate_does_not_depend_on_the_size_of_the_host(spark):
    rng = random.Random(8)
    line = "this page is licensed under terms that are given elsewhere"

    def body(n=40):
        return " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))

    rows = [(i, body() + ("\n" + line if i < 20 else ""), "h") for i in range(1000)]
    rows += [(2000 + i, body() + ("\n" + line if i < 19 else ""), "g") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.n_boilerplate_words for r in quality.quality_rules(docs).collect()}
    assert got == {r[0]: 10 if r[0] < 20 else 0 for r in rows}
    stay = {r.doc_id: r.text for r in quality.kept_documents(docs).collect()}
    assert stay == {r[0]: r[1].split("\n")[0] if r[0] < 20 else r[1] for r in rows}


def test_pages_of_one_template_are_documents_of_their_own(spark):
    page = "order {} was shipped\non the day {} of may\n" + " ".join(f"w{chr(97 + i)}" for i in range(20))
    rows = [(i, page.format(1000 + i, i), "h") for i in range(20)]
    copies = [(100 + i, "copies of a text\nare one document\n" + "x y z " * 9, "h") for i in range(30)]
    docs = spark.createDataFrame(rows + copies, "doc_id long, text string, source string")
    got = {r.doc_id: (r.n_boilerplate_words, r.kept) for r in quality.quality_rules(docs).collect()}
    assert all(got[i] == (30, False) for i in range(20))
    assert all(got[100 + i][0] == 0 for i in range(30))


def test_mix_reaches_targets(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(1, 40), rng.choice(["a", "a", "a", "b", None])) for i in range(400)]
    rows += [rows[0], (None, "w w", "b"), (500, None, "c"), (501, "w", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs)
    first = sorted(map(str, got.collect()))
    assert first == sorted(map(str, mixing.mix(docs.repartition(5)).collect()))
    totals = defaultdict(int)
    for r in got.collect():
        assert 0 <= r.taken <= 3 * r.size
        totals[r.source] += r.taken
    targets = {r.source: (r.target, r.source_size) for r in got.collect()}
    assert sum(t for t, _ in targets.values()) == pytest.approx(sum(r.size for r in got.collect()))
    for source, (target, size) in targets.items():
        assert target <= 3 * size + 1e-9
        assert abs(totals[source] - target) <= max(3, 0.02 * target)


def test_flow_of_overlapping_sources():
    sizes = {("a",): 100, ("a", "b"): 100, ("b",): 50}
    taken = mixing.routed(sizes, {"a": 120.0, "b": 150.0})
    assert sum(taken.values()) == 270
    # each pattern once before any twice; the twenty left fit where costs are equal
    assert all(taken[p] >= sizes[p] for p in sizes)
    assert all(taken[p] <= 2 * sizes[p] for p in sizes)


def test_overlapping_memberships_are_mixed_end_to_end(spark):
    rng = random.Random(6)
    kinds = [["a"], ["a", "b"], ["b"], ["b", "c"], ["d"]]
    rows = [(i, "w " * rng.randint(1, 9), kinds[i % 5]) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, members array<string>")
    got = mixing.mix(docs, "members", {"a": 6, "b": 1, "c": 1, "d": 1}).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        sizes[tuple(r.members)] += r.size
        taken[tuple(r.members)] += r.taken
    held = {s: sum(n for p, n in sizes.items() if s in p) for s in "abcd"}
    total = sum(sizes.values())
    targets = mixing.shares(held, {"a": 6, "b": 1, "c": 1, "d": 1}, total)
    want = mixing.routed(sizes, targets)
    for pattern in sizes:
        assert abs(taken[pattern] - want[pattern]) <= 9, pattern
    # b's own documents leave its quota, so those of a and b serve a before any is used a third time
    assert taken["a",] <= 2 * sizes["a",] + 9 and taken["a", "b"] > sizes["a", "b"] - 9
    assert abs(taken["d",] - targets["d"]) <= 9


def test_any_column_name_and_empty_tables(spark):
    names = ("rest last bin of fill gap wanted repeats place pattern before number held flow members"
             " numbers targets weight size target taken times source_size __bin").split()  # fmt: skip
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(0, 9), rng.choice("abc")) for i in range(60)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, source string")
    clash = plain.selectExpr("*", *[f"'z' AS `{n}`" for n in names])
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    want = sorted(mixing.mix(plain).select(*columns).collect())
    got = mixing.mix(clash)
    assert sorted(got.select(*columns).collect()) == want
    assert got.where("rest = 'z' AND pattern = 'z' AND place = 'z'").count() == 60
    mixed = mixing.mixed_documents(clash)
    assert mixed.columns == clash.columns
    assert mixed.where("size = 'z' AND last = 'z'").count() == mixing.mixed_documents(plain).count()
    assert mixing.mixed_documents(clash.limit(0)).count() == 0


def test_targets_are_the_shares_of_many_sources(spark):
    rng = random.Random(9)
    rows = [(i, "w " * rng.choice([0, 1, 5, 60]), f"s{rng.randrange(900)}é") for i in range(3_000)]
    rows += [(9_000 + i, "w " * 500, "big") for i in range(40)] + [(9_999, "w w", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(text.split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    want = mixing.shares({s: sizes[s] for s in order}, weights, sum(sizes.values()))
    got = mixing.mix(docs).select("source", "target", "source_size").distinct().collect()
    assert len(got) == len(want)
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]


def least_cost(sizes, quotas):
    """The most words, then the least cost, over all whole flows of a tiny table."""
    patterns, best = list(sizes), None
    choices = []
    for p in patterns:
        top = 3 * sizes[p]
        choices.append([c for c in product(range(top + 1), repeat=len(p)) if sum(c) <= top])
    for flow in product(*choices):
        given = defaultdict(int)
        for p, parts in zip(patterns, flow):
            for s, n in zip(p, parts):
                given[s] += n
        if any(given[s] > quotas[s] for s in given):
            continue
        words = [sum(parts) for parts in flow]
        cost = sum(sum(c * max(0, min(w - i * sizes[p], sizes[p])) for i, c in enumerate(mixing.REPEAT_COSTS))
                   for p, w in zip(patterns, words))
        key = (-sum(words), cost)
        best = key if best is None else min(best, key)
    return best


@pytest.mark.parametrize("seed", range(12))
def test_flow_is_the_cheapest(seed):
    rng = random.Random(seed)
    kinds = rng.sample([("a",), ("b",), ("a", "b"), ("b", "c")], 3)
    sizes = {p: rng.randint(1, 2) for p in kinds}
    quotas = {s: rng.randint(0, 5) for s in "abc"}
    taken = mixing.routed(sizes, quotas)
    cost = sum(sum(c * max(0, min(taken[p] - i * sizes[p], sizes[p])) for i, c in enumerate(mixing.REPEAT_COSTS))
               for p in sizes)
    assert (-sum(taken.values()), cost) == least_cost(sizes, quotas)


def test_mixed_documents_repeat_rows(docs):
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    taken = mixing.mix(docs).agg(F.sum("times")).first()[0]
    assert mixed.count() == taken


PIECES = ["a", "b", " ", "\n", "\t", "the", "é", "日本", "<|endoftext|>", "😀", "12", "\r", "\x00",
          "\xa0", "'S", "'t", "ﬁ", ".", "Σ", "İ", "é", "</w>", "!!!", "aaaa", "▁", "  "]


def odd_texts(n):
    rng = random.Random(7)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 12))) for _ in range(n)]
    return texts + ["".join(rng.choices("thein", k=9_000)), "=" * 700, "", None]


def test_bpe_equals_the_library(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    library, encoder = Tokenizer.from_file(path), bpe.Encoder(path)
    for text in odd_texts(1500):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert encoder.encode(text or "") == want
        decoded = " ".join(t for _, t in encoder.texts(text or ""))
        assert decoded == library.decode(want, skip_special_tokens=False)


def test_bpe_of_long_texts(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    size = bpe.RUN_CHARS // 4
    # U+001C to U+001F are no blanks of the file, whatever Python calls them
    texts = ["b c " * size + tail for tail in ("!!\x1c!! x", "!\x1d\x1e?\x1f ab", "\x85!\xa0?")]
    texts += ["a" * (4 * size - 1) + "\x1c" + "!" * 50, "thein" * 200_000, "=" * (5 * size), "\x1f" * 70]
    docs = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    got = bpe.encoded(docs.repartition(3), path)
    assert got.columns == ["doc_id", "text", "ids"]
    for r in got.collect():
        want = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids == want, r.doc_id


def test_bpe_on_odd_tables(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows_ = [(1, "a b", "z"), (1, "a b", "z"), (None, None, None), (2, "", "z")]
    docs = spark.createDataFrame(rows_, "doc_id long, text string, row string")
    got = sorted(((r.doc_id or 0), r.row, tuple(r.ids)) for r in bpe.encoded(docs, path).collect() if r.row)
    assert [g[:2] for g in got] == [(1, "z"), (1, "z"), (2, "z")] and got[0] == got[1]
    assert got[0][2] and not got[2][2]
    assert bpe.encoded(docs.limit(0), path).count() == 0
    assert bpe.round_trips(docs.limit(0), path).count() == 0
    assert bpe.round_trips(docs, path).where("n_tokens = 0").count() == 2


def test_stream_has_bounded_memory():
    encoder = bpe.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    rng, stream, ids, text = random.Random(4), bpe.Stream(encoder.v), [], ""
    for _ in range(60):
        part = "".join(rng.choices("thein", k=100))
        text += part
        ids += stream.push(part)
        assert len(stream.text) <= 4 * bpe.EMIT_EVERY
    assert ids + stream.finish() == Tokenizer.from_file(
        public_tokenizers.path("word_bpe_49k.json")
    ).encode(text, add_special_tokens=False).ids
    decoder = bpe.Decoder(encoder.v, joined=False)
    out = "".join(decoder.feed([i]) for i in encoder.encode("Größe 日本 ok")) + decoder.finish()
    assert out.split() == ["größe", "日本", "ok"]


def test_token_counts_equal_the_library(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = odd_texts(1500)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in token_counts.token_counts(docs, path).collect():
        text = texts[r.doc_id] or ""
        assert (r.n_tokens, r.n_bytes) == (len(library.encode(text)), len(text.encode()))
    tokens = token_counts.Tokens(path)
    for limit in (3, 50):
        for text in filter(None, texts):
            counted = sum(
                n for b in token_counts.batches_of([text], limit)
                for n in tokens.counts([p for _, p in b])
            )
            assert counted == len(library.encode(text))


def test_compact_windows_cover_every_passage_once():
    import numpy as np

    values = np.array(random.Random(1).choices(range(40), k=120), np.uint64)
    windows = compact_windows(values, 10)
    for i in range(120):
        for j in range(i + 9, 120):
            inside = [c for left, c, right in windows if left <= i <= c <= j <= right]
            assert inside == [i + int(values[i : j + 1].argmin())]


def test_repeated_passages_are_found(docs, rows):
    got = {(r.doc_id, r.other_id) for r in repeated_passages(docs).collect()}
    found = {x for pair in got for x in pair}
    windows = defaultdict(set)
    for doc, text, *_ in {(r[0], r[1]) for r in rows if r[0] is not None}:
        words = (text or "").lower().split()
        for i in range(len(words) - 49):
            windows[tuple(words[i : i + 50])].add(doc)
    assert {d for v in windows.values() if len(v) > 1 for d in v} <= found


def _passages_of_the_middle():
    """Documents 0 and 9 hold shingles of all others, 3 and 6 share a passage that neither holds."""
    rng = random.Random(8)

    def prose(n):
        return [f"w{rng.randrange(10**6)}" for _ in range(n)]

    shared, noise = prose(70), prose(6)
    # every shingle of the passage is also a lone piece of the first and the last text
    pieces = []
    for i in range(0, 66):
        pieces += shared[i : i + 5] + prose(40)
    return [
        (0, " ".join(pieces)), (3, " ".join(noise + shared + prose(30))),
        (6, " ".join(prose(30) + shared + prose(5))), (9, " ".join(prose(3) + pieces)), (4, " ".join(prose(80))),
    ]


def test_passages_that_first_and_last_holder_lack_are_found(spark):
    docs = spark.createDataFrame(_passages_of_the_middle(), "doc_id long, text string")
    got = {(r.doc_id, r.other_id, r.component_id) for r in repeated_passages(docs).collect()}
    assert (3, 6, 3) in got
    assert {root for a, _, root in got if a == 0} <= {0}


def _prose(rng, n):
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def _pairs_of_equal_runs(texts, n=50):
    holders = defaultdict(set)
    for doc, text in texts:
        words = text.split()
        for i in range(len(words) - n + 1):
            holders[tuple(words[i : i + n])].add(doc)
    return {pair for held in holders.values() for pair in combinations(sorted(held), 2)}


def _texts_with_passages():
    """One passage in many texts, others in two of them only, and copies of texts."""
    rng = random.Random(21)
    passage, inner = _prose(rng, 60), _prose(rng, 70)
    texts = [(i, _prose(rng, 20 + i) + passage + _prose(rng, 30)) for i in range(12)]
    for i in (4, 7):
        texts[i] = (i, texts[i][1] + inner)
    texts += [(20 + i, texts[i][1]) for i in (0, 5, 5, 11)]
    texts += [(40, texts[5][1]), (41, _prose(rng, 90)), (42, _prose(rng, 90)), (43, _prose(rng, 30))]
    texts.append((44, texts[17][1]))
    return [(doc, " ".join(words)) for doc, words in {doc: words for doc, words in texts}.items()]


@pytest.mark.parametrize("whole", [200, 2])
def test_all_pairs_that_share_a_passage_are_reported(spark, monkeypatch, whole):
    monkeypatch.setattr(compact, "WHOLE", whole)
    monkeypatch.setattr(compact, "PART", 5)
    texts = _texts_with_passages()
    rows = repeated_passages(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    want = _pairs_of_equal_runs(texts)
    assert {(0, 5), (4, 7), (5, 25), (7, 40), (41, 44)} <= want
    assert {(r.doc_id, r.other_id) for r in rows} == want
    assert len(rows) == len(set(rows))
    words = {doc: text.split() for doc, text in texts}
    for r in rows:
        assert words[r.doc_id][r.start_word : r.end_word] == words[r.other_id][r.other_start : r.other_end]
    # the passage that only two texts of a component share
    assert max(r.end_word - r.start_word for r in rows if (r.doc_id, r.other_id) == (4, 7)) == 70
    assert {r.component_id for r in rows} == {0, 41}


def test_texts_of_one_common_line_are_not_compared(spark, monkeypatch):
    compared, asked = [], compact._in_cells
    monkeypatch.setattr(compact, "FEW", 4)
    monkeypatch.setattr(compact, "_in_cells", lambda held, nodes, pairs, *more:
                        compared.append(pairs.count()) or asked(held, nodes, pairs, *more))
    rng = random.Random(22)
    line, passage = _prose(rng, 24), _prose(rng, 60)
    texts = [(i, _prose(rng, 30) + line + _prose(rng, 30)) for i in range(120)]
    for i in (50, 70):
        texts[i] = (i, texts[i][1] + passage)
    texts = [(doc, " ".join(words)) for doc, words in texts]
    rows = repeated_passages(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.other_id) for r in rows} == {(50, 70)}
    # with the first and the last one only; a pair per two of them would be 7,140
    assert sum(compared) < 700


def test_passages_need_so_many_shingles():
    rng = random.Random(23)
    for _ in range(60):
        kinds = rng.choice((2, 30, 200))
        a, b = ([rng.randrange(kinds) for _ in range(rng.randrange(30, 90))] for _ in range(2))
        cut = rng.randrange(20)
        b[cut : cut + 60] = a[:60]
        runs = [compact.Runs(np.array(x, np.int64)) for x in (a, b)]
        spans = [len(set(a[i : i + 46])) for i in range(len(a) - 45)]
        assert runs[0].need == (-(-75 * min(spans) // 100) if spans else len(a) + 1)
        for start, end, low, high, similarity in compact.passages(*runs):
            left, right = set(a[start : end + 1]), set(b[low : high + 1])
            assert end - start >= 45
            assert len(left & right) >= runs[0].need
            assert similarity == len(left & right) / len(left | right) >= 0.75


def test_kept_documents_move_their_text_once(spark):
    docs = spark.createDataFrame(
        [(i, f"line {i} " + "word " * 3 + " ".join(f"x{i}y{j}" for j in range(40)), "s", 3) for i in range(9)],
        "doc_id long, text string, source string, n_chars long",
    )
    kept = quality.kept_documents(docs)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    (row,) = {line.split("struct(", 1)[1] for line in plan.splitlines() if "struct(" in line and "doc_id" in line}
    assert "text" not in row.split(") AS row")[0]
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: (r.text, r.n_chars) for r in kept.collect()} == {i: (t, len(t)) for i, t in texts.items()}


def _tables_left(spark):
    root = shared_root(spark).removeprefix("file:")
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def _shuffle_files(spark):
    manager = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in names if name.startswith("shuffle_")}


def test_written_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    table = written(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count().repartition(3, "k"))
    for _ in range(50):
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before
    assert table.count() == 10
    dropped(table)
    assert table._written_to.rpartition("/")[2] not in _tables_left(spark)


def test_joins_drop_the_tables_they_no_longer_need(spark):
    words = [f"w{i}" for i in range(200)]
    docs = spark.createDataFrame(
        [(i, " ".join(words[: 150 + i % 7] + [f"x{i}"] * (i % 3))) for i in range(40)], "doc_id long, text string"
    )
    for made, least in ((ngram_groups, 4), (repeated_passages, 2)):
        before = _tables_left(spark)
        result = made(docs)
        assert len(_tables_left(spark) - before) <= least
        assert result.count() > 0


def test_overlaps_are_counted_in_cells(spark, monkeypatch):
    monkeypatch.setattr("quirelake.llm.cells.LEAST_BLOCKS", 3)
    rng = np.random.default_rng(5)
    sets = {i: rng.choice(300, rng.integers(1, 80), replace=False) for i in range(30)}
    chosen = [(a, b) for a in sets for b in sets if a < b and (a * b) % 3]
    pairs = spark.createDataFrame(
        [(a, len(sets[a]), b, len(sets[b])) for a, b in chosen], "a long, na long, b long, nb long"
    )
    parts = spark.createDataFrame(
        [(i, int(f), [int(v) for v in s if v % 4 == f]) for i, s in sets.items() for f in range(4) if any(s % 4 == f)],
        "node long, fragment int, part array<long>",
    )
    got = {(r.a, r.b): r.same for r in ngram_join._overlaps(pairs, parts, 4).collect()}
    assert got == {(a, b): len(np.intersect1d(sets[a], sets[b])) for a, b in chosen}


def test_entries_that_can_be_close_stay():
    rng = np.random.default_rng(6)
    values = np.sort(rng.integers(0, 60, 200)).astype(np.uint64)
    sizes = rng.integers(4, 60, 200)
    places = np.array([rng.integers(0, n // 4 + 1) for n in sizes])
    kept = ngram_join._hopeful(values, sizes, places, 75)
    close = np.zeros(200, bool)
    for i in range(200):
        for j in range(200):
            need = -(-75 * (sizes[i] + sizes[j]) // 175)
            fits = 100 * min(sizes[i], sizes[j]) >= 75 * max(sizes[i], sizes[j])
            if i != j and values[i] == values[j] and fits:
                close[i] |= places[i] <= sizes[i] - need and places[j] <= sizes[j] - need
    assert kept[close].all() and not kept.all()
