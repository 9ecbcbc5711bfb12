"""Spelling variants, ranked search and language identification against brute force."""

from __future__ import annotations

import collections
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest

from readloom.llm import language, ranking, spelling, tokens
from readloom.llm.common import Scratch, table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = "doc_id long, text string, word string, n long, term string, item long, held_out string, lang string"


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def test_token_lists_cut_nowhere_inside():
    rng = random.Random(4)
    letters = tokens.byte_table({*range(0x41, 0x5B), *range(0x61, 0x7B)})
    for size in (1, 3, 7, 1000):
        text = "".join(rng.choice("abC  -") for _ in range(200)) + "x" * 40
        found = [t.decode() for part in tokens.token_lists(text.encode(), letters, size) for t in part]
        assert found == re.findall("[a-z]+", text.lower())
    assert list(tokens.token_lists(b"", letters)) == []


# Spelling variants

def one_edit(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long_ = sorted((a, b), key=len)
    return any(long_[:k] + long_[k + 1:] == short for k in range(len(long_)))


def spelling_by_hand(rows, min_length=5, min_count=3, damage=97, ratio=2):
    counts = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = ascii_lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if damage and h % damage == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= min_length and c >= min_count}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    best = {w: min(xs, key=lambda x: (-n[x], x)) for w, xs in near.items() if xs}
    form = {w: x for w, x in best.items() if n[x] >= ratio * n[w]}
    found = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        found.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return found


@pytest.fixture(scope="module")
def spelled():
    """Frequent words with chains of rarer variants, accents, clashing cases, odd marks, nulls, a long text."""
    rng = random.Random(9)
    base = ["".join(rng.choice("abéÿ") for _ in range(rng.randrange(4, 9))) for _ in range(60)]
    pool = []
    for k, word in enumerate(base):
        pool += [word] * (40 // (k % 7 + 1))
        for _ in range(6):
            at = rng.randrange(len(word))
            other = rng.choice(["", word[at] + "a", "b", "é"])
            pool += [word[:at] + other + word[at + 1:]] * rng.randrange(1, 9)
    pool += ["aaaaa"] * 4 + ["aaaaaa"] * 9 + ["aaaaaaa"] * 20 + ["AAAAAAAA"] * 50 + ["aaaaab"] * 9
    rng.shuffle(pool)
    rows = [(k, rng.choice([" ", ", ", "1", "×y ", "日"]).join(pool[k::30])) for k in range(30)]
    rows += [(None, None), (None, "aaaaa baaaa"), (3, ""), (4, " ".join(base) * 30), rows[5], rows[5],
             (7, "ÀÉÎõü " * 3 + "x" * 3000 + " Ünder ünder")]
    return rows


@pytest.mark.parametrize("damage, block", [(97, 512), (5, 3), (0, 1)])
def test_spelling_groups(spark, spelled, damage, block):
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in spelled], SCHEMA).repartition(5)
    rows = [tuple(r) for r in spelling.spelling_groups(docs, spelling.Rule(damage=damage), block).collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == spelling_by_hand(spelled, damage=damage)


def test_spelling_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, "words words words", "w", 5, "t", 6, "h", "en")] * 2, CLASHES)
    assert [tuple(r) for r in spelling.spelling_groups(docs).collect()] == [("words", None, "words", 6, 0, None)]
    empty = spark.createDataFrame([], SCHEMA)
    assert spelling.spelling_groups(empty).count() == 0
    blank = spark.createDataFrame([(1, None), (2, ""), (3, "12 34")], "doc_id long, text string")
    assert spelling.spelling_groups(blank).count() == 0


def test_tiles_compare_all_lengths():
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(2, 7))) for _ in range(200)})
    pairs = collections.Counter()
    for longest in range(2, 8):
        for suffix in (False, True):
            half = longest // 2
            part = (lambda w: w[-half:]) if suffix else (lambda w: w[:half])
            for _, own in itertools.groupby(
                    sorted((w for w in words if len(w) in (longest, longest - 1)), key=part), key=part):
                own = list(own)
                for i, j in zip(*spelling.tile_pairs(longest, suffix, own, None)):
                    pairs[frozenset((own[i], own[j]))] += 1
    expected = {frozenset(p) for p in itertools.combinations(words, 2) if one_edit(*p)}
    assert set(pairs) == expected and set(pairs.values()) == {1}


# Ranked search

def ranked_by_hand(docs, items, k=10):
    split = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    counted = [(i, collections.Counter(split.findall(ascii_lower(t or "")))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = collections.Counter(t for _, c in counted for t in c)
    found = []
    for item_id, text in items:
        terms = collections.Counter(split.findall(ascii_lower(text or "")))
        scores = []
        for i, c in counted:
            m = 25 + (75 * sum(c.values()) * n_docs) // total
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t, times in terms.items() if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0))
        found += [(item_id, rank + 1, None if none else i, -score)
                  for rank, (score, none, i) in enumerate(sorted(scores)[:k])]
    return collections.Counter(found)


@pytest.fixture(scope="module")
def searched():
    rng = random.Random(21)
    vocabulary = [f"t{k}" for k in range(150)] + ["É", "é", "日本", "A1", "a1"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]

    def text(n):
        return rng.choice([" ", "-", "\n", "\x7f"]).join(rng.choices(vocabulary, weights, k=n))

    docs = [(k, text(rng.choice([1, 5, 30, 200]))) for k in range(160)]
    docs += [(None, docs[3][1]), (3, docs[3][1]), (3, docs[3][1]), (999, None), (998, ""), (997, " .,"),
             (996, text(4000))] + [(500 + k, docs[8][1]) for k in range(25)]
    items = [(k, text(rng.choice([1, 8, 40]))) for k in range(25)]
    items += [(25, docs[8][1]), (25, docs[8][1]), (26, None), (27, "absent"), (None, "t3 t4"), (28, " ")]
    return docs, items


@pytest.mark.parametrize("sizes", [
    {}, {"scan_terms": 20, "dense_terms": 10, "bucket": 3, "focus": 2, "head": 4},
    {"dense_terms": 60, "bucket": 16, "focus": 1, "head": 1}])
def test_ranked_search(spark, searched, sizes):
    docs, items = searched
    left = spark.createDataFrame([(i, t, "w", 5, "t", 6, "h", "en") for i, t in docs], CLASHES).repartition(4)
    right = spark.createDataFrame(items, "item_id long, text string").repartition(2)
    rows = ranking.best_documents(left, right, **sizes).collect()
    assert collections.Counter(map(tuple, rows)) == ranked_by_hand(docs, items)


def test_ranked_search_without_rows(spark, searched):
    docs = spark.createDataFrame(searched[0], "doc_id long, text string")
    items = spark.createDataFrame(searched[1], "item_id long, text string")
    assert ranking.best_documents(docs.limit(0), items).count() == 0
    assert ranking.best_documents(docs, items.limit(0)).count() == 0
    assert ranking.best_documents(docs.where("text is null"), items).count() == 0


def test_buckets_are_pruned_before_the_integers():
    """Short vectors fall to the norm of their bucket, others to the heaviest terms; the best all stay."""
    rng = np.random.default_rng(3)
    n_terms, n_docs = 40, 600
    layout = (rng.random((n_terms, n_docs)) ** 4 * 100_000).astype(np.int64)
    layout[:, 300:] //= 50
    norms = np.sqrt((layout.astype(float) ** 2).sum(axis=0))
    order = np.argsort(-norms)
    layout, norms = layout[:, order], norms[order]
    weight = np.sort(rng.integers(1, 5000, 12))[::-1].copy()
    query = ranking.Query(0, np.arange(12), weight, float(np.linalg.norm(weight)), float(np.linalg.norm(weight[4:])))
    block = ranking.Block(np.arange(n_terms), n_terms, [query])
    best, work = {0: ranking.Best(10, 1)}, ranking.Work()
    for at in range(0, n_docs, 50):
        own = slice(at, at + 50)
        ranking.search_bucket(
            block, best, norms[own], layout[:, own], np.arange(n_docs)[own], np.zeros(50, bool), 4, work)
    scores = weight @ layout[:12]
    assert best[0].scores.tolist() == sorted(scores.tolist(), reverse=True)[:10]
    assert work.pairs == n_docs and work.after_length <= 350 and work.after_coordinates < work.after_length


# Language identification

def segmentations(word: bytes, pieces: set[bytes]):
    if not word:
        yield ()
    for k in range(1, len(word) + 1):
        if word[:k] in pieces:
            for rest in segmentations(word[k:], pieces):
                yield (word[:k], *rest)


@pytest.mark.parametrize("safe", [100, 0])
def test_forward_and_backward_sum_all_segmentations(safe):
    """By products, and (nothing is safe) by logarithms."""
    rng = np.random.default_rng(5)
    pieces = [b" ", b"a", b"b", b" a", b"ab", b"ba", b"aba", b"bb", b" abababa"]
    logs = np.log(rng.dirichlet(np.ones(len(pieces)), 3).T)
    model = language.Model(pieces, logs, ["x", "y", "z"], np.zeros(3))
    model.safe = safe
    words = ["a", "ab", "abab", "bbba", "aababb", "abababab", "b"]
    totals = model.word_logs(words)
    for k, word in enumerate(words):
        ways = list(segmentations(b" " + word.encode(), set(pieces)))
        for lang in range(3):
            p = [math.exp(sum(logs[pieces.index(x), lang] for x in way)) for way in ways]
            assert math.isclose(totals[k, lang], math.log(sum(p)))
            found = np.zeros((len(pieces) + 1, 3))
            model.expected([word], np.array([lang]), np.array([2]), found)
            expected = np.zeros_like(found)
            for way, share in zip(ways, p):
                for x in way:
                    expected[pieces.index(x), lang] += 2 * share / sum(p)
            assert np.allclose(found, expected)


def test_lattice_looks_on_only_where_pieces_go_on(monkeypatch):
    """The lattice is that of a plain search, and bytes that begin no longer piece are not looked up again."""
    rng = random.Random(11)
    pieces = [bytes([b]) for b in range(256)] + [b"ab", b"abcd", b"bcdefghi", b" x", b"xyz", b"dd\0"]
    lookup = language.Pieces(pieces)
    words = [bytes(rng.choice(b" abcdefghixyz\0\xff") for _ in range(11)) for _ in range(300)] + [b" abcdefghix"]
    raw = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), 11)
    plain = np.full((len(words), 11, 8), len(pieces))
    for k, word in enumerate(words):
        for place in range(11):
            for length in range(1, min(8, 11 - place) + 1):
                if word[place:place + length] in pieces:
                    plain[k, place, length - 1] = pieces.index(word[place:place + length])
    searched = []
    search = np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda a, v, *r: searched.append(np.size(v)) or search(a, v, *r))
    assert (lookup.lattice(raw) == plain).all()
    assert sum(n for n in searched if n > 1) < 2.5 * raw.size
    short = np.frombuffer(b"ab", np.uint8).reshape(1, 2)
    assert lookup.lattice(short)[0].tolist() == [[pieces.index(b"a"), pieces.index(b"ab")], [pieces.index(b"b"), len(pieces)]]


def test_long_words_do_not_vanish():
    pieces = language.pieces_of(language.vocabulary_file())
    logs = np.full((len(pieces), 2), -30.0)
    logs[:, 1] = -31.0
    model = language.Model(pieces, logs, ["x", "y"], np.zeros(2))
    for word in ("\u0e01" * language.MAX_WORD, "qzxj" * 12):
        [[x, y]] = model.word_logs([word])
        assert np.isfinite(x) and x > y


def test_words_of_plain_texts_are_the_runs_of_all_texts():
    text = "".join(map(chr, range(128))) * 2 + " The END_of 3rd x-ray\x1fZ"
    runs = re.findall(r"[^\W\d_]+", text.lower())
    assert [w for part in language.words_of(text) for w in part] == runs
    assert [w for part in language.words_of(text + " é") for w in part] == [*runs, "é"]


def test_words_of_long_texts_are_whole(monkeypatch):
    text = "Ab1 cD, ébc² Ⅷ½ " * 50 + "x" * 130
    expected = [w for w in re.findall(r"[^\W\d_]+", text.lower()) if any(c.isalpha() for c in w)]
    whole = [w for part in language.words_of(text) for w in part]
    assert "".join(whole) == "".join(expected) and max(map(len, whole)) <= language.MAX_WORD
    monkeypatch.setattr(language, "SLICE", 16)
    assert [w for part in language.words_of(text) for w in part] == whole


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = language.identify(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r["held_out"] and r["lang"]]
    assert held and sum(r["lang_pred"] == r["lang"] for r in held) >= 0.95 * len(held)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1


def test_language_of_odd_texts(spark):
    rng = random.Random(1)
    xs = [(k, " ".join(rng.choices(["xano", "xilo", "xuro"], k=20)), "x") for k in range(12)]
    ys = [(k + 20, " ".join(rng.choices(["yeme", "yoke", "yaza"], k=20)), "y") for k in range(12)]
    odd = [(50, None, "x"), (51, "", None), (52, "12 ... ²", "y"), (53, "xano " * 3, None), (None, "yoke", "y"),
           (54, "Xilo" * 5000, "x"), (54, "Xilo" * 5000, "x"), (55, "日本語のテキスト", None)]
    full = [(i, t, "w", 5, "t", 6, "h", lang) for i, t, lang in xs + ys + odd]
    docs = spark.createDataFrame(full, CLASHES).repartition(3)
    found = collections.defaultdict(list)
    for r in language.identify(docs).collect():
        found[r["doc_id"]].append((r["lang_pred"], r["score"]))
    assert all(found[k][0][0] == "x" for k in (*range(12), 53, 54)) and len(found[54]) == 2
    assert all(found[k][0][0] == "y" for k in (*range(20, 32), None))
    assert [found[k] for k in (50, 51, 52)] == [[("und", 0.0)]] * 3
    assert found[55][0][0] in ("x", "y")
    # What is predicted does not depend on lang or source of the row itself.
    other = spark.createDataFrame(
        [(i, t, "w", 5, "t", 6, "h", "z" if zlib.crc32(str(i).encode()) % 3 == 1 else lang)
         for i, t, _, _, _, _, _, lang in full if i is not None], CLASHES)
    again = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(other).collect()}
    mine = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(docs.where("doc_id is not null")).collect()}
    assert again.keys() == mine.keys()
    for i, (lang, score) in mine.items():
        assert again[i][0] == lang and math.isclose(again[i][1], score, rel_tol=1e-9)
    unlabelled = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[2:] for r in language.identify(unlabelled).collect()] == [("und", 0.0)]
    assert language.identify(docs.limit(0)).count() == 0
