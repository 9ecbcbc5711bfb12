"""Each operator against a brute-force version on small, awkward tables."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from readloom.llm import (
    chat,
    decontam,
    jaccard,
    licenses,
    lm,
    packing,
    quality,
    recompression,
    sharding,
    suffix,
)
from readloom.llm.common import Scratch
from readloom.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns whose names helper columns also have.
CLASHES = "doc_id long, text string, _row long, doc string, places string, quality string, row int, n_chars long"


def words(text: str | None) -> list[str]:
    return [w for w in re.split("[\x20\x09-\x0D]+", text or "") if w]


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" + ("." if rng.random() < 0.1 else "") for _ in range(n))


@pytest.fixture(scope="module")
def texts() -> list[tuple[int | None, str | None]]:
    """Copies, near copies, shared passages, runs, odd blanks, nulls, empties, a long text, repeated rows."""
    rng = random.Random(5)
    base = [prose(rng, rng.randrange(20, 300)) for _ in range(25)]
    passage, other = prose(rng, 90), prose(rng, 200)
    rows = list(enumerate(base))

    def add(text):
        rows.append((len(rows), text))

    for _ in range(4):
        add(base[3])
        near = base[4].split(" ")
        near[rng.randrange(len(near))] = "edited"
        add(" ".join(near))
        add(f"{prose(rng, 30)} {passage} {prose(rng, 10)}")
        add(passage.replace(" ", "\t\n", 7))
    for text in (None, "", " \t\n", "one", "One", "two words", "a" * 1500, "For " * 900, "é" * 700,
                 "ab" * 450 + "c", other + other, other[5:900], "x\x0by  z\r\n" * 60, "日本語 テキスト。" * 80):
        add(text)
    add(" ".join(base) * 3)
    rows += [(7, base[7]), (7, base[7]), (None, base[9]), (None, None)]
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def multiset(rows) -> collections.Counter:
    return collections.Counter(tuple(r) for r in rows)


def covered(units: list, counts: collections.Counter, size: int) -> list[bool]:
    marks = [False] * len(units)
    for i in range(len(units) - size + 1):
        if counts[tuple(units[i:i + size])] > 1:
            marks[i:i + size] = [True] * size
    return marks


def windows(all_units: list[list], size: int) -> collections.Counter:
    return collections.Counter(
        tuple(u[i:i + size]) for u in all_units for i in range(len(u) - size + 1))


@pytest.mark.parametrize("size", [24, 400])
def test_suffix_dedup(docs, texts, size):
    units = [list((t or "").encode()) for _, t in texts]
    counts = windows(units, size)
    expected = []
    for (i, _), u in zip(texts, units):
        marks = covered(u, counts, size)
        kept = bytes(x for x, m in zip(u, marks) if not m)
        spans = sum(m and not (k and marks[k - 1]) for k, m in enumerate(marks))
        expected.append((i, len(u), sum(marks), spans, hashlib.sha256(kept).hexdigest()))
    assert multiset(suffix.repeat_report(docs, size).collect()) == multiset(expected)


@pytest.mark.parametrize("size,rounds", [(35, 4), (3, 2)])
def test_recompression_dedup(docs, texts, size, rounds):
    units = [words(t) for _, t in texts]
    counts = windows(units, size)
    expected = []
    for (i, _), u in zip(texts, units):
        marks = covered(u, counts, size)
        kept = " ".join(x for x, m in zip(u, marks) if not m)
        expected.append((i, len(u), sum(marks), hashlib.sha256(kept.encode()).hexdigest()))
    assert multiset(recompression.repeat_report(docs, size, rounds).collect()) == multiset(expected)


def shingles(text: str | None, n: int) -> frozenset:
    w = words(ascii_lower(text or ""))
    if len(w) < n:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1))


def linked_components(sets: list[frozenset], percent: int) -> list[int]:
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    return [find(x) for x in range(len(sets))]


@pytest.mark.parametrize("n,percent", [(4, 85), (2, 50)])
def test_jaccard_join(docs, texts, n, percent):
    sets = [shingles(t, n) for _, t in texts]
    roots = linked_components(sets, percent)
    smallest = {}
    for (i, _), r in zip(texts, roots):
        if i is not None:
            smallest[r] = min(i, smallest.get(r, i))
    expected = [(i, len(s), smallest.get(r) if s else i) for (i, _), s, r in zip(texts, sets, roots)]
    rule = jaccard.Threshold(n, percent)
    assert multiset(jaccard.near_duplicates(docs, rule).collect()) == multiset(expected)
    kept = jaccard.one_of_each(docs, rule)
    assert kept.columns == docs.columns
    n_groups = len({r for r, s in zip(roots, sets) if s}) + sum(not s for s in sets)
    assert kept.count() == n_groups


def test_jaccard_join_of_many_near_copies(spark):
    """A hub with copies that only link through it, and a common line in otherwise different texts."""
    rng = random.Random(2)
    hub, line = prose(rng, 120, 10**6).split(" "), prose(rng, 20, 10**6)
    rows = [(0, " ".join(hub))]
    for i in range(1, 60):
        copy = list(hub)
        for _ in range(rng.randrange(1, 5)):
            copy[rng.randrange(len(copy))] = f"edit{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    rows += [(i, f"{line} {prose(rng, rng.randrange(1, 40), 10**6)}") for i in range(60, 120)]
    sets = [shingles(t, 4) for _, t in rows]
    roots = linked_components(sets, 85)
    lowest = {}
    for (i, _), r in zip(rows, roots):
        lowest.setdefault(r, i)
    found = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(4),
        jaccard.Threshold(4, 85)).collect()}
    assert found == {i: lowest[r] for (i, _), r in zip(rows, roots)}


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, 100 + k) for k in range(1, 20)] + [(200, 200), (302, 301)]
    found = {r["node"]: r["component"] for r in components(
        spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test")).collect()}
    assert found == {k: 0 for k in range(31)} | {100 + k: 100 for k in range(20)} | {301: 301, 302: 301}


def test_packing(docs, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    expected = collections.Counter()
    for i, t in texts:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        first = len(ids) - (len(ids) - 1) // 2048 * 2048
        cuts = [0, *range(first, len(ids), 2048), len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected[(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    rows = packing.pack_documents(docs).collect()
    assert multiset(r[:5] for r in rows) == expected
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(sequences) <= math.ceil(sum(r["length"] for r in rows) / 2048 * 1.05) + 1


def test_best_two_fit_takes_back_its_smallest():
    # 6 + 3 leaves a gap of 1; 2 + 2 in place of 3 fills the bin of 10.
    bins, offsets = packing.best_two_fit(np.array([6, 3, 2, 2]), 10)
    assert bins[0] == bins[2] == bins[3] and bins[1] != bins[0]
    assert sorted(offsets[[0, 2, 3]].tolist()) == [0, 6, 8]


def test_encoder_agrees_with_whole_texts():
    encoder = packing.Encoder(packing.tokenizer_file())
    rng = random.Random(3)
    pieces = ["a", "Word", " ", "\n", "\t", "é", "'s", "12", "!?", " ", "　", "<|endoftext|>", "日本", "\0"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(12)))
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == encoder.plain(text)


def test_encoder_agrees_with_the_json_tokenizer_as_it_is():
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = packing.Encoder(packing.tokenizer_file())
    mark = "<|endoftext|>"
    assert np.frombuffer(encoder.ids(f"a {mark} b"), "<u4").tolist() == [64, 220, 50256, 275]
    rng = random.Random(6)
    pieces = ["a", "Word", " ", "\n", "é", "'s", "12", "!?", mark, mark, "<|", "endoftext|>", "日本", "\0"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(12)))
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_encoder_holds_nothing_between_texts():
    """A text is one call of the encoder; no words are remembered, however many differ."""
    encoder = packing.Encoder(packing.tokenizer_file())
    calls, array = [], encoder.array
    encoder.array = lambda text: calls.append(text) or array(text)
    text = " ".join(f"word{k}" for k in range(5000))
    assert np.frombuffer(encoder.ids(text), "<u4").tolist() == encoder.plain(text)
    assert encoder.ids("") == b""
    assert calls == [text, ""]


def test_lm_scores(spark, docs, texts):
    tokens = [[*words(ascii_lower(t or "")), None] for _, t in texts]
    held = [zlib.crc32(str(i).encode() if i is not None else b"") % 5 == 1 for i, _ in texts]
    counts = collections.Counter(w for t, h in zip(tokens, held) if not h for w in t)
    n, v = sum(counts.values()), len(counts)
    expected = collections.Counter()
    for (i, _), t, h in zip(texts, tokens, held):
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        expected[(i, h, len(t), sum(counts[w] > 0 for w in t), n, round(base, 5))] += 1
    rows = lm.score(docs).collect()
    assert collections.Counter((*r[:5], round(r["base_score"], 5)) for r in rows) == expected
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in rows)
    # Word order is learnt: texts of the training part score better than by words alone.
    train = [r for r in rows if not r["held_out"]]
    assert sum(r["score"] for r in train) > sum(r["base_score"] for r in train)


def test_lm_rare_words_are_joined(docs, monkeypatch):
    whole = {tuple(r[:5]): r["base_score"] for r in lm.score(docs).collect()}
    monkeypatch.setattr(lm, "MAX_FREQUENT", 3)
    for r in lm.score(docs).collect():
        assert r["base_score"] == pytest.approx(whole[tuple(r[:5])])


def test_lm_filter_gives_counts_back():
    from readloom.llm import bloom

    keys = np.arange(2, 4002, 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) & ~np.uint64(1)
    segments = bloom.n_segments(60_000, 12)
    bits = np.zeros(segments * bloom.SEGMENT_BITS // 8, np.uint8)
    true = np.arange(len(keys)) % 500 + 1
    level = np.searchsorted(lm.LEVELS, true, "right")
    for k in range(1, level.max() + 1):
        segment, inside = lm.offsets(keys[level >= k], k, segments)
        for offset in inside:
            at = segment * np.uint64(bloom.SEGMENT_BITS) + offset
            np.bitwise_or.at(bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
    model = lm.Model(bits, segments, 1, 1, keys[:0], true[:0], true[:0], true[:0])
    found = model.level(keys)
    assert (found >= level).all() and (found == level).mean() > 0.95


def test_lm_filter_in_parts_gives_the_same_scores(docs, monkeypatch):
    from readloom.llm import bloom

    whole = collections.Counter((*r[:5], round(r["base_score"], 6), round(r["score"], 6)) for r in lm.score(docs).collect())
    monkeypatch.setattr(bloom, "MAX_BITS", 1)
    asked = []
    monkeypatch.setattr(lm, "PART_SEGMENTS", 1)
    monkeypatch.setattr(lm, "answered", lambda *a, f=lm.answered, **k: asked.append(a) or f(*a, **k))
    parts = collections.Counter((*r[:5], round(r["base_score"], 6), round(r["score"], 6)) for r in lm.score(docs).collect())
    assert parts == whole and asked


def test_lm_filter_larger_than_a_broadcast_keeps_its_error(spark, monkeypatch):
    """Many pairs of few first words, more items than the bound has room for: absent pairs stay absent."""
    from readloom.llm import bloom

    monkeypatch.setattr(bloom, "MAX_BITS", 1 << 17)
    rng = random.Random(8)
    train = [" ".join(f"{rng.choice('abc')} x{rng.randrange(6000)}" for _ in range(4000)) for _ in range(12)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(train)], "doc_id long, text string")
    model, _, items = lm.train(docs, Scratch(spark, "lm-test"))
    n_items = sum(int(np.searchsorted(lm.LEVELS, r["n"], "right")) for r in items.collect())
    assert model.bits is None and model.segments * bloom.SEGMENT_BITS >= lm.BITS_PER_ITEM * n_items > 1 << 17
    absent = " ".join(f"{rng.choice('abc')} y{k}" for k in range(20000))
    asks = spark.createDataFrame([(0, absent), (1, train[0])], "portion long, text string")
    found = collections.defaultdict(dict)
    lists = [dict(zip(*lm.asked_by_part([t.encode()], model.frequent[:0], model.segments, 2))) for t in (absent, train[0])]
    for r in lm.answered(items, asks, model.segments, 2).collect():
        own = zip(lists[r["portion"]][r["part"]].tolist(), r["levels"])
        found[r["portion"]] |= {k: level for k, level in own if level}
    true = {r["key"] % 2**64: int(np.searchsorted(lm.LEVELS, r["n"], "right")) for r in items.collect()}
    keys = [np.unique(lm.pair_keys(lm.token_keys([t.encode()])[0])) for t in (absent, train[0])]
    wrong = np.mean([found[0].get(k, 0) > 0 for k in keys[0].tolist() if k not in true])
    assert wrong < 0.03
    seen = [k for k in keys[1].tolist() if k in true]
    assert seen and all(found[1][k] >= true[k] for k in seen)
    assert np.mean([found[1][k] == true[k] for k in seen]) > 0.95


def test_decontamination(spark, docs):
    rng = random.Random(9)
    items = [(k, f"{prose(rng, rng.randrange(6, 60), 5000)}. {prose(rng, 6, 5000)}.") for k in range(80)]
    items += [(80, prose(rng, 300, 5000)), (81, None), (82, ""), (83, "short"), (84, items[0][1])]
    held = [(900, f"{prose(rng, 50)} {items[3][1].upper()} {prose(rng, 300)}"), (901, items[80][1]),
            (902, prose(rng, 1000) + " " + items[0][1].replace(" ", "\n")),
            (903, items[5][1].split(". ")[0])]
    table = spark.createDataFrame(
        [(i, t, "en", "s", len(t)) for i, t in held], SCHEMA).unionByName(docs)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontam.leaks(table, bench).collect()}
    assert found == {(900, 3), (901, 80), (902, 0), (902, 84)}
    clean = decontam.without_leaks(table, bench)
    assert clean.columns == table.columns and clean.count() == table.count() - 3


def test_one_changed_word_hides_no_item():
    rng = random.Random(12)
    items = [(k, f"{prose(rng, 12, 5000).replace('.', '')}. "
                 f"{' '.join(f'a{rng.randrange(9000)}' for _ in range(1 + k % 16))}.") for k in range(48)]
    items.append((48, "one two three four five six seven. yes yes yes yes no."))
    rule = decontam.LeakRule()
    (index,) = decontam.indexes(items, rule)
    for item, text in items:
        own = text.split()
        docs = [" ".join([prose(rng, 30), *own[:k], "changed", *own[k + 1:], prose(rng, 30)]) for k in range(len(own))]
        docs.append(f"{prose(rng, 30)} {' '.join(own[:3])} {prose(rng, 30)}")
        # The question alone leaks only if the answer is a single word.
        docs.append(f"{prose(rng, 30)} {text.split('. ')[0]} {prose(rng, 30)}")
        found = {k for k, held in index.leaks(*decontam.layout(docs)).items() if item in held}
        single = {len(own) + 1} if len(text.split(". ")[1].split()) == 1 else set()
        assert found == set(range(len(own))) | single, text


def test_short_items_and_scripts_without_blanks(spark):
    rng = random.Random(13)
    items = ["法国的首都是哪里？巴黎。", "日本で一番高い山は何ですか。富士山です。", "เมืองหลวงของประเทศไทยคืออะไรกรุงเทพมหานคร",
             "2+2=? 4", "Who? Me", "水？", "“Where” does—the…river end? ‘In’ the sea.", "!?"]
    around = prose(rng, 40)
    docs = [f"{around} {t} {around}" for t in items[:3]] + [f"文字在前{items[0]}文字在后面，还有很多别的话。"]
    docs += [f"{around}\n2+2=?\t4, {around}", "2+2=? 42", "2, 2, 4", "12+2=? 4", "who?   me", "我要喝水？好", "a !? b",
             "where does the river end in the sea", items[0].replace("巴", "里"), "法国的天气很好，我喜欢那里的食物。"]
    table = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontam.leaks(table, bench).collect()}
    assert found == {(0, 0), (1, 1), (2, 2), (3, 0), (4, 3), (8, 4), (9, 5), (11, 6), (12, 0)}
    kept = {r["doc_id"] for r in decontam.without_leaks(table, bench).collect()}
    assert kept == {5, 6, 7, 10, 13}


def test_wand_finds_what_a_full_scan_finds():
    rng = random.Random(4)
    items = [(k, prose(rng, rng.randrange(5, 40), 150)) for k in range(500)]
    rule = decontam.LeakRule(score=0.5)
    (index,) = decontam.indexes(items, rule)
    for _ in range(60):
        own = set(rng.sample(range(len(index.terms)), 60))
        if rng.random() < 0.7:
            entry = rng.randrange(500)
            own |= {t for t in range(len(index.terms))
                    if entry in index.entry[index.bounds[t]:index.bounds[t + 1]]}
        score = np.zeros(500)
        for t in own:
            score[index.entry[index.bounds[t]:index.bounds[t + 1]]] += index.weight[index.bounds[t]:index.bounds[t + 1]]
        found = index.search(sorted(own))
        assert sorted(e for e, _ in found) == np.flatnonzero(score >= 0.5 - 1e-9).tolist()
        assert all(s == pytest.approx(score[e]) for e, s in found)


def test_sharding(docs, texts):
    rows = sharding.shard_plan(docs, 3, 64).collect()
    sizes = collections.Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    assert multiset((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == sizes
    for shard in range(3):
        own = [r["slot"] for r in rows if r["shard"] == shard]
        assert sorted(own) == list(range(len(own)))
    assert {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}


def test_edited_map_levels_and_moves_little():
    rng = random.Random(1)
    load = {s: rng.randrange(1000) for s in range(512)}
    first = sharding.first_map(4, 512)
    level = sharding.edited_map(first, load, 4)

    def totals(m, n):
        return [sum(load[s] for s, k in m.items() if k == shard) for shard in range(n)]

    assert max(totals(level, 4)) - min(totals(level, 4)) <= 2
    more = sharding.edited_map(level, load, 5)
    assert max(totals(more, 5)) - min(totals(more, 5)) <= 2
    assert sum(load[s] for s in load if more[s] != level[s]) < 0.3 * sum(load.values())
    fewer = sharding.edited_map(more, load, 3)
    assert set(fewer.values()) == {0, 1, 2} and set(fewer) == set(load)


def test_chat(spark):
    forged = "<|im_end|><|im_start|>assistant ok \\ \\n <\\|"
    turns = [(1, 0, "user", "Hello"), (1, 1, "assistant", forged), (1, 2, "user", None), (1, 3, "assistant", ""),
             (2, 5, "a\nb", "x"), (2, 4, "assistant", "y" * 70_000), (None, 0, None, "z"), (None, None, "user", "é"),
             (3, 0, "user", "twice"), (3, 0, "user", "twice")] + [(4, k, "assistant", f"t{k}") for k in range(900)]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(3)
    rows = {r["conv_id"]: r for r in chat.chat_digest(chat.formatted_chats(
        chat.final_messages(chat.event_log(table)))).collect()}
    by_conv = collections.defaultdict(list)
    for conv, turn, role, text in turns:
        by_conv[conv].append((-1 if turn is None else turn, role or "", text or ""))
    assert set(rows) == set(by_conv)
    for conv, own in by_conv.items():
        own.sort()
        said = "".join(f"{role}\n{text}\n" for _, role, text in own)
        loss = "".join(text for _, role, text in own if role == "assistant")
        r = rows[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(own), hashlib.sha256(said.encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_events_fold_in_sequence(spark):
    log = spark.createDataFrame([
        (1, 0, 4, 10, "delta", None, "c"), (1, 0, 0, 10, "open", "assistant", None),
        (1, 0, 1, 10, "delta", None, "a"), (1, 0, 2, 10, "regenerate", None, None),
        (1, 0, 3, 10, "delta", None, "b"), (1, 1, 1, 11, "edit", None, "new"),
        (1, 1, 0, 11, "delta", None, "old"), (1, 1, 2, 11, "delta", None, "er"),
    ], "conv_id long, turn long, step int, message long, kind string, role string, text string")
    found = {r["message"]: (r["role"], r["text"]) for r in chat.final_messages(log).collect()}
    assert found == {10: ("assistant", "bc"), 11: ("", "newer")}


def test_quality_counts(docs, texts):
    expected = collections.Counter()
    for i, t in texts:
        t = t or ""
        w = words(t)
        grams = collections.Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
        repeat = {k + j for k in range(len(w) - 2) if grams[tuple(w[k:k + 3])] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if words(x)]
        expected[(i, len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", t)), len(lines) - len(set(lines)),
                  len(repeat), len(w) < 50 or 100 * len(repeat) > 50 * len(w))] += 1
    assert multiset(r[:7] for r in quality.quality_report(docs).collect()) == expected


def test_line_rules(spark):
    good = "A plain line of prose that ends as it should, with a mark."
    bad = ["home | news | sport | contact.", "Accept cookies to go on.", "BUY!! NOW!! GET!! IT!! TODAY!!",
           "no mark at the end", "a### b*** c$$$ d%%% e&&& f###."]
    text = "\n".join([good] * 6 + bad + ["", good])
    tidy = spark.createDataFrame(
        [(1, text), (2, "\n".join(bad * 12)), (3, None)], "doc_id long, text string")
    rules = quality.LineRules(max_repeat_percent=100)
    (row,) = quality.clean(tidy, rules).collect()
    assert (row["doc_id"], row["text"]) == (1, "\n".join([good] * 6 + ["", good]))


def test_padded_lines_keep_their_end(spark):
    lines = ["A short line." + " " * n for n in (0, 15, 16, 400)] + ['He said it."' + ")" * 30 + "\t" * 30]
    text = "\n".join(lines)
    rows = spark.createDataFrame([(1, text), (2, "No mark here" + " " * 30)], "doc_id long, text string")
    rules = quality.LineRules(min_words=1, max_repeat_percent=100)
    assert [tuple(r) for r in quality.clean(rows, rules).collect()] == [(1, text)]


def test_every_licence_sentence_has_a_cue_and_is_found(spark):
    rows = []
    for name, forms in licenses.SENTENCES.items():
        for form in forms:
            assert any(cue in form.lower() for cue in licenses.CUES) or name == "mit-name"
            rows.append((len(rows), name, f"Intro line.\n{form}. And more."))
    table = spark.createDataFrame(rows, "doc_id long, name string, text string")
    found = {r["doc_id"]: r["sentence_ids"] for r in licenses.license_scan(table).collect()}
    assert found == {i: name for i, name, _ in rows}


def test_licence_rules_need_their_order(spark):
    s = licenses.SENTENCES
    mit = ". ".join(s[k][0] for k in ("mit-grant", "mit-notice", "as-is-mit"))
    mixed = ". ".join(s[k][0] for k in ("mit-notice", "mit-grant", "as-is-mit"))
    bsd3 = ".\n".join(s[k][0] for k in ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse"))
    rows = [(0, mit), (1, mixed), (2, bsd3), (3, bsd3.rsplit(".\n", 1)[0]), (4, None), (5, ""), (6, mit + ". " + bsd3)]
    found = {r["doc_id"]: r["licenses"] for r in licenses.license_scan(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {0: "MIT", 1: "", 2: "BSD-3-Clause", 3: "BSD-2-Clause", 4: "", 5: "", 6: "MIT,BSD-3-Clause"}


def test_wrapped_licence_sentences(spark):
    import textwrap

    s = licenses.SENTENCES | licenses.VERSIONS
    whole = {
        "MIT": [". ".join(s[k][0] for k in ("mit-grant", "mit-notice", "as-is-mit")) + "."],
        "ISC": [s["isc-grant"][0] + "."],
        "BSD-3-Clause": [s["bsd-redistribution"][0] + ":", *(
            f"{k}. {s[name][0]}." for k, name in enumerate(("bsd-source", "bsd-binary", "bsd-endorse"), 1))],
        "GPL-3.0-or-later": [s["gpl-redistribute"][0] + ".", s["gpl-warranty"][0] + ".  See the licence."],
        "GPL-2.0-or-later": [s["gpl2-redistribute"][0] + ".", s["gpl-warranty"][0] + "."],
        "AGPL-3.0-or-later": [s["agpl3-redistribute"][0] + ".", s["gpl-warranty"][0] + "."],
    }
    expected, rows = {}, []
    for licence, paragraphs in whole.items():
        for width, mark in ((10**6, ""), (72, ""), (40, "# "), (60, " * "), (50, "// "), (45, ";; "), (48, "dnl ")):
            lines = "\n\n".join("\n".join(textwrap.wrap(p, width)) for p in ["Copyright 2020 X", *paragraphs]).split("\n")
            for end in ("\n", "\r\n"):
                expected[len(rows)] = licence
                rows.append((len(rows), "def f(): pass\n" + end.join((mark + x).rstrip() for x in lines)))
    for text in ("This program is free software: it is fun.", s["gpl-redistribute"][0].replace("version 3", "version 9"),
                 s["isc-grant"][0].replace("fee is", "fee\n\nis")):
        expected[len(rows)] = ""
        rows.append((len(rows), text))
    expected[len(rows)] = "CC-BY-4.0"
    rows.append((len(rows), "no mark at the end\nLicensed under CC BY 4.0\nnor here"))
    found = {r["doc_id"]: r["licenses"] for r in licenses.license_scan(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == expected


@pytest.mark.parametrize("operator", [
    suffix.repeat_report, recompression.repeat_report, jaccard.near_duplicates, packing.pack_documents,
    lm.score, sharding.shard_plan, quality.quality_report, licenses.license_scan, quality.clean,
    jaccard.one_of_each, suffix.without_repeats])
def test_empty_tables(nothing, operator):
    assert operator(nothing).collect() == []


def test_empty_benchmark_and_conversations(spark, docs, nothing):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.leaks(docs, none).collect() == []
    assert decontam.without_leaks(docs, none).count() == docs.count()
    assert decontam.leaks(nothing, none).collect() == []
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.chat_digest(chat.formatted_chats(chat.final_messages(chat.event_log(turns)))).collect() == []


def test_other_columns_pass_through_whatever_their_names(spark):
    rng = random.Random(8)
    shared = prose(rng, 120)
    rows = [(i, f"{prose(rng, 60)}. {shared}.", i, "d", None, "q", i, 5) for i in range(4)]
    rows += [(9, rows[0][1], None, None, "p", None, None, None), (10, None, 1, "", "", "", 1, 0)]
    table = spark.createDataFrame(rows, CLASHES)
    bench = spark.createDataFrame([(1, rows[2][1][:200])], "item_id long, text string")
    others = {r[0]: (*r[2:7],) for r in rows}
    for result in (quality.clean(table), jaccard.one_of_each(table), suffix.without_repeats(table),
                   decontam.without_leaks(table, bench)):
        assert result.columns == table.columns
        found = result.collect()
        assert found
        for r in found:
            assert (*r[2:7],) == others[r["doc_id"]]


@pytest.mark.parametrize("size, passage, spread", [(400, 200, 100), (60, 24, None), (48, 48, None)])
def test_passage_report_adds_shorter_repeats(docs, texts, size, passage, spread):
    units = [list((t or "").encode()) for _, t in texts]
    counts, shorter = windows(units, size), windows(units, passage)
    expected = []
    for (i, _), u in zip(texts, units):
        marks, known = covered(u, counts, size), covered(u, shorter, passage)
        kept = bytes(x for x, m in zip(u, marks) if not m)
        spans = [sum(m and not (k and ms[k - 1]) for k, m in enumerate(ms)) for ms in (marks, known)]
        expected.append((i, len(u), sum(marks), spans[0], hashlib.sha256(kept).hexdigest(), sum(known), spans[1]))
    assert multiset(suffix.passage_report(docs, size, passage, spread).collect()) == multiset(expected)


def test_pipeline_removes_planted_passages_of_every_length(spark):
    """Passages of 51 to 70 words that two documents share go from both; the rest of each stays."""
    import corpus_pipeline

    rng = random.Random(17)
    syllables = "an be co de er fi go ha in jo ke la mo ne or pa re st ti und".split()

    def prose_of(n):
        return [("".join(rng.choice(syllables) for _ in range(rng.randrange(2, 4)))) for _ in range(n)]

    planted = {n: prose_of(n) for n in range(51, 71)}
    rows, own = [], []
    for n, passage in planted.items():
        for _ in range(2):
            before, after = prose_of(40), prose_of(40)
            own.append((before, after))
            rows.append((len(rows), " ".join(before + passage + after), "en", "s", 0))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    kept = {r["doc_id"]: r["text"].split() for r in corpus_pipeline.repeated_passages(spark, docs, "").collect()}
    assert len(kept) == len(rows)
    for k, (before, after) in enumerate(own):
        passage = planted[51 + k // 2]
        assert len(set(zip(*[kept[k][j:] for j in range(8)])) & set(zip(*[passage[j:] for j in range(8)]))) == 0
        assert kept[k][:38] == before[:38] and kept[k][-38:] == after[-38:]


def test_lm_filter_in_parts_asks_frequent_words_once(docs, texts, monkeypatch):
    """With few frequent words most words are asked in portions; scores stay the same."""
    from readloom.llm import bloom

    whole = collections.Counter((*r[:5], round(r["score"], 6)) for r in lm.score(docs).collect())
    monkeypatch.setattr(bloom, "MAX_BITS", 1)
    for most in (0, 20):
        monkeypatch.setattr(lm, "MAX_FREQUENT", most)
        assert collections.Counter((*r[:5], round(r["score"], 6)) for r in lm.score(docs).collect()) == whole
    frequent = np.sort(lm.token_keys([texts[0][1].encode()])[0][:5])
    parts, lists = lm.asked_by_part([texts[0][1].encode()], frequent, 64, 4)
    keys = np.concatenate(lists)
    assert not np.isin(keys, frequent).any() and not np.isin(keys, lm.mass_keys(frequent)).any()
    raw = lm.narrowed(keys)
    assert len(raw) == 5 * len(keys) and (lm.widened(raw) == keys & lm.KEY_BITS).all()


def test_lm_asks_each_word_and_pair_of_a_portion_once(docs, monkeypatch):
    """Repeated words cost no more searches, and a filter over the bound of a broadcast stays in parts."""
    texts = [b"b a b a b a c " * 100, b"", b"a b rare a b"]
    tokens = np.concatenate(lm.token_keys(texts))
    frequent = np.unique(tokens)[:2]
    searched, search = [], np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda a, v, *r: searched.append(np.size(v)) or search(a, v, *r))
    d = lm.Distinct.of(tokens, frequent)
    monkeypatch.setattr(np, "searchsorted", search)
    assert searched == [5] and (d.words[d.at_word] == tokens).all() and (d.pairs[d.at_pair] == lm.pair_keys(tokens)).all()
    assert d.known.sum() == 2 and len(d.asked()) == 3 + 3 + len(set(lm.pair_keys(tokens).tolist()))
    strings = lm.byte_strings(b"abcdef", np.array([0, 2, 2, 6]))
    assert strings.to_pylist() == [b"ab", b"", b"cdef"]
    raw, ends = lm.flat_bytes(strings.slice(1))
    assert raw.tobytes() == b"cdef" and ends.tolist() == [0, 0, 4]

    whole = collections.Counter((*r[:5], round(r["score"], 6)) for r in lm.score(docs).collect())
    asked = []
    monkeypatch.setattr(lm, "answered", lambda *a, f=lm.answered, **k: asked.append(a) or f(*a, **k))
    assert collections.Counter((*r[:5], round(r["score"], 6)) for r in lm.score(docs).collect()) == whole and not asked
    monkeypatch.setattr(lm, "BROADCAST_BITS", 1)
    assert collections.Counter((*r[:5], round(r["score"], 6)) for r in lm.score(docs).collect()) == whole and asked


def test_leaks_do_not_depend_on_item_blocks(spark):
    """One item a block, a few, and all in one give the same rows, scores included."""
    rng = random.Random(15)
    items = [(k, f"{prose(rng, rng.randrange(6, 90), 900)}. {prose(rng, 6, 900)}.") for k in range(60)]
    held = []
    for k, text in items:
        own = text.split(" ")
        own[rng.randrange(len(own))] = "edited"
        held.append((k, f"{prose(rng, 80, 900)} {' '.join(own)} {prose(rng, 80, 900)}"))
    docs = spark.createDataFrame(held, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(4)
    runs = [
        collections.Counter((*r[:2], round(r["score"], 12), *r[3:]) for r in decontam.leaks(docs, bench, block_bytes=n).collect())
        for n in (1, 2000, 1 << 20)]
    assert runs[0] == runs[1] == runs[2] and len(runs[0]) >= 55


def test_slices_hold_every_window_once():
    from readloom.llm import repeats

    rng = random.Random(31)
    for size, n_bytes in ((1, 3), (2, 5), (5, 40), (7, 1000)):
        text = "".join(rng.choice("ab  \t\n") for _ in range(400)).encode() + b"x" * 60 + b" end"
        units = text.split()
        found = []
        for first, part in repeats.word_slices(text, size, n_bytes):
            own = part.split()
            assert own == units[first:first + len(own)]
            found += [(first + k, tuple(own[k:k + size])) for k in range(len(own) - size + 1)]
        assert found == [(k, tuple(units[k:k + size])) for k in range(len(units) - size + 1)]
        found = [(first + k, part[k:k + size]) for first, part in repeats.byte_slices(text, size, n_bytes)
                 for k in range(len(part) - size + 1)]
        assert found == [(k, text[k:k + size]) for k in range(len(text) - size + 1)]
    assert list(repeats.word_slices(b"", 3, 5)) == [(0, b"")] == list(repeats.byte_slices(b"", 3, 5))


def test_long_texts_in_slices_give_the_same_rows(docs, monkeypatch):
    from readloom.llm import repeats

    def rows():
        return [multiset(f(docs).collect()) for f in (
            lambda d: suffix.passage_report(d, 400, 200, 100), lambda d: recompression.repeat_report(d, 35),
            lambda d: jaccard.near_duplicates(d, jaccard.Threshold(n=4, percent=85)))]

    whole = rows()
    for module in (repeats, jaccard):
        monkeypatch.setattr(module, "WORK_BYTES", 700)
    assert rows() == whole


def test_a_long_text_takes_bounded_memory():
    """20 MB in one text: what a pass over it holds beyond the text itself stays small."""
    import tracemalloc

    import pyarrow as pa

    rng = random.Random(2)
    line = " ".join(f"w{rng.randrange(5000)}" for _ in range(20000))
    text = "\n".join(line[k:] + str(k) for k in range(0, 2000, 12))[:20 << 20]
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], ["row", "text"])
    from readloom.llm import repeats
    for method in (suffix.byte_method(), recompression.word_method()):
        tracemalloc.start()
        n = sum(b.num_rows for b in repeats.anchor_rows(method)(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert n > 1000 and peak < 400 << 20
