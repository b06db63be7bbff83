"""Exact, near and line deduplication against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from awkward import AWKWARD, SCHEMA, clashing, documents

from cartwright.llm import exact_dedup, line_dedup, minhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def lowered(text):
    return (text or "").encode().lower()


def near_corpus(seed, originals=12, copies=14, words=60):
    """Groups of edited copies, of which some drift out of reach of each other, and a shared passage."""
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(900)]
    passage = " ".join(f"p{i}" for i in range(25))
    rows = []
    for group in range(originals):
        base = [random.choice(vocabulary) for _ in range(random.choice([3, 8, 20, words, 4 * words]))]
        for copy in range(random.randint(1, copies)):
            text = list(base)
            for _ in range(random.choice([0, 0, 1, 1, 2, 3, 6])):
                text[random.randrange(len(text))] = random.choice(vocabulary)
            base = text if random.random() < 0.3 else base
            rows.append((len(rows), " ".join(text) + (f" {passage}" if group % 2 else ""), "s"))
    random.shuffle(rows)
    return rows


def brute_components(rows, width, numerator=80, denominator=100):
    sets = []
    for _, text, _ in rows:
        words = WORD.findall(lowered(text))
        sets.append({tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if len(words) >= width else {tuple(words)} if words else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and denominator * len(a & sets[j]) >= numerator * len(a | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (key, _, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return [(key, len(sets[i]), least.get(find(i))) for i, (key, _, _) in enumerate(rows)]


def order(row):
    return tuple((value is not None, value) for value in row)


@pytest.mark.parametrize(("seed", "rounds", "per_entry"), [(1, 6, 4), (2, 6, 0), (3, 1, 0), (4, 0, 0)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, seed, rounds, per_entry):
    monkeypatch.setattr(minhash, "PIVOT_ROUNDS", rounds)
    monkeypatch.setattr(minhash, "PAIRS_PER_ENTRY", per_entry)
    corpus = near_corpus(seed)
    docs = spark.createDataFrame(corpus, SCHEMA).repartition(3)
    found = minhash.near_duplicates(docs, words=2).collect()
    assert sorted((r[0], r[1], r[2]) for r in found) == sorted(brute_components(corpus, 2))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_near_duplicates_of_awkward_rows(spark):
    found = minhash.near_duplicates(clashing(documents(spark)), words=2).collect()
    assert sorted(((r[0], r[1], r[2]) for r in found), key=order) == sorted(brute_components(AWKWARD, 2), key=order)
    kept = minhash.deduplicate(clashing(documents(spark)), words=2)
    assert kept.columns == clashing(documents(spark)).columns
    keys = sorted((r["doc_id"] for r in kept.collect()), key=lambda k: (k is not None, k))
    # The three spellings of the first sentence, the repeated rows, and the two rows without a key are one each.
    assert keys == [None, 1, 3, 4, 5, 6, 7, 8, 9]
    assert minhash.near_duplicates(documents(spark).limit(0)).collect() == []


def test_needed_is_never_more_than_what_similar_sets_share():
    random.seed(5)
    for _ in range(3000):
        n = random.randint(1, 60)
        union = [random.getrandbits(62) for _ in range(n)]
        spare = n - -(-n * 80 // 100)
        moved = random.sample(union, random.randint(0, spare))
        half = random.randint(0, len(moved))
        a, b = set(union) - set(moved[:half]), set(union) - set(moved[half:])
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            shared = len(set(sorted(a)[:32]) & set(sorted(b)[:32]))
            assert shared >= max(minhash.needed(len(a), 32, 80, 100), minhash.needed(len(b), 32, 80, 100)) or min(len(a), len(b)) >= 32 and shared >= 10


def test_similar_sets_share_a_band():
    random.seed(6)
    sets = []
    for n in [4, 5, 9, 30, 31, 32, 33, 60, 200, 900] * 20:
        union = [random.getrandbits(63) for _ in range(n + n // 4)]
        sets += [np.array(sorted(union[:n]), np.int64), np.array(sorted(union), np.int64)]
    keys = minhash.band_keys([*sets, np.empty(0, np.int64), sets[0][:3]], 80, 100).to_pylist()
    assert all(set(a) & set(b) for a, b in zip(keys[:-2:2], keys[1:-2:2]))
    # No other set can be near one of three.
    assert keys[-2:] == [[], []]


def test_common_shingles_make_no_long_lists(spark, monkeypatch):
    """Every shingle here is in several texts, and only the planted pairs are near."""
    random.seed(7)
    texts = [" ".join(f"w{random.randrange(40)}" for _ in range(90)) for _ in range(300)]
    texts += [f"{text} end" for text in texts[:5]]
    layers, keep = {}, minhash.ParquetStore.keep

    def counting(store, name, rows, *more, **named):
        layers[name] = keep(store, name, rows, *more, **named)
        if name == "lists":
            layers["entries"] = layers[name].count()
        return layers[name]

    monkeypatch.setattr(minhash.ParquetStore, "keep", counting)
    rows = minhash.near_duplicates(spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], SCHEMA), words=2).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in rows if not r["kept"]) == [(300 + i, i) for i in range(5)]
    assert layers["entries"] < 2 * len(texts)


def test_pairs_of_near_copies_meet_once(spark, monkeypatch):
    """Loose copies of one text share many lists; each pair comes out of one of them, from either end, and no link is lost."""
    random.seed(8)
    base = [f"w{i}" for i in range(160)]
    corpus = []
    for i in range(60):
        words = list(base)
        for at in random.sample(range(len(words)), random.choice([3, 4, 5])):
            words[at] = f"x{random.getrandbits(40)}"
        corpus.append((i, " ".join(words), "s"))
    made = []
    met = minhash._met

    def counting(*sides):
        made.append((met(*sides).count(), met(*sides).distinct().count()))
        return met(*sides)

    monkeypatch.setattr(minhash, "_met", counting)
    monkeypatch.setattr(minhash, "PIVOT_ROUNDS", 0)
    found = minhash.near_duplicates(spark.createDataFrame(corpus, SCHEMA), words=2).collect()
    assert sorted((r[0], r[1], r[2]) for r in found) == sorted(brute_components(corpus, 2))
    rows, pairs = made[-1]
    assert 60 < pairs <= rows <= 2 * pairs


def test_lists_of_a_loose_group_are_read_for_one_round(spark, monkeypatch):
    """Texts with one long passage in common share lists without links; few comparisons an entry need no more pivots."""
    random.seed(9)
    passage = [f"w{i}" for i in range(60)]
    corpus = [(i, " ".join([*passage, *(f"x{i}y{j}" for j in range(20))]), "s") for i in range(80)]
    corpus += [(100 + i, f"{text} end", "s") for i, text, _ in corpus[:6]]
    layers, keep = {}, minhash.ParquetStore.keep

    def counting(store, name, rows, *more, **named):
        layers[name] = keep(store, name, rows, *more, **named)
        if name.startswith("active"):
            layers[name] = layers[name].localCheckpoint()
        return layers[name]

    monkeypatch.setattr(minhash.ParquetStore, "keep", counting)
    found = minhash.near_duplicates(spark.createDataFrame(corpus, SCHEMA), words=2).collect()
    assert sorted((r[0], r[1], r[2]) for r in found) == sorted(brute_components(corpus, 2))
    active = {name for name in layers if name.startswith("active")}
    assert active == {"active-1"}
    # One row for each entry of a list, at most one per class and band: in proportion to the texts.
    assert layers["active-1"].count() <= len(corpus) * len(minhash.band_multipliers(80, 100))


def brute_exact(rows):
    groups = defaultdict(list)
    for key, text, _ in rows:
        groups[lowered(text)].append(key)
    return [
        (key, max((k for k in groups[lowered(text)] if k is not None), default=None), len(groups[lowered(text)]), hashlib.sha256(lowered(text)).hexdigest())
        for key, text, _ in rows
    ]


@pytest.mark.parametrize("support", [0.2, 0.9])
def test_exact_copies(spark, support):
    rows = AWKWARD + [(100 + i, "Hot copy É", "a") for i in range(12)]
    found = exact_dedup.decisions(clashing(documents(spark, rows)), support=support).collect()
    assert sorted(((r[0], r[1], r[2], r[4]) for r in found), key=order) == sorted(brute_exact(rows), key=order)
    kept = exact_dedup.deduplicate(clashing(documents(spark, rows)), support=support)
    assert kept.columns == clashing(documents(spark)).columns
    texts = [lowered(r["text"]) for r in kept.collect()]
    assert sorted(texts) == sorted({lowered(t) for _, t, _ in rows})
    assert exact_dedup.decisions(documents(spark).limit(0)).collect() == []


def brute_lines(rows):
    """Keys are unique here."""
    lines, heads = [], {}
    for key, text, _ in sorted(rows):
        for number, line in enumerate((text or "").split("\n")):
            line = lowered(line).strip(b" \t\r\x0b\x0c")
            lines.append((key, number, line))
            if line:
                heads.setdefault(line, (key, number))
    removed, earlier = set(), []
    for line, head in sorted(heads.items(), key=lambda x: x[1]):
        words = set(WORD.findall(line))
        if any(100 * len(words & other) >= 80 * len(words | other) for other in earlier):
            removed.add(line)
        earlier.append(words)
    return [
        (key, number, *heads.get(line, (key, number)), not line or heads[line] == (key, number) and line not in removed) for key, number, line in lines
    ]


def line_corpus(seed):
    random.seed(seed)
    texts = [t for _, t, _ in near_corpus(seed, originals=8, words=25)]
    rows = []
    while texts:
        lines = [texts.pop() for _ in range(min(len(texts), random.randint(1, 5)))]
        lines += random.choices(["", "  ", "the the end", "The end", "end the", "a", "B b"], k=3)
        random.shuffle(lines)
        rows.append((len(rows), "\n".join(lines), "s"))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_lines_equal_brute_force(spark, seed):
    corpus = line_corpus(seed)
    docs = spark.createDataFrame(corpus, SCHEMA).repartition(3)
    assert sorted(map(tuple, line_dedup.judge_lines(docs).collect())) == sorted(brute_lines(corpus))
    kept = defaultdict(list)
    for key, number, _, _, stays in brute_lines(corpus):
        if stays:
            kept[key].append(number)
    for row in line_dedup.clean(docs).collect():
        lines = dict((k, t.split("\n")) for k, t, _ in corpus)[row["doc_id"]]
        assert row["text"] == "\n".join(lines[i] for i in kept[row["doc_id"]])


def test_lines_of_awkward_rows(spark):
    docs = clashing(documents(spark))
    rows = line_dedup.judge_lines(docs).collect()
    assert len(rows) == sum(len((t or "").split("\n")) for _, t, _ in AWKWARD)
    first = [r for r in rows if r["class_doc_id"] == 1]
    assert sorted((r["doc_id"], r["kept"]) for r in first) == [(1, True), (2, False), (6, False)]
    nine = [r for r in rows if r["doc_id"] == 9 and r["line_no"] == 0]
    assert sorted(r["kept"] for r in nine) == [False, True]
    cleaned = line_dedup.clean(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == len(AWKWARD)
    assert line_dedup.judge_lines(documents(spark).limit(0)).collect() == []


def test_line_identity_has_two_independent_halves(spark):
    """Hashes are chained: a half that hashes the first half again would add nothing to it."""
    lines = spark.range(50).selectExpr("concat('line ', id) AS line")
    rows = lines.select("line", *line_dedup._digest()).selectExpr("d1", "d2", "xxhash64(line, 1) AS chained").collect()
    assert len({r["d1"] for r in rows}) == len({r["d2"] for r in rows}) == 50
    assert all(r["d2"] not in (r["chained"], r["d1"]) for r in rows)
