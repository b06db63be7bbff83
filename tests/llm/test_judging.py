"""Toxicity, url filters, mixing, neighbours and components against brute force."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from awkward import AWKWARD, SCHEMA, clashing, documents

from cartwright.llm import ann, mixing, toxicity, url_filters
from cartwright.llm.common import store_for
from cartwright.llm.components import connected_components

# --- toxicity ---------------------------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def brute_match(entries, word):
    """The fewest edits at which a term, or an opening of the word and a stem, meet."""
    best = None
    for entry in entries:
        ends = range(len(word) + 1) if entry.stem else [len(word)]
        edits = min(distance(entry.term, word[:end]) for end in ends)
        if edits <= entry.edits and (best is None or edits < best):
            best = edits
    return best


def test_automaton_equals_edit_distance():
    entries = tuple(toxicity.Entry(t, s, 1.0, 0.5) for t, s in [("idiot", False), ("lowei", True), ("disgusting", False), ("bad", False), ("badger", True)])
    automaton = toxicity.LexiconAutomaton(entries)
    random.seed(3)
    words = ["", "idiot", "idot", "idiiot", "xidiot", "loweichen", "lwei", "loweyes", "disgsting", "disgustinngg", "ba", "bad", "bd", "badgr", "badgering"]
    for _ in range(4000):
        word = list(random.choice(words) or "idiot")
        for _ in range(random.randint(0, 3)):
            at = random.randrange(len(word) + 1)
            word[at : at + random.randint(0, 1)] = random.choice(["", "x", "e", "i", "é"])
        words.append("".join(word))
    for word in words:
        found = automaton.match(word)
        assert (found[1] if found else None) == brute_match(entries, word), word


def test_quotation_counts_less_than_abuse():
    reader = toxicity.Reader((toxicity.Entry("idiot", False, 5.0, 2.0),))
    abuse, plain = reader.evidence("you idiot go away")[0], reader.evidence("the idiot went away")[0]
    quoted, said = reader.evidence('the "idiot" went away')[0], reader.evidence("he said idiot and left")[0]
    wrong = reader.evidence("the idiott went away")[0]
    assert abuse > plain > wrong > quoted == said > 0
    assert reader.evidence("nothing here") == (0.0, 0.0, 0.0) == reader.evidence("")


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs.select("doc_id", "text"), model).join(labels, "doc_id").selectExpr("doc_id", "toxicity", "toxic").toPandas()
    held = rows[[__import__("zlib").crc32(str(i).encode()) % 4 == 2 for i in rows["doc_id"]]]
    found, true = held["toxicity"] >= 0.3, held["toxic"] == 1
    assert len(held) > 500
    assert (found & true).sum() / true.sum() > 0.9
    assert (found & true).sum() / found.sum() > 0.95


def test_toxicity_of_awkward_rows(spark):
    docs = clashing(documents(spark))
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (6, None), (1, 0)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, model, output="score").collect()
    assert len(rows) == len(AWKWARD)
    assert all(0 <= r["score"] <= 1 for r in rows)
    nothing = toxicity.fit(docs.limit(0), labels.limit(0))
    assert nothing.entries == ()
    assert toxicity.score(docs.limit(0), nothing).collect() == []


def test_sample_takes_one_row_of_a_key(spark):
    docs = spark.createDataFrame([(1, f"bad text {i}", "a") for i in range(500)] + [(2, "good", "a"), (3, None, "a"), (5, "fine", "a")], SCHEMA)
    keys = spark.createDataFrame([(i, int(i == 1)) for i in range(1, 6)], "doc_id bigint, toxic int")
    drawn = [r[0] for r in keys.filter(~toxicity.is_held_out(keys.doc_id)).select("doc_id").collect()]
    assert 1 in drawn
    first = toxicity.labelled_sample(docs, keys, "doc_id", "text", store_for(docs)).collect()
    assert len(first) == len([i for i in drawn if i != 4])
    again = toxicity.labelled_sample(docs.repartition(5), keys, "doc_id", "text", store_for(docs)).collect()
    assert Counter(map(tuple, first)) == Counter(map(tuple, again))


# --- urls -------------------------------------------------------------------------------------

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
CANONICAL = '<html><LINK href="{}" rel="canonical"></html>'
REFRESH = "<meta http-equiv='refresh' content='0; URL={}'>"
PAGES = [
    (1, "http://A.Example.net/en/x?y#z", None, "a.example.net", "/en/x", "example.net/en/", "allow"),
    (2, "https://foo.net/p", "", "foo.net", "/p", "net/", "block"),
    (3, "https://foo.net", None, "foo.net", "", None, "allow"),
    (4, None, None, "", "", None, "allow"),
    (5, "no scheme", CANONICAL.format("https://foo.net/p"), "", "", None, "allow"),
    (6, "http://ali.as/1", CANONICAL.format("https://foo.net/p"), "ali.as", "/1", None, "block"),
    (7, "http://ali.as/2", REFRESH.format("/1"), "ali.as", "/2", None, "block"),
    (8, "http://ali.as/3", REFRESH.format("2"), "ali.as", "/3", None, "block"),
    (9, "http://mixed.it/a", CANONICAL.format("http://www.q.org/fr/1"), "mixed.it", "/a", None, "allow"),
    (10, "http://mixed.it/b", CANONICAL.format("http://mixed.it/a#top"), "mixed.it", "/b", None, "allow"),
    (11, "http://bad.net/x", REFRESH.format("http://mixed.it/a"), "bad.net", "/x", "net/", "block"),
    (12, "http://x.example.com/de/", CANONICAL.format("//y.it/c?d=1"), "x.example.com", "/de/", "example.com/de/", "block"),
    (13, "ftp://Y.it/c?d=1#e", None, "y.it", "/c", None, "block"),
    (14, "http://y.it/c", None, "y.it", "/c", None, "allow"),
    (15, "http://notexample.com/de/1", None, "notexample.com", "/de/1", None, "allow"),
    (15, "http://notexample.com/de/1", None, "notexample.com", "/de/1", None, "allow"),
    (None, "http://net/?q=://", None, "net", "/", "net/", "block"),
]


def test_urls(spark):
    pages = spark.createDataFrame([p[:3] for p in PAGES], "page_id bigint, url string, html string")
    rows = url_filters.judge(pages.selectExpr("*", "1 AS host", "2 AS node", "3 AS component", "4 AS rule"), RULES).collect()
    expected = [(p[0], *p[3:]) for p in PAGES]
    assert Counter(map(tuple, rows)) == Counter(expected)
    assert url_filters.judge(pages.limit(0), RULES).collect() == []


def test_every_link_of_a_page_is_an_edge(spark):
    html = (
        '<link rel="alternate canonical" href="http://b.it/1"><link href=\'http://b.it/2\' rel=\'canonical next\'><link rel=canonical href=http://b.it/3>'
        '<link rel="not-canonical" href="http://b.it/4"><link rel="canonicals" href="http://b.it/5">'
    )
    html += REFRESH.format("http://c.it/1") + REFRESH.format("http://c.it/2")
    pages = spark.createDataFrame([(1, "http://a.it/", html), (2, "http://d.it/", None)], "page_id bigint, url string, html string")
    found = Counter(tuple(r) for r in url_filters.link_edges(pages).collect())
    assert found == Counter(("a.it/", to) for to in ("b.it/1", "b.it/2", "b.it/3", "c.it/1", "c.it/2"))


def test_given_edges(spark):
    pages = spark.createDataFrame([(1, "http://a.it/", None)], "page_id bigint, url string, html string")
    edges = spark.createDataFrame([("http://a.it/", "http://b.it/"), ("http://b.it/", "http://c.net/")], "a string, b string")
    assert url_filters.judge(pages, RULES, edges=edges).first()["verdict"] == "block"


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    random.seed(9)
    edges = {
        "path": [(i, i + 1) for i in range(60)],
        "star": [(0, i) for i in range(1, 80)],
        "random": [(random.randrange(90), random.randrange(90)) for _ in range(60)] + [(None, 3), (4, None)],
        "none": [(5, 5)],
    }[shape]
    rows = connected_components(spark.createDataFrame(edges, "a bigint, b bigint"), store_for(spark.range(1))).collect()
    parent = {n: n for e in edges if None not in e and e[0] != e[1] for n in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a in parent and b in parent:
            parent[find(a)] = find(b)
    groups, found = defaultdict(set), defaultdict(set)
    for node in parent:
        groups[find(node)].add(node)
    for row in rows:
        found[row["component"]].add(row["node"])
    assert len(rows) == len(parent)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))


# --- mixing -----------------------------------------------------------------------------------


def mixing_corpus(seed):
    random.seed(seed)
    sizes = {"big": 300, "mid": 90, "small": 20, "one": 1}
    return [(i, " ".join(["w"] * random.randint(1, 9)), s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]


def words_of(text):
    return text.count(" ") + text.count("\n") + 1 if text else 0


def brute_exponent(tokens, target):
    total = sum(tokens.values())
    shares = [t / total for t in tokens.values()]

    def steep(t):
        powers = [p**t for p in shares]
        weights = [p / sum(powers) for p in powers]
        if target.entropy is not None:
            return -sum(w * math.log(w) for w in weights) <= target.entropy
        most, least = max(w / p for w, p in zip(weights, shares)), min(w / p for w, p in zip(weights, shares))
        budget = 1 / least if target.budget is None else target.budget / total
        return most * budget <= target.repetitions * (1 + 1e-12)

    low, high = 0.0, 16.0 if target.entropy is not None else 1.0
    if steep(low):
        return low
    for _ in range(60):
        low, high = ((low + high) / 2, high) if not steep((low + high) / 2) else (low, (low + high) / 2)
    return high


TARGETS = [mixing.Target(repetitions=4.0), mixing.Target(entropy=1.1), mixing.Target(entropy=9.0), mixing.Target(repetitions=3.0, budget=900.0)]


@pytest.mark.parametrize("target", TARGETS)
def test_weights_and_budgets(spark, target):
    corpus = mixing_corpus(4)
    docs = spark.createDataFrame(corpus, SCHEMA).repartition(3)
    tokens = Counter()
    for _, text, source in corpus:
        tokens[source] += words_of(text)
    total = sum(tokens.values())
    exponent = brute_exponent(tokens, target)
    powers = {s: (t / total) ** exponent for s, t in tokens.items()}
    weights = {s: p / sum(powers.values()) for s, p in powers.items()}
    budget = target.budget or max(tokens[s] / weights[s] for s in tokens)
    rows = mixing.schedule(docs, target, block_tokens=64).collect()
    by_source = defaultdict(list)
    for row in rows:
        by_source[row["source"]].append(row)
    longest = max(words_of(t) for _, t, _ in corpus)
    for source, own in by_source.items():
        emitted = sum(r["n_tokens"] for r in own)
        assert weights[source] * budget - 1e-3 <= emitted <= weights[source] * budget + longest
        # Every pass but the last is a permutation of all documents; none comes twice in a pass.
        passes = defaultdict(list)
        for row in own:
            passes[row["pass"]].append(row["doc_id"])
        ids = sorted(i for i, _, s in corpus if s == source)
        for number, members in passes.items():
            assert len(set(members)) == len(members)
            assert number == max(passes) or sorted(members) == ids
    # Blocks hold all sources in the proportions of their weights.
    last = max(r["block"] for r in rows)
    for block in range(last):
        inside = Counter()
        for row in rows:
            if row["block"] == block:
                inside[row["source"]] += row["n_tokens"]
        assert all(abs(inside[s] - weights[s] * 64) <= 2 * longest for s in weights)
        positions = sorted(r["position"] for r in rows if r["block"] == block)
        assert positions == list(range(len(positions)))
    again = mixing.schedule(docs.repartition(5), target, block_tokens=64).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))


def test_running_totals_do_not_depend_on_their_steps(spark, monkeypatch):
    docs = spark.createDataFrame(mixing_corpus(5), SCHEMA)
    expected = Counter(map(tuple, mixing.schedule(docs, TARGETS[0]).collect()))
    monkeypatch.setattr(mixing, "ROWS_PER_STEP_BITS", 1)
    monkeypatch.setattr(mixing, "STEPS_PER_PARENT_BITS", 2)
    assert Counter(map(tuple, mixing.schedule(docs, TARGETS[0]).collect())) == expected


def test_mixing_awkward_rows(spark):
    docs = clashing(documents(spark))
    mixed = mixing.mix(docs, mixing.Target(repetitions=2.0))
    assert mixed.columns == docs.columns
    copies = Counter((r["doc_id"], r["text"], r["source"]) for r in mixed.collect())
    once = Counter(AWKWARD)
    assert set(copies) == set(once)
    assert all(once[k] <= copies[k] <= 2 * once[k] for k in copies)
    assert mixing.mix(docs.limit(0), mixing.Target(repetitions=2.0)).collect() == []
    blank = spark.createDataFrame([(1, None, "a"), (2, "", "b")], SCHEMA)
    assert mixing.mix(blank, mixing.Target(entropy=0.5)).count() == 2
    with pytest.raises(ValueError):
        mixing.Target()


def test_mix_comes_in_order_of_blocks(spark, folder):
    docs = spark.createDataFrame(mixing_corpus(6), SCHEMA).repartition(3)
    planned = mixing.schedule(docs, TARGETS[0], block_tokens=64).orderBy("block", "position").select("doc_id").collect()
    mixing.mix(docs, TARGETS[0], block_tokens=64).write.parquet(f"{folder}/mixed")
    files = sorted(p for p in __import__("os").listdir(f"{folder}/mixed") if p.endswith(".parquet"))
    written = [r["doc_id"] for p in files for r in spark.read.parquet(f"{folder}/mixed/{p}").collect()]
    assert written == [r["doc_id"] for r in planned]


def test_no_window_grows_with_empty_or_repeated_rows(spark, monkeypatch):
    corpus = mixing_corpus(7) + [(1000 + i, "", "empty") for i in range(2000)] + [(5000, "w w", "big")] * 2000
    docs = spark.createDataFrame(corpus, SCHEMA)
    steps, starts = [], mixing._running_starts

    def watched(rows, *rest):
        steps.append(rows.groupBy("source_key", "pass", "step").count().agg({"count": "max"}).first()[0])
        return starts(rows, *rest)

    monkeypatch.setattr(mixing, "_running_starts", watched)
    found = mixing.schedule(docs, TARGETS[0], block_tokens=64).collect()
    assert max(steps) < 4 << mixing.ROWS_PER_STEP_BITS
    assert max(Counter(r["block"] for r in found).values()) < 200
    copies = Counter(r["doc_id"] for r in found)
    assert copies[5000] >= 2000 and all(copies[i] >= 1 for i, _, _ in corpus)
    again = mixing.schedule(docs.repartition(5), TARGETS[0], block_tokens=64).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, again))


# --- neighbours -------------------------------------------------------------------------------


def brute_neighbours(rows, k, every):
    out = {}
    for at, (key, vector) in enumerate(rows):
        if key is not None and key % every == 0:
            scores = [(-float((vector * other).sum()), other_key, i) for i, (other_key, other) in enumerate(rows) if i != at]
            out.setdefault(key, []).append([(o, -s) for s, o, _ in sorted(scores)[:k]])
    return out


def vectors(seed, count=900, size=12):
    random_numbers = np.random.default_rng(seed)
    rows = random_numbers.normal(size=(count, size)).astype(np.float32)
    rows[200:500] = rows[200]
    return [(i, r.astype(np.float64)) for i, r in enumerate(rows)]


def test_neighbours_by_calibrated_recall(spark, monkeypatch):
    monkeypatch.setattr(ann, "SMALL_LENGTH", 100)
    monkeypatch.setattr(ann, "LEAF_ROWS", 16)
    monkeypatch.setattr(ann, "BLOCK_ROWS", 100)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 10)
    rows = vectors(1)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id bigint, embedding array<float>").repartition(3)
    truth = brute_neighbours(rows, 20, 20)
    found = defaultdict(list)
    for row in ann.search(table).collect():
        found[row["query_id"]].append((row["rank"], row["vec_id"], row["score"]))
    assert set(found) == set(truth)
    hits = total = 0
    by_id = dict(rows)
    for query, own in found.items():
        own.sort()
        assert [r for r, _, _ in own] == list(range(1, 21))
        assert [(-s, i) for _, i, s in own] == sorted((-s, i) for _, i, s in own)
        for _, other, score in own:
            assert other != query and score == pytest.approx(float((by_id[query] * by_id[other]).sum()), rel=1e-12)
        best = {i for i, _ in truth[query][0]}
        hits += len(best & {i for _, i, _ in own})
        total += len(best)
    assert hits / total >= 0.9
    exact = ann.search(table, target=1.1).collect()
    got = defaultdict(list)
    for row in sorted(exact, key=lambda r: r["rank"]):
        got[row["query_id"]].append(row["vec_id"])
    assert got == {q: [i for i, _ in t[0]] for q, t in truth.items()}


def test_neighbours_of_mixed_lengths(spark, monkeypatch):
    """Two lengths with a tree each and two rare ones: every vector meets those of its own length, and only those."""
    monkeypatch.setattr(ann, "SMALL_LENGTH", 100)
    monkeypatch.setattr(ann, "BLOCK_ROWS", 64)
    random_numbers = np.random.default_rng(9)
    groups = {size: [(i, random_numbers.normal(size=size)) for i in range(start, start + count)] for size, start, count in ((3, 0, 160), (5, 160, 240), (2, 400, 61), (7, 500, 2))}
    table = spark.createDataFrame([(i, v.tolist()) for rows in groups.values() for i, v in rows], "vec_id bigint, embedding array<double>").repartition(4)
    found = defaultdict(list)
    for row in sorted(ann.search(table, target=1.1).collect(), key=lambda r: r["rank"]):
        found[row["query_id"]].append(row["vec_id"])
    truth = {}
    for rows in groups.values():
        truth |= {q: [i for i, _ in t[0]] for q, t in brute_neighbours(rows, 20, 20).items()}
    assert found == truth and found[500] == [501]


def test_neighbours_of_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (20, [0.0, 2.0]), (20, [0.0, 2.0]), (3, None), (40, [0.0, 0.0]), (5, [nan, 1.0]), (60, [inf, 1.0]), (7, [None, 1.0]),
        (8, [1.0, 1.0]), (9, [1.0]), (None, [3.0, 0.0]), (80, []),
    ]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "1 AS row", "2 AS leaf", "3 AS score")
    found = defaultdict(list)
    for row in sorted(ann.search(table).collect(), key=lambda r: (r["query_id"], r["rank"])):
        found[row["query_id"]].append((row["rank"], row["vec_id"], row["score"]))
    # Key 9 has no other vector of its length.
    assert found[0] == [(1, None, 3.0), (2, 8, 1.0), (3, 20, 0.0), (4, 20, 0.0)]
    assert sorted(found[20]) == sorted([(1, 20, 4.0), (2, 8, 2.0), (3, None, 0.0), (4, 0, 0.0)] * 2, key=str) or len(found[20]) == 8
    assert set(found) == {0, 20}
    assert ann.search(table.limit(0)).collect() == []
