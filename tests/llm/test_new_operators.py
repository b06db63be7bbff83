"""Spelling variants, page text and the conversation trie against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from awkward import AWKWARD, clashing, documents
from conftest import SMALL
from pyspark.sql import functions as F

from cartwright.llm import registry, spelling, turn_trie
from cartwright.llm.main_text import extract, main_text

# --- spelling -----------------------------------------------------------------------------------


def brute_words(rows, shortest=7, least=2, every=31):
    n = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if h % every == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            if len(word) >= shortest:
                n[word] += 1
    return {w: k for w, k in n.items() if k >= least}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(n, times=10):
    near = {w: [] for w in n}
    words = sorted(n)
    by_size = defaultdict(list)
    for w in words:
        by_size[len(w)].append(w)
    for w in words:
        near[w] = [x for d in (-1, 0, 1) for x in by_size[len(w) + d] if one_edit(w, x)]
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= times * n[w] else None
    rows = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return rows


def variants_of(spark, n, **options):
    words = spark.createDataFrame(list(n.items()), "word string, n bigint").repartition(3)
    return {tuple(r) for r in spelling.group_variants(words, **options).collect()}


def vocabulary(seed, stems=60, edits=6):
    random.seed(seed)
    letters, n = "abcdeéñ×", {}
    for _ in range(stems):
        stem = "".join(random.choice(letters) for _ in range(random.randint(7, 10)))
        n[stem] = random.choice([1, 5, 50, 700, 8000])
        for _ in range(edits):
            w, at = list(stem), random.randrange(len(stem))
            w[at : at + random.randint(0, 1)] = random.choice(["", "a", "é", "b"])
            n["".join(w)] = random.choice([1, 2, 5, 60, 600])
    return n


def test_variants_equal_brute_force(spark):
    """Cells of some twenty words, so that most pairs lie in two of them."""
    n = vocabulary(20)
    assert variants_of(spark, n, cell=20) == brute_variants(n)


def test_words_of_documents(spark):
    rows = [*AWKWARD, (None, "Xylophone xylophone XYLOPHONE ÉCOLES×÷ü écolesx", "q"), (12, "xylophone " * 50 + "y" * 40000, "q"), (12, "y" * 40000, "q")]
    for every in (31, 2):
        got = spelling.count_words(clashing(documents(spark, rows)), every=every).collect()
        assert {r["word"]: r["n"] for r in got} == brute_words([r[:2] for r in rows], every=every)
    assert spelling.count_words(documents(spark, [])).count() == 0


def test_giant_and_empty_vocabularies(spark):
    n = {"y" * 40000: 100, "y" * 39999: 2, "y" * 20000 + "z" + "y" * 19999: 7, "w" * 70: 3, "w" * 71: 30}
    assert variants_of(spark, n) == brute_variants(n)
    assert variants_of(spark, {"lonely": 4}) == {("lonely", None, "lonely", 4, 0, None)}
    assert spelling.group_variants(spark.createDataFrame([], "word string, n bigint")).count() == 0
    with pytest.raises(ValueError):
        spelling.group_variants(spark.createDataFrame([], "word string, n bigint"), times=1)


def test_many_anagrams_stay_linear():
    """Two classes of a thousand permutations each, one letter apart."""
    random.seed(1)
    base = "aabbccddee"
    words = {"".join(random.sample(base, 10)) for _ in range(900)}
    words |= {w.replace("a", "z", 1) for w in words} | {w.replace("a", "", 1) for w in words}
    n = {w: i + 1 for i, w in enumerate(sorted(words))}
    expected = {w: c for w, _, _, _, c, _ in brute_variants(n)}
    got = Counter()
    sizes = {size: [w for w in n if len(w) == size] for size in (9, 10)}
    made = {size: spelling.Words(ws, np.array([n[w] for w in ws])) for size, ws in sizes.items()}
    for asked, own in ((9, 9), (10, 10), (9, 10)):
        for a, b in spelling.near_pairs(made[asked], made[own], asked == own, spelling.PointTree(made[own].points)):
            got.update(made[asked].words[i] for i in a)
            got.update(made[own].words[i] for i in b)
    assert got == Counter({w: c for w, c in expected.items() if c})


def test_spelling_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = registry.op11_spelling(spark, SMALL)
    assert got.dtypes == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == brute_variants(brute_words([(r[0], r[1]) for r in docs]))


# --- pages --------------------------------------------------------------------------------------

TEXT = "The quick brown fox jumps over the lazy dog and then runs on through a long green field, where it rests for a while. "
LINKS = "".join(f'<li><a href="/{i}">Section number {i}</a></li>' for i in range(12))


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("   \n", ""),
        ("<html><body></body></html>", ""),
        ("<article></article>", ""),
        ("just text &amp; <b>more</b>\n\n of&nbsp;it", "just text & more of it"),
        ("<p>a<p>b<br>c<i>d</i>e &lt;x&gt; 1 < 2", "a b cde <x> 1 < 2"),
        ("<article><h1>T&amp</h1><p>x&#x41;&am</article><footer>f", "T& xA&am"),
        (f"<body><nav>{LINKS}</nav><article><h1>Title</h1><p>Short.</p></article><div class=ad>{TEXT * 9}</div><footer>{TEXT}</footer>", "Title Short."),
        (f"<main><header><h1>Head</h1></header><p>{TEXT}</p><aside>{TEXT}</aside><form><label>Mail</label><input></form><script>var a='</p>'</script></main>", f"Head {TEXT.strip()}"),
        (f"<article><p>{TEXT}</p><section id='comments'><article class=comment><p>{TEXT * 5}</p></article></section></article>", TEXT.strip()),
        (f"<div hidden>{TEXT}</div><article><p style='display: none'>x</p><p>{TEXT}</p><!-- <p>no</p> --></article>", TEXT.strip()),
        (f"<header><h1>Site</h1></header><article><p>{TEXT}</article>", TEXT.strip()),
        (f"<table><tr><td>{TEXT}<td>two<tr><td>three</table>", f"{TEXT.strip()} two three"),
        (f"<article><p>{TEXT}</p><p>cut off <a href='x", f"{TEXT.strip()} cut off"),
        (f"<article><p>{TEXT}</p><!-- open", TEXT.strip()),
    ],
)
def test_main_text(page, text):
    assert main_text(page) == text


def test_pages_without_landmarks():
    """Plain blocks: the densest subtree stands out from link lists and short furniture."""
    story = "".join(f"<p>{TEXT * (i % 3 + 1)}</p>" for i in range(6))
    page = f"""<body><div class="top-menu"><ul>{LINKS}</ul></div><div id="wrap"><div class="left"><ul>{LINKS}</ul></div>
    <div class="story"><h1>My title</h1>{story}</div></div>
    <div class="cookie-notice"><p>{TEXT}</p></div><div id="comments"><p>{TEXT * 20}</p></div><div><a href="/x">About</a> <a href="/y">Contact</a></div></body>"""
    assert main_text(page) == " ".join(["My title", *[(TEXT * (i % 3 + 1)).strip() for i in range(6)]])


def test_deep_and_broken_pages():
    assert main_text("<div>" * 50000 + "deep" + "</div>" * 3) == "deep"
    assert main_text("<b " * 20000) == ""
    assert main_text("<" * 20000).replace(" ", "") == "<" * 20000
    assert main_text("</p></div></article>text</html> tail") == "text tail"
    assert main_text("<article>" + "<p>x " * 50000).count("x") == 50000


def test_extract_keeps_rows(spark):
    rows = [(1, None, 3), (1, None, 3), (None, "", 4), (2, f"<article>{TEXT * 4000}</article>", 5)]
    pages = spark.createDataFrame(rows, "page_id bigint, html string, N_chars bigint").withColumn("html_to_read", F.lit(1))
    got = extract(pages)
    assert got.columns == ["page_id", "html", "html_to_read", "text", "n_chars"]
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in got.collect()) == [(0, "", 0), (1, "", 0), (1, "", 0), (2, (TEXT * 4000).strip(), len(TEXT) * 4000 - 1)]
    assert extract(pages.limit(0)).count() == 0


# --- conversations --------------------------------------------------------------------------------


def brute_nodes(rows, every=20, openings=4):
    original = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            original[c].append((turn is not None, turn or 0, role or "", text or ""))
    for turns in original.values():
        turns.sort(key=lambda t: (*t[:3], t[3][:64], hashlib.sha256(f"{len(t[2])}:{t[2]}:{t[3]}".encode()).digest()))
    built = {}
    for c, turns in original.items():
        h = zlib.crc32(str(c).encode()) % openings
        base = abs(c) // every * every * (1 if c >= 0 else -1)
        built[c] = tuple(t[2:] for t in original.get(base, [])[:h] + turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
        ends[built[c]].append(c)
    result = []
    below = {node: 0 for node in members}
    leaves, saved, children = dict(below), dict(below), dict(below)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node in members:
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(members[node]) - 1) * words
    for node, ids in members.items():
        digest = hashlib.sha256(",".join(map(str, ends.get(node, []))).encode()).hexdigest()
        result.append((ids[0], len(node), members[node[:-1]][0] if node else None, len(ids), children[node], leaves[node], saved[node], digest))
    return sorted(result, key=str)


def nodes_of(rows):
    return sorted(map(tuple, rows.collect()), key=str)


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)


def chats(seed, n=150):
    """Copies, common openings of many lengths, a hot first turn, long chains, nulls and negative ids."""
    random.seed(seed)
    rows, chain = [], [f"link {i}" for i in range(40)]
    for c in range(-30, n):
        kind = random.random()
        if kind < 0.3:
            texts = ["hello there", "how are you", "fine"][: random.randint(1, 3)]
        elif kind < 0.6:
            texts = chain[: random.randint(1, 40)] + [f"own {random.randint(0, 9)}"]
        elif kind < 0.65:
            texts = [None, "", "x y"]
        else:
            texts = ["hello there"] + [random.choice("abcd") for _ in range(random.randint(0, 6))]
        for turn, text in enumerate(texts):
            rows.append((c, random.choice([turn, turn, turn, None]), random.choice(["user", "user", None]), text))
    return rows + [(None, 1, "user", "nobody"), (5, 1, "user", "again"), (5, 1, "user", "again")]


@pytest.mark.parametrize("shard_rows", [40])
def test_trie_equals_brute_force(spark, shard_rows):
    rows = chats(shard_rows)
    assert nodes_of(turn_trie.conversation_nodes(conversations(spark, rows), shard_rows=shard_rows)) == brute_nodes(rows)


def test_trie_of_few_and_hot(spark):
    assert turn_trie.conversation_nodes(conversations(spark, [])).count() == 0
    # Conversation 23 takes its opening from 20, which is not there, and may lose all its own turns.
    lonely = [(c, 0, "user", "only") for c in (21, 22, 23, 24, 25)]
    assert nodes_of(turn_trie.conversation_nodes(conversations(spark, lonely))) == brute_nodes(lonely)
    hot = [(0, t, "user", "same") for t in range(300)] + [(1, 0, "user", "same")] * 300
    assert nodes_of(turn_trie.conversation_nodes(conversations(spark, hot), shard_rows=50)) == brute_nodes(hot)


def test_double_array_holds_its_paths():
    random.seed(2)
    paths = list({tuple(random.randint(1, 30) for _ in range(random.randint(1, 6))) for _ in range(500)})
    trie = turn_trie.DoubleArray([np.array(p) for p in paths])
    assert len({p[:d] for p in paths for d in range(1, 7) if d <= len(p)}) == int((trie.check >= 0).sum())
    for path in paths:
        node = np.array([0])
        for letter in path:
            node = trie.step(node, np.array([letter]))
            assert node[0] > 0
    assert trie.step(np.array([0]), np.array([31]))[0] == -1


def test_trie_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = registry.op13_turn_trie(spark, SMALL)
    expected = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    assert got.dtypes == [(name, "string" if name == "ends_sha256" else "bigint") for name in expected]
    assert nodes_of(got) == brute_nodes(rows)
