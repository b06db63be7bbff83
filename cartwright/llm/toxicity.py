"""Toxicity: a lexicon trie read through Levenshtein automata, scored in context windows.

The lexicon is learned from labelled rows: words, and stems that open a word.  Trie and edit budget
are walked as one automaton, made deterministic as words ask for it, so a word costs one step per
letter and most words end after a few.  A misspelled term counts less than an exact one, and not at
all where labelled clean texts hold the same misspelling.  Inside quotation marks, or after words
that report speech, a term counts a quarter.  A logistic model turns the evidence into a score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import col, free_name, keeps_cache, ship, slices, store_for, use_cache
from cartwright.sources.store import ParquetStore

# Bounds of the labelled sample that lexicon and model are fitted on.
TOXIC_ROWS, CLEAN_ROWS = 1500, 3000
LEXICON_ENTRIES, CANDIDATES = 2000, 5000
# A text is toxic from this score on, for the operator and for the pipeline.
TOXIC_FROM = 0.3
SHORTEST_WORD, SHORTEST_STEM, LONGEST_STEM = 3, 4, 12
# Uses of a term that one document counts for, and toxic documents that a term needs.
OFTEN, LEAST_DOCS = 5, 3
# A term needs this log-likelihood ratio and this log-odds to enter.
LEAST_RATIO, LEAST_ODDS = 25.0, 1.5
FUZZY, QUOTED, ADDRESSED = 0.7, 0.25, 1.25
WINDOW = 8
CACHED_CHUNKS = 250_000

_WORD = re.compile(r"[^\W\d_]+")
_QUOTES = "\"'“”„‟«»‹›‘’"
# Words that report speech, and words that address a reader, in the four languages.
REPORTING = frozenset(
    "said says called wrote quoted quote term word cited sagte schrieb zitat wort genannt dit disait écrit mot citation dijo escribió llamó palabra cita".split()
)
ADDRESSING = frozenset("you your du dich dir ihr euch tu toi vous usted tú te ti".split())


@dataclass(frozen=True)
class Entry:
    term: str
    stem: bool
    weight: float
    fuzzy_weight: float = 0.0

    @property
    def edits(self) -> int:
        """Edits by length: short terms must be exact."""
        return 0 if len(self.term) < 5 else 1 if len(self.term) < 9 else 2


# --- the automaton ----------------------------------------------------------------------------


class LexiconAutomaton:
    """Trie and Levenshtein budgets as one automaton over letters."""

    def __init__(self, entries: tuple[Entry, ...]) -> None:
        self.entries = entries
        self._children: list[dict[str, int]] = [{}]
        self._ends: list[list[int]] = [[]]
        self._budget: list[int] = [0]
        for number, entry in enumerate(entries):
            node = 0
            self._budget[0] = max(self._budget[0], entry.edits)
            for letter in entry.term:
                if letter not in self._children[node]:
                    self._children[node][letter] = len(self._children)
                    self._children.append({})
                    self._ends.append([])
                    self._budget.append(0)
                node = self._children[node][letter]
                self._budget[node] = max(self._budget[node], entry.edits)
            self._ends[node].append(number)
        self._letters = {letter for children in self._children for letter in children}
        self._ids: dict[tuple[tuple[int, int], ...], int] = {}
        self._states: list[tuple[tuple[int, int], ...]] = []
        self._steps: list[dict[str, int]] = []
        # Best stem reached in a state, and best whole word if the word ends there.
        self._open: list[tuple[int, int] | None] = []
        self._closed: list[tuple[int, int] | None] = []
        self._start = self._state({0: 0})

    def _state(self, positions: dict[int, int]) -> int:
        """Number of the state; letters of the lexicon that a word leaves out need no step."""
        queue = list(positions)
        while queue:
            node = queue.pop()
            for child in self._children[node].values():
                edits = positions[node] + 1
                if edits <= self._budget[child] and edits < positions.get(child, 99):
                    positions[child] = edits
                    queue.append(child)
        key = tuple(sorted(positions.items()))
        if key not in self._ids:
            self._ids[key] = len(self._states)
            self._states.append(key)
            self._steps.append({})
            ends = [(e, -self._weight(n, e), n) for node, e in key for n in self._ends[node] if e <= self.entries[n].edits]
            stems = [end for end in ends if self.entries[end[2]].stem]
            self._closed.append(self._best(ends))
            self._open.append(self._best(stems))
        return self._ids[key]

    def _weight(self, number: int, edits: int) -> float:
        return self.entries[number].fuzzy_weight if edits else self.entries[number].weight

    @staticmethod
    def _best(ends: list[tuple[int, float, int]]) -> tuple[int, int] | None:
        return (min(ends)[2], min(ends)[0]) if ends else None

    def _step(self, state: int, letter: str) -> int:
        """State after a letter, or -1 if no term can follow."""
        after: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self._budget[node] and edits < after.get(node, 99):
                after[node] = edits

        for node, edits in self._states[state]:
            reach(node, edits + 1)
            for label, child in self._children[node].items():
                reach(child, edits + (label != letter))
        return self._state(after) if after else -1

    def match(self, word: str) -> tuple[int, int] | None:
        """Entry and edits of the closest term, or None."""
        state, best = self._start, None
        for letter in word:
            if letter not in self._letters:
                letter = ""
            steps = self._steps[state]
            if letter in steps:
                state = steps[letter]
            else:
                steps[letter] = state = self._step(state, letter)
            if state < 0:
                return best
            reached = self._open[state]
            if reached and (best is None or reached[1] < best[1]):
                best = reached
        whole = self._closed[state]
        return whole if whole and (best is None or whole[1] < best[1]) else best


# --- evidence ---------------------------------------------------------------------------------

Evidence = tuple[float, float, float]


class Reader:
    """Evidence of texts under one lexicon."""

    def __init__(self, entries: tuple[Entry, ...]) -> None:
        self.automaton = LexiconAutomaton(entries)
        self.entries = entries
        self._chunks: dict[str, tuple[tuple[int, int], ...]] = {}

    def _read_chunk(self, chunk: str) -> tuple[tuple[int, int], ...]:
        return tuple(hit for word in _WORD.findall(chunk) if (hit := self.automaton.match(word)))

    def hits(self, text: str) -> tuple[list[str], list[tuple[int, int, int]]]:
        """Chunks of the text, and (position, entry, edits) of every term."""
        chunks = text.lower().split()
        if len(self._chunks) > CACHED_CHUNKS:
            self._chunks.clear()
        known = self._chunks
        for chunk in set(chunks).difference(known):
            known[chunk] = self._read_chunk(chunk)
        return chunks, [(at, *hit) for at, found in enumerate(map(known.__getitem__, chunks)) if found for hit in found]

    def evidence(self, text: str) -> Evidence:
        """Sum of weights in context, the largest sum within a window, and the sum per hundred words."""
        chunks, hits = self.hits(text)
        if not hits:
            return 0.0, 0.0, 0.0
        quoted = self._quoted(chunks, hits)
        valued = []
        for at, number, edits in hits:
            entry = self.entries[number]
            near = {word for chunk in chunks[max(0, at - WINDOW) : at + WINDOW + 1] for word in _WORD.findall(chunk)}
            value = entry.fuzzy_weight if edits else entry.weight
            if at in quoted or near & REPORTING:
                value *= QUOTED
            elif near & ADDRESSING:
                value *= ADDRESSED
            valued.append((at, value))
        best, start, inside = 0.0, 0, 0.0
        for at, value in valued:
            inside += value
            while valued[start][0] < at - WINDOW:
                inside -= valued[start][1]
                start += 1
            best = max(best, inside)
        total = sum(value for _, value in valued)
        return total, best, 100 * total / len(chunks)

    @staticmethod
    def _quoted(chunks: list[str], hits: list[tuple[int, int, int]]) -> set[int]:
        """Positions between an opening and a closing quotation mark within the window."""
        found = set()
        for at, _, _ in hits:
            opens = any(chunks[i][0] in _QUOTES for i in range(max(0, at - WINDOW), at + 1))
            closes = any(chunks[i].rstrip(".,;:!?")[-1:] in _QUOTES for i in range(at, min(len(chunks), at + WINDOW + 1)) if chunks[i].rstrip(".,;:!?"))
            if opens and closes:
                found.add(at)
        return found


# --- learning ---------------------------------------------------------------------------------


def is_held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, store: ParquetStore) -> DataFrame:
    """``toxic, row_text`` of at most TOXIC_ROWS and CLEAN_ROWS labelled documents that are not held out.

    A key with several labels is toxic if one of them says so.  Keys are drawn by hash.
    Of rows of one key the one with the smallest hash of its text is taken.
    """
    marked = labels.filter(col(key).isNotNull() & F.col("toxic").isNotNull() & ~is_held_out(col(key)))
    marked = marked.groupBy(col(key).alias("sample_key")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    drawn = [
        marked.filter(F.col("toxic") == value).orderBy(F.xxhash64("sample_key"), "sample_key").limit(rows)
        for value, rows in ((1, TOXIC_ROWS), (0, CLEAN_ROWS))
    ]
    keys = store.keep("sample-keys", drawn[0].unionByName(drawn[1]).coalesce(1))
    rows = docs.select(col(key).alias("sample_key"), col(text).cast("string").alias("row_text"))
    drawn_rows = rows.join(F.broadcast(keys), "sample_key").select("sample_key", "toxic", F.struct(F.xxhash64("row_text"), "row_text").alias("row"))
    return store.keep("sample", drawn_rows.groupBy("sample_key", "toxic").agg(F.min("row").alias("row")).select("toxic", "row.row_text"))


def count_terms(sample: DataFrame) -> DataFrame:
    """``term, stem, toxic_docs, toxic_uses, clean_uses`` over words and their openings.

    A document uses a term OFTEN times at most.  The empty term counts all words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "row_text", 1 << 20):
                docs: Counter = Counter()
                uses: dict[int, Counter] = {0: Counter(), 1: Counter()}
                for toxic, text in zip(part.column("toxic").to_pylist(), part.column("row_text").to_pylist()):
                    words = Counter(_WORD.findall((text or "").lower()))
                    found: Counter = Counter()
                    for word, n in words.items():
                        if len(word) >= SHORTEST_WORD:
                            found[word, False] += n
                        for k in range(SHORTEST_STEM, min(LONGEST_STEM, len(word)) + 1):
                            found[word[:k], True] += n
                    uses[toxic].update({term: min(n, OFTEN) for term, n in found.items()})
                    uses[toxic]["", False] += sum(words.values())
                    if toxic:
                        docs.update(found.keys())
                terms = list(uses[0].keys() | uses[1].keys())
                counts = ([c[t] for t in terms] for c in (docs, uses[1], uses[0]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([t for t, _ in terms], pa.string()), pa.array([s for _, s in terms], pa.bool_()),
                        *(pa.array(c, pa.int64()) for c in counts),
                    ],
                    ["term", "stem", "toxic_docs", "toxic_uses", "clean_uses"],
                )

    ship(sample.sparkSession)
    rows = sample.mapInArrow(run, "term string, stem boolean, toxic_docs bigint, toxic_uses bigint, clean_uses bigint")
    return rows.groupBy("term", "stem").agg(*[F.sum(c).alias(c) for c in ("toxic_docs", "toxic_uses", "clean_uses")])


def choose_terms(rows: list[tuple[str, bool, int, int]], toxic: int, clean: int) -> list[Entry]:
    """Terms by strength; a term goes if it opens a stronger one or is opened by one.

    Rows are (term, stem, toxic uses, clean uses), and the totals those of all words.  Of terms with
    equal counts the whole word, then the longer stem, is the more telling.
    """
    scored = []
    for term, stem, a, b in rows:
        odds = log((a + 0.5) / (toxic + 1)) - log((b + 0.5) / (clean + 1))
        ratio = _likelihood_ratio(a, b, toxic, clean)
        if ratio >= LEAST_RATIO and odds >= LEAST_ODDS:
            scored.append((-ratio, stem, -len(term), term, odds))
    chosen: dict[str, Entry] = {}
    for _, stem, _, term, odds in sorted(scored):
        if len(chosen) == LEXICON_ENTRIES:
            break
        opened = any(term[:k] in chosen and (chosen[term[:k]].stem or k == len(term)) for k in range(1, len(term) + 1))
        if not opened and not (stem and any(t.startswith(term) for t in chosen)):
            chosen[term] = Entry(term, stem, odds)
    return list(chosen.values())


def _likelihood_ratio(a: int, b: int, toxic: int, clean: int) -> float:
    """Twice the log-likelihood gained by a rate of its own in each class."""
    rate = (a + b) / (toxic + clean)
    return 2 * sum(seen * log(seen / (total * rate)) for seen, total in ((a, toxic), (b, clean)) if seen)


def weigh_misspellings(entries: list[Entry], sample: DataFrame, toxic: int, clean: int) -> tuple[Entry, ...]:
    """Let a misspelling count by how rarely clean texts of the sample hold it."""
    plain = tuple(Entry(e.term, e.stem, e.weight, e.weight) for e in entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(plain)
        for batch in batches:
            for part in slices(batch, "row_text"):
                counts: Counter = Counter()
                for label, text in zip(part.column("toxic").to_pylist(), part.column("row_text").to_pylist()):
                    counts.update({(number, label) for _, number, edits in reader.hits(text or "")[1] if edits})
                keys = list(counts)
                arrays = [pa.array([k[i] for k in keys], pa.int32()) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array([counts[k] for k in keys], pa.int64())], ["number", "toxic", "docs"])

    rows = sample.mapInArrow(run, "number int, toxic int, docs bigint").groupBy("number", "toxic").agg(F.sum("docs").alias("docs"))
    seen = {(row["number"], row["toxic"]): row["docs"] for row in rows.collect()}  # two rows per term at most
    out = []
    for number, entry in enumerate(entries):
        in_clean = seen.get((number, 0), 0) * toxic / max(clean, 1)
        right = (seen.get((number, 1), 0) + 2) / (seen.get((number, 1), 0) + in_clean + 2.2)
        out.append(Entry(entry.term, entry.stem, entry.weight, entry.weight * FUZZY * max(0.0, 2 * right - 1)))
    return tuple(out)


@dataclass(frozen=True)
class Model:
    entries: tuple[Entry, ...]
    coefficients: tuple[float, ...]

    def score(self, evidence: Evidence) -> float:
        """0 to 1; without a lexicon, 0."""
        if not self.entries:
            return 0.0
        bias, *slopes = self.coefficients
        logit = bias + sum(slope * log1p(value) for slope, value in zip(slopes, evidence))
        return 1 / (1 + exp(-max(-30.0, min(30.0, logit))))


def _logistic(features: np.ndarray, labels: np.ndarray, prior_shift: float) -> tuple[float, ...]:
    """Newton steps with a small ridge; ``prior_shift`` moves the drawn share of toxic rows to the true one."""
    x = np.column_stack([np.ones(len(features)), features])
    ridge = np.diag([1e-3] + [0.05] * features.shape[1])
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (labels - p) - ridge @ beta
        beta = beta + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, gradient)
    return float(beta[0] + prior_shift), *(float(b) for b in beta[1:])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """Learn lexicon and model.  Without labelled rows of both kinds the lexicon is empty.

    The sample is bounded by TOXIC_ROWS and CLEAN_ROWS; of its terms over the statistical bars the CANDIDATES strongest are
    looked at and LEXICON_ENTRIES taken at most, which bounds the automaton, not the texts it reads.  Null keys and
    labels take no part, of repeated keys one row does; null texts are empty.
    """
    store = store_for(docs)
    sample = labelled_sample(docs, labels, key, text, store)
    sizes = {row["toxic"]: row["n"] for row in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    nothing = Model((), (0.0,))
    if not toxic or not clean:
        store.discard()
        return nothing
    counted = store.keep("terms", count_terms(sample))
    words = counted.filter("term = ''").first()
    toxic_words, clean_words = words["toxic_uses"], words["clean_uses"]
    ratio = F.col("toxic_uses") / max(toxic_words, 1) / ((F.col("clean_uses") + 0.5) / (clean_words + 1))
    likely = counted.filter((F.col("toxic_docs") >= LEAST_DOCS) & (F.col("term") != "") & (ratio >= exp(LEAST_ODDS) / 2))
    likely = likely.orderBy(F.desc(F.col("toxic_uses") * F.log(ratio)), "term", "stem").limit(CANDIDATES)
    rows = likely.select("term", "stem", "toxic_uses", "clean_uses").collect()
    entries = choose_terms([tuple(row) for row in rows], toxic_words, clean_words)
    if not entries:
        store.discard()
        return nothing
    entries = weigh_misspellings(entries, sample, toxic, clean)
    names = ("total", "window", "density")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(entries)
        for batch in batches:
            for part in slices(batch, "row_text"):
                pairs = [reader.evidence(t or "") for t in part.column("row_text").to_pylist()]
                values = [pa.array([p[i] for p in pairs], pa.float64()) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([part.column("toxic"), *values], ["toxic", *names])

    schema = "toxic int, " + ", ".join(f"{name} double" for name in names)
    found = sample.mapInArrow(run, schema).orderBy("toxic", *names).toPandas()  # as bounded as the sample
    labelled = labels.filter(~is_held_out(col(key)) & F.col("toxic").isNotNull())
    share = labelled.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    share = min(max(share, 1e-4), 1 - 1e-4)
    shift = log(share / (1 - share)) - log(toxic / clean)
    store.discard()
    return Model(entries, _logistic(np.log1p(found[list(names)].to_numpy()), found["toxic"].to_numpy(), shift))


# --- scoring ----------------------------------------------------------------------------------

_READERS: dict[tuple[Entry, ...], Reader] = {}
keeps_cache("toxicity", _READERS.clear)


def _reader(entries: tuple[Entry, ...]) -> Reader:
    if entries not in _READERS:
        _READERS.clear()
        _READERS[entries] = Reader(entries)
    return _READERS[entries]


def score(docs: DataFrame, model: Model, text: str = "text", output: str = "toxicity") -> DataFrame:
    """Add ``output``, 0 to 1.

    Null and empty texts have no evidence and get the score of that; a text of any length is read whole.  Nothing but the text is looked at;
    rows and other columns stay as they are, and a column that has the name ``output`` is replaced.
    """
    ship(docs.sparkSession)
    kept = [name for name in docs.columns if name.lower() != output.lower()]
    work = free_name("text_to_score", docs.columns)
    schema = docs.select(*[col(name) for name in kept]).schema.add(output, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_cache("toxicity")
        reader = _reader(model.entries)
        for batch in batches:
            for part in slices(batch, work):
                scores = [model.score(reader.evidence(t or "")) for t in part.column(work).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(name) for name in kept), pa.array(scores, pa.float64())], [*kept, output])

    return docs.select(*[col(name) for name in kept], col(text).cast("string").alias(work)).mapInArrow(run, schema)
