"""Toxicity by a learned lexicon, Levenshtein automata over its trie, and context windows.

The lexicon holds whole words and stems that labelled toxic documents have and others lack.
Deterministic automata, made lazily, are the intersection of the trie, read from either end,
with the Levenshtein automaton of each word: a pass over a word in each direction finds the
terms within the allowed number of edits. Hits are counted by kind and by their surroundings, quotation or address, and a
logistic model turns the counts into a score.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resultlake.llm import batches as B
from resultlake.llm import words as W
from resultlake.llm.batches import rows_key, rows_schema
from resultlake.llm.scratch import stored

#: Labelled rows that a model is fitted on, at most: a seeded choice of the training rows.
MAX_TRAIN = 20_000
#: Characters of the beginnings that may become stems; whole words become terms at any length.
SHORTEST, STEM_POINTS = 3, 24
#: States of each automaton, and words with what they match, that a task keeps; beyond, each starts anew.
MOST_STATES, MOST_WORDS = 100_000, 1 << 17
#: Log ratio of the shares of toxic and other documents that have a term; documents with it.
LOG_RATIO, SUPPORT = 3.0, 4
#: Bytes before and after a hit that its context window holds.
WINDOW = 60
#: What ends a whole word.
END = "\0"

#: Marks of quotation, words that speak about words, and words of address.
QUOTES = re.compile('["“”„«»‘’`]|(?<!\\w)\'|\'(?!\\w)')
ABOUT = re.compile(r"\b(word|words|term|terms|called|quote|quoted|quotes|says|said|saying|wrote|writes|phrase|mot|mots|wort|wörter|palabra|palabras|zitat|cita|citation)\b", re.I)
ADDRESS = re.compile(r"\b(you|your|you're|youre|ur|u|du|dein|deine|ihr|tu|ton|ta|vous|votre|eres|usted|ustedes)\b", re.I)

EXACT, STEM, ONE_EDIT, TWO_EDITS = 1, 2, 3, 4
FEATURES = 11


def allowed_edits(points: int) -> int:
    """Edits that a term of so many characters may be off by."""
    return (points >= 5) + (points >= 8)


class Automaton:
    """The deterministic intersection of a trie with the Levenshtein automata of the words read, made lazily.

    A state is a set of (node, edits). ``caps`` of a term say how many edits each of its
    beginnings, the empty one first, may have used; a node takes the largest of its terms.
    Every term found is within its allowed number of edits.
    """

    def __init__(self, terms: Iterable[tuple[str, int, list[int]]], stems: Iterable[tuple[str, int]] = ()):
        self.children: list[dict[str, int]] = [{}]
        self.word, self.stem, self.caps, self.allowed = [-1], [-1], [0], [0]
        for letters, term, caps in terms:
            path = self._path(letters)
            for node, cap in zip(path, caps):
                self.caps[node] = max(self.caps[node], cap)
            self.word[path[-1]], self.allowed[path[-1]] = term, caps[-1]
        for letters, term in stems:
            self.stem[self._path(letters)[-1]] = term
        #: Children of each node that may have used one edit, or two.
        self.room = [[[], *([c for c in nodes.values() if self.caps[c] >= e] for e in (1, 2)), []] for nodes in self.children]
        self._forget()

    def _path(self, letters: str) -> list[int]:
        path = [0]
        for letter in letters:
            at = self.children[path[-1]]
            if letter not in at:
                at[letter] = len(self.children)
                self.children.append({})
                for values, value in ((self.word, -1), (self.stem, -1), (self.caps, 0), (self.allowed, 0)):
                    values.append(value)
            path.append(at[letter])
        return path

    def _forget(self) -> None:
        self.states: dict[tuple, int] = {}
        self.sets: list[tuple] = []
        self.stems: list[int] = []
        self.moves: list[dict[str, int]] = []
        self.ends: list[tuple[int, int] | None] = []
        self.start = self._state({0: 0}, -1)

    def _state(self, fewest: dict[int, int], stem: int) -> int:
        """The state of nodes with their fewest edits; those by letters of terms that the word lacks are added."""
        todo = list(fewest)
        for node in todo:  # grows as nodes are added or reached with fewer edits
            e = fewest[node] + 1
            for child in self.room[node][e]:
                if fewest.get(child, 99) > e:
                    fewest[child] = e
                    todo.append(child)
        pairs = tuple(sorted(fewest.items()))
        key = (pairs, stem)
        known = self.states.get(key)
        if known is not None:
            return known
        self.states[key] = len(self.sets)
        self.sets.append(pairs)
        self.stems.append(stem)
        self.moves.append({})
        best = None
        for node, e in pairs:
            if self.word[node] >= 0 and e <= self.allowed[node]:
                hit = ((EXACT, ONE_EDIT, TWO_EDITS)[e], self.word[node])
                best = min(best, hit) if best else hit
        if stem >= 0 and not (best and best[0] == EXACT):
            best = (STEM, stem)
        self.ends.append(best)
        return len(self.sets) - 1

    def _move(self, state: int, letter: str) -> int:
        """The next state; -1 if no term can follow."""
        found: dict[int, int] = {}
        stem = self.stems[state]
        for node, e in self.sets[state]:
            child = self.children[node].get(letter)
            if child is not None and found.get(child, 99) > e:
                found[child] = e
                if e == 0 and self.stem[child] >= 0:
                    stem = self.stem[child]
            e += 1
            if e <= self.caps[node] and found.get(node, 99) > e:
                found[node] = e
            for child in self.room[node][e]:
                if found.get(child, 99) > e:
                    found[child] = e
        out = -1 if not found and stem < 0 else self._state(found, stem)
        self.moves[state][letter] = out
        return out

    def match(self, word: str) -> tuple[int, int] | None:
        """(kind, term) of the nearest term, else None."""
        if len(self.sets) > MOST_STATES:
            self._forget()
        state, moves = self.start, self.moves
        for letter in word:
            after = moves[state].get(letter)
            state = self._move(state, letter) if after is None else after
            if state < 0:
                return None
        return self.ends[state]


class Lexicon:
    """Whole words, which end with ``END``, and stems, found through two automata. Letters are code points.

    Of a term's edits not all are in its first half, or its second half has none. The
    automaton over the terms serves the first case: a first half has one edit less than
    allowed. That over the reversed terms serves the other: there the second half comes
    first and must be exact. Neither has to follow every beginning with all the edits.
    """

    def __init__(self, terms: list[str]):
        words = [(t[: -len(END)], i, allowed_edits(len(t) - len(END))) for i, t in enumerate(terms) if t.endswith(END)]
        stems = [(t, i) for i, t in enumerate(terms) if not t.endswith(END)]
        self.forward = Automaton(((t, i, [max(0, e - (k <= len(t) // 2 < len(t))) for k in range(len(t) + 1)]) for t, i, e in words), stems)
        self.backward = Automaton((t[::-1], i, [e * (k >= len(t) - len(t) // 2) for k in range(len(t) + 1)]) for t, i, e in words if e)
        self.known: dict[bytes, tuple[int, int] | None] = {}

    def match(self, word: str) -> tuple[int, int] | None:
        """(kind, term) of the nearest term, else None."""
        ahead = self.forward.match(word)
        if ahead and ahead[0] in (EXACT, STEM):
            return ahead
        back = self.backward.match(word[::-1])
        return min(ahead, back) if ahead and back else ahead or back

    def features(self, column: pa.Array) -> np.ndarray:
        """The counts of each text that the score is made of."""
        raw, offsets = B.buffer(column)
        data = W.LOWER[raw]
        starts, ends, counts = W.spans(data, offsets, W.ALNUM)
        out = np.zeros((len(counts), FEATURES))
        out[:, 0] = 1
        if not len(starts):
            return out
        own, first, which = np.unique(W.hashes(data, starts, ends), return_index=True, return_inverse=True)
        held = data.tobytes()
        kinds = np.zeros(len(own), np.int8)
        terms = np.zeros(len(own), np.int32)
        for i, (s, e) in enumerate(zip(starts[first].tolist(), ends[first].tolist())):
            raw_word = held[s:e]
            if raw_word in self.known:
                hit = self.known[raw_word]
            else:
                hit = self.match(_word(raw_word))
                if len(self.known) >= MOST_WORDS:
                    self.known = {}
                if len(raw_word) <= 64:
                    self.known[raw_word] = hit
            if hit:
                kinds[i], terms[i] = hit
        hits = np.flatnonzero(kinds[which])
        doc = np.repeat(np.arange(len(counts)), counts)[hits]
        by = defaultdict(list)
        for h, d in zip(hits.tolist(), doc.tolist()):
            by[d].append(h)
        text = raw.tobytes()
        for d, own_hits in by.items():
            plain, quoted, address, seen = np.zeros(5), np.zeros(5), 0, set()
            for h in own_hits:
                kind = kinds[which[h]]
                lo, hi = max(offsets[d], starts[h] - WINDOW), min(offsets[d + 1], ends[h] + WINDOW)
                before = text[lo : starts[h]].decode("utf-8", "ignore")
                after = text[ends[h] : hi].decode("utf-8", "ignore")
                inside = len(QUOTES.findall(before)) % 2 == 1 and QUOTES.search(after) is not None
                (quoted if inside or ABOUT.search(before) else plain)[kind] += 1
                address += ADDRESS.search(before) is not None or ADDRESS.search(after) is not None
                if kind in (EXACT, STEM):
                    seen.add(int(terms[which[h]]))
            out[d, 1:5] = np.log1p(plain[1:])
            out[d, 5:7] = np.log1p([quoted[EXACT] + quoted[STEM], quoted[ONE_EDIT] + quoted[TWO_EDITS]])
            out[d, 7] = np.log1p(address)
            out[d, 8] = np.log1p(len(seen))
            out[d, 9] = np.log1p(100 * (plain[EXACT] + plain[STEM]) / counts[d])
            out[d, 10] = float(plain[EXACT] + plain[STEM] > 0)
        return out


def _word(raw: bytes) -> str:
    """A word as its lower-case letters."""
    return raw.decode("utf-8", "replace").lower()


def _beginnings(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class that have a word, marked at its end, or a beginning of one."""
    counts = (Counter(), Counter())
    for b in B.pieces(it, "text"):
        raw, offsets = B.buffer(b.column("text"))
        data = W.LOWER[raw]
        starts, ends, n = W.spans(data, offsets, W.ALNUM)
        held = data.tobytes()
        at = np.concatenate([[0], np.cumsum(n)])
        for i, toxic in enumerate(b.column("toxic").to_pylist()):
            seen = {_word(held[s:e]) for s, e in zip(starts[at[i] : at[i + 1]].tolist(), ends[at[i] : at[i + 1]].tolist())}
            counts[bool(toxic)].update({w[:k] for w in seen for k in range(SHORTEST, min(len(w), STEM_POINTS) + 1)} | {w + END for w in seen if len(w) + 1 >= SHORTEST})
            if len(counts[0]) + len(counts[1]) > 400_000:
                yield from _counted(counts)
                counts = (Counter(), Counter())
    yield from _counted(counts)


def _counted(counts: tuple[Counter, Counter]) -> Iterator[pa.RecordBatch]:
    for toxic in (0, 1):
        if counts[toxic]:
            n = np.fromiter(counts[toxic].values(), np.int64)
            zero = np.zeros(len(n), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(list(counts[toxic]), pa.string()), pa.array(n if toxic else zero), pa.array(zero if toxic else n)], ["term", "toxic", "clean"])


def learn_terms(train: DataFrame) -> list[str]:
    """Terms from ``train`` (text, toxic): each the longest beginning that its documents share.

    The driver sees terms that ``SUPPORT`` toxic documents of the training rows have and
    hardly another has; their number is bounded by that of the training rows alone.
    """
    n1, n0 = train.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum(1 - F.col("toxic")), F.lit(0))).first()
    counts = train.select("text", "toxic").mapInArrow(_beginnings, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    ratio = F.log((F.col("toxic") + 0.5) / (n1 + 1.0)) - F.log((F.col("clean") + 0.5) / (n0 + 1.0))
    pure = counts.filter((F.col("toxic") >= SUPPORT) & (ratio >= LOG_RATIO))
    support = {r["term"]: r["toxic"] for r in pure.collect()}
    longer = defaultdict(list)
    for t in support:
        longer[t[:-1]].append(t)
    out = set()
    for t in support:
        if t[:-1] in support:
            continue
        todo = [t]
        while todo:
            now = todo.pop()
            same = [x for x in longer[now] if support[x] >= 0.95 * support[now]]
            if same:
                todo.append(max(same, key=lambda x: (support[x], x)))
            else:
                out.add(now)
    return sorted(out, key=lambda t: (-support[t], t))


def fit(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weights of a logistic model by Newton's method; each row counts ``n`` times."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * (p * (1 - p) + 1e-9))[:, None]).T @ x + np.diag(penalty), x.T @ (n * (y - p)) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return w


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text is divisible by 5; so is that of a null id."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def toxicity(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``.

    ``labels`` (doc_id, toxic) are used only where the id is not held out and toxic is 0 or
    1; a doc_id labelled twice is toxic if one label is. At most ``max_train`` labelled texts,
    chosen by a hash of the id, are fitted on; rows with one id and text are one of them. Null and empty texts get the score of a text
    without hits. Without any labelled text of both classes every score is the share of
    toxic labels, or 0. Rows with equal texts have equal scores. ``row_col``,
    a key of the rows, is returned as the last column. Other columns are ignored.
    """
    B.small_batches(docs.sparkSession)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *rows_key(row_col))
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).filter(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("toxic").cast("long").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(max_train)
    mine = base.join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("id", "toxic", "text", F.xxhash64("text").alias("h"))  # max_train pairs of numbers
    taken = mine.select("id", "h").distinct().orderBy(F.xxhash64("id"), "id", "h").limit(max_train)  # ids may have many texts
    train = stored(mine.join(F.broadcast(taken), ["id", "h"]).dropDuplicates(["id", "h"]).select("text", "toxic"), "training")
    terms = learn_terms(train)

    def learn(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(terms)  # of this task alone: kept by the worker it would take memory from later stages
        for b in B.pieces(it, "text"):
            x = lexicon.features(b.column("text"))
            yield pa.RecordBatch.from_arrays([B.lists(x.ravel(), np.full(len(x), FEATURES), pa.float64()), b.column("toxic")], ["x", "toxic"])

    seen = train.mapInArrow(learn, "x array<double>, toxic long").groupBy("x", "toxic").count().collect()  # at most max_train rows
    rows = sorted((tuple(r["x"]), r["toxic"], r["count"]) for r in seen)
    x = np.array([v for v, _, _ in rows]).reshape(-1, FEATURES)
    y, n = np.array([t for _, t, _ in rows], float), np.array([n for _, _, n in rows], float)
    if len(set(y.tolist())) == 2:
        weights = fit(x, y, n)
    else:
        share = float((y * n).sum() / n.sum()) if len(y) else 0.0
        weights = np.zeros(FEATURES)
        weights[0] = np.log((share + 1e-9) / (1 - share + 1e-9))

    def score(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(terms)  # of this task alone: kept by the worker it would take memory from later stages
        for b in B.pieces(it, "text"):
            s = 1 / (1 + np.exp(-np.clip(lexicon.features(b.column("text")) @ weights, -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s), *(b.column(c) for c in own)], ["doc_id", "score", *own])

    own = [row_col] if row_col else []
    scored = base.mapInArrow(score, "doc_id long, score double" + rows_schema(row_col))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), *own)
