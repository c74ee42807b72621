"""Toxicity: a lexicon trie searched by Levenshtein automata, with scores from the context of each hit.

The lexicon is learned: words that labelled toxic documents use far more often than others. Each word of
a text is run through the automaton that accepts every string within the allowed edit distance of some
term, i.e. the Levenshtein automaton intersected with the trie. It is built state by state as words need
it and kept, so most words die after two or three steps. Hits in quotation marks or after a word of
reporting count as quotation; the window around a hit gives its company. A logistic regression over
these counts gives the score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from residua.llm import labelled
from residua.session import bound_arrow_batches

FOLDS, KEPT_BACK, THRESHOLD = 3, 1, 0.7
#: Terms of the lexicon at most, and what a word needs to become one.
MAX_TERMS, MIN_DOCS, MIN_RATIO, MIN_LETTERS = 500, 3, 30.0, 3
#: Documents are near copies if their sets of words have at least this Jaccard similarity.
NEAR_COPY = 0.8
#: Terms of at least so many letters are also found with one edit.
FUZZY_LETTERS = 5
#: Words on either side of a hit that make its context.
WINDOW = 8
#: What is left of a hit's weight inside quotation marks or after a word of reporting.
QUOTED_SHARE = 0.3
OPENING, CLOSING = "\"'“„«‘‹", "\"'”“»’›"
REPORTING = frozenset("said says wrote writes called calls quote quoted reported dit écrit sagte schrieb dijo escribió".split())
#: A word: letters and digits, with single marks that stand in for letters inside it.
WORD = re.compile(r"[^\W_]+(?:[*@$][^\W_]+)*")
#: Characters whose words are held at a time, about.
SLICE = 1 << 20
#: Words whose result is kept by a worker, at most.
KEPT = 200_000
_BLANK = re.compile(r"\s")


class LexiconAutomaton:
    """Finds the term nearest to a word, within the term's allowed edits."""

    def __init__(self, terms: list[str]):
        self.terms = sorted(set(terms))
        self.child: list[dict[str, int]] = [{}]
        self.end: list[int] = [-1]
        for k, term in enumerate(self.terms):
            node = 0
            for letter in term:
                if letter not in self.child[node]:
                    self.child[node][letter] = len(self.child)
                    self.child.append({})
                    self.end.append(-1)
                node = self.child[node][letter]
            self.end[node] = k
        self.long = [False] * len(self.child)  # whether a term that allows an edit passes through the node
        for term in self.terms:
            if len(term) >= FUZZY_LETTERS:
                node = 0
                self.long[0] = True
                for letter in term:
                    node = self.child[node][letter]
                    self.long[node] = True
        self.ids: dict[frozenset[tuple[int, int]], int] = {}
        self.states: list[frozenset[tuple[int, int]]] = []
        self.step: list[dict[str, int]] = []
        self.accept: list[tuple[int, int] | None] = []
        self.start = self._state(frozenset([(0, 0)]))

    def _state(self, positions: frozenset[tuple[int, int]]) -> int:
        if not positions:
            return -1
        if positions not in self.ids:
            self.ids[positions] = len(self.states)
            self.states.append(positions)
            self.step.append({})
            self.accept.append(self._accepting(positions))
        return self.ids[positions]

    def _accepting(self, positions: frozenset[tuple[int, int]]) -> tuple[int, int] | None:
        found = []
        for node, edits in positions:
            term = self.end[node]
            if term >= 0 and (edits == 0 or len(self.terms[term]) >= FUZZY_LETTERS):
                found.append((edits, term))
            if edits == 0:  # the term's last letter is missing
                for child in self.child[node].values():
                    term = self.end[child]
                    if term >= 0 and len(self.terms[term]) >= FUZZY_LETTERS:
                        found.append((1, term))
        return min(found, default=None)

    def _move(self, state: int, letter: str) -> int:
        after = set()
        for node, edits in self.states[state]:
            if (child := self.child[node].get(letter)) is not None:
                after.add((child, edits))
            if edits == 0 and self.long[node]:
                after.add((node, 1))  # a letter too many
                for child in self.child[node].values():
                    if self.long[child]:
                        after.add((child, 1))  # another letter
                        if (skip := self.child[child].get(letter)) is not None:
                            after.add((skip, 1))  # a letter is missing
        return self._state(frozenset(x for x in after if x[1] == 0 or self.long[x[0]]))

    def find(self, word: str) -> tuple[int, int] | None:
        """(edits, term number) of the nearest term, or None."""
        state = self.start
        for letter in word:
            step = self.step[state]
            state = step[letter] if letter in step else step.setdefault(letter, self._move(state, letter))
            if state < 0:
                return None
        return self.accept[state]


@dataclass
class Model:
    """The lexicon, words near a term that clean documents use, and the weights of the hit counts.

    The automaton is built where it is used.
    """

    terms: list[str]
    weight: np.ndarray
    innocent: frozenset[str] = frozenset()
    _automaton: LexiconAutomaton | None = None
    _known: dict[str, tuple[int, int] | None] | None = None

    def __getstate__(self) -> dict:
        return {"terms": self.terms, "weight": self.weight, "innocent": self.innocent, "_automaton": None, "_known": None}

    def hits(self, text: str) -> tuple[int, list[tuple[int, int, bool]]]:
        """The number of words, and per hit its word's number, its edits, and whether it is quoted."""
        if self._automaton is None:
            self._automaton, self._known = LexiconAutomaton(self.terms), {}
        find, known = self._automaton.find, self._known
        low, n, out = text.lower(), 0, []
        last: list[str] = []  # the words before a slice that its first words may follow
        for start, stop in slices(low):
            words = WORD.findall(low, start, stop)
            if len(known) > KEPT:
                known.clear()
            found = set()
            for word in set(words):
                if word not in known:
                    hit = find(word)
                    known[word] = None if hit and hit[0] and word in self.innocent else hit
                if known[word] is not None:
                    found.add(word)
            if found:
                led = last + words
                for k, m in enumerate(WORD.finditer(low, start, stop)):
                    if m.group() in found:
                        before, after = low[max(0, m.start() - 60) : m.start()], low[m.end() : m.end() + 60]
                        j = k + len(last)
                        quoted = _inside_quotes(before, after) or bool(REPORTING & set(led[max(0, j - WINDOW) : j]))
                        out.append((n + k, known[m.group()][0], quoted))
            n += len(words)
            last = (last + words[-WINDOW:])[-WINDOW:]
        return n, out

    def features(self, text: str | None) -> np.ndarray:
        """Exact and near hits outside and inside quotation, hits in company, and hits among all words."""
        n, found = self.hits(text or "")
        if not found:
            return _NOTHING
        count = np.zeros(4)
        company = 0
        for j, (k, edits, quoted) in enumerate(found):
            count[2 * (edits > 0) + quoted] += 1
            company += j > 0 and k - found[j - 1][0] <= WINDOW
        exact, exact_quoted, near, near_quoted = count
        return np.array(
            [
                math.log1p(exact + QUOTED_SHARE * exact_quoted),
                math.log1p(near + QUOTED_SHARE * near_quoted),
                math.log1p(company),
                100 * (exact + near) / (n + 100),
                1.0,
            ]
        )

    def score(self, text: str | None) -> float:
        z = float(self.features(text) @ self.weight)
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


_NOTHING = np.array([0.0, 0.0, 0.0, 0.0, 1.0])


def slices(text: str) -> Iterator[tuple[int, int]]:
    """Parts of about SLICE characters that end at white space, so that no word spans two."""
    at = 0
    while at < len(text):
        stop = at + SLICE
        if stop < len(text):
            blank = max(text.rfind(" ", at, stop), text.rfind("\n", at, stop))
            if blank < 0:
                m = _BLANK.search(text, stop)
                blank = m.start() if m else len(text)
            stop = blank + 1
        yield at, min(stop, len(text))
        at = stop


def _inside_quotes(before: str, after: str) -> bool:
    """Whether a mark of quotation opens within reach before and closes within reach after."""
    opened = max((before.rfind(q) for q in OPENING), default=-1)
    if opened < 0 or before[opened - 1 : opened].isalnum() or not any(q in after for q in CLOSING):
        return False
    return not any(q in before[opened + 1 :] for q in "”»›")


def near_copies(sets: list[frozenset[str]], least: float = NEAR_COPY) -> list[list[frozenset[str]]]:
    """Group sets by the first member of a group, to which all others have a Jaccard similarity of at least `least`.

    Exact: two sets so alike share one of their rarest words, as the rest of a set is too small to hold all
    that they must have in common.
    """
    held = Counter(w for words in sets for w in words)
    groups: list[list[frozenset[str]]] = []
    firsts: dict[str, list[int]] = {}
    for words in sets:
        rarest = sorted(words, key=lambda w: (held[w], w))[: len(words) - math.ceil(least * len(words)) + 1]
        for k in sorted({k for w in rarest for k in firsts.get(w, ())}):
            first = groups[k][0]
            if len(first & words) >= least * len(first | words):
                groups[k].append(words)
                break
        else:
            for w in rarest:
                firsts.setdefault(w, []).append(len(groups))
            groups.append([words])
    return groups


def learn_lexicon(rows: list[tuple[str, int]]) -> list[str]:
    """Words that toxic documents use far more often, by smoothed ratio of document counts.

    Near copies count once, with all their words, so they can't make a lexicon.
    """
    sets: tuple[list, list] = ([], [])
    for text, label in rows:
        if words := frozenset(w for w in WORD.findall(text.lower()) if len(w) >= MIN_LETTERS):
            sets[label].append(words)
    groups = [near_copies(x) for x in sets]
    counts = []
    for label in (1, 0):
        count: Counter[str] = Counter()
        for same in groups[label]:
            count.update(frozenset().union(*same))
        counts.append(count)
    keep = {w for w, n in counts[0].items() if n >= MIN_DOCS}
    toxic, other = len(groups[1]), len(groups[0])
    scored = []
    for w in keep:
        ratio = (counts[0][w] + 0.5) / (toxic + 1) / ((counts[1][w] + 0.5) / (other + 1))
        if ratio >= MIN_RATIO:
            scored.append((-counts[0][w] * math.log(ratio), w))
    return [w for _, w in sorted(scored)[:MAX_TERMS]]


def near_words(model: Model, rows: list[tuple[str, int]]) -> frozenset[str]:
    """Words of documents labelled clean that are near a term without being one."""
    automaton = LexiconAutomaton(model.terms)
    words = set().union(*(WORD.findall(text.lower()) for text, label in rows if label == 0))
    return frozenset(w for w in words if (hit := automaton.find(w)) and hit[0])


def train(rows: list[tuple[str, int]], steps: int = 300) -> Model:
    """Learn the lexicon, then the weights by Newton's method with a ridge towards fixed prior weights.

    The priors say that hits are bad and near hits less so, and stand where labels say nothing. Words
    near a term that one half of the clean documents uses are innocent while the weights are learned
    from the other half, so the weight of near hits is learned on words not seen before.
    """
    prior = np.array([3.0, 2.0, 0.5, 0.2, -4.0])
    terms = learn_lexicon(rows) if 0 < sum(y for _, y in rows) < len(rows) else []
    model = Model(terms, prior)
    if not terms:
        return model
    model.innocent = near_words(model, rows[::2])
    half = rows[1::2]
    x = np.array([model.features(t) for t, _ in half]).reshape(-1, len(prior))
    y = np.array([label for _, label in half], dtype=float)
    w = prior.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + (w - prior)
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        move = np.linalg.solve(hess, grad)
        w -= move / max(1.0, np.abs(move).max())
        if np.abs(move).max() < 1e-9:
            break
    return Model(terms, w, near_words(model, rows))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Score every row of docs (doc_id, text): doc_id, held_out, score, predicted.

    The model is fitted on a bounded sample of labels.toxic outside the fold that is kept back; see
    labelled.sample. Null and empty texts have no hit and get the base score; texts of any length are read
    whole, their words a slice at a time; without labels the lexicon is empty and so is every hit list; a
    null doc_id is not held out; repeated rows are scored alike, and a score that ties with the threshold
    counts as 1; an empty table gives no rows; other columns are ignored.
    """
    bound_arrow_batches(docs.sparkSession)
    model = train(labelled.sample(docs, labels, "toxic", FOLDS, KEPT_BACK))

    @arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(x) for x in texts.to_pylist()], pa.float64())

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), run(F.col("text").cast("string")).alias("score"))
    return scored.select(
        "doc_id",
        labelled.held_out(F.col("doc_id"), FOLDS, KEPT_BACK).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
