"""A weighted backoff automaton in arrays: states, arcs, failure arcs and one traversal."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Streams are read in this many lanes side by side; each lane carries its own state.
LANES = 4096


@dataclass
class Automaton:
    """States are numbers, 0 the empty history.  All weights are log10.

    ``arc_key`` holds ``state * words + word`` in ascending order, with the
    arc's weight and target beside it.  ``fail_to`` and ``fail_log`` are each
    state's failure arc; state 0 has none and gives an unknown word ``unknown_log``.
    """

    words: int
    arc_key: np.ndarray
    arc_log: np.ndarray
    arc_to: np.ndarray
    fail_to: np.ndarray
    fail_log: np.ndarray
    unknown_log: float

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Reads one word in every lane: the next states and the weights gained."""
        after, gained = np.zeros_like(state), np.zeros(len(state))
        lane, at = np.arange(len(state)), state
        while len(lane):
            key = at * np.int64(self.words) + word[lane]
            place = np.searchsorted(self.arc_key, key)
            np.minimum(place, len(self.arc_key) - 1, out=place)
            hit = self.arc_key[place] == key
            after[lane[hit]] = self.arc_to[place[hit]]
            gained[lane[hit]] += self.arc_log[place[hit]]
            stuck = ~hit & (at == 0)
            gained[lane[stuck]] += self.unknown_log
            fails = ~hit & (at != 0)
            lane, at = lane[fails], at[fails]
            gained[lane] += self.fail_log[at]
            at = self.fail_to[at]
        return after, gained

    def traverse(self, word: np.ndarray, begins: np.ndarray, begin_state: int, memory: int) -> np.ndarray:
        """Weight gained at each word of a stream read left to right; a word where ``begins`` holds
        opens a text: it sets the state and gains nothing.

        The stream is cut into lanes of equal length.  A state depends on the
        last ``memory`` words, so a lane reads that many before its own first.
        """
        gained = np.zeros(len(word))
        length = -(-len(word) // LANES) if len(word) else 0
        first = np.arange(0, len(word), max(length, 1))
        state = np.zeros(len(first), np.int32)
        for t in range(-memory, length):
            lane = np.flatnonzero((first + t >= 0) & (first + t < len(word)))
            at = first[lane] + t
            after, weight = self.step(state[lane], word[at])
            opens = begins[at]
            after[opens] = begin_state
            state[lane] = after
            if t >= 0:
                gained[at] = np.where(opens, 0.0, weight)
        return gained


def build(place: list[np.ndarray], valid: list[np.ndarray], counts: list[np.ndarray], tokens: int, vocabulary: int,
          discount: float, strength: float, growth: float) -> tuple[Automaton, np.ndarray]:
    """The automaton of the n-grams that a stream holds and training texts know, and the states of its words.

    ``place[n][i]`` numbers the n-gram of ``n + 1`` words ending at position i
    among the distinct ones, ``valid[n][i]`` says whether one ends there and
    ``counts[n]`` has the distinct ones' training counts.  Weights are those
    that ``lmscore.score_texts`` documents.
    """
    order = len(place)
    words = len(counts[0])
    known = [np.flatnonzero(c > 0).astype(np.int32) for c in counts]
    ends = []  # a position where each known n-gram ends
    for n in range(order):
        at = np.flatnonzero(valid[n]).astype(np.int32)
        last = np.full(len(counts[n]), -1, np.int32)
        last[place[n][at]] = at
        known[n] = known[n][last[known[n]] >= 0]
        ends.append(last[known[n]])
    # states: the known n-grams of fewer than ``order`` words, shorter ones first
    state_of, states = [], 1
    for n in range(order - 1):
        number = np.zeros(len(counts[n]), np.int32)
        number[known[n]] = np.arange(states, states + len(known[n]))
        states += len(known[n])
        state_of.append(number)
    fail_to, fail_weight = np.zeros(states, np.int32), np.ones(states)
    for n in range(order - 1):
        own = state_of[n][known[n]]
        seen = counts[n][known[n]].astype(float)
        pseudo = strength * seen**growth
        fail_weight[own] = pseudo / (seen + pseudo)
        if n:
            fail_to[own] = state_of[n - 1][place[n - 1][ends[n]]]
    arcs = sum(map(len, known))
    arc_key, arc_log, arc_to = np.empty(arcs, np.int64), np.empty(arcs), np.zeros(arcs, np.int32)
    weight, low = None, 0  # ``weight``: of each known n-gram one word shorter, by its number
    for n in range(order):
        own = counts[n][known[n]]
        if n:
            history = place[n - 1][ends[n] - 1]
            source = state_of[n - 1][history]
            fails = fail_weight[source]
            own = own / counts[n - 1][history] * (1 - fails) + fails * weight[place[n - 1][ends[n]]]
        else:
            source = np.zeros(len(own), np.int32)
            own = (own - discount) / tokens
        key = source * np.int64(words) + place[0][ends[n]]
        rank = np.argsort(key)
        here = slice(low, low + len(own))  # arcs of longer histories have larger keys
        arc_key[here], arc_log[here] = key[rank], np.log10(own[rank])
        if n < order - 1:
            arc_to[here] = state_of[n][known[n][rank]]
            weight = np.zeros(len(counts[n]))
            weight[known[n]] = own
        elif n:
            arc_to[here] = state_of[n - 1][place[n - 1][ends[n][rank]]]
        low = here.stop
        del key, rank, own, source
    machine = Automaton(words, arc_key, arc_log, arc_to, fail_to, np.log10(fail_weight),
                        float(np.log10(discount * vocabulary / tokens)))
    return machine, state_of[0] if order > 1 else np.zeros(words, np.int32)
