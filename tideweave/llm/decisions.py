"""Which token comes next, as binary decisions coded by logistic context mixing.

At each place up to three questions are asked, from the longest context to none: was the token taught
after the last two tokens; if not, after the last one; if not, at all. A yes gives it its share of
what the context was followed by; three noes leave it to spelling. So all that may follow a context
shares probability 1 at most.

Each question is a bit with CONTEXTS predictors: counters of zeros and ones looked up by a context
(the last eight outcomes; the last two levels and how often the last tokens were seen; the last three
levels; how often the last three tokens were seen and the length of the run of yeses). Their log-odds
are mixed with weights chosen by a gate, and refined by an adaptive table of the rates observed at
each even mixture of them.

Counters, weights and rates are learned from all places of training texts, each seen as if it had
not been counted once (``less``), so tokens and pairs seen once teach what new ones need. Weights are
fitted by one Newton step from equal ones over all places (a second gains less than 0.001 bits a token)
rather than in one stream, so that scores don't depend on how the texts are dealt to tasks.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

#: Steps of how often a context was seen.
STEPS = np.array([1, 2, 3, 5, 9, 17, 65, 257, 4097])
Q = len(STEPS) + 1
_STEP_OF = np.searchsorted(STEPS, np.arange(STEPS[-1] + 1), side="right").astype(np.int32)
#: Number of values of each predictor's context.
SIZES = (256, 16 * Q * Q, 64 * Q, 32 * Q)
CONTEXTS, DECISIONS = len(SIZES), 3
STARTS = np.concatenate(([0], np.cumsum(SIZES)))
SLOTS = int(STARTS[-1])
INPUTS = CONTEXTS + 1
PRIOR, BIAS, RIDGE = 0.4, 0.3, 1.0
RATES, LIMIT, RATE_PRIOR = 33, 8.0, 8.0
CENTRES = 1 / (1 + np.exp(-np.linspace(-LIMIT, LIMIT, RATES)))


def before(c1: np.ndarray, c2: np.ndarray, place: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """How often the last token and the last two were seen; the start of a text precedes each."""
    one, two = np.full_like(c1, texts), np.full_like(c2, texts)
    one[1:], two[1:] = c1[:-1], c2[:-1]
    one[place == 0], two[place == 0] = texts, texts
    return one, two


def steps_of(n: np.ndarray) -> np.ndarray:
    return _STEP_OF[np.minimum(n, STEPS[-1])]


@dataclass
class Question:
    """One decision at the places ``at`` where it is asked."""

    at: np.ndarray
    yes: np.ndarray
    slots: list[np.ndarray]  # by predictor
    gate: np.ndarray
    less: np.ndarray

    def taught(self) -> Question:
        """At training places only."""
        if self.less.all():
            return self
        keep = np.flatnonzero(self.less)
        return Question(self.at[keep], self.yes[keep], [s[keep] for s in self.slots], self.gate[keep], self.less[keep])

    def variant(self) -> np.ndarray:
        """Which of the three tables of log-odds holds."""
        return (self.less * (2 - self.yes)).astype(np.int32)


class Places:
    """The places of some texts: counts of the token and of the pair and triple that end there, and what is asked.

    ``less`` marks the places seen as if their own occurrence had not been counted.
    """

    def __init__(self, c1: np.ndarray, c2: np.ndarray, c3: np.ndarray, place: np.ndarray, texts: int, total: int, less: np.ndarray):
        less = less.astype(np.int64)
        one, two = before(c1, c2, place, texts)
        self.less, self.counts = less, (c3 - less, c2 - less, c1 - less)
        self.of = one, two, total = np.maximum(two - less, 0), np.maximum(one - less, 0), total - less
        self.yes = yes = [(n > 0) & (of > 0) for n, of in zip(self.counts, self.of, strict=True)]
        level = np.where(yes[0], 3, np.where(yes[1], 2, yes[2])).astype(np.int32)
        self.new = level == 0
        at = np.arange(len(place), dtype=np.int32)
        place = place.astype(np.int32)

        def back(x: np.ndarray, n: int) -> np.ndarray:
            out = np.zeros_like(x)
            out[n:] = x[:-n]
            out[place < n] = 0
            return out

        steps = steps_of(one), steps_of(two)
        seen = steps[0] * Q + steps[1]
        hits = yes[0].astype(np.int32)
        outcomes = sum(back(hits, n) << n - 1 for n in range(1, 9))
        missed = np.concatenate(([-1], np.maximum.accumulate(np.where(yes[0], -1, at))[:-1])).astype(np.int32)
        run = np.minimum(np.minimum(at - 1 - missed, place), 31)
        last = back(level, 1)
        levels = last * 4 + back(level, 2)
        three = steps_of(back(np.maximum(self.counts[0], 0), 1))
        contexts = (outcomes, levels * (Q * Q) + seen, (back(level, 3) * 16 + levels) * Q + steps[1], three * 32 + run)
        contexts = [c + start for c, start in zip(contexts, STARTS[:-1].astype(np.int32), strict=True)]
        gates = (steps[0], steps[1], steps[1])
        asked = [of > 0 for of in self.of]
        asked[1] &= ~yes[0]
        asked[2] &= ~yes[0] & ~yes[1]
        self.questions = []
        for ask, answer, gate in zip(asked, yes, gates, strict=True):
            where = np.flatnonzero(ask)
            self.questions.append(Question(where, answer[where], [c[where] for c in contexts], gate[where], less[where]))

    def shares(self) -> np.ndarray:
        """What the token is of all that the longest context that knows it was followed by; 1 where none does."""
        out = np.ones(len(self.new))
        for n, of, yes in reversed(list(zip(self.counts, self.of, self.yes, strict=True))):
            out[yes] = np.minimum(n[yes] / of[yes], 1)
        return out


@dataclass
class Mixer:
    """What was learned: counters and weights by decision, and observed rates."""

    counts: np.ndarray  # decision x slot x (noes, yeses)
    weights: np.ndarray  # decision x gate x input
    rates: np.ndarray  # decision x gate x rate bucket x (noes, yeses)

    @classmethod
    def new(cls) -> Mixer:
        weights = np.full((DECISIONS, Q, INPUTS), 1 / CONTEXTS)
        weights[:, :, -1] = 0
        return cls(np.zeros((DECISIONS, SLOTS, 2)), weights, np.zeros((DECISIONS, Q, RATES, 2)))

    def odds(self, d: int) -> np.ndarray:
        """Log-odds by slot as they are, with one yes taken out, and with one no taken out."""
        no, yes = self.counts[d].T
        logs = [(np.log(np.maximum(n - 1, 0) + PRIOR), np.log(n + PRIOR)) for n in (no, yes)]
        return np.stack((logs[1][1] - logs[0][1], logs[1][0] - logs[0][1], logs[1][1] - logs[0][0]))

    def inputs(self, d: int, q: Question) -> np.ndarray:
        """By predictor its log-odds, and a constant; training places are taken out of their counters."""
        table, first = self.odds(d).ravel(), q.variant() * np.int32(SLOTS)
        out = np.empty((INPUTS, len(q.at)))
        out[-1] = BIAS
        for k, slot in enumerate(q.slots):
            out[k] = table[slot + first]
        return out

    def mixed(self, d: int, q: Question) -> tuple[np.ndarray, np.ndarray]:
        """The weighted and the even mixture at each place."""
        odds, variant = self.odds(d), q.variant()
        # Weights are multiplied into the tables, one for each gate.
        by_gate = (odds[:, None] * np.repeat(self.weights[d, :, :-1], SIZES, axis=1)).ravel()
        first, gated = variant * np.int32(SLOTS), (variant * np.int32(Q) + q.gate) * np.int32(SLOTS)
        x, even = BIAS * self.weights[d, q.gate, -1], np.zeros(len(q.at))
        for slot in q.slots:
            x += by_gate[slot + gated]
            even += odds.ravel()[slot + first]
        return x.clip(-LIMIT, LIMIT), even / CONTEXTS

    def log10_probabilities(self, places: Places) -> np.ndarray:
        """log10 of the probability of each place's token, or where it is new, of its being new."""
        out = np.log10(places.shares())
        for d, q in enumerate(places.questions):
            x, even = self.mixed(d, q)
            rates = self.rates[d]
            refined = (rates[:, :, 1] + RATE_PRIOR * CENTRES) / (rates.sum(axis=2) + RATE_PRIOR)
            p = 0.5 / (1 + np.exp(-x)) + 0.5 * refined.ravel()[q.gate * RATES + _bucket(even)]
            out[q.at] += np.log10(np.where(q.yes, p, 1 - p))
        return out

    def learn(self, summed: Callable[[Callable[[Places], np.ndarray], int], np.ndarray]) -> None:
        """Learn in passes over all training places; ``summed`` adds up what a function gives for parts of them."""
        self.counts = summed(_counted, self.counts.size).reshape(self.counts.shape)
        found = summed(self._observed, self.rates.size + self.weights.size * (INPUTS + 1))
        self.rates, sums = found[: self.rates.size].reshape(self.rates.shape), found[self.rates.size :]
        sums = sums.reshape(DECISIONS, Q, INPUTS + 1, INPUTS)
        for d in range(DECISIONS):
            for gate in range(Q):
                self.weights[d, gate] += np.linalg.solve(sums[d, gate, 1:] + RIDGE * np.eye(INPUTS), sums[d, gate, 0]).clip(-2, 2)
        self.weights = self.weights.round(6)  # beyond what the order of addition may change

    def _observed(self, places: Places) -> np.ndarray:
        """Of the training places: the rates at each even mixture, and by gate slope and curvature of the cost."""
        rates, sums = np.zeros(self.rates.shape), np.zeros((DECISIONS, Q, INPUTS + 1, INPUTS))
        for d, q in enumerate(q.taught() for q in places.questions):
            x = self.inputs(d, q)
            even = x[:-1].mean(axis=0)
            rates[d] = np.bincount((q.gate * RATES + _bucket(even)) * 2 + q.yes, minlength=rates[d].size).reshape(rates[d].shape)
            # Weights are equal as yet.
            p = 1 / (1 + np.exp(-np.clip(even, -LIMIT, LIMIT)))
            order = np.argsort(q.gate.astype(np.uint8), kind="stable")
            cuts = np.searchsorted(q.gate[order], np.arange(Q + 1))
            x, slope, curve = x[:, order], (q.yes - p)[order], (p * (1 - p))[order]
            for gate in range(Q):
                part = slice(cuts[gate], cuts[gate + 1])
                sums[d, gate, 0] = x[:, part] @ slope[part]
                sums[d, gate, 1:] = (x[:, part] * curve[part]) @ x[:, part].T
        return np.concatenate((rates.ravel(), sums.ravel()))


def _counted(places: Places) -> np.ndarray:
    out = np.zeros((DECISIONS, SLOTS * 2))
    for d, q in enumerate(q.taught() for q in places.questions):
        for slot in q.slots:
            out[d] += np.bincount(slot * 2 + q.yes, minlength=SLOTS * 2)
    return out


def _bucket(x: np.ndarray) -> np.ndarray:
    return np.rint((x.clip(-LIMIT, LIMIT) + LIMIT) * ((RATES - 1) / (2 * LIMIT))).astype(np.int32)
