"""A character-level bidirectional LSTM with CRF transitions, in numpy.

Arrays have the batch last: (steps, units, windows). Gates are in the order input,
forget, output, candidate; the first three are 0.5 + 0.5 tanh, so that one call of
tanh serves all. Training computes them; reading takes them from tables.
"""

from dataclasses import dataclass

import numpy as np

GATES = 4
#: Steps times stretches that are searched at once.
STEPS_AT_ONCE = 1 << 16
#: Places of the tables, and where they end: float32 has no tanh nearer to one.
PLACES, REACH = 1 << 16, 9.0
PER_UNIT = PLACES / (2 * REACH)
_BENT = np.tanh((np.arange(PLACES) + 0.5) / PER_UNIT - REACH)
TANH, OPEN = _BENT.astype(np.float32), (0.5 + 0.5 * _BENT).astype(np.float32)


@dataclass
class Tagger:
    """Weights, all in one dictionary: for each direction the gates' input (which
    holds their bias) and state, for the CRF emissions, their bias and transitions."""

    weights: dict[str, np.ndarray]
    units: int

    @classmethod
    def new(cls, kinds: int, tags: int, units: int, seed: int = 3) -> "Tagger":
        random = np.random.default_rng(seed)
        weights = {}
        for way in ("forward", "backward"):
            weights[f"{way}_input"] = random.normal(0, 0.4, (GATES * units, kinds))
            weights[f"{way}_state"] = random.normal(0, 0.3, (GATES * units, units))
            weights[f"{way}_input"][units : 2 * units] += 0.5  # remember at first
            weights[f"{way}_emission"] = random.normal(0, 0.3, (tags, units))
        weights["bias"] = np.zeros((tags, 1))
        weights["transitions"] = np.zeros((tags, tags))
        return cls({name: w.astype(np.float32) for name, w in weights.items()}, units)

    def _one_hot(self, kinds: np.ndarray) -> np.ndarray:
        every = np.arange(self.weights["forward_input"].shape[1], dtype=kinds.dtype)
        return (kinds == every[:, None]).astype(np.float32)

    def _states(self, kinds: np.ndarray, way: str, kept: list | None = None) -> np.ndarray:
        units, (steps, windows) = self.units, kinds.shape
        into, state = self.weights[f"{way}_input"], self.weights[f"{way}_state"]
        scaled = np.ones((GATES * units, 1), np.float32)
        scaled[: 3 * units] = 0.5
        into, state = into * scaled, state * scaled
        hidden = np.zeros((units, windows), np.float32)
        cell = np.zeros_like(hidden)
        out = np.empty((steps, units, windows), np.float32)
        gates, part = np.empty((GATES * units, windows), np.float32), np.empty((GATES * units, windows), np.float32)
        for t in range(steps) if way == "forward" else range(steps - 1, -1, -1):
            np.matmul(into, self._one_hot(kinds[t]), out=gates)
            np.matmul(state, hidden, out=part)
            gates += part
            np.tanh(gates, out=gates)
            gates[: 3 * units] *= 0.5
            gates[: 3 * units] += 0.5
            before = cell
            cell = gates[units : 2 * units] * cell
            cell += gates[:units] * gates[3 * units :]
            bent = np.tanh(cell)
            hidden = np.multiply(gates[2 * units : 3 * units], bent, out=out[t])
            if kept is not None:
                kept.append((t, gates.copy(), before, bent))
        return out

    def _read_states(self, kinds: np.ndarray, way: str) -> np.ndarray:
        """As ``_states``, with gates from tables: each is off by at most 2e-4.

        The weights give places in the tables, so that one product of kinds and hidden
        states is all that a gate needs besides.
        """
        units, (steps, windows) = self.units, kinds.shape
        into, state = self.weights[f"{way}_input"], self.weights[f"{way}_state"]
        per = np.full((GATES * units, 1), PER_UNIT)
        per[: 3 * units] /= 2
        weights = np.concatenate([into * per + PLACES / 2, state * per], axis=1).astype(np.float32)
        every = np.arange(into.shape[1], dtype=kinds.dtype)[:, None]
        given = np.zeros((len(every) + units, windows), np.float32)
        kind, hidden = given[: len(every)], given[len(every) :]
        gates = np.empty((GATES * units, windows), np.float32)
        whole, places = np.empty(gates.shape, np.int32), np.empty(gates.shape, np.intp)
        i, f, o, g = (gates[n * units : (n + 1) * units] for n in range(GATES))
        cell, bent = np.zeros_like(hidden), np.empty_like(hidden)
        out = np.empty((steps, units, windows), np.float32)
        for t in range(steps) if way == "forward" else range(steps - 1, -1, -1):
            kind[...] = kinds[t] == every
            np.matmul(weights, given, out=gates)
            whole[...] = gates  # by way of 32 bits, which is faster
            places[...] = whole
            np.take(OPEN, places[: 3 * units], out=gates[: 3 * units], mode="clip")
            np.take(TANH, places[3 * units :], out=g, mode="clip")
            cell *= f
            i *= g
            cell += i
            np.multiply(cell, np.float32(PER_UNIT), out=bent)
            bent += np.float32(PLACES / 2)
            whole[:units] = bent
            places[:units] = whole[:units]
            np.take(TANH, places[:units], out=bent, mode="clip")
            np.multiply(o, bent, out=hidden)
            out[t] = hidden
        return out

    def emissions(self, kinds: np.ndarray) -> np.ndarray:
        """(steps, tags, windows) for (steps, windows) kinds of characters."""
        return self._emitted(*(self._read_states(kinds, way) for way in ("forward", "backward")))

    def _emitted(self, forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
        found = np.matmul(self.weights["forward_emission"], forward)
        found += np.matmul(self.weights["backward_emission"], backward)
        found += self.weights["bias"]
        return found

    def decode(self, emitted: list[np.ndarray]) -> list[np.ndarray]:
        """Most likely tags of whole sequences, given as (tags, steps), by the CRF.

        A sequence stands between two steps of tag 0. A run of n other tags gains, by its
        transitions, at most n times ``gain`` over tag 0, and loses by how far tag 0 leads.
        A step that is in no run where gains make up for the lead has tag 0 in the best
        path; only the stretches between such steps need the search.
        """
        over = self.weights["transitions"] - self.weights["transitions"][0, 0]
        gain = max(over[0, 1:].max() + over[1:, 0].max(), over[1:, 1:].max(), 0.0)
        found, stretches = [], []
        for number, scores in enumerate(emitted):
            found.append(np.zeros(scores.shape[1], np.uint8))
            worth = scores[1:].max(0) - scores[0] + np.float32(gain + 1e-3)
            if len(worth) and worth.max() >= 0:
                edges = np.nonzero(np.diff(_within_gains(worth), prepend=False, append=False))[0]
                stretches += [(number, start, end) for start, end in zip(edges[::2].tolist(), edges[1::2].tolist())]
        stretches.sort(key=lambda s: s[2] - s[1])
        while stretches:
            longest = stretches[-1][2] - stretches[-1][1]
            fit = max(1, STEPS_AT_ONCE // (longest + 2))
            some, stretches = stretches[-fit:], stretches[:-fit]
            padded = np.full((longest + 2, len(emitted[0]), len(some)), -1e9, np.float32)
            padded[:, 0] = 0
            for at, (number, start, end) in enumerate(some):
                padded[1 : 1 + end - start, :, at] = emitted[number][:, start:end].T
            path = self._viterbi(padded)
            for at, (number, start, end) in enumerate(some):
                found[number][start:end] = path[1 : 1 + end - start, at]
        return found

    def _viterbi(self, emitted: np.ndarray) -> np.ndarray:
        steps, tags, windows = emitted.shape
        back = np.empty((steps, tags, windows), np.uint8)
        score = emitted[0]
        for t in range(1, steps):
            reached = score[:, None] + self.weights["transitions"][:, :, None]
            back[t] = reached.argmax(0)
            score = np.take_along_axis(reached, back[t][None].astype(np.intp), 0)[0] + emitted[t]
        path = np.empty((steps, windows), np.uint8)
        path[-1] = score.argmax(0)
        each = np.arange(windows)
        for t in range(steps - 1, 0, -1):
            path[t - 1] = back[t, path[t], each]
        return path

    # --- training -----------------------------------------------------------

    def _crf_gradient(self, emitted: np.ndarray, gold: np.ndarray):
        """Negative log-likelihood per window, and its gradients."""
        steps, tags, windows = emitted.shape
        transitions = self.weights["transitions"][:, :, None]
        alpha = np.empty_like(emitted)
        beta = np.zeros_like(emitted)
        alpha[0] = emitted[0]
        for t in range(1, steps):
            alpha[t] = _log_sum(alpha[t - 1][:, None] + transitions, 0) + emitted[t]
        for t in range(steps - 2, -1, -1):
            beta[t] = _log_sum(transitions + (emitted[t + 1] + beta[t + 1])[None], 1)
        total = _log_sum(alpha[-1], 0)
        on_emitted = np.exp(alpha + beta - total)
        on_transitions = np.zeros_like(self.weights["transitions"])
        for t in range(1, steps):
            joint = alpha[t - 1][:, None] + transitions + (emitted[t] + beta[t])[None] - total
            on_transitions += np.exp(joint).sum(2)
        np.subtract.at(on_transitions, (gold[:-1].ravel(), gold[1:].ravel()), 1)
        step, window = np.indices(gold.shape)
        path = emitted[step, gold, window].sum(0) + self.weights["transitions"][gold[:-1], gold[1:]].sum(0)
        on_emitted[step, gold, window] -= 1
        return float((total - path).mean()), on_emitted / windows, on_transitions / windows

    def _back_through(self, kinds, way: str, kept: list, out: np.ndarray, on_out: np.ndarray, found: dict):
        units = self.units
        state = self.weights[f"{way}_state"]
        on_into, on_state = np.zeros_like(self.weights[f"{way}_input"]), np.zeros_like(state)
        on_hidden = np.zeros_like(on_out[0])
        on_cell = np.zeros_like(on_hidden)
        for at in range(len(kept) - 1, -1, -1):
            t, gates, before, bent = kept[at]
            i, f, o, g = (gates[n * units : (n + 1) * units] for n in range(GATES))
            on_h = on_out[t] + on_hidden
            on_cell = on_cell + on_h * o * (1 - bent**2)
            on_gates = np.concatenate(
                [on_cell * g * i * (1 - i), on_cell * before * f * (1 - f), on_h * bent * o * (1 - o), on_cell * i * (1 - g**2)]
            )
            on_cell = on_cell * f
            on_into += on_gates @ self._one_hot(kinds[t]).T
            if at:
                on_state += on_gates @ out[kept[at - 1][0]].T
            on_hidden = state.T @ on_gates
        found[f"{way}_input"], found[f"{way}_state"] = on_into, on_state

    def gradients(self, kinds: np.ndarray, gold: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        kept = {"forward": [], "backward": []}
        out = {way: self._states(kinds, way, kept[way]) for way in kept}
        loss, on_emitted, on_transitions = self._crf_gradient(self._emitted(out["forward"], out["backward"]), gold)
        found = {"transitions": on_transitions, "bias": on_emitted.sum((0, 2))[:, None]}
        for way in kept:
            found[f"{way}_emission"] = np.einsum("tkb,thb->kh", on_emitted, out[way])
            on_out = np.matmul(self.weights[f"{way}_emission"].T, on_emitted)
            self._back_through(kinds, way, kept[way], out[way], on_out, found)
        return loss, found

    def fit(self, kinds: np.ndarray, gold: np.ndarray, steps: int, batch: int, rate: float = 0.02, seed: int = 5) -> float:
        """Adam over random batches of the windows (steps, windows); the last loss."""
        random = np.random.default_rng(seed)
        mean = {name: np.zeros_like(w) for name, w in self.weights.items()}
        square = {name: np.zeros_like(w) for name, w in self.weights.items()}
        loss = float("nan")
        for step in range(1, steps + 1):
            some = random.integers(0, kinds.shape[1], batch)
            loss, gradients = self.gradients(kinds[:, some], gold[:, some])
            norm = np.sqrt(sum(float((g**2).sum()) for g in gradients.values()))
            for name, gradient in gradients.items():
                gradient = gradient * min(1.0, 5 / (norm + 1e-9))
                mean[name] = 0.9 * mean[name] + 0.1 * gradient
                square[name] = 0.999 * square[name] + 0.001 * gradient**2
                change = mean[name] / (1 - 0.9**step) / (np.sqrt(square[name] / (1 - 0.999**step)) + 1e-8)
                self.weights[name] -= (rate * (1 - 0.9 * step / steps) * change).astype(np.float32)
        return loss


def _within_gains(worth: np.ndarray) -> np.ndarray:
    """Whether a step lies in some run of steps whose sum is not negative."""
    sums = np.concatenate([[0.0], np.cumsum(worth, dtype=np.float64)])
    least_before = np.minimum.accumulate(sums)[:-1]
    most_after = np.maximum.accumulate(sums[::-1])[::-1][1:]
    return most_after >= least_before


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    most = values.max(axis, keepdims=True)
    return np.squeeze(most, axis) + np.log(np.exp(values - most).sum(axis))
