"""A gated recurrent network over word ids with a class-factored softmax, in numpy.

Words 0 .. classes * members - 1 form classes of `members` consecutive ids. A word's probability is that of its class times
that of the word within the class, so a step costs classes + members outputs instead of their product.

Texts run side by side in lanes; a lane holds texts one after the other and its state starts anew with each. Lanes advance in
windows of a fixed number of steps and carry their state from window to window, for training (truncated backpropagation) as
for scoring, so a text of any length is read to its end.
"""

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

Net = dict[str, np.ndarray]
#: Words whose outcomes are handled at a time.
ROWS = 2048


@dataclass(frozen=True)
class Shape:
    hidden: int = 24
    classes: int = 64
    members: int = 64

    @property
    def words(self) -> int:
        return self.classes * self.members


def new_net(shape: Shape, counts: np.ndarray, seed: int = 3) -> Net:
    """Small random weights; output biases from the words' counts."""
    rng, h = np.random.default_rng(seed), shape.hidden
    mass = (counts + 1.0).reshape(shape.classes, shape.members)
    return {k: v.astype(np.float32) for k, v in {
        "input": rng.normal(0, 0.1, (shape.words, 3 * h)), "state": rng.normal(0, 0.6 / np.sqrt(h), (h, 3 * h)),
        "bias": np.concatenate([np.full(h, 1.0), np.zeros(2 * h)]), "class": rng.normal(0, 0.1, (h, shape.classes)),
        "class_bias": np.log(mass.sum(axis=1) / mass.sum()), "word": rng.normal(0, 0.1, (shape.classes, h, shape.members)),
        "word_bias": np.log(mass / mass.sum(axis=1, keepdims=True))}.items()}


def lanes(lengths: np.ndarray, most: int) -> tuple[list[list[int]], np.ndarray]:
    """Texts dealt to at most `most` lanes, the longest first to the emptiest; lanes in order of their length, downwards."""
    order = np.argsort(-lengths, kind="stable")
    heap = [(0, i) for i in range(min(most, len(order)))]
    dealt: list[list[int]] = [[] for _ in heap]
    for text in order.tolist():
        load, lane = heapq.heappop(heap)
        dealt[lane].append(text)
        heapq.heappush(heap, (load + int(lengths[text]), lane))
    total = np.array([int(lengths[d].sum()) for d in dealt], np.int64)
    by_total = np.argsort(-total, kind="stable")
    return [dealt[i] for i in by_total], total[by_total]


class Lanes:
    """Texts in lanes, as runs of words one lane after the other; windows of them are laid side by side when they are read.

    Memory grows with the words, not with the longest lane times the lanes.
    """

    def __init__(self, texts: list[np.ndarray], most: int, start: int):
        lengths = np.array([len(t) for t in texts], np.int64)
        dealt, self.total = lanes(lengths, most)
        order = np.array([i for lane in dealt for i in lane], np.int64)
        first = np.cumsum(lengths[order]) - lengths[order]
        self.steps, self.first = int(self.total.max(initial=0)), np.cumsum(self.total) - self.total
        self.targets = np.concatenate([texts[i] for i in order]).astype(np.int32) if len(order) else np.zeros(0, np.int32)
        self.text = np.repeat(order, lengths[order]).astype(np.int32)
        self.starts = np.zeros(len(self.targets), bool)
        self.starts[first[lengths[order] > 0]] = True
        self.inputs = np.zeros_like(self.targets)
        self.inputs[1:] = self.targets[:-1]
        self.inputs[self.starts] = start

    def window(self, at: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Steps `at` to `at + size` of the lanes that still have words: input words, target words, whether a text starts,
        text numbers, and how many lanes (from the first) have a word at each step."""
        steps = np.arange(at, min(at + size, self.steps))
        active = (self.total[None, :] > steps[:, None]).sum(axis=1)
        going = int(active.max(initial=0))
        # behind a lane's end its last word stands in; it is not active
        place = self.first[:going] + np.minimum(steps[:, None], self.total[:going] - 1)
        return self.inputs[place], self.targets[place], self.starts[place], self.text[place], active


def _gated(net: Net) -> tuple[np.ndarray, np.ndarray]:
    """Input weights with the bias, and state weights, as three contiguous parts: keeping, letting in, new."""
    h = net["state"].shape[0]
    given = np.ascontiguousarray(net["input"].reshape(-1, 3, h).transpose(1, 0, 2))
    given += net["bias"].reshape(3, 1, h)
    return given, np.ascontiguousarray(net["state"].reshape(h, 3, h).transpose(1, 0, 2))


def run(weights: tuple[np.ndarray, np.ndarray], state: np.ndarray, inputs: np.ndarray, starts: np.ndarray, active: np.ndarray,
        keep: list | None = None) -> np.ndarray:
    """States after each step of a window, by the weights as `_gated` parts them. active: lanes (from the first) that have a word
    at each step. `state` is changed."""
    out = np.zeros((*inputs.shape, state.shape[1]), np.float32)
    for t, n in enumerate(active.tolist()):
        old = state[:n]
        old[starts[t, :n]] = 0
        given, own = np.take(weights[0], inputs[t, :n], axis=1), np.matmul(old, weights[1])
        gates, new = given[:2], given[2]
        gates += own[:2]  # 1 / (1 + exp(-x)) by the hyperbolic tangent of half of it
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        new += gates[1] * own[2]
        np.tanh(new, out=new)
        after = old - new
        after *= gates[0]
        after += new
        if keep is not None:
            keep.append((old.copy(), gates[0], gates[1], new, own[2]))
        state[:n] = out[t, :n] = after
    return out


def _runs(keys: np.ndarray, size: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order of keys below `size`, and which places each key then has."""
    order = np.argsort(keys.astype(np.int16) if size <= 1 << 15 else keys, kind="stable")
    ends = np.cumsum(np.bincount(keys, minlength=size)).tolist()
    return order, [(k, a, b) for k, (a, b) in enumerate(zip([0, *ends], ends)) if a < b]


def _together(runs: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """Runs cut to at most ROWS places, in lists of runs of like length that fill ROWS places when padded to the longest."""
    cut = [(k, at, min(at + ROWS, b)) for k, a, b in runs for at in range(a, b, ROWS)]
    waiting: list[tuple[int, int, int]] = []
    for run_ in sorted(cut, key=lambda r: r[1] - r[2]):
        longest = waiting[0][2] - waiting[0][1] if waiting else 0
        if (len(waiting) + 1) * longest > ROWS or longest > 1.5 * (run_[2] - run_[1]) + 16:
            yield waiting
            waiting = []
        waiting.append(run_)
    if waiting:
        yield waiting


def _predicted(net: Net, states: np.ndarray, targets: np.ndarray, grads: Net | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Natural log probabilities of target words from the states that predict them, and, with `grads`, the gradients of the
    summed loss with respect to the states; those of the softmaxes' weights are added to `grads`.

    Goes by the targets' classes, ROWS words at a time, so that a block stays in the processor's cache; outcomes come before words.
    """
    classes, members = net["word"].shape[0], net["word"].shape[2]
    order, runs = _runs(targets // members, classes)
    states = states[order]
    of_class, member = np.divmod(targets[order], members)
    logs, back = np.zeros(len(targets)), np.zeros_like(states)

    def softmax(block: list[tuple[int, int, int]], weight: str, bias: str, goals: np.ndarray) -> None:
        """Runs of words, each predicted by a matrix of its own."""
        which, first, last = (np.array(x) for x in zip(*block))
        steps = np.arange((last - first).max())
        if len(block) == 1:
            which, place, used = block[0][0], slice(*block[0][1:]), np.float32(1)
            at, rows, real = (goals[place], steps), place, slice(None)
        else:
            place = np.minimum(first[:, None] + steps, last[:, None] - 1)
            real = first[:, None] + steps < last[:, None]
            at, rows, used = (np.arange(len(block))[:, None], goals[place], steps[None, :]), place[real], real.astype(np.float32)
        given, matrix = states[place], net[weight].reshape(-1, *net[weight].shape[-2:])[which]
        x = np.matmul(matrix.swapaxes(-1, -2), given.swapaxes(-1, -2))
        x += net[bias].reshape(-1, x.shape[-2])[which][..., None]
        x -= x.max(axis=-2, keepdims=True)
        own = x[at]
        np.exp(x, out=x)
        total = x.sum(axis=-2)
        logs[rows] += (own - np.log(total))[real]
        if grads is not None:
            x *= (used / total)[..., None, :]
            x[at] -= used
            of_weight, of_bias = np.matmul(given.swapaxes(-1, -2), x.swapaxes(-1, -2)), x.sum(axis=-1)
            for (k, _, _), w, b in zip(block, of_weight.reshape(-1, *matrix.shape[-2:]), of_bias.reshape(-1, matrix.shape[-1])):
                grads[weight].reshape(-1, *w.shape)[k] += w
                grads[bias].reshape(-1, len(b))[k] += b
            back[rows] += np.matmul(x.swapaxes(-1, -2), matrix.swapaxes(-1, -2))[real]

    for block in _together([(0, 0, len(targets))]):
        softmax(block, "class", "class_bias", of_class)
    for block in _together(runs):
        softmax(block, "word", "word_bias", member)
    out, ds = np.empty_like(logs), np.empty_like(back)
    out[order], ds[order] = logs, back
    return out, ds


def log_likelihood(net: Net, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural log probabilities of target words from the states that predict them."""
    return _predicted(net, states, targets)[0]


def score(net: Net, texts: list[np.ndarray], start: int, most: int = 1024, window: int = 64) -> np.ndarray:
    """Natural log probability of each whole text (arrays of word ids)."""
    if not texts:
        return np.zeros(0)
    laid, out, weights = Lanes(texts, most, start), np.zeros(len(texts)), _gated(net)
    state = np.zeros((len(laid.total), net["state"].shape[0]), np.float32)
    for at in range(0, laid.steps, window):
        inputs, targets, starts, text, active = laid.window(at, window)
        states = run(weights, state[:inputs.shape[1]], inputs, starts, active)
        used = np.arange(inputs.shape[1]) < active[:, None]
        # a word is predicted by the state that has read the words before it: the input of a step is the word before
        logs = log_likelihood(net, states[used], targets[used])
        out += np.bincount(text[used], logs, len(texts))
    return out


def _add_rows(out: np.ndarray, rows: np.ndarray, used: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Adds the rows that are used to those of their ids; returns the sum of all."""
    place = np.flatnonzero(used)
    order, runs = _runs(ids[place], len(out))
    sums = np.add.reduceat(rows[place[order]], [a for _, a, _ in runs], axis=0)
    out[[i for i, _, _ in runs]] += sums
    return sums.sum(axis=0)


def gradients(net: Net, state: np.ndarray, inputs: np.ndarray, targets: np.ndarray, starts: np.ndarray, active: np.ndarray,
              into: Net | None = None, weights: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[Net, float]:
    """Of the mean log loss of a window, by backpropagation through its steps; and the summed loss. `state` moves on.

    With `into`, the gradients of the summed loss are added to it, so a window of few words costs little. `weights`: of `_gated`.
    """
    h = state.shape[1]
    kept: list = []
    weights = weights or _gated(net)
    states = run(weights, state, inputs, starts, active, kept)
    used = np.arange(inputs.shape[1]) < active[:, None]
    grads = {k: np.zeros_like(v) for k, v in net.items()} if into is None else into
    logs, ds = _predicted(net, states[used], targets[used], grads)
    out = np.zeros_like(states)
    out[used] = ds
    back, given = np.zeros((inputs.shape[1], h), np.float32), np.zeros((*inputs.shape, 3, h), np.float32)
    of_state, turned = np.zeros((3, h, h), np.float32), np.ascontiguousarray(weights[1].transpose(0, 2, 1))
    for t in range(len(kept) - 1, -1, -1):
        n = int(active[t])
        old, keeps, lets, new, own = kept[t]
        through = np.empty((3, n, h), np.float32)
        d_keep, d_let, d_new = through
        d = out[t, :n] + back[:n]
        stays = d * keeps
        np.multiply(d - stays, 1 - new * new, out=d_new)
        np.multiply(stays * (old - new), 1 - keeps, out=d_keep)
        given[t, :n, 2] = d_new
        d_new *= lets
        np.multiply(d_new * own, 1 - lets, out=d_let)
        given[t, :n, 0], given[t, :n, 1] = d_keep, d_let
        of_state += np.matmul(old.T, through)
        stays += np.matmul(through, turned).sum(axis=0)
        stays[starts[t, :n]] = 0
        back[:n] = stays
    grads["state"] += of_state.transpose(1, 0, 2).reshape(h, 3 * h)
    grads["bias"] += _add_rows(grads["input"], given.reshape(-1, 3 * h), used.reshape(-1), inputs.reshape(-1))
    if into is None:
        for g in grads.values():
            g /= max(1, len(logs))
    return grads, -float(logs.sum())


class Adam:
    def __init__(self, net: Net, rate: float):
        self.net, self.rate, self.step = net, rate, 0
        self.one, self.two = ({k: np.zeros_like(v) for k, v in net.items()} for _ in range(2))

    def apply(self, grads: Net, share: float) -> None:
        """share: from 0 at the start of training to 1 at its end; the rate falls to a tenth."""
        self.step += 1
        # a number of Python, so that arrays stay float32
        rate = float(self.rate * (1 - 0.9 * share) * np.sqrt(1 - 0.99 ** self.step) / (1 - 0.9 ** self.step))
        for k, g in grads.items():
            self.one[k] += 0.1 * (g - self.one[k])
            self.two[k] += 0.01 * (g * g - self.two[k])
            self.net[k] -= rate * self.one[k] / (np.sqrt(self.two[k]) + 1e-7)


def windows(net: Net, texts: list[np.ndarray], start: int, most: int, window: int, gathered: Net) -> Iterator[tuple[int, float]]:
    """The words of each window of the texts, and the share of steps before it; the state goes on from window to window.

    The gradients of a window's summed loss are added to `gathered`. The net may change between windows if `gathered` is cleared then.
    """
    laid, weights = Lanes(texts, most, start), _gated(net)
    state = np.zeros((len(laid.total), net["state"].shape[0]), np.float32)
    for at in range(0, laid.steps, window):
        inputs, targets, starts, _, active = laid.window(at, window)
        if not gathered:
            gathered |= {k: np.zeros_like(v) for k, v in net.items()}
            weights = _gated(net)
        gradients(net, state[:inputs.shape[1]], inputs, targets, starts, active, gathered, weights)
        yield int(active.sum()), at / laid.steps


def train(net: Net, texts: list[np.ndarray], start: int, epochs: int, most: int = 128, window: int = 32, rate: float = 6e-3, seed: int = 1) -> Net:
    """Truncated backpropagation over the texts, `window` steps at a time; the net is changed and returned."""
    rng, adam, gathered = np.random.default_rng(seed), Adam(net, rate), {}
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for words, share in windows(net, [texts[i] for i in order], start, most, window, gathered):
            adam.apply({k: g / words for k, g in gathered.items()}, (epoch + share) / epochs)
            gathered.clear()
    return net
