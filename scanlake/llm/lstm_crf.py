"""A bidirectional LSTM over characters with a linear-chain CRF on top, in numpy.

Parameters: ``in_f, in_b`` give each symbol its four gate inputs (a one-hot input layer),
``rec_f, rec_b`` are the recurrent weights, ``out_f, out_b, out_0`` the tag scores and
``moves`` the tag transitions. Gates are in the order input, forget, output, candidate.
"""

from __future__ import annotations

import numpy as np

from scanlake.llm.training import Adam


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def new_model(symbols: int, hidden: int, tags: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    model = {}
    for side in "fb":
        model[f"in_{side}"] = rng.normal(0, 0.3, (symbols, 4 * hidden))
        model[f"in_{side}"][:, hidden : 2 * hidden] += 1.0  # remember at first
        model[f"rec_{side}"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden))
        model[f"out_{side}"] = rng.normal(0, 0.3, (hidden, tags))
    model["out_0"] = np.zeros(tags)
    model["moves"] = np.zeros((tags, tags))
    return {k: v.astype(np.float32) for k, v in model.items()}


def run_side(inputs: np.ndarray, recurrent: np.ndarray, ids: np.ndarray, keep: bool = False):
    """States (n, t, hidden) of one direction, left to right; with keep also what backpropagation needs."""
    n, steps = ids.shape
    hidden = recurrent.shape[0]
    state, cell = np.zeros((n, hidden), np.float32), np.zeros((n, hidden), np.float32)
    states, kept = np.empty((n, steps, hidden), np.float32), []
    for t in range(steps):
        gates = inputs[ids[:, t]] + state @ recurrent
        opened = sigmoid(gates[:, : 3 * hidden])
        i, f, o = opened[:, :hidden], opened[:, hidden : 2 * hidden], opened[:, 2 * hidden :]
        g = np.tanh(gates[:, 3 * hidden :])
        before, previous = cell, state
        cell = f * cell + i * g
        squashed = np.tanh(cell)
        state = o * squashed
        states[:, t] = state
        if keep:
            kept.append((i, f, o, g, before, squashed, previous))
    return states, kept


def back_side(d_states: np.ndarray, kept: list, inputs: np.ndarray, recurrent: np.ndarray, ids: np.ndarray):
    """Gradients of the input table and the recurrent weights, through time."""
    d_inputs, d_recurrent = np.zeros_like(inputs), np.zeros_like(recurrent)
    d_state = d_cell = np.zeros_like(d_states[:, 0])
    for t in range(ids.shape[1] - 1, -1, -1):
        i, f, o, g, before, squashed, previous = kept[t]
        d_state = d_state + d_states[:, t]
        d_cell = d_cell + d_state * o * (1 - squashed**2)
        d_gates = np.concatenate(
            [d_cell * g * i * (1 - i), d_cell * before * f * (1 - f), d_state * squashed * o * (1 - o), d_cell * i * (1 - g**2)], axis=1
        )
        np.add.at(d_inputs, ids[:, t], d_gates)
        d_recurrent += previous.T @ d_gates
        d_state = d_gates @ recurrent.T
        d_cell = d_cell * f
    return d_inputs, d_recurrent


def scores(model: dict[str, np.ndarray], ids: np.ndarray) -> np.ndarray:
    """Tag scores (n, t, tags) of windows of symbols."""
    ahead, _ = run_side(model["in_f"], model["rec_f"], ids)
    back, _ = run_side(model["in_b"], model["rec_b"], ids[:, ::-1])
    return ahead @ model["out_f"] + back[:, ::-1] @ model["out_b"] + model["out_0"]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def crf_loss(emitted: np.ndarray, moves: np.ndarray, tags: np.ndarray):
    """Mean negative log likelihood per window, and its gradients by scores and transitions."""
    n, steps, k = emitted.shape
    alpha, beta = np.empty_like(emitted), np.zeros_like(emitted)
    alpha[:, 0] = emitted[:, 0]
    for t in range(1, steps):
        alpha[:, t] = emitted[:, t] + _log_sum(alpha[:, t - 1, :, None] + moves, 1)
    for t in range(steps - 2, -1, -1):
        beta[:, t] = _log_sum(moves + (emitted[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
    total = _log_sum(alpha[:, -1], 1)
    d_emitted = np.exp(alpha + beta - total[:, None, None])
    pairs = alpha[:, :-1, :, None] + moves + (emitted[:, 1:] + beta[:, 1:])[:, :, None, :] - total[:, None, None, None]
    d_moves = np.exp(pairs).sum(axis=(0, 1))
    rows, at = np.arange(n)[:, None], np.arange(steps)
    gold = emitted[rows, at, tags].sum(axis=1) + moves[tags[:, :-1], tags[:, 1:]].sum(axis=1)
    d_emitted[rows, at, tags] -= 1
    np.subtract.at(d_moves, (tags[:, :-1], tags[:, 1:]), 1)
    return float((total - gold).mean()), d_emitted / n, d_moves / n


def loss_and_gradients(model: dict[str, np.ndarray], ids: np.ndarray, tags: np.ndarray):
    ahead, kept_f = run_side(model["in_f"], model["rec_f"], ids, keep=True)
    flipped = ids[:, ::-1]
    back, kept_b = run_side(model["in_b"], model["rec_b"], flipped, keep=True)
    back = back[:, ::-1]
    emitted = ahead @ model["out_f"] + back @ model["out_b"] + model["out_0"]
    loss, d_emitted, d_moves = crf_loss(emitted, model["moves"], tags)
    gradients = {"moves": d_moves, "out_0": d_emitted.sum(axis=(0, 1))}
    gradients["out_f"] = np.einsum("nth,ntk->hk", ahead, d_emitted)
    gradients["out_b"] = np.einsum("nth,ntk->hk", back, d_emitted)
    gradients["in_f"], gradients["rec_f"] = back_side(d_emitted @ model["out_f"].T, kept_f, model["in_f"], model["rec_f"], ids)
    d_back = (d_emitted @ model["out_b"].T)[:, ::-1]
    gradients["in_b"], gradients["rec_b"] = back_side(d_back, kept_b, model["in_b"], model["rec_b"], flipped)
    return loss, gradients


def train(ids: np.ndarray, tags: np.ndarray, symbols: int, hidden: int, n_tags: int, epochs: int, seed: int, batch: int = 128, rate: float = 0.01):
    model = new_model(symbols, hidden, n_tags, seed)
    adam, rng = Adam(model, rate), np.random.default_rng(seed)
    for epoch in range(epochs):
        order = rng.permutation(len(ids))
        for start in range(0, len(order), batch):
            part = order[start : start + batch]
            _, gradients = loss_and_gradients(model, ids[part], tags[part])
            adam.step(gradients, rate * (1 - epoch / epochs) + 1e-4)
    return model


def viterbi(emitted: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best tag path of each row of scores (n, t, tags)."""
    n, steps, _ = emitted.shape
    best, came = emitted[:, 0], np.zeros(emitted.shape, np.int8)
    for t in range(1, steps):
        options = best[:, :, None] + moves
        came[:, t] = options.argmax(axis=1)
        best = np.take_along_axis(options, came[:, t][:, None, :].astype(np.int64), 1)[:, 0] + emitted[:, t]
    path = np.empty((n, steps), np.int8)
    path[:, -1] = best.argmax(axis=1)
    for t in range(steps - 1, 0, -1):
        path[:, t - 1] = came[np.arange(n), t, path[:, t]]
    return path


def viterbi_blocks(blocks, moves: np.ndarray) -> np.ndarray:
    """Best tag path of one row of scores that comes in blocks (t, tags): only a byte a place and tag is kept."""
    best, came = None, []
    for block in blocks:
        back = np.zeros(block.shape, np.int8)
        for t, emitted in enumerate(block.astype(np.float64)):
            if best is None:
                best = emitted
                continue
            options = best[:, None] + moves
            back[t] = options.argmax(axis=0)
            best = options.max(axis=0) + emitted
        came.append(back)
    tag, paths = int(best.argmax()), []
    for back in reversed(came):
        path = np.empty(len(back), np.int8)
        for t in range(len(back) - 1, -1, -1):
            path[t] = tag
            tag = int(back[t, tag])
        paths.append(path)
    return np.concatenate(paths[::-1])
