"""A bidirectional gated recurrent network over bytes, in numpy.

Each side has a table ``in`` of gate inputs by byte and recurrent weights ``rec``, for an
update gate, a reset gate and a candidate. Gates are piecewise linear (0 to 1, and -1 to 1
for the candidate), which keeps a step at a few passes over memory. The scores of the
classes at a position are linear in both sides' states there.
"""

from __future__ import annotations

import numpy as np

from scanlake.llm.training import Adam


def new_model(hidden: int, classes: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    model = {}
    for side in "fb":
        model[f"in_{side}"] = rng.normal(0, 0.2, (256, 3 * hidden))
        model[f"in_{side}"][:, :hidden] += 0.7  # keep the state at first
        model[f"in_{side}"][:, hidden : 2 * hidden] += 0.5
        model[f"rec_{side}"] = rng.normal(0, 0.5 / np.sqrt(hidden), (hidden, 3 * hidden))
        model[f"out_{side}"] = rng.normal(0, 0.3, (hidden, classes))
    model["out_0"] = np.zeros(classes)
    return {k: v.astype(np.float32) for k, v in model.items()}


def run_side(inputs: np.ndarray, recurrent: np.ndarray, data: np.ndarray, keep: bool = False):
    """States (t, n, hidden) of one direction over windows (n, t); with keep also each step's values."""
    n, steps = data.shape
    hidden = recurrent.shape[0]
    states = np.empty((steps, n, hidden), inputs.dtype)
    state, kept = np.zeros((n, hidden), inputs.dtype), []
    columns = np.ascontiguousarray(data.T).astype(np.intp)
    given, back = np.empty((n, 3 * hidden), inputs.dtype), np.empty((n, 3 * hidden), inputs.dtype)
    for t in range(steps):
        np.take(inputs, columns[t], axis=0, out=given, mode="clip")
        np.matmul(state, recurrent, out=back)
        gates = given[:, : 2 * hidden] + back[:, : 2 * hidden]
        opened = np.clip(gates, 0, 1)
        update, reset = opened[:, :hidden], opened[:, hidden:]
        candidate = reset * back[:, 2 * hidden :]
        candidate += given[:, 2 * hidden :]
        if keep:
            kept.append((gates, opened, candidate.copy(), back[:, 2 * hidden :].copy(), state))
        np.clip(candidate, -1, 1, out=candidate)
        state = np.subtract(state, candidate, out=states[t])
        state *= update
        state += candidate
    return states, kept


def back_side(d_states: np.ndarray, kept: list, inputs: np.ndarray, recurrent: np.ndarray, data: np.ndarray):
    """Gradients of the input table and recurrent weights by backpropagation through time."""
    hidden = recurrent.shape[0]
    d_inputs, d_recurrent = np.zeros_like(inputs), np.zeros_like(recurrent)
    d_state = np.zeros_like(d_states[0])
    for t in range(len(kept) - 1, -1, -1):
        gates, opened, raw, back, before = kept[t]
        update, reset = opened[:, :hidden], opened[:, hidden:]
        candidate = np.clip(raw, -1, 1)
        d_state = d_state + d_states[t]
        d_candidate = d_state * (1 - update) * (np.abs(raw) < 1)
        d_open = np.concatenate([d_state * (before - candidate), d_candidate * back], axis=1) * ((gates > 0) & (gates < 1))
        np.add.at(d_inputs, data[:, t], np.concatenate([d_open, d_candidate], axis=1))
        d_back = np.concatenate([d_open, d_candidate * reset], axis=1)
        d_recurrent += before.T @ d_back
        d_state = d_state * update + d_back @ recurrent.T
    return d_inputs, d_recurrent


def position_scores(model: dict[str, np.ndarray], data: np.ndarray) -> np.ndarray:
    """Class scores (t, n, classes) of every position of windows of bytes (n, t)."""
    ahead, _ = run_side(model["in_f"], model["rec_f"], data)
    behind, _ = run_side(model["in_b"], model["rec_b"], data[:, ::-1])
    return ahead @ model["out_f"] + behind[::-1] @ model["out_b"] + model["out_0"]


def probabilities(scores: np.ndarray) -> np.ndarray:
    out = np.exp(scores - scores.max(axis=-1, keepdims=True))
    out /= out.sum(axis=-1, keepdims=True)
    return out


def loss_and_gradients(model: dict[str, np.ndarray], data: np.ndarray, used: np.ndarray, labels: np.ndarray):
    """Mean cross entropy over the used positions of windows, every one labelled as its window."""
    ahead, kept_f = run_side(model["in_f"], model["rec_f"], data, keep=True)
    flipped = data[:, ::-1]
    behind, kept_b = run_side(model["in_b"], model["rec_b"], flipped, keep=True)
    behind = behind[::-1]
    found = probabilities(ahead @ model["out_f"] + behind @ model["out_b"] + model["out_0"])
    weight = used.T / max(1, used.sum())
    rows = np.arange(len(labels))
    loss = -(np.log(found[:, rows, labels] + 1e-12) * weight).sum()
    d_scores = found.copy()
    d_scores[:, rows, labels] -= 1
    d_scores = (d_scores * weight[:, :, None]).astype(found.dtype)
    gradients = {"out_0": d_scores.sum(axis=(0, 1))}
    gradients["out_f"] = np.tensordot(ahead, d_scores, ((0, 1), (0, 1)))
    gradients["out_b"] = np.tensordot(behind, d_scores, ((0, 1), (0, 1)))
    gradients["in_f"], gradients["rec_f"] = back_side(d_scores @ model["out_f"].T, kept_f, model["in_f"], model["rec_f"], data)
    d_behind = (d_scores @ model["out_b"].T)[::-1]
    gradients["in_b"], gradients["rec_b"] = back_side(d_behind, kept_b, model["in_b"], model["rec_b"], flipped)
    return float(loss), gradients


def train(data, used, labels, hidden: int, classes: int, epochs: int, seed: int, batch: int = 128, rate: float = 0.01):
    model = new_model(hidden, classes, seed)
    adam, rng = Adam(model, rate, clip=1.0), np.random.default_rng(seed)
    for epoch in range(epochs):
        order = rng.permutation(len(data))
        for start in range(0, len(order), batch):
            part = order[start : start + batch]
            _, gradients = loss_and_gradients(model, data[part], used[part], labels[part])
            adam.step(gradients, rate * (1 - epoch / epochs))
    return model
