"""A bidirectional LSTM in numpy that labels a page's blocks as article or not.

Each block is a vector: its tag path and the names on it, hashed; its words, hashed; a
few shapes (length, share of links, punctuation, place). The whole sequence of a page's
blocks is read from both ends, so every block is judged in the page's context. It is
trained on `training_pages`, a bounded set (PAGES) of labelled pages in many layouts, from a
fixed seed, so every run gives the same weights.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Sequence
from functools import lru_cache

import numpy as np

from slotfuse.llm.blocks import Block, leaf_blocks
from slotfuse.llm.training_pages import training_pages

PATH, WORDS, SHAPE = 256, 32, 14
INPUT = PATH + WORDS + SHAPE
HIDDEN = 24
PAGES, EPOCHS, BATCH = 1500, 9, 25
NAME_PART = re.compile(r"[a-z]+")
HASHED = 1 << 17  # entries of the word cache, emptied when it is full
CELLS = 60_000  # padded blocks labelled at a time, at most

_WORDS: dict[str, tuple[int, float]] = {}


def _word(word: str) -> tuple[int, float]:
    found = _WORDS.get(word)
    if found is None:
        if len(_WORDS) >= HASHED:
            _WORDS.clear()
        h = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        found = _WORDS[word] = (PATH + h % WORDS, 1.0 if h >> 16 & 1 else -1.0)
    return found


@lru_cache(maxsize=1 << 14)
def _path(path: tuple[str, ...], names: tuple[str, ...]) -> np.ndarray:
    """Elements, whole names, and the words in them, each hashed apart: `sidebar-layout`
    is not `sidebar`, though both have the word. The last name and element stand out."""
    out = np.zeros(PATH)
    keys = [f"<{t}" for t in path] + [f".{n}" for n in names] + [f"leaf {path[-1] if path else ''}"]
    keys += [f"~{part}" for n in names for part in NAME_PART.findall(n) if part != n]
    if names:
        keys.append(f"last {names[-1]}")
    for key in set(keys):
        h = zlib.crc32(key.encode())
        out[h % PATH] += 1.0 if h >> 16 & 1 else -1.0
    return out


def features(blocks: Sequence[Block]) -> np.ndarray:
    out = np.zeros((len(blocks), INPUT), dtype=np.float32)
    for i, b in enumerate(blocks):
        row, n = out[i], len(b.text)
        row[:PATH] = _path(b.path, b.names)
        tokens = b.text.lower().split()
        weight = 1 / math.sqrt(len(tokens))
        for t in tokens:
            place, sign = _word(t)
            row[place] += sign * weight
        leaf = b.path[-1] if b.path else ""
        row[PATH + WORDS:] = (
            min(2.0, math.log1p(n) / 4), min(2.0, math.log1p(len(tokens)) / 3), min(1.0, b.linked / n), b.text.count(".") * 10 / (n + 20),
            b.text.count(",") * 10 / (n + 20), b.text[-1] in ".!?:", b.text[0].isupper(), leaf in ("h1", "h2", "h3"),
            len(b.path) / 8, (i + 1) / len(blocks), "©" in b.text, 1.0,
            1.0 if i and blocks[i - 1].path == b.path else 0.0, min(1.0, sum(map(str.isdigit, b.text)) * 4 / n),
        )
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(x: np.ndarray, mask: np.ndarray, w: np.ndarray, back: bool):
    """States (pages, blocks, HIDDEN) of one direction; padding leaves the state alone."""
    pages, steps, _ = x.shape
    h, c = np.zeros((pages, HIDDEN), x.dtype), np.zeros((pages, HIDDEN), x.dtype)
    out = np.zeros((pages, steps, HIDDEN), x.dtype)
    ahead = x @ w[:x.shape[2]]
    tape = []
    for t in range(steps - 1, -1, -1) if back else range(steps):
        z = ahead[:, t] + h @ w[x.shape[2]:]
        i, f, o = _sigmoid(z[:, :HIDDEN]), _sigmoid(z[:, HIDDEN:2 * HIDDEN] + 1), _sigmoid(z[:, 2 * HIDDEN:3 * HIDDEN])
        g = np.tanh(z[:, 3 * HIDDEN:])
        m = mask[:, t, None]
        fresh = f * c + i * g
        squashed = np.tanh(fresh)
        tape.append((t, i, f, o, g, c, squashed, h, m))
        c = m * fresh + (1 - m) * c
        h = m * (o * squashed) + (1 - m) * h
        out[:, t] = h
    return out, tape


def _backward(x: np.ndarray, w: np.ndarray, tape, d_out: np.ndarray) -> np.ndarray:
    grad = np.zeros_like(w)
    dh, dc = np.zeros((len(x), HIDDEN)), np.zeros((len(x), HIDDEN))
    width = x.shape[2]
    for t, i, f, o, g, before, squashed, h_before, m in reversed(tape):
        total = dh + d_out[:, t]
        inner = total * m
        d_fresh = dc * m + inner * o * (1 - squashed**2)
        dz = np.concatenate(
            [d_fresh * g * i * (1 - i), d_fresh * before * f * (1 - f), inner * squashed * o * (1 - o), d_fresh * i * (1 - g**2)], axis=1
        )
        grad[:width] += x[:, t].T @ dz
        grad[width:] += h_before.T @ dz
        dh = dz @ w[width:].T + total * (1 - m)
        dc = d_fresh * f + dc * (1 - m)
    return grad


def _pad(rows: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(len(r) for r in rows)
    x, mask = np.zeros((len(rows), longest, INPUT), np.float32), np.zeros((len(rows), longest), np.float32)
    for k, r in enumerate(rows):
        x[k, :len(r)], mask[k, :len(r)] = r, 1
    return x, mask


def _logits(x: np.ndarray, mask: np.ndarray, weights: dict[str, np.ndarray]):
    ahead, tape_a = _forward(x, mask, weights["ahead"], False)
    behind, tape_b = _forward(x, mask, weights["behind"], True)
    seen = np.concatenate([ahead, behind, x], axis=2)
    return seen @ weights["out"], seen, tape_a, tape_b


def labelled_sequences(count: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features and labels. Words are left out of half the blocks, so paths count too."""
    rng, out = np.random.default_rng(seed), []
    for page, labels in training_pages(count, seed):
        blocks = leaf_blocks(page)
        known = [b for b in blocks if b.text.rsplit(" ", 1)[-1] in labels]
        if known:
            # The marker word is taken off again: it must not be a feature.
            bare = [b._replace(text=b.text.rsplit(" ", 1)[0] or b.text) for b in known]
            x = features(bare)
            x[rng.random(len(x)) < 0.5, PATH:PATH + WORDS] = 0
            out.append((x, np.array([labels[b.text.rsplit(" ", 1)[-1]] for b in known], np.float32)))
    return out


@lru_cache(maxsize=2)
def train(pages: int = PAGES, epochs: int = EPOCHS, seed: int = 5) -> dict[str, np.ndarray]:
    """Weights by Adam on the mean log loss, back through time over whole pages."""
    rng = np.random.default_rng(seed)
    data = sorted(labelled_sequences(pages, seed), key=lambda s: len(s[0]))
    weights = {
        "ahead": rng.normal(0, 0.1, (INPUT + HIDDEN, 4 * HIDDEN)),
        "behind": rng.normal(0, 0.1, (INPUT + HIDDEN, 4 * HIDDEN)),
        "out": rng.normal(0, 0.1, 2 * HIDDEN + INPUT),
    }
    first, second = ({k: np.zeros_like(v) for k, v in weights.items()} for _ in range(2))
    batches, step = [data[i:i + BATCH] for i in range(0, len(data), BATCH)], 0
    for epoch in range(epochs):
        for b in rng.permutation(len(batches)):
            x, mask = _pad([s[0] for s in batches[b]])
            y = np.zeros_like(mask)
            for k, s in enumerate(batches[b]):
                y[k, :len(s[1])] = s[1]
            logits, seen, tape_a, tape_b = _logits(x, mask, weights)
            d = (_sigmoid(logits) - y) * mask / mask.sum()
            d_seen = d[..., None] * weights["out"][:2 * HIDDEN]
            grads = {
                "out": np.einsum("ptk,pt->k", seen, d),
                "ahead": _backward(x, weights["ahead"], tape_a, d_seen[..., :HIDDEN]),
                "behind": _backward(x, weights["behind"], tape_b, d_seen[..., HIDDEN:]),
            }
            step += 1
            rate = 0.02 if epoch < epochs - 3 else 0.006
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                weights[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return {k: v.astype(np.float32) for k, v in weights.items()}


def label_pages(pages: Sequence[Sequence[Block]], weights: dict[str, np.ndarray]) -> list[np.ndarray]:
    """For each page, which of its blocks are article."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted((k for k, p in enumerate(pages) if p), key=lambda k: len(pages[k]))
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end - at + 1) * len(pages[order[end]]) <= CELLS // 8 and end - at < 256:
            end += 1
        part = order[at:end]
        x, mask = _pad([features(pages[k]) for k in part])
        logits = _logits(x, mask, weights)[0]
        for row, k in enumerate(part):
            out[k] = logits[row, :len(pages[k])] > 0
        at = end
    return out
