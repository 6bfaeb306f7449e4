"""Unigram models over a fixed vocabulary of pieces, summed over all segmentations.

A word's probability in a language is the sum, over all ways to cut it into pieces, of the
product of the pieces' probabilities. The forward algorithm adds them up from left to
right; many words are taken at once, position by position, along a trie of the pieces.
Every byte is a piece too, so every word has a probability.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cached_property

import numpy as np

CELLS = 1 << 20  # numbers in one table of partial sums
RESCALE = 8  # positions between two scalings
START = b" "  # stands before every word, as pieces tell the beginning of words


def load_pieces(path: str) -> list[bytes]:
    """The pieces of a sentencepiece vocabulary that words in small letters can contain."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = set()
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
            continue
        piece = model.id_to_piece(i)
        body = piece.removeprefix("▁")
        if body == body.lower() and (not body or body.isalpha()):
            pieces.add((START if piece != body else b"") + body.encode())
    single = {bytes([b]) for b in range(256)}
    return sorted((pieces | single) - {b""})


class Trie:
    """The pieces as a table of steps: `go[node, byte]` is the next node, 0 if there is none."""

    def __init__(self, pieces: Sequence[bytes]) -> None:
        self.pieces = list(pieces)
        self.longest = max(map(len, self.pieces))

    def __getstate__(self) -> list[bytes]:
        return self.pieces

    def __setstate__(self, pieces: list[bytes]) -> None:
        self.__init__(pieces)

    @cached_property
    def _tables(self) -> tuple[np.ndarray, np.ndarray]:
        nodes: dict[bytes, int] = {b"": 0}
        steps = []
        for piece in self.pieces:
            for end in range(1, len(piece) + 1):
                head = piece[:end]
                if head not in nodes:
                    nodes[head] = len(nodes)
                    steps.append((nodes[head[:-1]], head[-1], nodes[head]))
        go = np.zeros((len(nodes), 256), np.int32)
        source, byte, target = np.array(steps).T
        go[source, byte] = target
        piece_at = np.full(len(nodes), -1, np.int32)
        piece_at[[nodes[p] for p in self.pieces]] = np.arange(len(self.pieces))
        return go, piece_at

    def matches(self, table: np.ndarray, lengths: np.ndarray, start: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, words, pieces) of all pieces that begin at `start` of the words.

        `table` holds the words' bytes, 0 beyond their ends; words come longest first.
        """
        go, piece_at = self._tables
        words = np.arange(np.searchsorted(-lengths, -start))
        nodes = np.zeros(len(words), np.int32)
        for end in range(start, min(start + self.longest, table.shape[1])):
            nodes = go[nodes, table[words, end]]
            alive = nodes > 0
            if not alive.all():
                words, nodes = words[alive], nodes[alive]
            if not len(words):
                return
            pieces = piece_at[nodes]
            whole = pieces >= 0
            if whole.all():
                yield end + 1 - start, words, pieces
            elif whole.any():
                yield end + 1 - start, words[whole], pieces[whole]


def _tables_of(words: Sequence[bytes], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places in `words`, bytes, lengths) for words of like length, longest first."""
    lengths = np.array([len(w) for w in words])
    order = np.argsort(-lengths, kind="stable")
    at = 0
    while at < len(order):
        longest = lengths[order[at]]
        some = order[at:at + max(1, CELLS // (int(longest + 1) * max(1, width)))]
        joined = b"".join(words[i].ljust(longest, b"\0") for i in some)
        yield some, np.frombuffer(joined, np.uint8).reshape(len(some), longest), lengths[some]
        at += len(some)


def log_likelihoods(trie: Trie, words: Sequence[bytes], chances: np.ndarray) -> np.ndarray:
    """The logarithm of each word's probability in each language, over all segmentations.

    `chances` has a row for each piece and a column for each language. Sums are scaled
    every few positions, so words may be of any length.
    """
    out = np.empty((len(words), chances.shape[1]))
    for some, table, lengths in _tables_of(words, chances.shape[1]):
        sums = np.zeros((table.shape[1] + 1, len(some), chances.shape[1]))
        sums[0] = 1
        logs = np.zeros(sums.shape[1:])
        for start in range(table.shape[1]):
            if start and start % RESCALE == 0:
                ahead = sums[start:start + trie.longest]
                most = ahead.max(axis=0)
                most[most == 0] = 1
                ahead /= most
                logs += np.log(most)
            here = sums[start]
            for length, rows, pieces in trie.matches(table, lengths, start):
                sums[start + length, rows] += here[rows] * chances[pieces]
        out[some] = np.log(sums[lengths, np.arange(len(some))]) + logs
    return out


def expected_counts(trie: Trie, words: Sequence[bytes], counts: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """How often each piece is expected in the words of one language, each standing `counts` times.

    Forward and backward sums over all segmentations; for words of a few dozen bytes, as
    nothing is scaled but by a constant for each byte.
    """
    scaled = chances * 8.0 ** np.array([len(p) for p in trie.pieces])
    total = np.zeros(len(trie.pieces))
    for some, table, lengths in _tables_of(words, 1):
        before = np.zeros((table.shape[1] + 1, len(some)))
        before[0] = 1
        steps = []
        for start in range(table.shape[1]):
            for length, rows, pieces in trie.matches(table, lengths, start):
                before[start + length, rows] += before[start, rows] * scaled[pieces]
                steps.append((start, length, rows, pieces))
        after = np.zeros_like(before)
        after[lengths, np.arange(len(some))] = 1
        share = counts[some] / before[lengths, np.arange(len(some))]
        for start, length, rows, pieces in reversed(steps):
            rest = scaled[pieces] * after[start + length, rows]
            after[start, rows] += rest
            total += np.bincount(pieces, before[start, rows] * rest * share[rows], len(total))
    return total
