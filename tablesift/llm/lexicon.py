"""A minimal acyclic transducer from words to lists of token ids, as arrays in one file.

**Form.** States are joined by transitions, each with one byte of a word and a list of
ids; a final state has a list of its own. The ids of a word are those of its path, in order.
Words come in byte order; once no later word can run through a state, the state is replaced by
an equal one that exists (same transitions, targets and lists), so words share suffixes as
well as prefixes. Ids are moved as far towards the start as all words through a transition allow,
which makes equal states as frequent as can be: the automaton is minimal.

**File.** A header of section sizes, then the sections: sorted keys (state * 256 + byte),
targets, and where each list of ids begins and ends in the pool, each list stored once. The
file is memory-mapped, so all processes of a machine share its pages. Words are looked up together,
one byte of all at a time.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable

import numpy as np

Ids = tuple[int, ...]
#: Name and type of each section, in the order of the file.
SECTIONS = [("keys", np.int64), ("targets", np.int32), ("starts", np.int32), ("ends", np.int32),
            ("final_starts", np.int32), ("final_ends", np.int32), ("pool", np.uint32)]
MAGIC = b"LEXICON1"


def _common(a: Ids, b: Ids) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


class _Open:
    """A state that later words may still run through."""

    __slots__ = ("arcs", "final")

    def __init__(self):
        self.arcs: dict[int, list] = {}  # byte: [target, ids]
        self.final: Ids | None = None


class Builder:
    """Takes (word, ids) in byte order of the words, each word once."""

    def __init__(self):
        self.path = [_Open()]  # the open states of the last word
        self.last: bytes | None = None
        self.known: dict[tuple, int] = {}
        self.states: list[tuple] = []  # (final ids, ((byte, target, ids), ...))

    def _closed(self, state: _Open) -> int:
        key = (state.final, tuple((b, t, ids) for b, (t, ids) in sorted(state.arcs.items())))
        number = self.known.get(key)
        if number is None:
            number = self.known[key] = len(self.states)
            self.states.append(key)
        return number

    def _close(self, down_to: int) -> None:
        while len(self.path) - 1 > down_to:
            state = self.path.pop()
            self.path[-1].arcs[self.last[len(self.path) - 1]][0] = self._closed(state)

    def add(self, word: bytes, ids: Ids) -> None:
        if self.last is not None and word <= self.last:
            raise ValueError("words must come in byte order, each once")
        shared = 0
        if self.last is not None:
            for x, y in zip(word, self.last, strict=False):
                if x != y:
                    break
                shared += 1
        self._close(shared)
        rest = ids
        for depth in range(shared):  # what the shared transitions hold too much moves on
            arc, state = self.path[depth].arcs[word[depth]], self.path[depth + 1]
            n = _common(arc[1], rest)
            late = arc[1][n:]
            if late:
                arc[1] = arc[1][:n]
                for next_arc in state.arcs.values():
                    next_arc[1] = late + next_arc[1]
                if state.final is not None:
                    state.final = late + state.final
            rest = rest[n:]
        for byte in word[shared:]:
            self.path[-1].arcs[byte] = [-1, rest]
            rest = ()
            self.path.append(_Open())
        self.path[-1].final = rest
        self.last = word

    def finish(self) -> bytes:
        """The file's content."""
        self._close(0)
        root = self._closed(self.path[0])
        pool: list[int] = []
        places: dict[Ids, int] = {(): 0}

        def place(ids: Ids) -> int:
            if ids not in places:
                places[ids] = len(pool)
                pool.extend(ids)
            return places[ids]

        # the start state becomes number 0
        number = {k: (0 if k == root else k + (k < root)) for k in range(len(self.states))}
        arcs, finals = [], [(-1, -1)] * len(self.states)
        for k, (final, mine) in enumerate(self.states):
            for byte, target, ids in mine:
                at = place(ids)
                arcs.append((number[k] << 8 | byte, number[target], at, at + len(ids)))
            if final is not None:
                at = place(final)
                finals[number[k]] = (at, at + len(final))
        arcs = np.array(sorted(arcs), np.int64).reshape(-1, 4)
        finals = np.array(finals, np.int64).reshape(-1, 2)
        columns = [*arcs.T, *finals.T, np.array(pool, np.int64)]
        data = [np.ascontiguousarray(c).astype(kind).tobytes() for c, (_, kind) in zip(columns, SECTIONS, strict=True)]
        header = MAGIC + struct.pack(f"<{len(data)}Q", *map(len, data))
        padded = [d + b"\0" * (-len(d) % 8) for d in data]
        return header + b"".join(padded)


def compiled(words: Iterable[tuple[bytes, Ids]]) -> bytes:
    """The file of a lexicon; words in any order, of equal ones the last counts."""
    builder = Builder()
    for word, ids in sorted(dict(words).items()):
        builder.add(word, tuple(ids))
    return builder.finish()


def gather(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices of pool that begin at starts, one after the other."""
    lengths = lengths.astype(np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)]


class Lexicon:
    """A file of ``compiled``, memory-mapped."""

    def __init__(self, path: str):
        data = np.memmap(path, np.uint8, "r")
        if data[:8].tobytes() != MAGIC:
            raise ValueError(f"{path} is no lexicon")
        at = 8 + 8 * len(SECTIONS)
        for (name, kind), size in zip(SECTIONS, struct.unpack(f"<{len(SECTIONS)}Q", data[8:at].tobytes()), strict=True):
            setattr(self, name, data[at:at + size].view(kind))
            at += size + -size % 8

    def look_up(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each word is held, how many ids it has (0 if not held), and all their ids one after the other."""
        n = len(words)
        text = np.frombuffer(b"".join(words), np.uint8)
        size = np.fromiter(map(len, words), np.int64, n)
        begin = np.cumsum(size) - size
        state, held = np.zeros(n, np.int64), np.ones(n, bool)
        owners, starts, ends = [], [], []
        step, at = 0, np.arange(n)
        while len(at := at[size[at] > step]):
            key = state[at] << 8 | text[begin[at] + step]
            arc = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
            there = self.keys[arc] == key if len(self.keys) else np.zeros(len(at), bool)
            held[at[~there]] = False
            at, arc = at[there], arc[there]
            state[at] = self.targets[arc]
            some = self.ends[arc] > self.starts[arc]
            owners.append(at[some])
            starts.append(self.starts[arc[some]])
            ends.append(self.ends[arc[some]])
            step += 1
        held &= self.final_starts[state] >= 0
        at = np.arange(n)
        owners.append(at)
        starts.append(self.final_starts[state])
        ends.append(self.final_ends[state])
        owner, start, end = np.concatenate(owners), np.concatenate(starts).astype(np.int64), np.concatenate(ends).astype(np.int64)
        order = np.argsort(owner, kind="stable")
        order = order[held[owner[order]]]
        length = (end - start)[order]
        counts = np.bincount(owner[order], weights=length, minlength=n).astype(np.int64)
        return held, counts, gather(self.pool, start[order], length)
