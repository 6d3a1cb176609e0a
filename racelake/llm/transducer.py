"""A minimal acyclic transducer from words to token ids, in flat arrays.

Built incrementally from sorted words: states that accept the same suffixes
with the same transitions are shared, so common endings exist once.  The output
of a word is its place in sorted order, summed along its path from the numbers
of words that each skipped branch holds; the place indexes the id lists.

The arrays are one file (a JSON line, then aligned arrays) that tasks map into
memory; look-up walks all words of a batch one byte at a time.
"""

from __future__ import annotations

import json
import mmap

import numpy as np

_MULT = np.uint64(0x9E3779B97F4A7C15)


def _slots(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys.astype(np.uint64) * _MULT >> np.uint64(64 - bits)).astype(np.int64)


def build(words: list[bytes], ids: list[list[int]]) -> dict[str, np.ndarray]:
    """Compile sorted distinct non-empty words and their ids."""
    register: dict[tuple, int] = {}
    edges: list[list[tuple[int, int]]] = []  # of finished states
    final: list[bool] = []

    def finish(state: list) -> int:
        """state: [final, [(byte, finished child), ...]] -> number of an equal finished state."""
        key = (state[0], tuple(state[1]))
        if key not in register:
            register[key] = len(edges)
            edges.append(state[1])
            final.append(state[0])
        return register[key]

    path: list[list] = [[False, []]]  # unfinished states along the last word
    last = b""
    for word in words:
        common = 0
        top = min(len(word), len(last))
        while common < top and word[common] == last[common]:
            common += 1
        for depth in range(len(last), common, -1):
            child = finish(path.pop())
            path[-1][1].append((last[depth - 1], child))
        path.extend([False, []] for _ in range(len(word) - common))
        path[-1][0] = True
        last = word
    for depth in range(len(last), 0, -1):
        child = finish(path.pop())
        path[-1][1].append((last[depth - 1], child))
    root = finish(path.pop())

    # children are finished before their parents: one pass gives the word counts
    below = np.zeros(len(edges), np.int64)
    keys, targets, skips = [], [], []
    for state, out in enumerate(edges):
        n = int(final[state])
        for byte, child in out:
            keys.append(state << 8 | byte)
            targets.append(child)
            skips.append(n)
            n += int(below[child])
        below[state] = n

    bits = max(4, int(2 * len(keys) + 1).bit_length())
    mask, size = (1 << bits) - 1, 1 << bits
    key_at, target_at, skip_at = np.full(size, -1, np.int64), np.zeros(size, np.int32), np.zeros(size, np.int32)
    probes = 1
    slots = _slots(np.array(keys, np.int64), bits).tolist() if keys else []
    taken = bytearray(size)
    for key, target, skip, slot in zip(keys, targets, skips, slots, strict=True):
        tries = 1
        while taken[slot]:
            slot = (slot + 1) & mask
            tries += 1
        taken[slot] = 1
        key_at[slot], target_at[slot], skip_at[slot] = key, target, skip
        probes = max(probes, tries)
    ends = np.cumsum([0, *map(len, ids)], dtype=np.int64)
    flat = np.array([x for one in ids for x in one], np.uint32)
    return {"meta": np.array([root, bits, probes, len(words)], np.int64), "final": np.array(final, np.uint8),
            "keys": key_at, "targets": target_at, "skips": skip_at, "id_ends": ends, "ids": flat}


def to_bytes(arrays: dict[str, np.ndarray]) -> bytes:
    head, parts, at = {}, [], 0
    for name, a in arrays.items():
        raw = a.tobytes()
        head[name] = [a.dtype.str, a.size, at]
        pad = -len(raw) % 16
        parts += [raw, bytes(pad)]
        at += len(raw) + pad
    line = json.dumps(head).encode()
    line += b" " * (-(len(line) + 1) % 16) + b"\n"
    return line + b"".join(parts)


class Transducer:
    """Read side; ``open`` maps the file, ``from_bytes`` reads a buffer."""

    def __init__(self, buffer):
        end = buffer[:1 << 16].find(b"\n") + 1
        head = json.loads(bytes(buffer[:end]))
        for name, (kind, size, at) in head.items():
            setattr(self, name, np.frombuffer(buffer, kind, size, end + at))
        self.root, self.bits, self.probes, self.n_words = self.meta.tolist()

    @classmethod
    def open(cls, path: str) -> Transducer:
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    def places(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Place in the lexicon of the words data[start:end], -1 if not held."""
        n = starts.size
        out = np.full(n, -1, np.int64)
        alive = np.flatnonzero(ends > starts)
        state = np.full(alive.size, self.root, np.int64)
        place = np.zeros(alive.size, np.int64)
        mask = (1 << self.bits) - 1
        at = starts[alive].astype(np.int64)
        stop = ends[alive].astype(np.int64)
        while alive.size:
            key = state << 8 | data[at]
            slot = _slots(key, self.bits)
            found = self.keys[slot]
            for _ in range(self.probes - 1):
                wrong = np.flatnonzero((found != key) & (found >= 0))
                if not wrong.size:
                    break
                slot[wrong] = (slot[wrong] + 1) & mask
                found[wrong] = self.keys[slot[wrong]]
            hit = np.flatnonzero(found == key)
            slot = slot[hit]
            alive, at, stop = alive[hit], at[hit] + 1, stop[hit]
            state = self.targets[slot].astype(np.int64)
            place = place[hit] + self.skips[slot]
            done = at == stop
            ended = np.flatnonzero(done)
            good = ended[self.final[state[ended]] > 0]
            out[alive[good]] = place[good]
            on = np.flatnonzero(~done)
            alive, at, stop, state, place = alive[on], at[on], stop[on], state[on], place[on]
        return out
