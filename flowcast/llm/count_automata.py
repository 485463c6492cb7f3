"""Weighted acyclic automata over sorted word sequences: the state a sequence leads to carries its count.

A transducer is built from sequences in sorted order. Each adds only the states behind the words it shares with the one before;
all sequences of a shard are added in one vectorised step a level. States that can no longer grow are merged, from
the last level up, with equal ones: the same words with the same counts into the same states.

Sequences are rows of a matrix of word numbers, 0 behind their end, at most ``DEPTH`` words. Word numbers follow the order of the
words, so the order of rows is that of the sequences.
"""

import numpy as np

DEPTH = 6


def sort_rows(rows, weights):
    """Distinct rows in order with their summed weights."""
    if not len(rows):
        return rows, weights
    bits = max(int(rows.max()).bit_length(), 1)
    key, filled = np.zeros(len(rows), np.int64), 0
    for c in range(rows.shape[1]):      # columns packed into one key; a full key gives way to its rank
        if filled + bits > 63:
            order = np.argsort(key)
            rank = np.cumsum(np.diff(key[order], prepend=key[order[0]]) != 0)
            key[order], filled = rank, int(rank[-1]).bit_length()
        key = (key << bits) | rows[:, c]
        filled += bits
    order = np.argsort(key)
    first = np.flatnonzero(np.diff(key[order], prepend=-1))
    return rows[order[first]], np.add.reduceat(weights[order], first)


def prefixes(rows, weights):
    """Per depth d: (first row, count) of every distinct sequence of d words that begins a row; counts sum its rows."""
    out, new = [], np.zeros(len(rows), bool)
    if len(rows):
        new[0] = True
    totals = np.r_[0, np.cumsum(weights)]
    for d in range(rows.shape[1]):
        new[1:] |= rows[1:, d] != rows[:-1, d]
        first = np.flatnonzero(new)
        ends = np.r_[first[1:], len(rows)]
        real = rows[first, d] > 0
        out.append((first[real], totals[ends[real]] - totals[first[real]]))
    return out


class Transducer:
    """Arcs in one block a state: ``first[s]:first[s + 1]`` are the arcs of state s, words in order; state 0 is the end."""

    def __init__(self, first, words, weights, targets, root):
        self.first, self.words, self.weights, self.targets, self.root = first, words, weights, targets, root

    @classmethod
    def build(cls, rows, weights):
        """From sorted distinct rows; the weight of a state is the sum of the rows that pass it."""
        levels = prefixes(rows, weights)
        blocks = [(np.zeros(0, np.int64),) * 3]     # arcs of the states numbered so far
        sizes, count = [np.zeros(1, np.int64)], 1
        state_of_row = np.zeros(len(rows), np.int64)    # state reached by a row's prefix of the level in hand
        for d in range(len(levels) - 1, -1, -1):
            first, total = levels[d]
            word, target = rows[first, d].astype(np.int64), state_of_row[first]
            if d:
                owner = np.searchsorted(levels[d - 1][0], first, side="right") - 1
                owners = len(levels[d - 1][0])
            else:
                owner, owners = np.zeros(len(first), np.int64), 1
            merged, kept = _merge(owner, owners, word, total, target)
            arcs = np.flatnonzero(kept[owner]) if len(owner) else owner
            sizes.append(np.bincount(owner, minlength=owners)[kept])
            blocks.append((word[arcs], total[arcs], target[arcs]))
            number = np.where(merged >= 0, np.cumsum(kept)[merged] - 1 + count, 0)
            count += int(kept.sum())
            if d:
                state_of_row = np.zeros(len(rows), np.int64)
                state_of_row[levels[d - 1][0]] = number
            else:
                root = int(number[0])
        words, totals, targets = (np.concatenate(parts) for parts in zip(*blocks))
        return cls(np.r_[0, np.cumsum(np.concatenate(sizes))], words, totals, targets, root)

    @classmethod
    def forest(cls, parts):
        """Several transducers as one with as many roots; word w of part i becomes w plus the words before part i.

        ``parts`` lists (transducer, number of its words).
        """
        made = [p for p, _ in parts]
        states = np.cumsum([0] + [len(p.first) - 1 for p in made])
        arcs = np.cumsum([0] + [len(p.words) for p in made])
        words = np.cumsum([0] + [n for _, n in parts])
        return cls(np.concatenate([p.first[:-1] + a for p, a in zip(made, arcs)] + [arcs[-1:]]),
                   np.concatenate([p.words.astype(np.int32) + np.int32(w) for p, w in zip(made, words)]),
                   np.concatenate([p.weights for p in made]),
                   np.concatenate([p.targets.astype(np.int32) + np.int32(n) for p, n in zip(made, states)]),
                   np.array([p.root + n for p, n in zip(made, states)]))

    def rows(self):
        """The sequences that end, shorter ones first, with the weights they were built from."""
        arcs, _, _ = self._arcs(np.atleast_1d(self.root))
        path = self.words[arcs][:, None].astype(np.int32)
        weight, target = self.weights[arcs], self.targets[arcs]
        done_rows, done_weights = [np.zeros((0, DEPTH), np.int32)], [np.zeros(0, np.int64)]
        while len(path):
            arcs, parent, _ = self._arcs(target)
            rest = weight - np.bincount(parent, self.weights[arcs], len(path)).astype(np.int64)
            ends = np.flatnonzero(rest > 0)
            full = np.zeros((len(ends), DEPTH), np.int32)
            full[:, :path.shape[1]] = path[ends]
            done_rows.append(full)
            done_weights.append(rest[ends])
            path = np.hstack([path[parent], self.words[arcs][:, None].astype(np.int32)])
            weight, target = self.weights[arcs], self.targets[arcs]
        return np.concatenate(done_rows), np.concatenate(done_weights)

    def encode(self):
        """Bytes of the transducer, every array in the narrowest type that holds it."""
        out = []
        for a in (np.diff(self.first), self.words, self.weights, self.targets, np.array([self.root])):
            width = next(w for w in (1, 2, 4, 8) if int(a.max(initial=0)) < 1 << (8 * w - 1))
            out += [len(a).to_bytes(4, "little"), bytes([width]), a.astype(f"<i{width}").tobytes()]
        return b"".join(out)

    @classmethod
    def decode(cls, data):
        arrays, at = [], 0
        for _ in range(5):
            size, width = int.from_bytes(data[at:at + 4], "little"), data[at + 4]
            arrays.append(np.frombuffer(data, f"<i{width}", size, at + 5))
            at += 5 + size * width
        sizes, words, weights, targets, root = arrays
        return cls(np.r_[0, np.cumsum(sizes, dtype=np.int64)], words, weights, targets, int(root[0]))

    def _arcs(self, states):
        size = self.first[states + 1] - self.first[states]
        parent = np.repeat(np.arange(len(states)), size)
        return np.repeat(self.first[states + 1] - np.cumsum(size), size) + np.arange(size.sum()), parent, size

    def compose(self, rows):
        """Weights of the given sequences: the paths of the rows through the transducer, all rows a word at a time."""
        state, words = np.full(len(rows), self.root, np.int64), self.words.astype(np.int64)
        weight = np.zeros(len(rows), np.int64)
        alive = np.ones(len(rows), bool)
        base = int(words.max(initial=0)) + 1
        # Arcs of a state are in order of words and states in order of arcs, so one key finds an arc.
        key = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first)) * base + words
        for d in range(rows.shape[1]):
            going = alive & (rows[:, d] > 0)
            word = rows[:, d].astype(np.int64)
            want = state * base + np.minimum(word, base - 1)
            at = np.minimum(np.searchsorted(key, want), max(len(key) - 1, 0))
            hit = going & (word < base) & (key[at] == want) if len(key) else np.zeros(len(rows), bool)
            weight[hit], state[hit] = self.weights[at[hit]], self.targets[at[hit]]
            weight[going & ~hit] = 0
            alive &= hit | ~going
            alive &= rows[:, d] > 0
        return weight


def _merge(owner, owners, word, weight, target):
    """States by their arcs, sorted by owner: (kept state each state is equal to, or -1 without arcs; whether it is kept)."""
    size = np.bincount(owner, minlength=owners)
    start = np.r_[0, np.cumsum(size)[:-1]]
    sign = np.zeros(owners, np.uint64)
    with np.errstate(over="ignore"):
        code = word.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ weight.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        code = (code ^ (code >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + target.astype(np.uint64) * np.uint64(0x94D049BB133111EB)
        code ^= code >> np.uint64(32)
        filled = np.flatnonzero(size)
        if len(filled):
            sign[filled] = np.add.reduceat(code * (np.arange(len(code)) - start[owner] + 1).astype(np.uint64), start[filled])
    order = np.argsort(sign)
    new = np.ones(owners, bool)
    new[1:] = (sign[order][1:] != sign[order][:-1]) | (size[order][1:] != size[order][:-1])
    group = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    same = np.empty(owners, np.int64)
    same[order] = group
    # Equal signatures are only a hint: the arcs themselves decide, and unlike states stay apart.
    mine = np.arange(len(owner))
    other = start[same[owner]] + (mine - start[owner])
    unlike = (word != word[other]) | (weight != weight[other]) | (target != target[other])
    bad = np.unique(owner[unlike])
    same[bad] = bad
    same[size == 0] = -1
    kept = np.zeros(owners, bool)
    kept[same[same >= 0]] = True
    return same, kept
