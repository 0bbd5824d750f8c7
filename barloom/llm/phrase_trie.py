"""Double-array tries of phrases, and numpy walking all positions of a text through one at once.

A phrase is a row of labels: that of its group (a language, say), then one per word. State 0 is the
root; the child of state ``s`` by label ``c`` is ``base[s] + c``, if ``check`` of that
place is ``s``.
"""

import numpy as np

_TRIED = 2048


class PhraseTrie:
    """Arrays that tasks walk: sorted word numbers (labels), ``base``, ``check`` and the rows' end states."""

    def __init__(self, groups: list[str], heads: np.ndarray, words: np.ndarray):
        """``words``: 64-bit word numbers (phrase, place); ``heads``: the place of each phrase's group in ``groups``."""
        self.groups = {group: label for label, group in enumerate(groups)}
        self.numbers = np.unique(words)
        self.depth = words.shape[1]
        rows = np.empty((len(words), self.depth + 1), np.int32)
        rows[:, 0] = heads
        for place in range(self.depth):
            rows[:, place + 1] = np.searchsorted(self.numbers, words[:, place])
        self._build(rows)

    def _build(self, rows: np.ndarray) -> None:
        self.base, self.check = np.zeros(1, np.int32), np.full(1, -2, np.int32)
        self._grow(2 * len(rows) + len(self.numbers) + len(self.groups) + 2)
        self.check[0] = -2  # the root is taken and is nobody's child
        self._free_from = 1
        states = np.zeros(len(rows), np.int32)
        for place in range(rows.shape[1]):
            order = np.lexsort([rows[:, place], states])
            parents, labels = states[order], rows[order, place]
            new = np.ones(len(order), bool)
            new[1:] = (parents[1:] != parents[:-1]) | (labels[1:] != labels[:-1])
            self._add_children(parents[new], labels[new])
            states = self.base[states] + rows[:, place]
        self.ends = states

    def _grow(self, size: int) -> None:
        more = max(0, size - len(self.check))
        self.base = np.concatenate([self.base, np.zeros(more, np.int32)])
        self.check = np.concatenate([self.check, np.full(more, -1, np.int32)])

    def _add_children(self, parents: np.ndarray, labels: np.ndarray) -> None:
        """Places for all children of some states (sorted): states with many children first, single ones at last."""
        if not len(parents):
            return
        starts = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]]))
        sizes = np.diff(np.append(starts, len(parents)))
        many = np.flatnonzero(sizes > 1)
        for k in many[np.argsort(-sizes[many], kind="stable")]:
            first, last = starts[k], starts[k] + sizes[k]
            self._place(int(parents[first]), labels[first:last])
        single = starts[sizes == 1]
        if len(single):
            label = labels[single]
            room = np.flatnonzero(self.check[self._free_from :] == -1)
            if len(room) < len(single):
                self._grow(len(self.check) + len(single))
                room = np.flatnonzero(self.check[self._free_from :] == -1)
            at = room[: len(single)] + self._free_from
            self.check[at], self.base[parents[single]] = parents[single], at - label

    def _place(self, parent: int, labels: np.ndarray) -> None:
        """The first base at which all children find free places."""
        offsets, start = labels - labels[0], self._free_from
        while True:
            if start + _TRIED + offsets[-1] >= len(self.check):
                self._grow(2 * len(self.check) + int(offsets[-1]) + _TRIED)
            at = np.flatnonzero(self.check[start : start + _TRIED] == -1) + start
            for place in offsets[1:]:
                at = at[self.check[at + place] == -1]
                if not len(at):
                    break
            if len(at):
                break
            start += _TRIED
        self.check[at[0] + offsets] = parent
        self.base[parent] = at[0] - labels[0]
        if start > self._free_from + 8 * _TRIED:  # nearly full places behind are left to single children
            self._free_from = start - 8 * _TRIED

    def arrays(self) -> dict:
        """Plain data to send to tasks."""
        size = int(np.flatnonzero(self.check != -1).max()) + 1 if len(self.ends) else 1
        base, check = self.base[:size], self.check[:size]
        return {"groups": self.groups, "numbers": self.numbers, "base": base, "check": check, "ends": self.ends, "depth": self.depth}


def walk(trie: dict, group: str, numbers: np.ndarray, starts: int) -> np.ndarray:
    """End states of all phrases of the trie in rows of word numbers, overlaps included."""
    return walked(trie, group, numbers, starts)[1]


def walked(trie: dict, group: str, numbers: np.ndarray, starts: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the phrases of the trie start in rows of word numbers, as places of all rows together, and their end states.

    ``numbers`` are those of words, a row of them in each row, 0 where a piece ends. A phrase may start
    at the first ``starts`` places of a row. All places go down one level at a time.
    """
    base, check, known = trie["base"], trie["check"], trie["numbers"]
    if group not in trie["groups"] or not len(known):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    flat = numbers.ravel()
    place = np.minimum(np.searchsorted(known, flat), len(known) - 1)
    labels = np.where(known[place] == flat, place, -1)
    at = np.flatnonzero(labels.reshape(numbers.shape)[:, :starts] >= 0)
    at += at // starts * (numbers.shape[1] - starts)
    state = np.full(len(at), base[0] + trie["groups"][group], np.int64)
    for level in range(trie["depth"]):
        label = labels[at + level]
        child = base[state] + label
        real = (label >= 0) & (child > 0) & (child < len(check))
        at, state, child = at[real], state[real], child[real]
        real = check[child] == state
        at, state = at[real], child[real]
    return at, state
