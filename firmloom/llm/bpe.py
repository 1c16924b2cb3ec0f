"""Byte-pair encoding by prefix dynamic programming.

A token sequence is the encoding of its bytes if and only if every two neighbours
encode to themselves. So the encoding of each prefix of a word ends in one certain
token: the only one whose predecessor, the last token of the shorter prefix, is
compatible with it. One pass from left to right gives the last token and the token
count of every prefix, without encoding any prefix anew.
"""

from __future__ import annotations

import json


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable Latin-1 bytes
    stand for themselves, the others for letters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(other)}


class PrefixBpe:
    """Tokens and token counts of all prefixes of a word (bytes)."""

    def __init__(self, path: str):
        """`path`: a vocabulary file with byte-level merges and no marks for word ends."""
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters = byte_letters()

        def symbol(token: str) -> bytes:
            return bytes(letters[c] for c in token)

        ids = {symbol(t): n for t, n in model["vocab"].items()}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            a, b = symbol(a), symbol(b)
            self.merges[ids[a], ids[b]] = rank, ids[a + b]
        self.made = {new: (rank, *pair) for pair, (rank, new) in self.merges.items()}
        self._spines: tuple[dict[int, list], dict[int, list]] = {}, {}
        #: Tokens that encode to themselves.
        self.tokens: dict[bytes, int] = {}
        for s, n in ids.items():
            rank, left, right = self.made.get(n, (0, None, None))
            if len(s) == 1 or left is not None and self._apart(left, right, rank):
                self.tokens[s] = n
        self.longest = max(map(len, self.tokens))
        self._fits: dict[int, bool] = {}

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """The symbols that stand at the right (side 1) or left (0) end of a token while it is
        merged, each with the rank of the merge that ends it."""
        found = self._spines[side].get(token)
        if found is None:
            made = self.made.get(token)
            found = [(token, float("inf"))]
            if made:
                below = self._spine(made[1 + side], side)
                found = [*below[:-1], (below[-1][0], made[0]), *found]
            self._spines[side][token] = found
        return found

    def _apart(self, a: int, b: int, until: float = float("inf")) -> bool:
        """Whether no merge before rank `until` joins a symbol of `a` with one of `b`.

        Both tokens grow side by side; at each moment one symbol of each touches the border. They
        join if that pair's rank comes before the merges that end them (of equal ranks, the left goes first).
        """
        left, right, merges = self._spine(a, 1), self._spine(b, 0), self.merges
        i = j = 0
        while True:
            (x, ends_x), (y, ends_y) = left[i], right[j]
            pair = merges.get((x, y))
            if pair and pair[0] < until and pair[0] < ends_x and pair[0] <= ends_y:
                return False
            if i == len(left) - 1 and j == len(right) - 1:
                return True
            if ends_x <= ends_y:
                i += 1
            else:
                j += 1

    def counts(self, word: bytes) -> list[int]:
        """Token counts of the prefixes of 1, 2, ... bytes."""
        last, count = [-1], [0]
        tokens, fits, longest = self.tokens, self._fits, self.longest
        if len(fits) > 1_500_000:
            fits.clear()
        for i in range(1, len(word) + 1):
            for j in range(i - 1, i - longest - 1 if i > longest else -1, -1):
                t = tokens.get(word[j:i])
                if t is None:
                    continue
                if j:
                    key = last[j] << 17 | t
                    ok = fits.get(key)
                    if ok is None:
                        ok = fits[key] = self._apart(last[j], t)
                    if not ok:
                        continue
                last.append(t)
                count.append(count[j] + 1)
                break
            else:
                raise ValueError(f"no token ends byte {i} of {word!r}")
        return count[1:]
