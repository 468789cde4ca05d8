"""A skip-chain conditional random field over the tokens of one document.

Each token that might be personal has states outside, begin and inside (inside for words only).
Neighbouring tokens share a chain potential; distant tokens with the same or nearly the same text
share a skip potential, so evidence at one mention reaches the others. Repeated mentions are linked
each to the next, so n mentions give n - 1 links.

Names are recognised by their surroundings and by how they are written, not by lists of names: a
word enters the scores by its text only if it is everyday vocabulary of the labelled sample, and as
"a word not known, written so" otherwise. A name never seen is therefore scored as any other name.
"""

from __future__ import annotations

import json
import math
import sys
from collections import defaultdict
from dataclasses import dataclass, field

from .pii_lexer import Token, lex_rows

O, B, I = 0, 1, 2  # noqa: E741
NEVER = -1e9
#: Kinds of tokens that are no candidates; they are seen as surroundings only.
_CONTEXT = frozenset(("mark", "line", "number", "code", "url"))
# ---- fixed values: small words inside family names --------------------------------------------
PARTICLES = frozenset("af al bin da de del della den der di dos du el ibn la le les mac of ter van von y zu".split())
#: By definition no part of a name.
TITLES = frozenset("dr frau herr herrn madame miss mlle mme monsieur mr mrs ms prof señor señora sr sra".split())
# ---- end of fixed values ---------------------------------------------------------------------
_OWN_TEXT = frozenset(("word", "mark"))
#: Sweeps over a graph with loops; messages settle long before, this only guarantees an end.
SWEEPS = 200
#: Scores that a process remembers at most.
REMEMBERED = 300_000

Seen = tuple[str, str]


def case(word: str) -> str:
    return "low" if word.islower() else "one" if len(word) == 1 else "cap" if word[1:].islower() else "up" if word.isupper() else "mix"


_PAD: Seen = ("<s>", "-")
_CASES = frozenset(f"<{c}>" for c in ("low", "one", "cap", "up", "mix"))


def word_features(p2: str, p1: str, pc: str, w: str, c: str, n1: str, nc: str, n2: str) -> list[str]:
    """Names of what is true of a word and its surroundings; the first two hold without surroundings."""
    k = "?" if w in _CASES else "="
    return [
        f"c{k}{c}", f"k{k}", f"w={w}|{c}", f"w={w}|p={p1}", f"w={w}|n={n1}", f"c={c}|p={p1}", f"c={c}|n={n1}", f"pp={p2} {p1}", f"nn={n1} {n2}", f"pn={p1} {n1}",
        f"k{k}|p={p1}", f"k{k}|n={n1}", f"k{k}|q={p2}", f"k{k}|m={n2}", f"c={c}|m={n2}", f"k{k}|pp={p2} {p1}", f"k{k}|nn={n1} {n2}", f"k{k}|pn={p1} {n1}", f"s{k}{c}{pc}{nc}", f"s{k}{c}{nc}|p={p1}", f"s{k}{c}{pc}|n={n1}", f"s{k}{c}{nc}|pp={p2} {p1}",
    ]


def shape_features(p2: str, p1: str, kind: str, n1: str) -> list[str]:
    return [f"t={kind}", f"t={kind}|p={p1}", f"t={kind}|pp={p2} {p1}", f"t={kind}|n={n1}", f"t={kind}|pn={p1} {n1}"]


def skip_key(t: Token) -> str | None:
    """Distant tokens with one key are linked: words by their text without case, numbers by digits."""
    if t[2] == "word":
        return t[3].lower() if len(t[3]) > 2 else None
    if t[2].startswith(("doc", "phone")):
        return "".join(ch for ch in t[3].lower() if ch.isalnum())
    return t[3].lower() if t[2].startswith(("addr", "email")) else None


def before(tokens: list[Token], i: int) -> int:
    """The token a name could continue from: the word before, over one hyphen, full stop, comma or apostrophe."""
    j = i - 1
    if j >= 0 and tokens[j][2] == "mark" and tokens[j][3] in "-.,'’":
        if tokens[j][3] == "." and (not j or len(tokens[j - 1][3]) > 2):
            return -1
        j -= 1
    return j if j >= 0 and tokens[j][2] == "word" and tokens[i][2] == "word" else -1


def candidates(tokens: list[Token], seen: list[Seen]) -> list[int]:
    """Shapes, all words with a capital but titles, unknown words in lower case, and particles in front of capitals or unknown words."""
    out = []
    n = len(tokens)
    for i, (norm, c) in enumerate(seen):
        if c == "-":
            if tokens[i][2] not in _CONTEXT:
                out.append(i)
        elif c != "low" or norm == "<low>":
            if norm != "<title>":
                out.append(i)
        elif norm in PARTICLES:
            j = i + 1
            while j < n and j < i + 3 and seen[j][0] in PARTICLES:
                j += 1
            if j < n and (seen[j][1] not in ("-", "low") or seen[j][0] == "<low>"):
                out.append(i)
    return out


def links(tokens: list[Token], nodes: list[int]) -> tuple[list[int], list[tuple[int, int]]]:
    """Per node the node it could continue, or -1; and the skip links between nodes."""
    number = {i: k for k, i in enumerate(nodes)}
    chain = [number.get(before(tokens, i), -1) for i in nodes]
    last: dict[str, int] = {}
    skips = []
    for k, i in enumerate(nodes):
        key = skip_key(tokens[i])
        if key is None:
            continue
        for near in (key, key[:-1]) if tokens[i][2] == "word" and len(key) > 5 and key.endswith("s") else (key,):
            if near in last:
                skips.append((last[near], k))
        last[key] = k
    return chain, skips


@dataclass
class Graph:
    """Candidates of one document: token numbers, scores per state, chain links and skip links (two nodes, known word or not)."""

    nodes: list[int]
    unary: list[list[float]]
    chain: list[int]  # per node: the node just before it in the text, or -1
    skips: list[tuple[int, int, int]]
    sure: list[int] = field(default_factory=list)  # tokens that no message could turn


@dataclass
class Field:
    weights: dict[str, list[float]] = field(default_factory=dict)  # feature -> (begin, inside)
    move: list[list[float]] = field(default_factory=lambda: [[0.0] * 3 for _ in range(3)])
    agree: list[list[float]] = field(default_factory=lambda: [[0.0, 0.0], [0.0, 0.0]])  # unknown, known words: both outside, both personal
    vocabulary: frozenset[str] = frozenset()

    def __post_init__(self) -> None:
        self._views: dict[str, Seen] = {}
        self._scores: dict[tuple, tuple[float, float]] = {}

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.__post_init__()

    def save(self, path: str) -> None:
        kept = {k: [round(x, 2) for x in v] for k, v in sorted(self.weights.items()) if max(map(abs, v)) >= 0.1}
        with open(path, "w") as f:
            json.dump({"weights": kept, "move": self.move, "agree": self.agree, "vocabulary": sorted(self.vocabulary)}, f, ensure_ascii=False, separators=(",", ":"))

    @classmethod
    def load(cls, path: str) -> Field:
        with open(path) as f:
            stored = json.load(f)
        return cls(stored["weights"], stored["move"], stored["agree"], frozenset(stored["vocabulary"]))

    def view(self, t: Token) -> Seen:
        """(text as scores see it, case); ("<kind>", "-") for tokens that are no words, marks as they are."""
        if t[2] not in _OWN_TEXT:
            return (f"<{t[2].split('_')[0]}>", "-")
        got = self._views.get(t[3])
        if got is None:
            low, c = t[3].lower(), case(t[3]) if t[2] == "word" else "-"
            if len(self._views) > REMEMBERED:
                self._views.clear()
            got = self._views[t[3]] = ("<title>" if low in TITLES else sys.intern(low) if c == "-" or low in self.vocabulary else f"<{c}>", c)
        return got

    def score(self, kind: str, p2: Seen, p1: Seen, own: Seen, n1: Seen, n2: Seen) -> tuple[float, float]:
        key = (kind, p2, p1, own, n1, n2)
        got = self._scores.get(key)
        if got is None:
            names = word_features(p2[0], p1[0], p1[1], own[0], own[1], n1[0], n1[1], n2[0]) if kind == "word" else shape_features(p2[0], p1[0], kind, n1[0])
            b = n = 0.0
            for name in names:
                if w := self.weights.get(name):
                    b += w[0]
                    n += w[1]
            if len(self._scores) > REMEMBERED:
                self._scores.clear()
            got = self._scores[key] = (b, n)
        return got

    def graph(self, tokens: list[Token]) -> Graph:
        view, score, views, known_scores = self.view, self.score, self._views, self._scores
        kinds = {k: (f"<{k.split('_')[0]}>", "-") for k in {t[2] for t in tokens}}
        seen = [(views.get(t[3]) or view(t)) if t[2] in _OWN_TEXT else kinds[t[2]] for t in tokens]
        nodes = candidates(tokens, seen)
        padded = [_PAD, _PAD, *seen, _PAD, _PAD]
        # Scores go with what is seen, and that repeats: a dictionary answers most of them.
        around = [(tokens[i][2], padded[i], padded[i + 1], padded[i + 2], padded[i + 3], padded[i + 4]) for i in nodes]
        scores = [known_scores.get(x) or score(*x) for x in around]
        # Only what could be personal in the best surroundings, or has such a mention elsewhere, needs messages.
        begin, inside, floor = self._bounds()
        hopes = [b + begin > floor or n + inside > floor for b, n in scores]
        if True not in hopes:
            return Graph([], [], [], [])
        keys = {skip_key(tokens[i]) for i, h in zip(nodes, hopes, strict=True) if h} - {None}
        keys |= {f"{k}s" for k in keys} | {k[:-1] for k in keys if k.endswith("s")}
        kept = [k for k, i in enumerate(nodes) if hopes[k] or (keys and skip_key(tokens[i]) in keys)]
        nodes, scores = [nodes[k] for k in kept], [scores[k] for k in kept]
        chain, skips = links(tokens, nodes)
        # A name goes on only from the token before it.
        unary = [[0.0, b, n if chain[k] >= 0 else NEVER] for k, (b, n) in enumerate(scores)]
        return self._reduced(Graph(nodes, unary, chain, [(a, b, int(seen[nodes[b]][0] not in _CASES)) for a, b in skips]))

    def _gains(self) -> tuple[list[float], float, list[float]]:
        """What the neighbour before and the one after add at most, and which score a mention must exceed to help others."""
        into = [max(self.move[a][s] - self.move[a][O] for a in range(3)) for s in range(3)]
        onward = max(self.move[s][a] - self.move[O][a] for s in (B, I) for a in range(3))
        weakest = []
        for both_out, both_in in self.agree:
            gain = (math.exp(both_out) - 1) / max(1e-9, math.exp(both_in) - 1)
            weakest.append(min(0.0, math.log(max(1e-9, gain))))
        return into, onward, weakest

    def _bounds(self) -> tuple[float, float, float]:
        into, onward, weakest = self._gains()
        return into[B] + onward, into[I] + onward, min(weakest)

    def _reduced(self, g: Graph) -> Graph:
        """Fixes outside, and takes from the graph, what no state of its neighbours could make personal.

        A chain neighbour adds at most the greatest difference in ``move``; a skip link helps only if
        some mention in its group could be personal, or their weak evidence could add up.
        """
        n = len(g.nodes)
        into, onward, weakest = self._gains()
        group = list(range(n))

        def root(k: int) -> int:
            while group[k] != k:
                group[k] = group[group[k]]
                k = group[k]
            return k

        floor = [0.0] * n
        for a, b, known in g.skips:
            ra, rb = root(a), root(b)
            group[max(ra, rb)] = min(ra, rb)
            floor[min(ra, rb)] = min(floor[ra], floor[rb], weakest[known])
        after = [-1] * n
        for k, a in enumerate(g.chain):
            if a >= 0:
                after[a] = k
        alive = [True] * n
        while True:
            hope = set()
            for k, u in enumerate(g.unary):
                if alive[k]:
                    a, z = g.chain[k], after[k]
                    best = max(u[s] + (into[s] if a >= 0 and alive[a] else self.move[O][s] - self.move[O][O]) for s in (B, I))
                    best += onward if z >= 0 and alive[z] else max(self.move[s][O] for s in (B, I)) - self.move[O][O]
                    r = root(k)
                    if best > floor[r]:
                        hope.add(r)
            gone = [k for k in range(n) if alive[k] and root(k) not in hope]
            for k in gone:
                alive[k] = False
            if not gone:
                break
        # A shape whose score outweighs all that its links can say against it needs no messages.
        against = [0] * n
        for a, b, _ in g.skips:
            against[a] += 1
            against[b] += 1
        most = max(o for o, _ in self.agree)
        open_groups = {root(k) for k, u in enumerate(g.unary) if alive[k] and (u[I] > NEVER or g.chain[k] >= 0 or after[k] >= 0 or not u[B] + self.move[O][B] + self.move[B][O] - 2 * self.move[O][O] - most * against[k] > 0)}
        settled = [k for k in range(n) if alive[k] and root(k) not in open_groups]
        for k in settled:
            alive[k] = False
        kept = [k for k in range(n) if alive[k]]
        at = {k: x for x, k in enumerate(kept)}
        unary = []
        for k in kept:
            # Both ends of a name pay for their move, also where the neighbour is outside or no candidate.
            u, z = list(g.unary[k]), after[k]
            if g.chain[k] not in at:
                u = [x + self.move[O][s] for s, x in enumerate(u)]
                u[I] = NEVER
            if z not in at:
                u = [x + self.move[s][O] for s, x in enumerate(u)]
            unary.append(u)
        sure = [g.nodes[k] for k in settled]
        return Graph([g.nodes[k] for k in kept], unary, [at.get(g.chain[k], -1) for k in kept], [(at[a], at[b], known) for a, b, known in g.skips if a in at and b in at], sure)

    def marginals(self, g: Graph) -> list[list[float]]:
        """Sum-product per connected part: exact in one sweep there and back along a chain, loopy where skips join."""
        same = [[[o, 0.0, 0.0], [0.0, p, p], [0.0, p, p]] for o, p in self.agree]
        out: list[list[float]] = [[]] * len(g.nodes)
        part = list(range(len(g.nodes)))

        def root(k: int) -> int:
            while part[k] != k:
                part[k] = part[part[k]]
                k = part[k]
            return k

        edges = [(a, b, self.move, False) for b, a in enumerate(g.chain) if a >= 0] + [(a, b, same[known], True) for a, b, known in g.skips]
        for a, b, _, _ in edges:
            ra, rb = root(a), root(b)
            part[max(ra, rb)] = min(ra, rb)
        parts = defaultdict(list)
        for e in sorted(edges, key=lambda e: (e[1], e[0])):
            parts[root(e[0])].append(e)
        for k in range(len(g.nodes)):
            if root(k) == k and k not in parts:
                out[k] = g.unary[k]
        for mine in parts.values():
            self._pass(g.unary, mine, out)
        return [_normal(s) for s in out]

    @staticmethod
    def _pass(unary: list[list[float]], edges: list[tuple], out: list[list[float]]) -> None:
        """Scores of the nodes of one connected part, into ``out``."""
        at = defaultdict(list)
        for e, (a, b, _, _) in enumerate(edges):
            at[a].append((e, 0))
            at[b].append((e, 1))
        msg = [[(0.0, 0.0, 0.0), (0.0, 0.0, 0.0)] for _ in edges]  # to the first end, to the second end
        loopy = any(e[3] for e in edges)
        for _ in range(SWEEPS if loopy else 1):
            moved = 0.0
            for order, end in ((range(len(edges)), 1), (range(len(edges) - 1, -1, -1), 0)):
                for e in order:
                    a, b, pot, skip = edges[e]
                    source = a if end else b
                    x0, x1, x2 = unary[source]
                    for f, side in at[source]:
                        if f != e:
                            m = msg[f][side]
                            x0 += m[0]
                            x1 += m[1]
                            x2 += m[2]
                    if skip:  # only outside or personal matters: two sums instead of nine
                        p = x1 + math.log1p(math.exp(x2 - x1)) if x1 >= x2 else x2 + math.log1p(math.exp(x1 - x2))
                        y0, y1 = _lse2(x0 + pot[0][0], p), _lse2(x0, p + pot[1][1])
                        new = (0.0, y1 - y0, y1 - y0)
                    else:
                        rows = (pot[0], pot[1], pot[2])
                        if end:
                            y0, y1, y2 = (_lse(x0 + rows[0][t], x1 + rows[1][t], x2 + rows[2][t]) for t in (0, 1, 2))
                        else:
                            y0, y1, y2 = (_lse(x0 + r[0], x1 + r[1], x2 + r[2]) for r in rows)
                        new = (0.0, y1 - y0, y2 - y0)
                    if loopy:
                        old = msg[e][end]
                        moved = max(moved, abs(new[1] - old[1]), abs(new[2] - old[2]) if new[2] > -50 or old[2] > -50 else 0.0)
                    msg[e][end] = new
            if moved < 1e-3:
                break
        for k, mine in at.items():
            x0, x1, x2 = unary[k]
            for e, side in mine:
                m = msg[e][side]
                x0, x1, x2 = x0 + m[0], x1 + m[1], x2 + m[2]
            out[k] = [x0, x1, x2]

    def spans(self, text: str) -> list[tuple[int, int, str, str]]:
        """(start, end, kind of the first token, text), in order, not overlapping."""
        tokens = lex_rows(text)
        g = self.graph(tokens)
        out: list[list] = []
        states = [max(range(3), key=m.__getitem__) for m in self.marginals(g)]
        for k, i in enumerate(g.nodes):
            t = tokens[i]
            if states[k] == O:
                continue
            if states[k] == I and out and g.chain[k] >= 0 and states[g.chain[k]] != O and out[-1][3] == g.chain[k]:
                out[-1][1], out[-1][3] = t[1], k
            else:
                out.append([t[0], t[1], t[2], k])
        out += [[tokens[i][0], tokens[i][1], tokens[i][2], -1] for i in g.sure]
        out.sort(key=lambda x: x[0])
        return [(s, stop := _stop(text, s, e, kind), kind, text[s:stop]) for s, e, kind, _ in out]


def _stop(text: str, start: int, end: int, kind: str) -> int:
    """A name that ends with an initial takes the initial's full stop."""
    if kind == "word" and text[end : end + 1] == "." and end - start > 1 and not text[end - 2].isalnum():
        return end + 1
    return end


def _lse(x: float, y: float, z: float) -> float:
    top = x if x >= y else y
    if z > top:
        top = z
    return top + math.log(math.exp(x - top) + math.exp(y - top) + math.exp(z - top)) if top > -1e8 else top


def _lse2(x: float, y: float) -> float:
    return x + math.log1p(math.exp(y - x)) if x >= y else y + math.log1p(math.exp(x - y))


def _normal(s: list[float]) -> list[float]:
    top = max(s)
    e = [math.exp(max(x - top, -700)) for x in s]
    z = sum(e)
    return [x / z for x in e]
