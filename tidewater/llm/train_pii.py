"""Fits the field for personal information on a bounded sample of labelled documents.

    python -m tidewater.llm.train_pii FOLDER [LABELS]

The sample is every fifth document of the folder, at most SAMPLE_DOCUMENTS of them, whole. LABELS is
a JSON file of spans per document id: {"5": [["NAME", 12, 25], ...], ...}; documents without an entry
hold nothing personal. pii_labels.json holds the labels of the sample of sf0.1. Fitting maximises the likelihood per node given its neighbours
(pseudo-likelihood) by stochastic gradient steps. In each pass the field sees the sample differently:

* words of the vocabulary are hidden at random, so it learns what surrounds a word it does not know;
* names are read as everyday words at random, so surroundings can win over a word's text;
* names change their case, and get initials, particles and second family names at random;
* surroundings end early, or begin otherwise, at random;
* some repeated mentions are read without their surroundings, so it learns to trust the others.
"""

from __future__ import annotations

import json
import math
import random
import sys
from collections import Counter
from pathlib import Path

from .pii_field import _CASES, _PAD, B, Field, I, O, candidates, links, shape_features, word_features
from .pii_lexer import TYPES, Token, lex

#: Documents of the sample: the documented bound of what is fitted on.
SAMPLE_DOCUMENTS = 2_000
EVERY = 5
PASSES = 12
#: A word is vocabulary if that many documents of the sample use it outside of names.
VOCABULARY_DOCUMENTS = 2
RATE, DECAY = 0.2, 1e-4
#: Bounds of the skip potentials (both outside, both personal), of unknown and of known words: mentions
#: can hardly talk each other out of a name, and everyday words, which are repeated often, not into one.
MOST_AGREE = ((1.0, 7.0), (1.0, 2.0))
HIDDEN, RENAMED, BARE = 0.15, 0.1, 0.8
CUT = 0.08
LOWERED, RAISED, LONGER = 0.15, 0.05, 0.25
# ---- fixed values: what stands between the parts of a person's name ---------------------------
PARTICLES = (("de",), ("van", "der"), ("von",), ("van",), ("la",), ("di",), ("del",), ("mac",), ("St", "."), ("O", "'"))
# ---- end of fixed values ---------------------------------------------------------------------
WEIGHTS = Path(__file__).with_name("pii_weights.json")
LABELS = Path(__file__).with_name("pii_labels.json")


def sample(folder: str, remainder: int = 0) -> list[tuple[int, str]]:
    import pyarrow.parquet as pq

    rows = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).sort_by("doc_id").to_pylist()
    return [(r["doc_id"], r["text"]) for r in rows if r["doc_id"] % EVERY == remainder and r["text"] and r["text"].strip()][:SAMPLE_DOCUMENTS]


def states(tokens: list[Token], spans: list[list]) -> list[int]:
    """States of the tokens by labelled spans."""
    out, todo = [O] * len(tokens), sorted(spans, key=lambda s: s[1])
    at = 0
    for i, t in enumerate(tokens):
        while at < len(todo) and todo[at][2] <= t.start:
            at += 1
        if at == len(todo) or t.end <= todo[at][1]:
            continue
        kind, start, end = todo[at]
        mine = TYPES.get(t.kind.split("_")[0])
        if mine == kind and start <= t.start and t.end <= end + 1 and (kind == "NAME" or (t.start, t.end) == (start, end)):
            out[i] = B if t.start == start else I
    return out


def vocabulary(documents: list[tuple[list[Token], list[int]]]) -> frozenset[str]:
    used: Counter[str] = Counter()
    for tokens, gold in documents:
        used.update({t.text.lower() for t, y in zip(tokens, gold, strict=True) if t.kind == "word" and y == O})
    return frozenset(w for w, n in used.items() if n >= VOCABULARY_DOCUMENTS)


def lengthened(tokens: list[Token], gold: list[int], rng: random.Random) -> tuple[list[Token], list[int]]:
    """The tokens with initials, particles or second family names put into some names."""
    out, states_ = [], []
    for i, (t, y) in enumerate(zip(tokens, gold, strict=True)):
        word = lambda text: Token(t.start, t.start, "word" if text.isalpha() else "mark", text)  # noqa: B023, E731
        first_of_last = t.kind == "word" and y == I and len(t.text) > 2 and (i + 1 == len(tokens) or gold[i + 1] != I)
        single = t.kind == "word" and y == B and len(t.text) > 2 and (i + 1 == len(tokens) or gold[i + 1] != I)
        if (first_of_last or single) and rng.random() < LONGER:
            if first_of_last and rng.random() < 0.4:
                parts = [rng.choice("ABCDEFGHIJKLMNOPRSTVW"), "."]
            else:
                parts = list(rng.choice(PARTICLES))
            begins = y == B
            for part in parts:
                out.append(word(part))
                states_.append(O if not part.isalpha() else B if begins else I)
                begins = begins and not part.isalpha()
            if rng.random() < 0.1:
                out.append(t)
                states_.append(I)
                out.append(word("-"))
                states_.append(O)
            y = I
        out.append(t)
        states_.append(y)
        if t.kind == "word" and y == B and len(t.text) > 2 and i + 1 < len(tokens) and gold[i + 1] == I and rng.random() < LONGER / 4:
            out += [word("-"), t]  # a double given name
            states_ += [O, I]
    return out, states_


def disguised(model: Field, tokens: list[Token], gold: list[int], words: list[str], rng: random.Random) -> list[tuple[str, str]]:
    """The tokens as seen in this pass: some words hidden, some names read as everyday words."""
    named = {t.text.lower() for t, y in zip(tokens, gold, strict=True) if t.kind == "word" and y != O}
    swapped: dict[str, str | None] = {}
    style = rng.random()
    style = "low" if style < LOWERED else "up" if style < LOWERED + RAISED else None
    out = []
    for t, y in zip(tokens, gold, strict=True):
        norm, c = model.view(t)
        if c != "-" and norm != "<title>":
            low = t.text.lower()
            if style and y != O and (c == "cap" or c == "one" and style == "low"):
                c = style
            if low not in swapped:
                swapped[low] = rng.choice(words) if low in named and style != "low" and rng.random() < RENAMED else f"<{c}>" if low not in named and rng.random() < HIDDEN else None
            norm = swapped[low] or norm
            if norm in _CASES:
                norm = f"<{c}>"
        out.append((norm, c))
    return out


def fit(documents: list[tuple[list[Token], list[int]]], passes: int = PASSES, seed: int = 11) -> Field:
    rng, model = random.Random(seed), Field()
    model = Field(vocabulary=vocabulary(documents))
    capitals = {t.text.lower() for tokens, _ in documents for t in tokens if t.kind == "word" and not t.text.islower()}
    words = sorted(w for w in model.vocabulary if w in capitals and len(w) > 3)
    w, move, agree = model.weights, model.move, model.agree
    past: dict[str, list[float]] = {}
    past_move, past_agree = [[1.0] * 3 for _ in range(3)], [[1.0] * 2 for _ in range(2)]

    def step(values: list[float], at: int, slope: float, seen_slopes: list[float], rate: float = RATE) -> None:
        seen_slopes[at] += slope * slope  # adaptive: what is rarely seen moves further at a time
        values[at] += rate * slope / math.sqrt(seen_slopes[at])

    documents = list(documents)
    for _ in range(passes):
        rng.shuffle(documents)
        for tokens, gold_all in documents:
            tokens, gold_all = lengthened(tokens, gold_all, rng)  # noqa: PLW2901
            seen = disguised(model, tokens, gold_all, words, rng)
            nodes = candidates(tokens, seen)
            chain, skip_links = links(tokens, nodes)
            gold = [gold_all[i] for i in nodes]
            after = [-1] * len(nodes)
            for k, a in enumerate(chain):
                if a >= 0:
                    after[a] = k
            skips: list[list[int]] = [[] for _ in nodes]
            for a, b in skip_links:
                skips[a].append(b)
                skips[b].append(a)
            padded = [_PAD, _PAD, *seen, _PAD, _PAD]
            for k, i in enumerate(nodes):
                (p2, _), (p1, pc), (own, c), (n1, nc), (n2, _) = padded[i : i + 5]
                word = tokens[i].kind == "word"
                cut = rng.random()
                if cut < CUT:
                    p2 = rng.choice(("<s>", "<line>", ".", ",", ";", ":", "-", "<low>", "<number>"))
                elif cut < 2 * CUT:
                    n1 = rng.choice(("<s>", "."))
                    nc, n2 = "-", "<s>"
                names = word_features(p2, p1, pc, own, c, n1, nc, n2) if word else shape_features(p2, p1, tokens[i].kind, n1)
                if word and own in _CASES and skips[k] and rng.random() < BARE:
                    names = names[:2]
                known = int(own not in _CASES)
                a, z = chain[k], after[k]
                options = (O, B, I) if word and a >= 0 else (O, B)
                prior, follow = (gold[a] if a >= 0 else O), (gold[z] if z >= 0 else O)
                s = [0.0, 0.0, 0.0]
                for name in names:
                    if v := w.get(name):
                        s[1] += v[0]
                        s[2] += v[1]
                for y in options:
                    s[y] += move[prior][y] + move[y][follow]
                    s[y] += sum((agree[known][0] if y == O else agree[known][1]) for x in skips[k] if (gold[x] == O) == (y == O))
                top = max(s[y] for y in options)
                e = {y: math.exp(s[y] - top) for y in options}
                total = sum(e.values())
                for y in options:
                    d = (y == gold[k]) - e[y] / total
                    if abs(d) < 1e-3:
                        continue
                    if y:
                        for name in names:
                            v = w.setdefault(name, [0.0, 0.0])
                            step(v, y - 1, d - DECAY * v[y - 1], past.setdefault(name, [0.1, 0.1]))
                    step(move[prior], y, d, past_move[prior])
                    step(move[y], follow, d, past_move[y])
                    hits = sum((gold[x] == O) == (y == O) for x in skips[k])
                    if hits:
                        side = 0 if y == O else 1
                        step(agree[known], side, d * hits, past_agree[known], 8 * RATE)
                        agree[known][side] = min(MOST_AGREE[known][side], max(0.0, agree[known][side]))
    return model


def labelled(rows: list[tuple[int, str]], labels: dict[str, list]) -> list[tuple[list[Token], list[int]]]:
    out = []
    for doc, text in rows:
        tokens = lex(text)
        out.append((tokens, states(tokens, labels.get(str(doc), []))))
    return out


if __name__ == "__main__":
    folder, labels_path = sys.argv[1], (sys.argv[2] if len(sys.argv) > 2 else LABELS)
    fitted = fit(labelled(sample(folder), json.loads(Path(labels_path).read_text())))
    fitted.save(str(WEIGHTS))
    print("agree", fitted.agree, "move", fitted.move, "features", len(fitted.weights), "vocabulary", len(fitted.vocabulary))
