"""Plain versions of the operators, one text after the other, to compare with on small tables."""

import collections
import hashlib
import re

import numpy as np

from corpusloom.llm import line_chunks, prob_minhash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def contaminated(docs, items, size=10):
    """(id, n_words, n_hit, items) per document."""
    windows = collections.defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1) if n else ():
            windows[tuple(w[i : i + n])].add(item)
    lengths = {len(k) for k in windows}
    out = []
    for key, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[k]
        out.append((key, len(w), len(hit), sorted(str(i) for i in found if i is not None)))
    return out


def without_repeats(texts, window=400):
    """(removed, runs, kept) per text."""
    data = [(t or "").encode() for t in texts]
    counts = collections.Counter(b[i : i + window] for b in data for i in range(len(b) - window + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - window + 1):
            if counts[b[i : i + window]] > 1:
                gone[i : i + window] = True
        kept = bytes(c for c, g in zip(b, gone, strict=False) if not g)
        out.append((int(gone.sum()), int((np.diff(gone.astype(int)) == -1).sum()), kept))
    return out


def classes(docs, least=0.8):
    """id -> lowest id linked to it."""
    root = {k: k for k, _ in docs}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    seen, sets = {}, []
    for key, text in sorted(docs):
        w = prob_minhash.words_of(text)
        same = tuple(w) if w else ("", text or "")
        if same in seen:
            root[find(key)] = find(seen[same])
            continue
        seen[same] = key
        if w:
            n = min(5, len(w))
            sets.append((key, collections.Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))))
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            common = x.keys() & y.keys()
            if 2 * len(common) >= max(len(x), len(y)) * 0.3:
                every = x.keys() | y.keys()
                alike = sum(1 / sum(max(x[e] / x[d], y[e] / y[d]) for e in every) for d in common)
                if alike >= least:
                    low, high = sorted((find(a), find(b)))
                    root[high] = low
    return {k: find(k) for k in root}


def without_chunks(docs):
    """id -> text without chunks of lines that came before."""
    seen, out = set(), {}
    for key, text in sorted(docs):
        kept = []
        cut = line_chunks.chunks(text)
        for k, chunk in enumerate(cut):
            lines = line_chunks.compared(cut, k)
            body = "\n".join(lines)
            if line_chunks.comparable(lines) and body in seen:
                continue
            if line_chunks.comparable(lines):
                seen.add(body)
            kept += chunk
        out[key] = "\n".join(kept)
    return out


def base_facts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed) by their definitions."""
    text = text or ""
    w = SPACED.findall(text)
    runs = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    inside = {i + k for i, r in enumerate(runs) if runs.count(r) > 1 for k in range(3)} if len(set(runs)) < len(runs) else set()
    lines = text.split("\n")
    repeats = sum(bool(SPACED.search(line)) and line in lines[:i] for i, line in enumerate(lines))
    failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), repeats, len(inside), failed


def best_labels(scores, moves):
    """Viterbi by definition, for one sequence."""
    best = [scores[0]]
    came = []
    for s in scores[1:]:
        options = best[-1][:, None] + moves
        came.append(options.argmax(axis=0))
        best.append(options.max(axis=0) + s)
    label = int(best[-1].argmax())
    out = [label]
    for c in reversed(came):
        label = int(c[label])
        out.append(label)
    return out[::-1]


def sha(data):
    return hashlib.sha256(data).hexdigest()
def repaired(rows):
    """(cost, letters, repaired rows) of the cheapest edits of (role, text) rows, every path written out; equal costs: least letters."""
    reads = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
    best, seen = {0: (0, "", ())}, set()
    for role, text in rows:
        body = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
        gone = not body or (role, text) in seen
        late = 3 * (not gone and body[-1] not in ".!?")
        seen.add((role, text))
        after = {}
        for state, (cost, letters, out) in best.items():
            for n in range(4):
                moves = [(state, 4, "D", ())]
                if not gone:
                    moves += [(reads.get((new[:1], state)), 3 * (letter == "R") + late, letter, ((new, text),)) for letter, new in (("K", role), ("R", "user"), ("R", "assistant"))]
                for to, more, letter, row in moves:
                    path = (cost + more, letters + letter, out + row)
                    if to is not None and (to not in after or path[:2] < after[to][:2]):
                        after[to] = path
                new = "assistant" if state == 2 else "user"
                state, cost, letters, out = (3 if state == 2 else 2), cost + 3, letters + "I", (*out, (new, ""))
        best = after
    ends = {0: (), 1: (("user", ""), ("assistant", "")), 2: (("assistant", ""),), 3: ()}
    return min((c + 3 * len(ends[s]), w + "I" * len(ends[s]), out + ends[s]) for s, (c, w, out) in best.items())


def fewest_phrases(text, sample, stretch):
    """Phrases of a greedy parse of `text` by strings of `sample`, or single unknown bytes, stretch by stretch."""
    count = 0
    for at in range(0, len(text), stretch):
        rest = text[at : at + stretch]
        while rest:
            n = 1
            while n < len(rest) and rest[: n + 1] in sample:
                n += 1
            count, rest = count + 1, rest[n:]
    return count


def k_means(vectors, k, rounds):
    """(cluster, squared distance) of each (id, integers), and the centroids, all compared with all."""
    order = sorted(vectors, key=lambda v: (sha(f"1:{'' if v[0] is None else v[0]}".encode()), v[1]))
    centroids = [list(v) for _, v in order[:k]]
    nearest = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        own = collections.defaultdict(list)
        for _, x in vectors:
            own[nearest(x)[1]].append(x)
        for j, xs in own.items():
            centroids[j] = [sum(column) // len(xs) for column in zip(*xs, strict=True)]
    return [nearest(x)[::-1] for _, x in vectors], centroids
